"""Fill-in-middle: texts cut at two unit boundaries and their parts put in another order.

A unit is a word with the white space before it, or white space at the end. An Arrow-batched pandas UDF finds
the ends of a text's units with the regex library, keeps them in one compact array and cuts the text by two
lookups there; hashlib draws the places and the form from the document's id, so a rerun or a retried task
gives the same rows. A text that holds a sentinel stays plain, so the parts can always be told apart again.

Defined cases: a null text is an empty one, which is plain; a null id is drawn as an empty one; rows are
worked off one by one, so repeated rows give repeated results and an empty table gives none; only the id and the
text are read, so further columns are not carried on, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import in_batches

UNIT = regex.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: Sentinels before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIELDS = "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits for a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def unit_ends(text: str) -> array:
    """Where the units of a text end."""
    return array("Q", (m.end() for m in UNIT.finditer(text)))


def transformed(text: str, numbers: list[int], rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of a text."""
    ends = unit_ends(text)
    if not text or numbers[2] % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return len(ends), PLAIN, None, None, text
    places = sorted(number % (len(ends) + 1) for number in numbers[:2])
    first, second = (ends[place - 1] if place else 0 for place in places)
    prefix, middle, suffix = PREFIX + text[:first], MIDDLE + text[first:second], SUFFIX + text[second:]
    form = SPM if numbers[3] % 100 < spm_rate else PSM
    return len(ends), form, first, second - first, (suffix + prefix if form == SPM else prefix + suffix) + middle


def restored(output: str, form: str) -> str:
    """The text that an output was made of."""
    if form == PLAIN:
        return output
    outer, _, middle = output.partition(MIDDLE)
    if form == SPM:
        suffix, _, prefix = outer.removeprefix(SUFFIX).partition(PREFIX)
    else:
        prefix, _, suffix = outer.removeprefix(PREFIX).partition(SUFFIX)
    return prefix + middle + suffix


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, id_col: str = "doc_id", text_col: str = "text", with_output: bool = True) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` and the ``output`` itself.

    ``rate`` per cent of the documents are transformed, ``spm_rate`` per cent of these into the form that
    starts with the suffix. Without ``with_output`` the texts stay in the workers.
    """

    @F.pandas_udf(FIELDS + ", output string" * with_output)
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            rows = []
            for doc_id, text in zip(ids, texts):
                *facts, output = transformed(text, draws(seed, int(doc_id) if doc_id else None), rate, spm_rate)
                rows.append((*facts, _sha256(output), _sha256(restored(output, facts[1])), *[output] * with_output))
            frame = pd.DataFrame(rows, columns=[field.split()[0] for field in FIELDS.split(", ")] + ["output"] * with_output)
            yield frame.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    # The id goes as text: pandas would turn a column of longs with a null into doubles.
    made = cut(F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce(F.col("body"), F.lit(""))).alias("made")
    narrow = in_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body")))
    return narrow.select(F.col("id").alias("doc_id"), made).select("doc_id", "made.*")


def fim_digest(docs: DataFrame) -> DataFrame:
    """The contract's row of each document."""
    return fill_in_middle(docs, with_output=False)


_HEX = "CAST(('0x' || substr(h, {at}, 8)) AS BIGINT)"
ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units,
      {", ".join(f"{_HEX.format(at=1 + 8 * i)} AS h{i + 1}" for i in range(4))} FROM t),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
           WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
      coalesce(array_to_string(units[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
