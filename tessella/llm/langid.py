"""Language ID by rank-order profiles.

A language's profile is the ranked list of its most frequent character n-grams (one to three
characters of words in lower case, letters only, word ends marked). A document's own ranked list is
compared to each profile by the out-of-place distance: the sum of rank differences, or the greatest
rank for an n-gram the profile lacks. The nearest profile wins (ties: the lesser language name).

Profiles are fitted on a bounded sample: of each language at most ``sample`` documents with the
least hashes of (id, text), counted over their whole texts, and hold ``PROFILE`` n-grams; more than
``LANGUAGES`` languages are refused. Every document is predicted over its whole text in one pass
without a shuffle. Texts are taken apart with numpy, a slice of an Arrow batch at a time: an n-gram
is one 64-bit number whose order is the code-point order of its characters.

Defined cases: a null text or one without a letter (Unicode category L) is ``und`` with score 0;
without labelled documents every prediction is ``und``; a text none of whose n-grams a profile knows
gets score 0 and the first language; null ids are hashed as null (they train); repeated rows train
once; an empty table gives no rows; only the id, text and label columns are read, the label and id
never in a prediction.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import in_batches, slices, small

PROFILE = 400
SAMPLE = 400
LANGUAGES = 1000
UND = "und"
#: Cells in which the n-grams of a language are ranked before their best are merged.
CELLS = 64
#: A prefilter leaves about so many times the sample of each language to choose from.
SPARE = 4
#: Longer texts are counted in pieces that end at a word's end. A character takes about 80 bytes while it is counted.
PIECE_CHARS = 500_000
SLICE_BYTES = 2**20
NO_LETTER = re.compile(r"[\W\d_]")
#: The number of the mark at both ends of a word; less than any lower-case letter's, as "_" is.
END = 1
BITS = 21


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_key(gram: str) -> int:
    """The number of an n-gram; "_" is the mark of a word's end."""
    key = 0
    for i in range(3):
        key = key << BITS | (0 if i >= len(gram) else END if gram[i] == "_" else ord(gram[i]))
    return key


def key_gram(key: int) -> str:
    """The n-gram of a number."""
    codes = [key >> shift & (1 << BITS) - 1 for shift in (2 * BITS, BITS, 0)]
    return "".join("_" if c == END else chr(c) for c in codes if c)


def pieces_of(text: str) -> list[str]:
    """A text composed (NFC) and in lower case, in pieces of about ``PIECE_CHARS`` that end where a word does."""
    text = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower()
    out, at = [], 0
    while len(text) - at > PIECE_CHARS:
        end = NO_LETTER.search(text, at + PIECE_CHARS)
        if not end:
            break
        out.append(text[at : end.start()])
        at = end.start()
    return [*out, text[at:]] if out else [text]


def piece_grams(pieces: list[str]) -> Iterator[np.ndarray]:
    """The n-grams of each piece, in no order, as often as they occur."""
    lens = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 2
    chars = np.frombuffer("".join(f" {p} " for p in pieces).encode("utf-32-le"), dtype=np.uint32)
    letter = _letters()[chars]
    begin = np.cumsum(lens) - lens
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of other characters the first one marks the end of a word
    keep[begin] = True
    code = np.where(letter, chars, np.uint32(END))[keep].astype(np.int64)
    letter = letter[keep]
    ends = np.cumsum(np.add.reduceat(keep, begin, dtype=np.int64)) if len(pieces) else begin
    grams = []
    for n, wanted in ((1, letter), (2, letter[:-1] | letter[1:]), (3, letter[1:-1])):
        at = np.flatnonzero(wanted)
        key = code[at] << 2 * BITS
        for i in range(1, n):
            key |= code[at + i] << (2 - i) * BITS
        grams.append((key, np.searchsorted(at, ends).tolist()))
    last = [0, 0, 0]
    for i in range(len(pieces)):
        yield np.concatenate([key[a : upto[i]] for (key, upto), a in zip(grams, last)])
        last = [upto[i] for _, upto in grams]


def counted(grams: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order and their counts, over the pieces of one text or more."""
    keys, counts = zip(*(np.unique(g, return_counts=True) for g in grams))
    if len(keys) == 1:
        return keys[0], counts[0]
    which, at = np.unique(np.concatenate(keys), return_inverse=True)
    return which, np.bincount(at, weights=np.concatenate(counts), minlength=len(which)).astype(np.int64)


def text_counts(texts: list[str | None]):
    """(n-grams, counts) of each whole text; nulls have none."""
    pieces = [pieces_of(t or "") for t in texts]
    if sum(map(len, pieces)) == len(pieces):
        yield from (counted([g]) for g in piece_grams([ps[0] for ps in pieces]))
    else:  # a very long text's pieces are counted one by one
        yield from (counted(g for p in ps for g in piece_grams([p])) for ps in pieces)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, ties in code-point order; ``keys`` are in that order."""
    if len(keys) > most:
        at = np.flatnonzero(counts >= np.partition(counts, len(counts) - most)[len(counts) - most])
        keys, counts = keys[at], counts[at]
    return keys[np.argsort(-counts, kind="stable")[:most]]


class Profiles:
    """Language profiles ready for out-of-place distances: the rank of each n-gram in each language."""

    def __init__(self, profiles: dict[str, list[str]]):
        self.names = sorted(profiles)
        self.keys = np.array(sorted({gram_key(g) for grams in profiles.values() for g in grams}), dtype=np.int64)
        self.rank = np.full((len(self.keys) + 1, len(self.names)), -1, dtype=np.int64)  # the last row: known to none
        for i, name in enumerate(self.names):
            self.rank[np.searchsorted(self.keys, [gram_key(g) for g in profiles[name]]), i] = np.arange(len(profiles[name]))

    def nearest(self, keys: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        """(language, score) of a text's n-grams; the score is 1 less the distance as a share of the greatest one."""
        if not len(keys) or not len(self.keys):
            return UND, 0.0
        top = ranked(keys, counts)
        at = np.minimum(np.searchsorted(self.keys, top), len(self.keys) - 1)
        rank = self.rank[np.where(self.keys[at] == top, at, len(self.keys))]
        distance = np.where(rank >= 0, np.abs(rank - np.arange(len(top))[:, None]), PROFILE).sum(axis=0)
        best = int(np.argmin(distance))
        return self.names[best], 1.0 - float(distance[best]) / (PROFILE * len(top))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score) of one text."""
        return self.nearest(*next(text_counts([text])))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _least_draws(drawn: DataFrame, sample: int) -> DataFrame:
    """``d_lang, most``: the hash up to which a language's rows are its sample, from (lang, draw) rows.

    Rows are counted first; the hashes are even, so a share of their range leaves about ``SPARE`` times the
    sample, of which the least are taken.
    """
    share = F.lit(float(SPARE * sample)) / F.count("*")
    limits = drawn.groupBy(F.col("lang").alias("d_lang")).agg(share.alias("share"))
    bound = F.when(F.col("share") < 1, F.lit(-(2.0**63)) + F.col("share") * F.lit(2.0**64)).otherwise(F.lit(2.0**64))
    some = drawn.join(small(limits), F.col("lang") == F.col("d_lang")).filter(F.col("draw").cast("double") <= bound).select("lang", "draw").distinct()
    return some.groupBy(F.col("lang").alias("d_lang")).agg(F.array_max(F.slice(F.array_sort(F.collect_list("draw")), 1, sample)).alias("most"))


def fit_profiles(labelled: DataFrame, sample: int = SAMPLE) -> dict[str, list[str]]:
    """Profiles from (id, text, lang) rows; a language reaches the driver as PROFILE n-grams only.

    No task ranks a whole language: n-grams are counted by a pre-aggregated group-by and ranked in ``CELLS``
    cells of a language, of which each sends one row of its best.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("draw", F.xxhash64("id", "text"))
    limits = _least_draws(rows.select("lang", "draw"), sample)
    chosen = rows.join(small(limits), F.col("lang") == F.col("d_lang")).filter(F.col("draw") <= F.col("most"))

    def run(batches):
        for batch in slices(batches, 0, SLICE_BYTES):
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            per_text = list(text_counts(batch.column(0).to_pylist()))
            for lang in sorted(set(langs)):
                keys, counts = zip(*(per_text[i] for i in np.flatnonzero(langs == lang)))
                which, at = np.unique(np.concatenate(keys), return_inverse=True)
                total = np.bincount(at, weights=np.concatenate(counts), minlength=len(which)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(which), pa.string()), pa.array(which), pa.array(total)], names=["lang", "gram", "n"])

    once = chosen.dropDuplicates(["id", "draw"]).select("text", "lang")
    counts = in_batches(once).mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = lambda entries: F.slice(F.array_sort(entries), 1, PROFILE)
    cells = counts.groupBy("lang", F.pmod(F.xxhash64("gram"), F.lit(CELLS)).alias("cell")).agg(best(F.collect_list(F.struct((-F.col("n")).alias("less"), "gram"))).alias("top"))
    found = cells.groupBy("lang").agg(best(F.flatten(F.collect_list("top"))).alias("top")).limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages among the labels")
    return {r.lang: [key_gram(e.gram) for e in r.top] for r in found}


def with_language(rows: DataFrame, profiles: dict[str, list[str]], text_col: str = "text") -> DataFrame:
    """``rows`` with ``lang_pred`` and ``score`` added, in one pass over whole rows."""
    at = rows.columns.index(text_col)

    def run(batches):
        model = Profiles(profiles)
        for batch in slices(batches, at, SLICE_BYTES):
            found = [model.nearest(*grams) for grams in text_counts(batch.column(at).to_pylist())]
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return in_batches(rows).mapInArrow(run, schema)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """``id, held_out, lang_pred, score`` of every document, learned from those not held out."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    profiles = fit_profiles(rows.filter(~held_out(F.col("id"))), sample)
    return with_language(rows.select("id", "text"), profiles).select("id", held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def language_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`identify_languages`."""
    return identify_languages(docs).withColumnRenamed("id", "doc_id")
