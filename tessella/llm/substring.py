"""Substring dedup by difference-cover anchors.

A window is ``WINDOW`` consecutive words; it is removed where the same words also start earlier. Only
positions whose remainder modulo ``PERIOD`` lies in the difference cover are hashed (4 of 13), over
``ANCHOR = WINDOW - PERIOD + 1`` words: for any two offsets some shift below the period puts both in the
cover, so two equal windows share an aligned anchor inside them.

1. Equal texts are classes: every window of a later copy starts earlier in the first one, so only the
   first goes on.
2. Anchors are deduplicated per slice of an Arrow batch and shuffled by hash; an anchor seen more than
   once marks the windows around it as candidates. A passage in very many documents is shipped once a slice.
3. Matches are extended to whole windows: candidate windows are hashed over all their words, by two
   independent 64-bit hashes of each word, again one a slice, sorted by (both hashes, document, start),
   and all but the first are repeats. Two of 10^13 different windows agree in 128 bits with a
   probability of about 10^-13; an anchor's 64 bits only choose candidates.

Every exchange carries numbers only; candidate and repeat runs come back to the texts per document,
broadcast up to the bounds of :func:`~tessella.llm.common.small` and by a shuffle join beyond. Sorted partitions are
streamed, so no group is held in memory.

Defined cases: a null or empty text has no words; fewer than WINDOW words lose none; documents are
ordered by id, null last, then by hash of the text; repeated rows (same id and text) are one document
and get the same result; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import in_batches, partition_count, slices, small, written
from tessella.llm.neardup import mixed, other_word_hashes, word_hashes

WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1

_C = np.random.default_rng(8).integers(0, 2**64, WINDOW, dtype=np.uint64) | np.uint64(1)
_RUN = "h long, g long, d long, s int, n int, known boolean"
#: Larger slices find more repeats within them, which are not shuffled.
SLICE_BYTES = 8 * 2**20


def windows(h: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width`` words from each position."""
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total += h[at + k] * _C[k]
    return mixed(total)


def cover_positions(n: int) -> np.ndarray:
    """Anchor positions of a document of ``n`` words; none if it has no window."""
    if n < WINDOW:
        return np.zeros(0, np.int64)
    at = np.arange(n - ANCHOR + 1)
    return at[np.isin(at % PERIOD, COVER)]


def runs(d: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted, merged runs (document, start, length)."""
    order = np.lexsort((s, d))
    d, s, e = d[order], s[order], (s + n)[order]
    if not len(d):
        return d, s, e
    first = np.r_[True, d[1:] != d[:-1]]
    # Running greatest end within a document: documents are set apart by an offset beyond any end.
    group = np.cumsum(first) - 1
    apart = int(e.max()) + 2
    reach = np.maximum.accumulate(e + group * apart) - group * apart
    new = first | np.r_[True, s[1:] > reach[:-1]]
    begin = np.flatnonzero(new)
    last = np.r_[begin[1:], len(d)] - 1
    return d[begin], s[begin], reach[last] - s[begin]


def _batch(h, g, d, s, n, known: bool) -> pa.RecordBatch:
    columns = [h.view(np.int64), g.view(np.int64), d, s.astype(np.int32), n.astype(np.int32), np.full(len(h), known)]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["h", "g", "d", "s", "n", "known"])


def _spread(d: np.ndarray, s: np.ndarray) -> np.ndarray:
    """An even hash for rows that need no partner."""
    return mixed(d.astype(np.uint64) * _C[0] + s.astype(np.uint64) * _C[1])


def _anchors(batches):
    """Anchors of (d, text) batches. Anchors that repeat within a slice are known as candidates there
    and send one row without a document to tell the other slices."""
    for batch in slices(batches, 1, SLICE_BYTES):
        hs, ds, ps = [], [], []
        for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            h = word_hashes((text or "").encode().split())
            at = cover_positions(len(h))
            hs.append(windows(h, at, ANCHOR))
            ds.append(np.full(len(at), d, np.int64))
            ps.append(at)
        if not hs:
            continue
        h, d, p = np.concatenate(hs), np.concatenate(ds), np.concatenate(ps)
        order = np.argsort(h, kind="stable")
        h, d, p = h[order], d[order], p[order]
        new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
        many = ~(new & np.r_[new[1:], True]) if len(h) else new
        start = np.maximum(p - (WINDOW - ANCHOR), 0)  # an anchor stands for the windows around it
        none = np.zeros(len(h), np.uint64)
        yield _batch(h[~many], none[~many], d[~many], start[~many], (p - start + 1)[~many], False)
        signal = h[many & new]
        yield _batch(signal, none[: len(signal)], pa.nulls(len(signal), pa.int64()), np.zeros(len(signal), int), np.ones(len(signal), int), False)
        kd, ks, kn = runs(d[many], start[many], (p - start + 1)[many])
        yield _batch(_spread(kd, ks), none[: len(kd)], kd, ks, kn, True)


def _repeated(keep_first: bool):
    """A stream over rows sorted by both hashes (and order): rows that share them, as (d, s, n);
    without the first of each if ``keep_first``, however often a repeated row sends it."""

    def run(batches):
        last, held, first = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, g, known = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(5).to_numpy(zero_copy_only=False)
            same = np.r_[last == (h[0], g[0]), (h[1:] == h[:-1]) & (g[1:] == g[:-1])]
            if keep_first:
                # A row is the first itself while hash, document and start stay those of the row that opened its hash.
                d, s = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                opened = np.maximum.accumulate(np.where(same, -1, np.arange(len(h))))
                held_d, held_s = first or (-1, -1)
                d_first = np.where(opened < 0, held_d, d[opened])
                s_first = np.where(opened < 0, held_s, s[opened])
                same &= (d != d_first) | (s != s_first)
                first = int(d_first[-1]), int(s_first[-1])
            out = known | same
            if not keep_first:
                out[:-1] |= same[1:]
                if held is not None and same[0]:
                    yield held
            keep = pa.array(out & batch.column(2).is_valid().to_numpy(zero_copy_only=False))
            picked = batch.select(["d", "s", "n"]).filter(keep)
            if picked.num_rows:
                yield picked
            last = h[-1], g[-1]
            held = None if out[-1] or not batch.column(2)[-1].is_valid else batch.select(["d", "s", "n"]).slice(batch.num_rows - 1)

    return run


def _merged(pieces: DataFrame) -> DataFrame:
    """``d, starts, lengths`` of merged runs, a row a document."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            lens, pairs = pc.list_value_length(lists).to_numpy(), lists.flatten()
            row = np.repeat(np.arange(len(lens)), lens)
            at, s, n = runs(row, *(pc.struct_field(pairs, name).to_numpy().astype(np.int64) for name in ("s", "n")))
            offsets = np.r_[0, np.cumsum(np.bincount(at, minlength=len(lens)))].astype(np.int32)
            listed = [pa.ListArray.from_arrays(offsets, x.astype(np.int32)) for x in (s, n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *listed], names=["d", "starts", "lengths"])

    gathered = pieces.groupBy("d").agg(F.collect_list(F.struct("s", "n")).alias("pairs"))
    return in_batches(gathered).mapInArrow(run, "d long, starts array<int>, lengths array<int>")


def _candidates(batches):
    """Hashes of the candidate windows of (d, text, starts, lengths) batches. Of windows equal within
    a slice only the first is open; the later ones are known repeats, sent as runs."""
    for batch in slices(batches, 1, SLICE_BYTES):
        hs, gs, ds, ss = [], [], [], []
        for d, text, starts, lengths in zip(*(batch.column(i).to_pylist() for i in range(4))):
            words = (text or "").encode().split()
            h, g = word_hashes(words), other_word_hashes(words)
            at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)])
            at = at[at <= len(h) - WINDOW]
            hs.append(windows(h, at, WINDOW))
            gs.append(windows(g, at, WINDOW))
            ds.append(np.full(len(at), d, np.int64))
            ss.append(at)
        if not hs:
            continue
        h, g, d, s = map(np.concatenate, (hs, gs, ds, ss))
        order = np.lexsort((s, d, g, h))
        h, g, d, s = h[order], g[order], d[order], s[order]
        # Repeated rows are one document and send each of its windows once.
        opens = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])] if len(h) else np.zeros(0, bool)
        new = opens.copy()
        new[1:] |= (d[1:] != d[:-1]) | (s[1:] != s[:-1])
        h, g, d, s, first = (x[new] for x in (h, g, d, s, opens))
        yield _batch(h[first], g[first], d[first], s[first], np.ones(first.sum(), int), False)
        kd, ks, kn = runs(d[~first], s[~first], np.ones((~first).sum(), int))
        yield _batch(_spread(kd, ks), np.zeros(len(kd), np.uint64), kd, ks, kn, True)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` (id, t1, t2, text) with ``d``, a number that orders documents by id, null last, then by
    hash of the text. The id itself serves if no id is null or has two texts; otherwise a sorted table
    of the documents' keys gives increasing numbers."""
    keys = docs.select("id", "t1", "t2").distinct()
    odd = keys.groupBy("id").agg(F.count("*").alias("n")).filter("id IS NULL OR n > 1").limit(1).count()
    if not odd:
        return docs.withColumn("d", F.col("id"))
    order = [F.col("id").asc_nulls_last(), F.col("t1"), F.col("t2")]
    ranked = keys.repartitionByRange(partition_count(docs.sparkSession), *order).sortWithinPartitions(*order)
    ranked = written(ranked.select(F.col("id").alias("k_id"), F.col("t1").alias("k1"), F.col("t2").alias("k2"), F.monotonically_increasing_id().alias("d")), "substring-keys")
    where = F.col("id").eqNullSafe(F.col("k_id")) & (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2"))
    return docs.join(small(ranked), where).drop("k_id", "k1", "k2")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``d, starts, lengths``: runs of repeated window starts of (d, text) documents."""
    spark = docs.sparkSession
    parts = partition_count(spark)
    texts = docs.select("d", "text")
    anchors = in_batches(texts).mapInArrow(_anchors, _RUN).repartition(parts, "h").sortWithinPartitions("h")
    candidates = written(_merged(in_batches(anchors).mapInArrow(_repeated(False), "d long, s int, n int")), "substring-candidates").withColumnRenamed("d", "c_d")
    found = texts.join(small(candidates), F.col("d") == F.col("c_d")).select("d", "text", "starts", "lengths")
    hashed = in_batches(found).mapInArrow(_candidates, _RUN).repartition(parts, "h").sortWithinPartitions("h", "g", "known", "d", "s")
    return written(_merged(in_batches(hashed).mapInArrow(_repeated(True), "d long, s int, n int")), "substring-repeats")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """``id, n_words, n_removed`` and ``kept`` (the words left, joined by a space) or, without
    ``texts``, its SHA-256 as ``kept_sha256``; one row per input row."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    rows = rows.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(1), "text"))
    rows = _numbered(rows)
    copies = rows.select("t1", "t2", "d").groupBy("t1", "t2").agg(F.min("d").alias("first_d"), F.count("*").alias("n")).filter("n > 1")
    copies = written(copies.select(F.col("t1").alias("k1"), F.col("t2").alias("k2"), "first_d"), "substring-copies")
    rows = rows.join(small(copies), (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2")), "left").withColumn("copy", F.coalesce(F.col("d") > F.col("first_d"), F.lit(False)))
    firsts = rows.filter(~F.col("copy")).select("d", "text")
    repeats = repeated_windows(firsts).withColumnRenamed("d", "r_d")
    joined = rows.join(small(repeats), F.col("d") == F.col("r_d"), "left").select("id", "text", "copy", "starts", "lengths")
    name = "kept" if texts else "kept_sha256"

    def run(batches):
        for batch in slices(batches, 1):
            total, removed, kept = [], [], []
            for text, copy, starts, lengths in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                words = (text or "").encode().split()
                n = len(words)
                if copy:
                    left = [] if n >= WINDOW else words
                elif starts:
                    left, at = [], 0
                    for s, k in zip(starts, lengths):  # sorted; word ranges may overlap
                        left += words[at:s] if s > at else []
                        at = max(at, s + k - 1 + WINDOW)
                    left += words[at:]
                else:
                    left = words
                total.append(n)
                removed.append(n - len(left))
                joined_words = b" ".join(left)
                kept.append(joined_words.decode() if texts else hashlib.sha256(joined_words).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", name]
            )

    return in_batches(joined).mapInArrow(run, f"id long, n_words long, n_removed long, {name} string")


def substring_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`dedup_substrings`."""
    return dedup_substrings(docs, texts=False).withColumnRenamed("id", "doc_id")


ORACLE = """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS s, ws FROM w WHERE len(ws) >= 20),
h AS (SELECT doc_id, s, array_to_string(ws[s:s+19], ' ') AS k FROM g),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS nth FROM h) WHERE nth > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM r),
c AS (SELECT doc_id, list(i) AS gone FROM x GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda p: gone IS NULL OR NOT list_contains(gone, p[2])), lambda p: p[1]), ' '), '')) AS kept_sha256
FROM w LEFT JOIN c ON w.doc_id = c.doc_id
"""
