"""Sharding by minimax contiguous partition over ordered atomic groups (law ``bytes``).

Equal texts are one atomic group, ordered by the 64-bit hash of the text. The smallest feasible
shard capacity is found by binary search with a greedy check, and the cut is made there. The driver
never sees the groups: it holds the bytes of hash ranges ("pieces"). Treating every piece as
indivisible gives an upper bound of the capacity, treating pieces of several groups as divisible a
lower one; the pieces in which a cut may fall are split 256-fold by one aggregation a round until
the bounds agree, which the hash width bounds to eight rounds. Among cuts of that capacity each
shard takes the one nearest its even share, so a huge group does not leave the other shards empty.

Slots number a shard's rows without gaps: rows carry the partition they were written in, counts per
(shard, partition) give offsets, and only rows of one such cell are ordered together.

Defined cases: a null text has size 1 and checksum 0, as an empty one, and all null texts are one
group; repeated rows get slots of their own; an empty table gives no rows; only the id and text
columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import in_batches, written

SHARDS = 16
FIRST_BITS = 12
SPLIT = 256
#: At most so many pieces are split in a round, so at most SPLIT times as many rows reach the driver.
MOST_SPLIT = 512


class Pieces:
    """Hash ranges in order: least and greatest hash present, bytes, and whether one group only."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        rows = sorted(rows)
        self.lo = np.array([r[0] for r in rows], dtype=np.int64)
        self.hi = np.array([r[1] for r in rows], dtype=np.int64)
        self.size = np.array([r[2] for r in rows], dtype=np.int64)
        self.upto = np.r_[0, np.cumsum(self.size)]
        self.single = self.lo == self.hi

    def cuts(self, capacity: int, shards: int, divisible: bool) -> list[int] | None:
        """Greedy cut positions in bytes, or None if the shards do not suffice."""
        at, out, total = 0, [], int(self.upto[-1])
        for _ in range(shards):
            if at >= total:
                break
            end = at + capacity
            if end < total:
                k = int(np.searchsorted(self.upto, end, side="right")) - 1
                if not divisible or self.single[k]:
                    end = int(self.upto[k])
                if end <= at:
                    return None
            at = min(end, total)
            out.append(at)
        return out if at >= total else None

    def capacity(self, shards: int, divisible: bool) -> int:
        """The least capacity for which the greedy check succeeds, by binary search."""
        low, high = max(1, -(-int(self.upto[-1]) // shards)), max(1, int(self.upto[-1]))
        while low < high:
            mid = (low + high) // 2
            if self.cuts(mid, shards, divisible) is None:
                low = mid + 1
            else:
                high = mid
        return low

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Piece indexes at which shards begin (from the second on): of the cuts that keep the
        capacity feasible the one nearest the even share of what is left."""
        total, begin, out = int(self.upto[-1]), 0, []
        for left in range(shards, 1, -1):
            at = int(self.upto[begin])
            if at >= total:
                break
            ideal = at + (total - at) / left
            near = int(np.searchsorted(self.upto, ideal))
            best = None
            for k in (near, near - 1):
                fits = begin < k < len(self.upto) and self.upto[k] - at <= capacity
                if fits and self._rest_fits(k, capacity, left - 1) and (best is None or abs(self.upto[k] - ideal) < abs(self.upto[best] - ideal)):
                    best = k
            if best is None:
                best = int(np.searchsorted(self.upto, at + capacity, side="right")) - 1
            out.append(best)
            begin = best
        return [k for k in out if k < len(self.lo)]

    def _rest_fits(self, k: int, capacity: int, shards: int) -> bool:
        at, total = int(self.upto[k]), int(self.upto[-1])
        for _ in range(shards):
            if at >= total:
                return True
            at = int(self.upto[int(np.searchsorted(self.upto, at + capacity, side="right")) - 1])
        return at >= total


def _piece_rows(rows: DataFrame, keys: list[str]) -> list:
    return rows.groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("size").alias("size")).collect()


def _split(rows: DataFrame, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int, int]]:
    """The pieces [lo, hi] (disjoint, sorted) split SPLIT-fold, by one aggregation over the rows."""
    width = (hi - lo) // SPLIT + 1

    def run(batches):
        for batch in batches:
            h, size = (batch.column(i).to_numpy() for i in (0, 1))
            k = np.maximum(np.searchsorted(lo, h, side="right") - 1, 0)
            ok = (h >= lo[k]) & (h <= hi[k])
            k, h, size = k[ok], h[ok], size[ok]
            if not len(h):
                continue
            cell = k * SPLIT + (h - lo[k]) // width[k]
            order = np.argsort(cell, kind="stable")
            cell, h, size = cell[order], h[order], size[order]
            at = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[at]), pa.array(np.minimum.reduceat(h, at)), pa.array(np.maximum.reduceat(h, at)), pa.array(np.add.reduceat(size, at))],
                names=["cell", "lo", "hi", "size"],
            )

    parts = in_batches(rows.select("h", "size")).mapInArrow(run, "cell long, lo long, hi long, size long")
    return [(r.lo, r.hi, r.size) for r in _piece_rows(parts, ["cell"])]


def plan_cuts(rows: DataFrame, shards: int = SHARDS) -> list[int]:
    """Least hashes of the second and later shards, for rows with ``h`` and ``size``."""
    first = rows.select(F.shiftright("h", 64 - FIRST_BITS).alias("cell"), F.col("h").alias("lo"), F.col("h").alias("hi"), "size")
    found = [(r.lo, r.hi, r.size) for r in _piece_rows(first, ["cell"])]
    if not found:
        return []
    while True:
        pieces = Pieces(found)
        upper, lower = pieces.capacity(shards, False), pieces.capacity(shards, True)
        if lower == upper or pieces.single.all():
            break
        touched = np.zeros(len(pieces.lo), dtype=bool)
        for a, b in zip(pieces.cuts(lower, shards, True), pieces.cuts(upper, shards, False)):
            first_k, last_k = (int(np.searchsorted(pieces.upto, x, side="right")) - 1 for x in (min(a, b), max(a, b)))
            touched[max(first_k - 1, 0) : last_k + 1] = True
        chosen = np.flatnonzero(touched & ~pieces.single)[:MOST_SPLIT]
        if not len(chosen):
            break
        finer = _split(rows, pieces.lo[chosen], pieces.hi[chosen])
        gone = set(chosen.tolist())
        found = [x for i, x in enumerate(zip(pieces.lo.tolist(), pieces.hi.tolist(), pieces.size.tolist())) if i not in gone] + finer
    return [int(pieces.lo[k]) for k in pieces.even_cuts(upper, shards)]


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, crc, shard, slot`` of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).select(
        "id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64("text").alias("h"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "shard-rows")
    begins = plan_cuts(rows, shards)
    shard = F.lit(0)
    for begin in begins:
        shard = shard + (F.col("h") >= F.lit(begin)).cast("int")
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("cell", F.shiftright("row", 33))
    counts = placed.groupBy(F.col("shard").alias("c_shard"), F.col("cell").alias("c_cell")).agg(F.count("*").alias("rows"))
    before = Window.partitionBy("c_shard").orderBy("c_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("c_shard", "c_cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "cell").orderBy("row")
    numbered = placed.withColumn("at", F.row_number().over(within) - 1)
    joined = numbered.join(offsets, (F.col("shard") == F.col("c_shard")) & (F.col("cell") == F.col("c_cell")))
    return joined.select("id", "size", "crc", "shard", (F.col("offset") + F.col("at")).alias("slot"))


def shard_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`shard_documents`."""
    return shard_documents(docs).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
