"""Hard negatives of anchors by product quantisation with stored residual norms, exactly.

Vectors become integers, ``floor(scale * x)``. Each is cut into pieces of ``PIECE`` components; a piece is stored as
the number of its nearest of up to ``CODES`` centroids and the norm of what that leaves, rounded up. For an
anchor a table of its products with all centroids gives a row's estimated score by one lookup a piece, and by
Cauchy and Schwarz the true score lies within the sum of (norm of the anchor's piece) times (residual norm of the
row's piece). Only rows whose bounds can reach what is wanted are scored exactly, in integers: bounds
discard rows, never decide between them. Centroids come from a bounded sample of ``SAMPLE`` vectors (least
hashes); they affect the speed only, never the result, and every row is indexed.

Rows are dealt to hashed blocks of bounded size, whatever their labels, so a hot label is spread evenly; a block
is packed into one row (by label and id) and written once. Anchors are packed in the same way. Two
passes let each block of anchors meet each block of rows: the first finds the positives, the second the
negatives in the windows that the positives' scores set. A task returns the best few of its block, and a ranking
merges them. The work is that of an exhaustive search, as the answer is exact; where the packed anchors
are small, Spark broadcasts them and the rows are not shuffled.

Defined cases: a row with a null id, label or vector, or with a null or non-finite component, takes no part; of rows
with one id the least (vector, label) counts; shorter vectors are padded with zeros, so an empty one scores
0; an anchor without positives, or a positive without negatives in its window (as with a negative score),
gives no rows; ties go to the smaller id; an empty table gives none; a score that does not fit a long is an error;
only the id, vector and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import in_batches, written
from tessella.llm.vectors import matrix

PIECE, CODES, SAMPLE, ROUNDS = 4, 256, 8192, 6
#: A block holds so many rows at most, fewer where vectors are long: so many bytes as doubles.
BLOCK_ROWS, BLOCK_ANCHORS, BLOCK_BYTES = 8192, 1024, 16 * 2**20
#: Share of the greatest possible score added to the bounds against rounding.
ROUNDING = 1e-9
#: Sums of products surely below these are exact as doubles and as 64-bit integers.
AS_DOUBLE, AS_LONG = 2.0**53, 2.0**62
_PACKED = "block int, n int, ids binary, labels binary, x binary, kind string"


def packed(x: np.ndarray) -> tuple[bytes, str]:
    """Integral doubles as the bytes of the narrowest type that holds them."""
    most = np.abs(x).max(initial=0.0)
    kind = "int16" if most < 2**15 else "int32" if most < 2**31 else "float64"
    return x.astype(kind).tobytes(), kind


def fit_centroids(sample: np.ndarray) -> np.ndarray:
    """(pieces, codes, PIECE) centroids of the sample's pieces, by a few rounds of k-means from the first distinct ones."""
    books = []
    for at in range(0, sample.shape[1], PIECE):
        part = sample[:, at : at + PIECE]
        _, first = np.unique(part, axis=0, return_index=True)
        book = part[np.sort(first)[:CODES]]
        for _ in range(ROUNDS):
            code = nearest_code(part, book)
            n = np.bincount(code, minlength=len(book))
            sums = np.stack([np.bincount(code, weights=part[:, i], minlength=len(book)) for i in range(PIECE)], axis=1)
            book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
        books.append(np.r_[book, np.repeat(book[:1], CODES - len(book), axis=0)])
    return np.stack(books) if books else np.zeros((0, CODES, PIECE))


def nearest_code(part: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The number of each piece's nearest centroid."""
    with np.errstate(over="ignore", invalid="ignore"):
        return ((book * book).sum(axis=1)[None, :] - 2 * part @ book.T).argmin(axis=1)


def quantised(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of the rows' pieces, and the norms of what the codes leave, rounded up."""
    codes, norms = np.zeros((len(x), len(books)), np.uint8), np.zeros((len(x), len(books)), np.float32)
    for s, book in enumerate(books):
        part = x[:, s * PIECE : (s + 1) * PIECE]
        codes[:, s] = nearest_code(part, book)
        with np.errstate(over="ignore", invalid="ignore"):
            norms[:, s] = np.nextafter(np.sqrt(((part - book[codes[:, s]]) ** 2).sum(axis=1)).astype(np.float32), np.float32(np.inf))
    return codes, norms


class Rows:
    """A block of rows by label and id, unpacked."""

    def __init__(self, row: dict, width: int, books: np.ndarray | None = None):
        read = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.ids, self.labels, self.n = read("ids", np.int64), read("labels", np.int64), row["n"]
        self.x = read("x", row["kind"]).reshape(self.n, width).astype(np.float64)
        if books is not None:
            self.books = books
            self.cells = read("codes", np.uint8).reshape(self.n, len(books)) + (CODES * np.arange(len(books), dtype=np.int32))
            self.norms = read("norms", np.float32).reshape(self.n, len(books)).astype(np.float64)
            self.most = np.abs(self.x).max(axis=0, initial=0.0)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of every row with one anchor."""
        pieces = q.reshape(len(self.books), PIECE)
        with np.errstate(over="ignore", invalid="ignore"):
            table = np.einsum("scp,sp->sc", self.books, pieces)
            near = table.ravel()[self.cells].sum(axis=1)
            off = self.norms @ np.sqrt((pieces * pieces).sum(axis=1)) + ROUNDING * float(np.abs(q) @ self.most)
            return near - off, near + off

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact scores of some rows: 64-bit integers if these surely suffice, else Python's."""
        with np.errstate(over="ignore", invalid="ignore"):
            most = float(np.abs(q) @ self.most)
        if most < AS_DOUBLE:
            return (self.x[at] @ q).astype(np.int64)
        if most < AS_LONG:
            fits = np.abs(q) < AS_LONG  # a component that does not fit meets zeros only
            return self.x[at][:, fits].astype(np.int64) @ q[fits].astype(np.int64)
        whole = [int(a) for a in q.tolist()]
        return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in self.x[at].tolist()], dtype=object)

    def same(self, label: int) -> slice:
        """The places of a label's rows."""
        return slice(int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right")))


def kth_greatest(values: np.ndarray, k: int) -> float:
    """The k-th greatest value; without so many, below all."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def first_places(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(-scores[by_id], kind="stable")[:k]]


def positives_of(rows: Rows, anchor_id: int, label: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the block's first rows of the anchor's label."""
    least, greatest = rows.bounds(q)
    same = rows.same(label)
    at = np.arange(rows.n)[same]
    at = at[rows.ids[at] != anchor_id]
    at = at[~(greatest[at] < kth_greatest(least[at], k))]
    scores = rows.scores(q, at)
    top = first_places(rows.ids[at], scores, k)
    return rows.ids[at[top]], scores[top]


def negatives_of(rows: Rows, label: int, q: np.ndarray, windows: list[tuple[int, int]], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each window of scores its number and the ids and scores of the block's first rows of other labels in it."""
    least, greatest = rows.bounds(q)
    other = np.ones(rows.n, bool)
    other[rows.same(label)] = False
    for number, (low, high) in enumerate(windows):
        if low > high:
            continue
        may = other & ~(greatest < low) & ~(least > high)
        sure = least[other & (least >= low) & (greatest <= high)]
        at = np.flatnonzero(may & ~(greatest < kth_greatest(sure, k)))
        scores = rows.scores(q, at)
        inside = np.flatnonzero((scores >= low) & (scores <= high)) if len(at) else np.zeros(0, int)
        at, scores = at[inside], scores[inside]
        top = first_places(rows.ids[at], scores, k)
        yield number, rows.ids[at[top]], scores[top]


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id ``every`` divides, their positives the ``positives`` best other rows of the same
    label. Negatives of a positive are the best of other labels whose score is ``low`` to ``high`` per cent of its.
    """
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    plain = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("v"), rows[label_col].cast("long").alias("label"))
    plain = plain.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & usable)
    vectors = written(plain.groupBy("id").agg(F.min(F.struct("v", "label")).alias("row")).select("id", "row.label", "row.v"), "negatives-vectors")
    n, n_anchors, width = vectors.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = max(PIECE, -(-width // PIECE) * PIECE)
    most = max(64, BLOCK_BYTES // (8 * width))
    n_blocks, n_packs = max(1, -(-n // min(BLOCK_ROWS, most))), max(1, -(-n_anchors // min(BLOCK_ANCHORS, most)))
    drawn = vectors.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(min(SAMPLE, most)).select("v").toArrow()
    books = fit_centroids(np.floor(matrix(drawn.column("v"), width) * scale)) if drawn.num_rows else np.zeros((width // PIECE, CODES, PIECE))

    def pack(key, table, more=lambda x: {}):
        table = table.sort_by([("label", "ascending"), ("id", "ascending")])
        x = np.floor(matrix(table.column("v"), width) * scale)
        data, kind = packed(x)
        whole = lambda name: [table.column(name).to_numpy().astype(np.int64).tobytes()]
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(x)], pa.int32()), "ids": whole("id"), "labels": whole("label"), "x": [data], "kind": [kind]} | more(x))

    def pack_rows(key, table):
        return pack(key, table, lambda x: dict(zip(("codes", "norms"), ([a.tobytes()] for a in quantised(x, books)))))

    def pack_anchors(key, table):
        table = table.sort_by([("label", "ascending"), ("id", "ascending")])
        return pack(key, table).append_column("found", pa.array([table.column("found").to_pylist()], pa.list_(table.schema.field("found").type)))

    dealt = lambda df, blocks: df.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).groupBy("block")
    index = written(dealt(vectors, n_blocks).applyInArrow(pack_rows, _PACKED + ", codes binary, norms binary"), "negatives-index")
    over = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def meet(packs: DataFrame, work, schema: str) -> DataFrame:
        """What ``work`` finds for each pair of a pack of anchors and a block of rows."""
        left = packs.select(F.col("block").alias("pack"), F.struct(*packs.columns).alias("anchors")).withColumn("block", over(n_blocks))
        right = index.select("block", F.struct(*index.columns).alias("rows")).withColumn("pack", over(n_packs))

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    a, r = (batch.column(name)[i].as_py() for name in ("anchors", "rows"))
                    found = list(work(Rows(a, width), Rows(r, width, books), a))
                    if found:
                        yield pa.RecordBatch.from_pylist(found)

        return in_batches(right.join(left, ["pack", "block"]).select("anchors", "rows")).mapInArrow(run, schema)

    def find_positives(anchors, block, _):
        for i in range(anchors.n):
            for other, score in zip(*positives_of(block, anchors.ids[i], int(anchors.labels[i]), anchors.x[i], positives)):
                yield {"anchor_id": int(anchors.ids[i]), "positive_id": int(other), "positive_score": int(score)}

    def find_negatives(anchors, block, row):
        for i, found in enumerate(row["found"]):
            windows = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in found]
            for j, ids, scores in negatives_of(block, int(anchors.labels[i]), anchors.x[i], windows, negatives):
                for other, score in zip(ids, scores):
                    yield {"anchor_id": int(anchors.ids[i]), **found[j], "negative_id": int(other), "negative_score": int(score)}

    own = vectors.filter(F.col("id") % every == 0)
    no_found = F.expr("CAST(array() AS array<struct<positive_id: bigint, positive_score: bigint>>)").alias("found")
    pack_schema = _PACKED + ", found array<array<struct<positive_id: long, positive_score: long>>>"
    packs = dealt(own.select("*", no_found), n_packs).applyInArrow(pack_anchors, pack_schema)
    best = meet(packs, find_positives, "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id"))
    best = best.withColumn("place", place).filter(F.col("place") <= positives)
    best = best.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("found"))
    chosen = written(own.join(best, "id").select("id", "label", "v", "found"), "negatives-anchors")
    packs = dealt(chosen, n_packs).applyInArrow(pack_anchors, pack_schema)
    found = meet(packs, find_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id"))
    ranked = found.withColumn("rank", place.cast("int")).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def negatives_digest(rows: DataFrame) -> DataFrame:
    """The contract's rows: every seventh id has its label moved on first."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
t AS (SELECT vec_id, label, unnest(q) AS x, unnest(range(len(q))) AS i FROM v),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
      FROM t a JOIN t b ON a.i = b.i AND a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
