"""Vector searches of a stated query set against all rows, in blocks.

Both searches deal queries and rows to hashed blocks of bounded size and let each pair of blocks meet
in one task (a grid, so neither side is ever held whole); a task returns the best few of its block
for each query, and a ranking by query merges them.

:func:`nearest` is a permutation index. Each vector is represented by its ``FRONT`` nearest of up to
``PIVOTS`` pivots in order and posted in the inverted files of these pivots only, about 3 % of them.
The files of a block are built once and written. A query walks the files of its own front pivots and
accumulates the footrule distance of the two orders, in which a pivot that one of them lacks counts
as placed at ``BEYOND`` times ``FRONT``; vectors in none of these files are never touched. The ``SHARE``
of a block with the least footrule (``FACTOR`` times k at least, for small blocks) and all others whose
footrule is under ``CLOSE`` of the greatest, so that a large group of near copies is whole, are
reranked by the exact inner product in double precision. Pivots come from a bounded sample of
``SAMPLE`` vectors (least hashes); every row is indexed.

As the largest inner product is wanted, rows are blocked by length (powers of two) and get one more
component that brings all of a range to the length of its longest, and queries get a zero there; the
nearest direction is then the largest inner product.

:func:`exact_top_k` is exhaustive and term-at-a-time: vectors become sparse integer rows; each
component's posting list is scattered, weighted by the query's component, into a dense score array
over the block; a partition selects the best, ties to the smaller id. Scores are 64-bit integers where
a bound on the query's products proves that these suffice, else Python's integers.

Defined cases: a row with a null id, a null vector, or a null or non-finite component takes no part
(nor a zero or empty vector in :func:`nearest`); of rows with one id the least vector counts;
vectors shorter than others are padded with zeros; an empty table gives no rows; a reported score of
:func:`exact_top_k` that does not fit a long is an error, as a sum's overflow in SQL; only the id
and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import in_batches, written

BLOCK_ROWS = 8192
BLOCK_QUERIES = 8192
PIVOTS, FRONT, BEYOND = 2048, 64, 1.5
SHARE, FACTOR, CLOSE = 0.07, 10, 0.45
SAMPLE = 8192
TOO_ALIKE = 0.9
#: Vectors are ordered in parts of so many, which bounds the matrix of their products with all pivots.
PART = 1024
#: Products whose sum is surely below this are summed as 64-bit integers.
SAFE = 2.0**62


def _usable(vector: Column) -> Column:
    """Not null and every component finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def clean_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the usable rows; one row an id."""
    plain = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("v"))
    return plain.filter(F.col("id").isNotNull() & _usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """A list column as a matrix of doubles, short rows padded with zeros to ``width`` at least."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lens = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(lens.max()) if len(lens) else 0)
    out = np.zeros((len(lens), width))
    out[np.arange(width)[None, :] < lens[:, None]] = values
    return out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query: ``query_id, rank, vec_id, score``."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(left_ids: np.ndarray, right_ids: np.ndarray, best: list, kind: pa.DataType) -> pa.Table:
    """(query index, row index, score) arrays of the queries as a table."""
    qi, ri, score = map(np.concatenate, zip(*best)) if best else (np.zeros(0, int),) * 3
    return pa.table({"query_id": left_ids[qi], "vec_id": right_ids[ri], "score": pa.array(score, kind)})


def _query_blocks(n: int) -> Column:
    """The block of a query, of as many as ``n`` queries need."""
    return F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // BLOCK_QUERIES)))).cast("int")


def _over(n: int) -> Column:
    """A row for each of ``n`` blocks."""
    return F.explode(F.sequence(F.lit(0), F.lit(max(1, n) - 1)))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores, greatest first, ties to the smaller place."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")][:k]


def choose_pivots(units: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """The first of the unit vectors that are not too like an earlier one."""
    chosen: list[int] = []
    for i in range(len(units)):
        if len(chosen) == pivots:
            break
        if not chosen or (units[chosen] @ units[i]).max() < TOO_ALIKE:
            chosen.append(i)
    return units[chosen]


def orders(units: np.ndarray, pivots: np.ndarray, front: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    out = []
    for i in range(0, len(units), PART):
        far = -(units[i : i + PART].astype(np.float32) @ pivots.T.astype(np.float32))
        part = np.argpartition(far, front - 1, axis=1)[:, :front]
        out.append(np.take_along_axis(part, np.argsort(np.take_along_axis(far, part, 1), axis=1, kind="stable"), 1).astype(np.int16))
    return np.concatenate(out) if out else np.zeros((0, front), np.int16)


class InvertedFiles:
    """A file for each pivot, one after the other: the vectors whose front lists the pivot, and its place there."""

    def __init__(self, starts: np.ndarray, members: np.ndarray, places: np.ndarray, n: int, front: int):
        self.starts, self.members, self.places, self.n, self.front = starts, members, places, n, front
        self.beyond = int(BEYOND * front)
        self.ranks = np.arange(front)
        #: Footrule of two orders that share no pivot.
        self.greatest = 2 * int((self.beyond - self.ranks).sum())

    @classmethod
    def post(cls, order: np.ndarray, pivots: int) -> InvertedFiles:
        """The files of vectors with these orders."""
        n, front = order.shape
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(flat, minlength=pivots))].astype(np.int32)
        return cls(starts, (by_pivot // front).astype(np.int32), (by_pivot % front).astype(np.uint8), n, front)

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every vector's order to one query's.

        A shared pivot at places a and b adds |a - b| where two orders that lack it add (beyond - a) +
        (beyond - b), so it takes 2 (beyond - max(a, b)) off the greatest distance.
        """
        begin, lens = self.starts[order], self.starts[order + 1] - self.starts[order]
        ends = np.cumsum(lens)
        at = np.repeat(begin - (ends - lens), lens) + np.arange(int(ends[-1]))
        gain = self.beyond - np.maximum(self.places[at], np.repeat(self.ranks, lens))
        return self.greatest - 2 * np.bincount(self.members[at], weights=gain, minlength=self.n).astype(np.int64)

    def candidates(self, order: np.ndarray, k: int) -> np.ndarray:
        """The vectors to rerank for one query: the nearest orders of the files walked."""
        far = self.footrule(order)
        wanted = min(self.n, max(FACTOR * k, int(np.ceil(SHARE * self.n)))) if self.n else 0
        if not wanted:
            return np.zeros(0, int)
        cut = max(int(np.partition(far, wanted - 1)[wanted - 1]), int(CLOSE * self.greatest))
        return np.flatnonzero(far <= min(cut, self.greatest - 1) if wanted < self.n else far <= cut)


def _length(vector: Column) -> Column:
    """Euclidean length, scaled by the largest component against overflow."""
    most = F.array_max(F.transform(vector, F.abs))
    return most * F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / most) * (x / most)))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows brought to length one by one more component; ``longest`` is the greatest length among them."""
    x = x / longest
    return np.c_[x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))]


def nearest(rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: approximate nearest by inner product."""
    clean = clean_vectors(rows, id_col, vector_col).filter(F.exists("v", lambda x: x != 0)).withColumn("length", _length(F.col("v")))
    vectors = written(clean.withColumn("range", F.floor(F.log2("length") + 0.5).cast("int")), "nearest-vectors")
    # A range is a power of two, so there are at most about two thousand, however many rows.
    facts = vectors.groupBy("range").agg(F.count("*").alias("n"), F.max("length").alias("longest"), F.max(F.size("v")).alias("width"), F.count(F.when(F.col("id") % every == 0, 1)).alias("q")).collect()
    longest, width, n_queries = {r.range: r.longest for r in facts}, max((r.width for r in facts), default=0), sum(r.q for r in facts)
    n_blocks = {r.range: -(-r.n // BLOCK_ROWS) for r in facts}
    first = {r: sum(n for other, n in n_blocks.items() if other < r) for r in n_blocks}
    drawn = vectors.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(SAMPLE).select("v", "range").collect()
    sample = np.array([lifted(np.array([r.v + [0.0] * (width - len(r.v))]), longest[r.range])[0] for r in drawn]).reshape(len(drawn), width + 1)
    pivots = choose_pivots(sample)
    front = min(FRONT, max(1, len(pivots) // 2))

    def post(key, table):
        ids, x = table.column("id").to_numpy(), matrix(table.column("v"), width)
        by_id = np.argsort(ids)  # places then follow ids, which settles ties
        ids, x = ids[by_id], x[by_id]
        files = InvertedFiles.post(orders(lifted(x, longest[table.column("range")[0].as_py()]), pivots, front), len(pivots))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32())} | {name: [np.ascontiguousarray(a).tobytes()] for name, a in (("ids", ids), ("x", x), ("starts", files.starts), ("members", files.members), ("places", files.places))})

    steps = F.create_map(*[F.lit(x) for r in n_blocks for x in (r, F.struct(F.lit(first[r]).alias("first"), F.lit(n_blocks[r]).alias("n")))]) if facts else F.create_map(F.lit(0), F.struct(F.lit(0).alias("first"), F.lit(1).alias("n")))
    step = F.element_at(steps, F.col("range"))
    blocked = vectors.withColumn("block", (step["first"] + F.pmod(F.xxhash64("id"), step["n"])).cast("int"))
    index = blocked.select("block", "range", "id", "v").groupBy("block").applyInArrow(post, "block int, ids binary, x binary, starts binary, members binary, places binary")
    index = written(index, "nearest-index")

    def with_order(batches):
        for batch in batches:
            x = matrix(pa.chunked_array([batch.column(1)]), width)
            order = orders(np.c_[x / np.abs(x).max(axis=1, keepdims=True), np.zeros(len(x))], pivots, front) if len(x) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([o.tobytes() for o in order], pa.binary())], names=["id", "v", "order"])

    queries = in_batches(vectors.filter(F.col("id") % every == 0).select("id", "v")).mapInArrow(with_order, "id long, v array<double>, order binary")

    def meet(left, right):
        if not left.num_rows or not right.num_rows:
            return _found(np.zeros(0, np.int64), np.zeros(0, np.int64), [], pa.float64())
        read = lambda name, kind: np.frombuffer(right.column(name)[0].as_py(), dtype=kind)
        ids, q_ids = read("ids", np.int64), left.column("id").to_numpy()
        x, q = read("x", np.float64).reshape(len(ids), width), matrix(left.column("v"), width)
        files, out = InvertedFiles(read("starts", np.int32), read("members", np.int32), read("places", np.uint8), len(ids), front), []
        for i, order in enumerate(left.column("order").to_pylist()):
            places = files.candidates(np.frombuffer(order, np.int16).astype(np.int64), k)
            places = places[ids[places] != q_ids[i]]
            score = (x[places] * q[i]).sum(axis=1)
            top = _best(score, k)
            out.append((np.full(len(top), i), places[top], score[top]))
        return _found(q_ids, ids, out, pa.float64())

    sent = queries.select(_query_blocks(n_queries).alias("qb"), _over(sum(n_blocks.values())).alias("block"), "id", "v", "order")
    files = index.select(_over(-(-n_queries // BLOCK_QUERIES)).alias("qb"), "*")
    found = sent.groupBy("qb", "block").cogroup(files.groupBy("qb", "block")).applyInArrow(meet, "query_id long, vec_id long, score double")
    return _ranked(found, k)


def _integers(m: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), exact as doubles."""
    return np.floor(m * scale)


def _exact(q: np.ndarray, x: np.ndarray) -> int:
    """The inner product of two rows of integral doubles in Python's integers."""
    return sum(int(a) * int(b) for a, b in zip(q.tolist(), x.tolist()) if a and b)


def exact_top_k(rows: DataFrame, every: int = 100, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the greatest integer inner products, exactly."""
    vectors = clean_vectors(rows, id_col, vector_col)
    n, n_queries = vectors.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1))).first()
    n_blocks, block = max(1, -(-n // BLOCK_ROWS)), F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // BLOCK_ROWS)))).cast("int")
    queries = vectors.filter(F.col("id") % every == 0).select(_query_blocks(n_queries).alias("qb"), _over(n_blocks).alias("rb"), "id", "v")
    dealt = vectors.select(_over(-(-n_queries // BLOCK_QUERIES)).alias("qb"), block.alias("rb"), "id", "v")

    def meet(left, right):
        if not left.num_rows or not right.num_rows:
            return _found(np.zeros(0, np.int64), np.zeros(0, np.int64), [], pa.int64())
        left, right = left.sort_by("id"), right.sort_by("id")  # places then follow ids, which settles ties
        q_ids, x_ids = left.column("id").to_numpy(), right.column("id").to_numpy()
        q, x = (_integers(matrix(side.column("v")), scale) for side in (left, right))
        width = min(q.shape[1], x.shape[1])
        q, x = q[:, :width], x[:, :width]
        with np.errstate(over="ignore", invalid="ignore"):
            unsafe = np.nan_to_num(np.abs(q) @ np.abs(x).max(axis=0, initial=0.0), nan=np.inf) >= SAFE
        fits = np.where(np.abs(x) < SAFE, x, 0.0).astype(np.int64)
        postings = [(at, fits[at, term]) for term in range(width) for at in [np.flatnonzero(x[:, term])]]
        postings = [(slice(None) if len(at) == len(x) else at, weights) for at, weights in postings]
        out = []
        for i in range(len(q)):
            others = np.flatnonzero(x_ids != q_ids[i])
            if unsafe[i]:
                exact = [_exact(q[i], x[j]) for j in others]
                top = sorted(range(len(others)), key=lambda j: (-exact[j], j))[:k]
                out.append((np.full(len(top), i), others[top], np.array([exact[j] for j in top], dtype=object)))
                continue
            scores = np.zeros(len(x), dtype=np.int64)
            for term in np.flatnonzero(q[i]).tolist():
                at, weights = postings[term]
                scores[at] += int(q[i, term]) * weights
            top = others[_best(scores[others], k)]
            out.append((np.full(len(top), i), top, scores[top]))
        return _found(q_ids, x_ids, out, pa.int64())

    found = queries.groupBy("qb", "rb").cogroup(dealt.groupBy("qb", "rb")).applyInArrow(meet, "query_id long, vec_id long, score long")
    return _ranked(found, k)


EXACT_ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
t AS (SELECT vec_id, unnest(q) AS x, unnest(range(len(q))) AS i FROM v),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
      FROM t a JOIN t b ON a.i = b.i AND a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
