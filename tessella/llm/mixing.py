"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share ``share`` times all
words; a target stops at ``most`` times its source's size and the excess is reshared by weight until
none is above. Within a source every document first gets ``floor(target / size)`` certain whole
copies. One more copy is drawn for some:

1. Inclusion probabilities are proportional to a document's words, at most 1, and such that the words
   expected are the words left: ``p = min(1, c * size)`` with ``sum(p * size) = left``. Documents whose
   probability is 1 are taken for certain, so the longest ones are never left to chance. They sum to the
   number of documents drawn. ``c`` is found on the counts of equal sizes, in a few aggregates.
2. The others are ranked by random odds over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, and taken
   in that order.
3. The sample's fixed size is counted in words, as the targets are: documents are taken in rank order up to
   the one that no longer fits the words left. Then one document closes the gap: the first in rank order that
   leaves at most ``close`` of the target open. Where there is none, those behind that still fit are taken in rank
   order, again up to the first that does not, and so on. A source is done as soon as at most ``close`` of its target
   is open, so short documents are not drawn just because they fill what is left. What this costs: the number
   of documents drawn follows the sizes met, within a few of the sum of the probabilities, and one document
   of a source, as a rule, is chosen for its length; a source stays within ``close`` of its target, or within less
   than its smallest remaining document.

Nothing is gathered: ranks are cut into buckets whose number follows a source's rows (the cut lies near
rank 1, where a step holds at most an even share of them), words are summed per bucket, and only the
one bucket in which a source's target falls is ordered.

Defined cases: a null or empty text has size 0 and takes 0; a null source is a source of its own;
the draw hashes (id, hash of text), so reruns agree, and rows alike in both are interchangeable;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import n_words, partition_count, small, uniform, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
CLOSE = 0.005
BUCKET_ROWS = 4000
SEED = 20240229


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, their place in code-point order (null last), counted from 0.

    Rows are sorted by ranges; the offsets are running sums over the ranges, whose number the session fixes.
    """
    order = F.col("source").asc_nulls_last()
    ranged = sources.repartitionByRange(partition_count(sources.sparkSession), order).sortWithinPartitions(order)
    rows = written(ranged.withColumn("row", F.monotonically_increasing_id()), "mix-order").withColumn("cell", F.shiftright("row", 33))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("cell").agg(F.count("*").alias("n_cell")).select("cell", F.coalesce(F.sum("n_cell").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("row") - F.shiftleft("cell", 33)
    return rows.join(F.broadcast(offsets), "cell").withColumn("place", place).drop("row", "cell", "offset")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: ``source, source_size, n, target``.

    Resharing is a fixed point: a source is capped when the level (words per unit of weight) lifts
    it to its cap, and capping raises the level. Each pass is an aggregate over the table of
    sources; only two sums reach the driver.
    """
    sources = _numbered(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    sources = written(sources.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size")), "mix-sources")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level = None
    while True:
        capped = F.lit(False) if level is None else F.col("cap") <= F.col("weight") * F.lit(level)
        used, free = sources.agg(F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight")))).first()
        if not free:
            break
        next_level = (total - (used or 0.0)) / free
        if level is not None and next_level <= level:
            break
        level = next_level
    reached = F.lit(0.0) if level is None else F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.least("cap", reached)).select("source", "source_size", "n", "target")


def _with_scale(facts: DataFrame, sized: DataFrame) -> DataFrame:
    """``facts`` (source, left, ...) with ``c``, by which sizes become inclusion probabilities, and ``sure``, the words
    of the documents whose probability is 1.

    Capping raises ``c``, so passes over the counts of equal sizes go on until no more sizes are capped. Sums are
    exact, so reruns agree.
    """
    counts = sized.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("k"))
    lefts = facts.filter("left > 0").select(F.col("source").alias("l_source"), "left")
    counts = written(counts.join(small(lefts), F.col("source").eqNullSafe(F.col("l_source"))).drop("l_source"), "mix-counts")
    scale, known = None, -1
    while True:
        rows = counts.withColumn("c", F.lit(0.0)) if scale is None else counts.join(small(scale), F.col("source").eqNullSafe(F.col("c_source"))).drop("c_source")
        capped, size = F.col("size") * F.col("c") >= 1, F.col("size").cast("decimal(38,0)")
        sums = rows.groupBy("source").agg(
            F.max("left").alias("left"),
            F.coalesce(F.sum(F.when(capped, F.col("size") * F.col("k"))), F.lit(0)).alias("sure"),
            F.sum(F.when(~capped, F.col("k").cast("decimal(38,0)") * size * size)).cast("double").alias("squares"),
            F.sum(F.when(capped, F.col("k"))).alias("n_sure"),
        )
        c = F.coalesce(F.try_divide(F.greatest(F.col("left") - F.col("sure"), F.lit(0.0)), F.col("squares")), F.lit(0.0))
        scale = written(sums.select(F.col("source").alias("c_source"), c.alias("c"), "sure", "n_sure"), "mix-scale")
        n_sure = scale.agg(F.sum("n_sure")).first()[0] or 0
        scale = scale.drop("n_sure")
        if n_sure == known:
            break
        known, scale = n_sure, scale.drop("sure")
    return facts.join(small(scale), F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")


def _drawn(rest: DataFrame) -> DataFrame:
    """One pass: ``rest`` (source, id, h, size, rank, bucket, left) with ``hit``, the rows in rank order that the
    words left take whole, up to the first that they do not.

    Summed words per bucket locate the cut, only whose bucket is ordered row by row.
    """
    words = rest.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = words.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    placed = placed.select(F.col("source").alias("p_source"), F.col("bucket").alias("p_bucket"), "before", "words")
    rows = rest.join(placed, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("bucket") == F.col("p_bucket"))).drop("p_source", "p_bucket")
    whole = F.col("before") + F.col("words") <= F.col("left")
    crossing = ~whole & (F.col("before") < F.col("left"))
    inside = Window.partitionBy("source", "bucket").orderBy("rank", "id", "h", "size").rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.filter(crossing).withColumn("hit", F.col("before") + F.sum("size").over(inside) <= F.col("left"))
    return rows.filter(~crossing).withColumn("hit", whole).unionByName(cut).drop("before", "words")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
    close: float = CLOSE,
) -> DataFrame:
    """Copies of every document in the mix: ``id, h, source, size, source_size, target, copies``."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[source_col].alias("source"))
    rows = rows.select("id", "source", n_words(F.col("text")).alias("size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    sized = written(rows, "mix-sizes")  # four narrow columns: the texts are read once
    targets = source_targets(sized, weights, share, most)
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    certain = F.least(F.floor(ratio + 1e-12), F.lit(int(most))).cast("int")
    left = F.when(F.col("certain") < F.lit(float(most)), F.greatest(F.col("target") - F.col("certain") * F.col("source_size"), F.lit(0.0))).otherwise(F.lit(0.0))
    facts = _with_scale(targets.withColumn("certain", certain).withColumn("left", left), sized)
    facts = written(facts.withColumnRenamed("source", "s_source"), "mix-facts")
    joined = sized.join(small(facts), F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    p = F.col("size") * F.coalesce("c", F.lit(0.0))
    joined = joined.withColumn("p", p)
    sure, open_ = (F.col("p") >= 1) & (F.col("size") > 0), (F.col("p") > 0) & (F.col("p") < 1)
    u = F.col("u")
    drawn = (
        joined.filter(open_)
        .withColumn("left", F.col("left") - F.col("sure"))
        .withColumn("u", uniform(F.col("id"), F.col("h"), seed=seed))
        .withColumn("rank", F.try_divide(u * (1 - F.col("p")), (1 - u) * F.col("p")))
        # Ranks in (0, 1); about their middle, where the cut lies, equal steps hold at most an even share of the rows.
        .withColumn("bucket", F.floor(F.col("rank") / (1 + F.col("rank")) * F.greatest(F.ceil(F.col("n") / F.lit(BUCKET_ROWS)), F.lit(1)) * 2))
    )
    keep = ["id", "h", "source", "size", "source_size", "target", "certain", "hit"]
    out = joined.filter(~open_).withColumn("hit", sure).select(*keep)
    rest = written(drawn.filter(F.col("size") <= F.col("left")).drop("u", "p", "c", "sure", "n"), "mix-open")
    out = out.unionByName(drawn.filter(F.col("size") > F.col("left")).withColumn("hit", F.lit(False)).select(*keep))
    near, gap = F.lit(float(close)) * F.col("target"), F.col("left")
    while not rest.isEmpty():
        passed = written(_drawn(rest).withColumn("row", F.monotonically_increasing_id()), "mix-pass")
        got = passed.groupBy("source").agg(F.sum(F.when(F.col("hit"), F.col("size")).otherwise(0)).alias("got"))
        got = written(got.withColumnRenamed("source", "g_source"), "mix-got")
        rest = passed.filter(~F.col("hit")).drop("hit").join(small(got), F.col("source").eqNullSafe(F.col("g_source")))
        rest = rest.withColumn("left", gap - F.col("got")).drop("g_source", "got")
        closing = rest.filter((gap > near) & (F.col("size") <= gap) & (F.col("size") >= gap - near))
        closing = written(closing.groupBy(F.col("source").alias("c_source")).agg(F.min_by("row", F.struct("rank", "id", "h", "size")).alias("closing")), "mix-closing")
        rest = rest.join(small(closing), F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
        goes_on = F.col("closing").isNull() & (gap > near) & (F.col("size") <= gap)
        done = rest.filter(~goes_on).withColumn("hit", F.coalesce(F.col("row") == F.col("closing"), F.lit(False)))
        out = out.unionByName(passed.filter("hit").select(*keep)).unionByName(done.select(*keep))
        rest = written(rest.filter(goes_on).drop("row", "closing"), "mix-open")
    copies = F.col("certain") + F.when(F.col("hit"), 1).otherwise(0)
    return out.select("id", "h", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`mix_sources`."""
    return mix_sources(docs).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
