"""The corpus pipeline: language ID, near-dedup, secret masking, mixing, BPE encoding.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. Decisions come back to the texts
per document: by a broadcast where the table of decisions is proven small, by a shuffle join beyond.

Defined cases: a null text or one without letters is rejected by the first stage; null and repeated
ids are handled by (id, hash of the text); repeated rows are one document from the second stage on, and each
stage on its own takes them; null sources are a source of their own; an empty table passes through as
empty; columns beyond those of ``documents`` are not carried on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bpe, langid, mixing, neardup, secrets
from tessella.llm.common import small, written
from tessella.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that have a language and write it into ``lang``. Rejected are those without a letter
    and those in a script that no profile knows (score 0). Without any labelled document all with a letter
    stay as they are."""
    docs = docs.select(*COLUMNS)
    labelled = docs.select(F.col("doc_id").alias("id"), "text", "lang").filter(~langid.held_out(F.col("id")))
    profiles = langid.fit_profiles(labelled)
    if not profiles:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.with_language(docs, profiles).filter((F.col("lang_pred") != langid.UND) & (F.col("score") > 0))
    return found.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate component: the one with the least id, null last, then hash of the text."""
    docs = docs.select(*COLUMNS)
    found = written(neardup.near_duplicates(docs), "pipeline-components")
    repeated = found.groupBy("id", "th").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    place = F.struct(F.col("id").isNull().alias("no"), "id", "th")
    groups = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(place).alias("kept"), F.count("*").alias("n")).filter("n > 1")
    groups = written(groups.select(F.col("root").alias("k_root"), F.col("kept.id").alias("k_id"), F.col("kept.th").alias("k_th")), "pipeline-groups")
    other = ~(F.col("id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")))
    gone = found.join(small(groups), F.col("root") == F.col("k_root")).filter(other).select(F.col("id").alias("g_id"), F.col("th").alias("g_th")).distinct()
    where = F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.xxhash64("text") == F.col("g_th"))
    kept = docs.join(small(written(gone, "pipeline-gone")), where, "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every reported secret span in the texts."""
    docs = docs.select(*COLUMNS)
    spans = secrets.scan_secrets(docs).filter(F.size("spans") > 0).groupBy("id", "h").agg(F.first("spans").alias("spans"))
    where = F.col("doc_id").eqNullSafe(F.col("id")) & (F.md5("text") == F.col("h"))
    joined = docs.join(small(written(spans, "pipeline-spans")), where, "left")
    hit = F.col("spans").isNotNull()
    masked = joined.withColumn("text", F.when(hit, secrets.mask_secrets(F.col("text"), F.col("spans"))).otherwise(F.col("text")))
    return masked.select("doc_id", "text", "lang", "source", F.when(hit, F.length("text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it.

    Of rows with one id and text each gets an even share of their copies, and one of them what is left over.
    """
    docs = docs.select(*COLUMNS)
    taken = mixing.mix_sources(docs).groupBy("id", "h").agg(F.sum("copies").alias("all"), F.count("*").alias("n")).filter(F.col("all") > 0)
    each, left = F.floor(F.col("all") / F.col("n")).cast("int"), (F.col("all") % F.col("n")).cast("int")
    taken = written(taken.select("id", "h", each.alias("each"), left.alias("left")), "pipeline-copies")
    where = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("h"))
    times = lambda rows, n: rows.filter(F.col(n) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(n)))).select(*COLUMNS)
    rows = times(docs.join(small(taken.filter("each > 0")), where), "each")
    rest = taken.filter(F.col("left") > 0)
    return rows if rest.isEmpty() else rows.unionByName(times(docs.join(small(rest), where).dropDuplicates(["id", "h"]), "left"))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document taken."""
    return bpe.encode_documents(docs, tokenizer_path("word_bpe_49k.json")).select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("bpe_encode", bpe_encode),
]

#: Hash-drawn mixing and BPE cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
