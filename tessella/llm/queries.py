"""The training-data queries by name, each over its whole table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import bpe, extract, fim, langid, mixing, neardup, negatives, secrets, sharding, substring, tokenfile, vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file, given by the installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document with linked weak parts."""
    return secrets.secret_digest(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents to the sources' target words."""
    return mixing.mix_digest(_table(spark, sf_dir, "documents"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, written and read back."""
    return tokenfile.read_tokens(tokenfile.write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document."""
    return bpe.bpe_digest(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.near_duplicate_digest(_table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, equal texts together."""
    return sharding.shard_digest(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.language_digest(_table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate nearest vectors of every twentieth vector."""
    return vectors.nearest(_table(spark, sf_dir, "embeddings"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact best vectors of every hundredth vector."""
    return vectors.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages removed from every document."""
    return substring.substring_digest(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector's positives."""
    return negatives.negatives_digest(_table(spark, sf_dir, "embeddings"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract_pages(_table(spark, sf_dir, "pages"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document."""
    return fim.fim_digest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_mixing": op2_mixing,
    "op3_token_output": op3_token_output,
    "op4_sharding": op4_sharding,
    "op5_nearest": op5_nearest,
    "op6_bpe": op6_bpe,
    "op7_near_dedup": op7_near_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_html_extraction": op12_html_extraction,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES = {
    "op1_secret_scans": secrets.ORACLE,
    "op7_near_dedup": neardup.ORACLE,
    "op8_substring_dedup": substring.ORACLE,
    "op9_exact_top_k": vectors.EXACT_ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
    "op12_html_extraction": extract.ORACLE,
    "op13_fill_in_middle": fim.ORACLE,
}
