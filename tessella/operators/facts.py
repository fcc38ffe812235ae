"""Numeric facts in texts and their conflicts between a trusted and a checked side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units in the order they are tried.
UNITS = ["积分", "分", "钻石", "蓝宝石", "元", "天", "个", "场", "级", "%", "K", "W", "M", "D"]
FACT = r"([\x{4e00}-\x{9fa5}A-Za-z0-9]{2,8})\s*[:：+]?\s*(\d+(?:\.\d+)?)\s*(" + "|".join(UNITS) + ")"
MOST_CONFLICTS = 8


def numeric_facts(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, pos, key, value, unit``: key, number and unit wherever they follow each other."""
    whole = F.regexp_extract_all(F.col(text), F.lit(FACT), F.lit(0))
    found = texts.select(*keys, F.posexplode(whole).alias("pos", "_m"))
    part = lambda i: F.regexp_extract("_m", f"^{FACT}$", i)
    return found.select(*keys, "pos", part(1).alias("key"), part(2).alias("value"), part(3).alias("unit"))


def fact_conflicts(trusted: DataFrame, checked: DataFrame, doc: str = "doc", most: int = MOST_CONFLICTS) -> DataFrame:
    """Facts of checked texts whose (key, unit) the trusted texts of the document know, but not with
    that value: ``doc, rank, key, unit, value, known``.

    A checked text counts with its first value of a (key, unit), a conflict with its first text
    (``seq``); at most ``most`` a document, in order. ``known`` lists the trusted values, ``recorded`` the first
    three of them as they come in the text.
    """
    values = numeric_facts(trusted, [doc]).groupBy(doc, "key", "unit", "value").agg(F.min("pos").alias("pos"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda v: v["value"])
    known = values.groupBy(doc, "key", "unit").agg(F.array_sort(F.collect_list("value")).alias("known"), F.array_join(F.slice(in_order, 1, 3), "、").alias("recorded"))
    stated = numeric_facts(checked, [doc, "seq"]).groupBy(doc, "seq", "key", "unit").agg(F.min(F.struct("pos", "value")).alias("f"))
    bad = stated.join(known, [doc, "key", "unit"]).filter(~F.array_contains("known", F.col("f.value")))
    first = bad.groupBy(doc, "key", "unit").agg(F.min(F.struct("seq", F.col("f.pos").alias("pos"), F.col("f.value").alias("value"))).alias("f"), F.first("known").alias("known"), F.first("recorded").alias("recorded"))
    # A row for each (key, unit) of a document that conflicts; the array holds no more than that.
    best = first.groupBy(doc).agg(F.expr("collect_list(struct(f.seq AS seq, f.pos AS pos, key, unit, f.value AS value, known, recorded))").alias("c"))
    ranked = best.select(doc, F.posexplode(F.slice(F.array_sort("c"), 1, most)).alias("rank", "c"))
    return ranked.select(doc, (F.col("rank") + 1).alias("rank"), "c.key", "c.unit", "c.value", F.array_join("c.known", ",").alias("known"), "c.recorded")
