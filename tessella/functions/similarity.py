"""Similarity expressions of short texts and header lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.text import trimmed

CONTAINED = 0.8
POSITION_LIKE = 0.6
OTHER_LENGTH = 0.3


def _chars(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))


def text_similarity(a: Column, b: Column) -> Column:
    """1 if equal up to case and outer white space, 0.8 if one holds the other, else the Jaccard
    similarity of their character sets; 0 if either is null or empty."""
    x, y = trimmed(F.lower(a)), trimmed(F.lower(b))
    both = F.size(F.array_intersect(_chars(x), _chars(y)))
    either = F.size(F.array_union(_chars(x), _chars(y)))
    return (
        F.when(a.isNull() | b.isNull() | (a == "") | (b == ""), F.lit(0.0))
        .when(x == y, F.lit(1.0))
        .when(x.contains(y) | y.contains(x), F.lit(CONTAINED))
        .otherwise(both / either)
    )


def header_similarity(a: Column, b: Column) -> Column:
    """Share of positions whose headers are alike; 0.3 if the lists differ in length, 0 if one is empty."""
    alike = F.zip_with(a, b, lambda x, y: F.when(text_similarity(x, y) > POSITION_LIKE, 1).otherwise(0))
    share = F.aggregate(alike, F.lit(0), lambda n, x: n + x) / F.size(a)
    none = a.isNull() | b.isNull() | (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(none, F.lit(0.0)).when(F.size(a) != F.size(b), F.lit(OTHER_LENGTH)).otherwise(share)
