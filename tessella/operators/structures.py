"""What several readings of one page say of its structure, as one structure.

``segments`` have ``page, seg`` (the reading's place), ``failed``, ``page_type, layout, visual_hierarchy`` (texts),
``components`` (array of name, type, description), ``interactions, states, key_info`` (arrays of texts) and
``states_detail`` (array of element, detail). Failed readings are left out.

- A page with one reading keeps it as it is; with several, entries that agree up to case, white space and punctuation
  are there once, the first one's way (components agree by name and type), layouts are numbered lines, details of
  states are left out, the page's type is the first one given, visual hierarchies are joined.
- Entries that speak of the viewing tool are dropped in both cases.

Entries of all kinds are settled in one pre-aggregated pass by page, kind and key; only what a page keeps is gathered.

Defined cases: null texts count as empty, null arrays as empty ones; a page without a good reading has an empty
structure and 0 readings; ties of ``seg`` go by the texts; repeated rows are readings of their own; a null page is
a page of its own; further columns are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import merge_key
from tessella.operators.documents import is_tool_text

LISTS = ("interactions", "states", "key_info")
_ITEM = "struct<name:string,type:string,description:string>"


def _entries(segments: DataFrame) -> Column:
    """All of a reading's entries: kind, place, item."""
    made = []
    for kind in ("components", *LISTS, "states_detail"):
        names = {"components": ("name", "type", "description"), "states_detail": ("element", None, "detail")}.get(kind)
        parts = lambda e: [F.coalesce(e[n], F.lit("")) if n else F.lit("") for n in names] if names else [F.coalesce(e, F.lit("")), F.lit(""), F.lit("")]  # noqa: B023, E731
        entry = lambda e, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.struct(*[p.alias(n) for p, n in zip(parts(e), ("name", "type", "description"))]).cast(_ITEM).alias("item"))  # noqa: B023, E731
        kind_type = f"array<struct<kind:string,i:int,item:{_ITEM}>>"
        made.append(F.coalesce(F.transform(kind, entry).cast(kind_type), F.array().cast(kind_type)))
    return F.concat(*made)


def merged_structures(segments: DataFrame, page: str = "page") -> DataFrame:
    """``page, n_segments, page_type, layout, visual_hierarchy, components, interactions, states, key_info, states_detail``."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    good = ~F.coalesce("failed", F.lit(False))
    rows = segments.select(page, "seg", good.alias("_good"), text("page_type"), text("layout"), text("visual_hierarchy"), _entries(segments).alias("_all"))
    order = F.array_sort(F.collect_list(F.when(F.col("_good"), F.struct("seg", "layout", "page_type", "visual_hierarchy"))))
    heads = rows.groupBy(page).agg(order.alias("_s"))
    several, some = F.size("_s") > 1, lambda c: F.filter(F.transform("_s", lambda s: s[c]), lambda t: t != "")
    numbered = F.array_join(F.transform("_s", lambda s, i: F.concat(F.lit("[第"), (i + 1).cast("string"), F.lit("段] "), s["layout"])), "\n")
    heads = heads.select(
        page, F.size("_s").alias("n_segments"), F.coalesce(F.get(some("page_type"), F.lit(0)), F.lit("")).alias("page_type"),
        F.when(several, numbered).otherwise(F.coalesce(F.get("_s", F.lit(0))["layout"], F.lit(""))).alias("layout"), F.array_join(some("visual_hierarchy"), " ").alias("visual_hierarchy"),
    )
    counts = rows.groupBy(page).agg(F.count(F.when(F.col("_good"), 1)).alias("_n")).select(F.col(page).alias("_page"), "_n")
    entries = rows.filter("_good").join(counts, F.col(page).eqNullSafe(F.col("_page"))).select(page, "_n", "seg", F.explode("_all").alias("_e"))
    entries = entries.filter((F.col("_n") == 1) | (F.col("_e.kind") != "states_detail")).select(page, "_n", "seg", "_e.*")
    name = F.when(F.col("kind") == "components", F.concat(F.col("item.name"), F.lit("|"), F.col("item.type"))).otherwise(F.col("item.name"))
    key = F.when(F.col("_n") == 1, F.col("i").cast("string")).otherwise(merge_key(name))
    once = entries.groupBy(page, "kind", key.alias("_key")).agg(F.min(F.struct("seg", "i", "item")).alias("_at"))
    judged = {"components": ("name", "type", "description"), "states_detail": ("name",)}
    tool = reduce(or_, [F.when(F.col("kind") == kind, reduce(or_, [is_tool_text(F.col(f"_at.item.{c}")) for c in fields])).otherwise(F.lit(False)) for kind, fields in judged.items()])
    tool = tool | (F.col("kind").isin(*LISTS) & is_tool_text(F.col("_at.item.name")))
    listed = F.array_sort(F.collect_list(F.struct("kind", "_at.seg", "_at.i", "_at.item")))
    kept = once.filter(~tool).groupBy(F.col(page).alias("_page")).agg(listed.alias("_kept"))
    items = lambda kind: F.transform(F.filter(F.coalesce("_kept", F.array().cast(kept.schema["_kept"].dataType)), lambda e: e["kind"] == kind), lambda e: e["item"])
    detail = F.transform(items("states_detail"), lambda e: F.struct(e["name"].alias("element"), e["description"].alias("detail")))
    joined = heads.join(kept, F.col(page).eqNullSafe(F.col("_page")), "left")
    return joined.select(*heads.columns, items("components").alias("components"), *[F.transform(items(kind), lambda e: e["name"]).alias(kind) for kind in LISTS], detail.alias("states_detail"))
