"""Trees as adjacency lists and as level lists: paths, subtree sizes, target lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.arrays import scan
from tessella.functions.text import trimmed
from tessella.session import shared_checkpoint

NOT_FOUND = "no page of this name"


def ancestors(nodes: DataFrame, most_depth: int = 1024) -> DataFrame:
    """``id, ancestors`` (ids from the root to the node itself) of an adjacency list ``id, parent``.

    Pointer doubling: each round joins every open chain with that of its far end, so depth d takes
    log2(d) rounds of one shuffle join. A parent that is no node makes a root. A cycle raises
    ValueError once ``most_depth`` is passed.
    """
    known = nodes.select(F.col("id").alias("_known")).distinct()
    linked = nodes.join(known, F.col("parent") == F.col("_known"), "left")
    state = shared_checkpoint(linked.select("id", F.col("_known").alias("far"), F.array("id").alias("chain")))
    reach = 1
    while state.filter(F.col("far").isNotNull()).limit(1).count():
        if reach > most_depth:
            raise ValueError(f"a path is longer than {most_depth} or runs in a circle")
        above = state.select(F.col("id").alias("_id"), F.col("far").alias("_far"), F.col("chain").alias("_chain"))
        joined = state.join(above, F.col("far") == F.col("_id"), "left")
        longer = F.when(F.col("_chain").isNotNull(), F.concat("_chain", "chain")).otherwise(F.col("chain"))
        state = shared_checkpoint(joined.select("id", F.col("_far").alias("far"), longer.alias("chain")))
        reach *= 2
    return state.select("id", F.col("chain").alias("ancestors"))


def tree_paths(nodes: DataFrame, separator: str = "/") -> DataFrame:
    """``id, depth, path``: names (``name``) from the root joined; blank names are left out.

    A name is joined to each place of a chain as a pre-exploded row, so nothing is broadcast.
    """
    chains = ancestors(nodes.select("id", "parent"))
    steps = chains.select("id", F.size("ancestors").alias("depth"), F.posexplode("ancestors").alias("at", "step"))
    names = nodes.select(F.col("id").alias("step"), "name")
    named = steps.join(names, "step").groupBy("id", "depth").agg(F.array_sort(F.collect_list(F.struct("at", "name"))).alias("n"))
    parts = F.filter(F.transform("n", lambda s: s["name"]), lambda n: F.coalesce(n, F.lit("")) != "")
    return named.select("id", "depth", F.array_join(parts, separator).alias("path"))


def subtree_sizes(nodes: DataFrame) -> DataFrame:
    """``id, size``: the number of nodes in each node's subtree, itself included."""
    return ancestors(nodes).select(F.explode("ancestors").alias("id")).groupBy("id").agg(F.count("*").alias("size"))


_ROW = "struct<p:bigint,level:int,name:string,is_group:boolean>"


def _outlines(items: DataFrame, emit, kind: str, tree: str, pos: str, name: Column, is_group: Column) -> DataFrame:
    """``tree, o``: what ``emit`` makes of each row and the rows above it, as an outline's levels say."""
    row = F.struct(F.col(pos).cast("long").alias("p"), F.col("level").cast("int").alias("level"), name.alias("name"), is_group.alias("is_group"))
    above = lambda stack, x: F.filter(stack, lambda y: y["level"] < x["level"])
    push = lambda stack, x: F.concat(above(stack, x), F.array(x))
    results = scan(F.col("l"), F.array().cast(f"array<{_ROW}>"), push, lambda stack, x, _: emit(above(stack, x), x), f"array<{_ROW}>", kind)
    listed = items.groupBy(tree).agg(F.array_sort(F.collect_list(row)).alias("l"))
    return listed.select(tree, F.explode(results).alias("o"))


def level_paths(items: DataFrame, tree: str = "tree", pos: str = "pos", separator: str = "/") -> DataFrame:
    """``items`` (``level, name``) with ``path``: each row's parents are the last earlier rows of lower
    levels, as an outline lists them. An outline is one document's; a pass over it keeps the open rows only.
    """
    path = lambda above, x: F.array_join(F.concat(F.transform(above, lambda y: y["name"]), F.array(x["name"])), separator)
    emit = lambda above, x: F.struct(x["p"].alias("p"), path(above, x).alias("path"))
    found = _outlines(items, emit, "struct<p:bigint,path:string>", tree, pos, F.col("name"), F.lit(None).cast("boolean"))
    return items.join(found.select(tree, F.col("o.p").alias(pos), F.col("o.path").alias("path")), [tree, pos])


def group_members(items: DataFrame, tree: str = "tree", pos: str = "pos") -> DataFrame:
    """``tree, group_pos, pos``: pages below each group row (``is_group, level``): the rows after it up
    to the next one of its level or a higher one. A page knows the groups that are open where it stands."""
    groups = lambda above: F.transform(F.filter(above, lambda y: y["is_group"]), lambda y: y["p"])
    emit = lambda above, x: F.struct(x["p"].alias("p"), F.when(~x["is_group"], groups(above)).alias("groups"))
    found = _outlines(items, emit, "struct<p:bigint,groups:array<bigint>>", tree, pos, F.lit(None).cast("string"), F.col("is_group"))
    return found.select(tree, F.explode("o.groups").alias("group_pos"), F.col("o.p").alias(pos))


def page_numbers(items: DataFrame, tree: str = "tree", pos: str = "pos") -> DataFrame:
    """``items`` with ``page_index``: pages (not ``is_group``) numbered from 0 in order, null for groups."""
    order = Window.partitionBy(tree).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    number = F.sum(F.when(F.col("is_group"), 0).otherwise(1)).over(order) - 1
    return items.withColumn("page_index", F.when(~F.col("is_group"), number))


def matched_targets(items: DataFrame, wanted: DataFrame, tree: str = "tree") -> DataFrame:
    """``wanted`` (``tree, target``) with ``path`` and ``n_candidates``.

    A target is an exact path, else a unique name, else a unique end of a path; the first stage with
    exactly one hit decides, and ``path`` is null if none does.
    """
    hit = wanted.join(items.select(tree, "name", F.col("path").alias("_path")), tree)
    hit = hit.withColumn("_stage", F.when(F.col("_path") == F.col("target"), F.array(F.lit(1), F.lit(3))).otherwise(F.array(F.when(F.col("_path").endswith(F.col("target")), 3))))
    hit = hit.withColumn("_stage", F.array_compact(F.when(F.col("name") == F.col("target"), F.concat("_stage", F.array(F.lit(2)))).otherwise(F.col("_stage"))))
    stages = hit.select(tree, "target", "_path", F.explode("_stage").alias("_s")).groupBy(tree, "target", "_s").agg(F.count("*").alias("n"), F.min("_path").alias("p"))
    chosen = stages.groupBy(tree, "target").agg(F.min_by(F.when(F.col("n") == 1, F.col("p")), F.when(F.col("n") == 1, F.col("_s")).otherwise(F.lit(9) + F.col("_s"))).alias("path"))
    count = hit.filter(F.size("_stage") > 0).groupBy(tree, "target").agg(F.count_distinct("_path").alias("n_candidates"))
    return wanted.join(chosen, [tree, "target"], "left").join(count, [tree, "target"], "left").fillna(0, ["n_candidates"])


def wanted_pages(pages: DataFrame, wanted: DataFrame, tree: str = "tree", pos: str = "pos") -> DataFrame:
    """``tree, pos, name, error``: pages (``name, path``) that a wanted name or path picks, in their place, and a row with
    an error for each wanted name that picks none. Names are trimmed; blank ones and repeats do not count."""
    names = wanted.select(tree, trimmed(F.col("name")).alias("_want")).filter("_want <> ''").distinct()
    hits = pages.select(tree, pos, "name", F.explode(F.array_distinct(F.array("name", "path"))).alias("_want")).join(names, [tree, "_want"])
    found = hits.groupBy(tree, pos).agg(F.first("name").alias("name")).withColumn("error", F.lit(None).cast("string"))
    missing = names.join(hits.select(tree, "_want").distinct(), [tree, "_want"], "left_anti")
    return found.unionByName(missing.select(tree, F.lit(None).cast(pages.schema[pos].dataType).alias(pos), F.col("_want").alias("name"), F.lit(NOT_FOUND).alias("error")))


#: What is said of a target that picks no single row (fixed texts of the library's reports).
AMBIGUOUS, UNKNOWN, NO_ROWS = "「%s」匹配到 %d 个节点：%s。请使用完整路径（父分组/页面名）区分", "目录中未找到「%s」。可用路径：%s", "目录中没有任何%s"
NODES, GROUPS = "节点", "分组"


def explained_targets(items: DataFrame, wanted: DataFrame, groups_only: bool = False, tree: str = "tree", pos: str = "pos") -> DataFrame:
    """``wanted`` (``tree, target``), without repeats, with the row it picks and why it picks none.

    ``pos, name, path, level, is_group`` are the row of ``items`` that an exact path, else a unique name, else a unique end
    of a path picks; else null, with ``candidates``, the paths of all rows that any of these finds (paths, names and ends
    in this order, then as the outline has them), and ``reason``. ``groups_only`` looks at group rows only.
    Rows meet targets by equal texts (the ends of a path are listed), not pair by pair. A null target is as an empty one,
    which every path ends with; a tree without rows says so.
    """
    pool = items.filter("is_group") if groups_only else items
    row = F.struct(F.col(pos).alias("pos"), "name", "path", "level", "is_group")
    ends = F.transform(F.sequence(F.lit(1), F.char_length("path") + 1), lambda i: F.substring(F.col("path"), i, F.char_length("path")))
    listed = pool.select(tree, row.alias("row"), F.explode(F.array_distinct(F.concat(ends, F.array("name")))).alias("target"))
    asked = wanted.select(tree, F.coalesce("target", F.lit("")).alias("target")).distinct()
    stage = F.when(F.col("row.path") == F.col("target"), 1).when(F.col("row.name") == F.col("target"), 2).otherwise(3)
    hits = asked.join(listed, [tree, "target"]).withColumn("stage", stage)
    is_name, is_end = F.col("row.name") == F.col("target"), F.col("row.path").endswith(F.col("target"))
    only = lambda cond: F.when(F.count_if(cond) == 1, F.max(F.when(cond, F.col("row"))))
    found = hits.groupBy(tree, "target").agg(
        F.coalesce(only(F.col("stage") == 1), only(is_name), only(is_end)).alias("row"),
        F.transform(F.array_sort(F.collect_list(F.struct("stage", "row.pos", "row.path"))), lambda c: c["path"]).alias("candidates"))
    rows = asked.join(found, [tree, "target"], "left").withColumn("candidates", F.when(F.col("row").isNull(), F.coalesce("candidates", F.array().cast("array<string>"))))
    # Only targets without any hit need the paths of their tree.
    lost = rows.filter(F.size("candidates") == 0).select(tree).distinct()
    paths = pool.join(lost, tree, "left_semi").groupBy(tree).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), "path"))), lambda x: x["path"]), "、").alias("known"))
    n = F.size("candidates")
    reason = (
        F.when(n > 0, F.format_string(AMBIGUOUS, "target", n, F.array_join("candidates", "、")))
        .when(F.col("known").isNotNull(), F.format_string(UNKNOWN, "target", "known")).otherwise(F.lit(NO_ROWS % (GROUPS if groups_only else NODES)))
    )
    return rows.join(paths, tree, "left").select(tree, "target", "row.*", "candidates", F.when(F.col("row").isNull(), reason).alias("reason"))


def group_pages(items: DataFrame, targets: DataFrame, tree: str = "tree", pos: str = "pos") -> DataFrame:
    """``tree, target, own, pos, name, path``: the pages that each target of :func:`explained_targets` stands for.

    A page stands for itself; a group for its own page, if it has one (``has_page``), which comes first (``own``), and the
    pages below it. Targets without a row have none.
    """
    picked = targets.filter("is_group IS NOT NULL").select(tree, "target", F.col("pos").alias("at"), "is_group")
    rows = items.select(tree, F.col(pos).alias("pos"), "name", "path", "has_page")
    self_ = picked.join(rows.withColumnRenamed("pos", "at"), [tree, "at"]).filter(~F.col("is_group") | F.coalesce("has_page", F.lit(False)))
    self_ = self_.select(tree, "target", F.col("is_group").alias("own"), F.col("at").alias("pos"), "name", "path")
    members = group_members(items, tree, pos).select(tree, F.col("group_pos").alias("at"), F.col(pos).alias("pos"))
    below = picked.filter("is_group").join(members, [tree, "at"]).join(rows, [tree, "pos"])
    return self_.unionByName(below.select(tree, "target", F.lit(False).alias("own"), "pos", "name", "path"))
