"""Queries of the tree, flow, listing, cache and ordered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import cache, flow, listing, sequence, tables, tree
from tessella.plans.common import PLACE, placed, sql_merge_key, sql_text_similarity, table


def adjacent_collapse(spark, sf_dir):
    """Runs of one event type of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return sequence.collapsed(events, "event_type", ["user_id"], "event_id")


def running_limit(spark, sf_dir):
    """Running number of purchases of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return sequence.running_sum(events, F.when(F.col("event_type") == "purchase", 1).otherwise(0), ["user_id"], "event_id", "n_purchases", block=700)


def _adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name, *cols: table(spark, sf_dir, name).selectExpr(*cols)
    root = spark.range(1).selectExpr("'world' AS id", "CAST(NULL AS STRING) AS parent", "'World' AS name")
    parts = [
        t("region", "concat('r', r_regionkey) AS id", "'world' AS parent", "r_name AS name"),
        t("nation", "concat('n', n_nationkey) AS id", "concat('r', n_regionkey) AS parent", "n_name AS name"),
        t("supplier", "concat('s', s_suppkey) AS id", "concat('n', s_nationkey) AS parent", "s_name AS name"),
        t("customer", "concat('c', c_custkey) AS id", "concat('n', c_nationkey) AS parent", "c_name AS name"),
    ]
    for p in parts:
        root = root.unionByName(p)
    return root


def tree_paths(spark, sf_dir):
    """Paths of regions, nations, suppliers and customers."""
    return tree.tree_paths(_adjacency(spark, sf_dir))


def subtree_size(spark, sf_dir):
    """Sizes of their subtrees."""
    return tree.subtree_sizes(_adjacency(spark, sf_dir))


_OUTLINE = {"tree": "conv_id", "pos": "turn", "level": "CAST(length(text) % 3 AS INT)", "name": "concat(role, '_', CAST(length(text) % 3 AS STRING))", "is_group": "role = 'user'"}


def _outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(*[f"{e} AS {n}" for n, e in _OUTLINE.items()])


def outline_paths(spark, sf_dir):
    """Paths and page numbers of conversations read as outlines."""
    return tree.page_numbers(tree.level_paths(_outline(spark, sf_dir))).select("tree", "pos", "path", F.col("page_index").cast("long").alias("page_index"))


def outline_members(spark, sf_dir):
    """Pages below each group of an outline."""
    return tree.group_members(_outline(spark, sf_dir))


def outline_targets(spark, sf_dir):
    """Targets by path, name or end of a path."""
    items = tree.level_paths(_outline(spark, sf_dir))
    wanted = items.select("tree", F.col("name").alias("target")).unionByName(items.select("tree", F.col("path").alias("target"))).distinct()
    return tree.matched_targets(items, wanted)


def outline_wanted(spark, sf_dir):
    """Pages asked for by name or path, and names that pick none."""
    items = tree.level_paths(_outline(spark, sf_dir))
    by_path = items.filter("pos % 3 = 0").select("tree", F.col("path").alias("name"))
    by_name = items.filter("pos % 4 = 1").select("tree", F.concat(F.lit(" "), "name", F.when(F.col("tree") % 2 == 0, "?").otherwise("")).alias("name"))
    return tree.wanted_pages(items, by_path.unionByName(by_name))


def _asked(items: DataFrame) -> DataFrame:
    """Names, ends of paths, and names that are not there."""
    by_end = items.filter("pos % 2 = 1").select("tree", F.substring("path", 4, 1000).alias("target"))
    lost = items.filter("pos = 2").select("tree", F.concat("name", F.lit("?")).alias("target"))
    return items.select("tree", F.col("name").alias("target")).unionByName(by_end).unionByName(lost)


def outline_explained(spark, sf_dir):
    """The row each target picks, or its candidates and the reason."""
    items = tree.level_paths(_outline(spark, sf_dir))
    return tree.explained_targets(items, _asked(items)).withColumn("candidates", F.array_join("candidates", "|"))


def outline_group_pages(spark, sf_dir):
    """Pages of the groups and pages that targets pick, a group's own page first."""
    items = tree.level_paths(_outline(spark, sf_dir)).withColumn("has_page", F.expr("pos % 3 = 0"))
    return tree.group_pages(items, tree.explained_targets(items, _asked(items)))


_SPLIT = r"\. "


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("seg"), F.posexplode(F.split("text", _SPLIT)).alias("seq", "text")).withColumn("node_id", F.col("seq").cast("string"))


def _merged(spark: SparkSession, sf_dir: str):
    rows = _segments(spark, sf_dir)
    nodes, ids = flow.merged_nodes(rows)
    steps = sequence.neighbour(rows.withColumn("k", F.concat_ws(":", F.col("doc").cast("string"), F.col("seg").cast("string"))), F.col("node_id"), ["k"], "seq", "to_id", ahead=True)
    edges = steps.filter("to_id IS NOT NULL").select("doc", "seg", "seq", F.col("node_id").alias("from_id"), "to_id", F.lit(None).cast("string").alias("condition"))
    return nodes, ids, flow.merged_edges(edges, ids)


def flow_merge_nodes(spark, sf_dir):
    """Sentences of a conversation as nodes, equal ones merged."""
    return _merged(spark, sf_dir)[0]


def flow_merge_edges(spark, sf_dir):
    """Edges between merged nodes."""
    return _merged(spark, sf_dir)[2].select("doc", "seg", "seq", "from", "to")


def segment_stitch(spark, sf_dir):
    """Edges that join segments."""
    _, ids, edges = _merged(spark, sf_dir)
    return flow.stitched_edges(ids, edges)


def flow_degree(spark, sf_dir):
    """Degrees and types of merged nodes."""
    nodes, _, edges = _merged(spark, sf_dir)
    return flow.degrees(nodes, edges)


def flow_mermaid(spark, sf_dir):
    """Flow charts as text."""
    nodes, _, edges = _merged(spark, sf_dir)
    typed = nodes.join(flow.degrees(nodes, edges).select("doc", "merged", "type"), ["doc", "merged"])
    return flow.mermaid(typed, edges)


def flow_main(spark, sf_dir):
    """Main flows of the segments as one: every other sentence."""
    steps = _segments(spark, sf_dir).filter("seq % 2 = 0").withColumnRenamed("seq", "k").drop("text")
    return flow.merged_main_flow(steps, flow.merged_nodes(_segments(spark, sf_dir))[1])


def flow_branches(spark, sf_dir):
    """Branches of each segment's first sentence: the others as conditions, and targets for some."""
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("seq") > 0, F.struct("seq", "text")))), lambda s: s["text"])
    aims = F.transform(F.sequence(F.lit(1), F.greatest(F.count("*").cast("int"), F.lit(1))), lambda i: F.when(i % 3 == 0, F.lit("nowhere")).when(i % 3 == 1, (i - 1).cast("string")))
    rows = _segments(spark, sf_dir).groupBy("doc", "seg").agg(listed.alias("conditions"), aims.alias("targets")).selectExpr("doc", "seg", "0 AS seq", "'0' AS node_id", "conditions", "targets")
    found = flow.merged_branches(rows, flow.merged_nodes(_segments(spark, sf_dir))[1])
    return found.select("doc", "node", F.array_join("conditions", "|").alias("conditions"), F.array_join("targets", "|").alias("targets"))


def flow_exceptions(spark, sf_dir):
    """Sentences of an odd length as exceptional flows, each once."""
    return flow.merged_exceptions(_segments(spark, sf_dir).filter("length(text) % 2 = 1"))


def sector_listing(spark, sf_dir):
    """Nations of each region by name, nameless ones by id."""
    sectors = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("sector_id")).agg(F.collect_list("n_nationkey").alias("images"))
    names = table(spark, sf_dir, "nation").filter("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("image_id"), F.col("n_name").alias("name"))
    return listing.sector_images(sectors, names)


def sector_designs(spark, sf_dir):
    """Customers as layers of nations as designs."""
    images = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("sector_id"), F.col("n_nationkey").alias("image_id"))
    layers = table(spark, sf_dir, "customer").filter("c_nationkey % 7 <> 0").selectExpr("c_nationkey AS image_id", "c_custkey % 300 AS x", "c_custkey % 200 AS y", "10 AS w", "20 AS h")
    return listing.sector_designs(images, layers)


def directory_listing(spark, sf_dir):
    """Suppliers of nations with their line items."""
    folders = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("folder_id"))
    projects = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS folder_id", "s_suppkey AS project_id", "s_name AS project", "CASE WHEN s_suppkey % 9 = 0 THEN 'HTTP 403' END AS error")
    return listing.directory(folders, projects, table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("project_id")))


def slice_files(spark, sf_dir):
    """Slices still to fetch, named by part."""
    slices = placed(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "place AS seq", "p_name AS name", "concat('https://x/', l_partkey, '.png') AS url", "CAST(p_partkey % 40 + 1 AS BIGINT) AS w", "CAST(p_partkey % 30 + 1 AS BIGINT) AS h")
    there = table(spark, sf_dir, "part").filter("p_size > 40").selectExpr("concat(replace(p_name, ' ', '_'), '_', substr(md5(concat('https://x/', p_partkey, '.png')), 1, 8), '@2x.png') AS file_name")
    return listing.slice_plan(slices, there)


def content_cache_key(spark, sf_dir):
    """Keys of all documents."""
    return table(spark, sf_dir, "documents").select("doc_id", cache.content_key(F.col("lang"), F.col("text")).alias("key"))


def _cached(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select(cache.content_key(F.col("lang"), F.col("text")).alias("key"), "doc_id")
    done = table(spark, sf_dir, "labels").join(docs, "doc_id").select("key", F.col("doc_id").alias("written_at"), "quality", (F.col("toxic") == 1).alias("failed"))
    return docs, done


def cache_resume(spark, sf_dir):
    """Documents whose content has no good label yet, one of each content."""
    docs, done = _cached(spark, sf_dir)
    return cache.open_tasks(docs, done)


def cache_lookup(spark, sf_dir):
    """Documents with the last label of their content."""
    docs, done = _cached(spark, sf_dir)
    return cache.with_results(docs, done, ["quality"])


def cache_totals(spark, sf_dir):
    """Entries and bytes of the documents as a cache."""
    return cache.cache_totals(table(spark, sf_dir, "documents"), "text")


_ADJACENT = {
    "doc": "l_suppkey % 97", "pos": PLACE, "title": "CASE l_partkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN '' END",
    "source": "CASE WHEN l_orderkey % 6 = 0 THEN 'vlm' WHEN l_orderkey % 6 > 1 THEN 'dom' END", "notes": "CASE l_linenumber % 3 WHEN 0 THEN 'n' || l_linenumber WHEN 1 THEN '' END",
}


def adjacent_tables(spark, sf_dir):
    """Adjacent lines of an order as tables merged: by headers, source and title."""
    t = placed(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in (_ADJACENT | {"pos": "place"}).items()], "CASE WHEN l_suppkey % 5 = 0 THEN array() ELSE array(l_returnflag) END AS headers", "array(array(CAST(l_partkey AS STRING))) AS rows")
    found = tables.adjacent_merged(t, ["doc"])
    return found.select("doc", "pos", F.array_join("headers", "|").alias("headers"), "title", "source", F.array_join(F.flatten("rows"), "|").alias("rows"), "notes")


def similar_tables(spark, sf_dir):
    """Turns as tables merged by title or like headers: two words as headers, every sentence a row."""
    rows = F.transform(F.split("text", _SPLIT), lambda s: F.split(s, " "))
    title = F.when(F.length("text") % 4 == 0, F.concat("role", (F.length("text") % 3).cast("string"))).otherwise(F.lit(""))
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("seq"), title.alias("title"), F.slice(F.split("text", " "), 1, 2).alias("headers"), rows.alias("rows"))
    found = tables.similar_merged(t)
    return found.select("doc", "seq", "title", F.array_join("headers", "|").alias("headers"), F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), ";").alias("rows"))


QUERIES = {f.__name__: f for f in (
    adjacent_collapse, running_limit, tree_paths, subtree_size, outline_paths, outline_members, outline_targets, outline_wanted, outline_explained, outline_group_pages, flow_merge_nodes, flow_merge_edges, segment_stitch, flow_degree,
    flow_mermaid, flow_main, flow_branches, flow_exceptions, sector_listing, sector_designs, directory_listing, slice_files, content_cache_key, cache_resume, cache_lookup, cache_totals, adjacent_tables, similar_tables,
)}

_TREE = """
WITH RECURSIVE a AS (SELECT 'world' AS id, NULL AS parent, 'World' AS name UNION ALL SELECT 'r' || r_regionkey, 'world', r_name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, s_name FROM supplier UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer),
p AS (SELECT id, 1 AS depth, name AS path, [id] AS up FROM a WHERE parent IS NULL UNION ALL SELECT a.id, depth + 1, path || '/' || a.name, list_append(up, a.id) FROM a JOIN p ON a.parent = p.id)"""
_OUT = "o AS (SELECT conv_id AS tree, turn AS pos, length(text) % 3 AS level, role || '_' || (length(text) % 3) AS name, role = 'user' AS is_group FROM conversations)"
_PATHS = f"""
WITH RECURSIVE {_OUT},
u AS (SELECT c.tree, c.pos, max(e.pos) AS up FROM o c LEFT JOIN o e ON e.tree = c.tree AND e.pos < c.pos AND e.level < c.level GROUP BY c.tree, c.pos),
p AS (SELECT o.tree, o.pos, o.name AS path FROM o JOIN u USING (tree, pos) WHERE up IS NULL UNION ALL SELECT o.tree, o.pos, p.path || '/' || o.name FROM o JOIN u USING (tree, pos) JOIN p ON p.tree = o.tree AND p.pos = u.up)"""
_FLOW = f"""
WITH t AS (SELECT conv_id AS doc, turn AS seg, string_split(text, '. ') AS parts FROM conversations),
r AS (SELECT doc, seg, CAST(i - 1 AS INTEGER) AS seq, parts[i] AS text, {sql_merge_key('parts[i]')} AS k FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM t)),
f AS (SELECT doc, k, arg_min(text, seg * 1000000 + seq) AS text, min(seg * 1000000 + seq) AS first_at FROM r GROUP BY doc, k),
n AS (SELECT *, 'n' || row_number() OVER (PARTITION BY doc ORDER BY first_at) AS merged FROM f),
m AS (SELECT r.doc, seg, seq, merged FROM r JOIN n ON n.doc = r.doc AND n.k = r.k),
e0 AS (SELECT doc, seg, seq, merged AS "from", lead(merged) OVER (PARTITION BY doc, seg ORDER BY seq) AS "to" FROM m),
e AS (SELECT * FROM e0 WHERE "to" IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc, "from", "to" ORDER BY seg, seq) = 1),
g AS (SELECT n.doc, n.merged, (SELECT count(*) FROM e WHERE e.doc = n.doc AND e."to" = n.merged) AS in_degree, (SELECT count(*) FROM e WHERE e.doc = n.doc AND e."from" = n.merged) AS out_degree FROM n),
d AS (SELECT *, CASE WHEN in_degree = 0 THEN 'start' WHEN out_degree = 0 THEN 'end' ELSE 'process' END AS type FROM g)"""
_KEYED = "k AS (SELECT doc_id, md5(coalesce(lang, '') || '::' || coalesce(text, '')) AS key FROM documents), done AS (SELECT key, doc_id AS written_at, quality, toxic = 1 AS failed FROM labels JOIN k USING (doc_id))"

_ASKED = _PATHS + f""", i AS (SELECT tree, pos, name, path, level, is_group FROM p JOIN o USING (tree, pos)),
w AS (SELECT DISTINCT tree, target FROM (SELECT tree, name AS target FROM i UNION ALL SELECT tree, path[4:] FROM i WHERE pos % 2 = 1 UNION ALL SELECT tree, name || '?' FROM i WHERE pos = 2)),
h AS (SELECT w.tree, w.target, i.*, i.path = w.target AS s1, i.name = w.target AS s2, ends_with(i.path, w.target) AS s3 FROM w JOIN i ON i.tree = w.tree WHERE i.name = w.target OR ends_with(i.path, w.target)),
c AS (SELECT tree, target, count(*) FILTER (s1) AS n1, count(*) FILTER (s2) AS n2, count(*) FILTER (s3) AS n3, count(*) AS n, min(pos) FILTER (s1) AS p1, min(pos) FILTER (s2) AS p2, min(pos) FILTER (s3) AS p3,
  string_agg(path, '|' ORDER BY CASE WHEN s1 THEN 1 WHEN s2 THEN 2 ELSE 3 END, pos) AS candidates, string_agg(path, '、' ORDER BY CASE WHEN s1 THEN 1 WHEN s2 THEN 2 ELSE 3 END, pos) AS told FROM h GROUP BY tree, target),
x AS (SELECT w.tree, w.target, CASE WHEN n1 = 1 THEN p1 WHEN n2 = 1 THEN p2 WHEN n3 = 1 THEN p3 END AS spot, coalesce(n, 0) AS n, candidates, told FROM w LEFT JOIN c ON c.tree = w.tree AND c.target = w.target)"""

ORACLES = {
    "outline_explained": _ASKED + """ SELECT x.tree, x.target, i.pos, i.name, i.path, CAST(i.level AS INTEGER) AS level, i.is_group, CASE WHEN spot IS NULL THEN coalesce(candidates, '') END AS candidates,
        CASE WHEN spot IS NOT NULL THEN NULL WHEN n > 0 THEN '「' || x.target || '」匹配到 ' || n || ' 个节点：' || told || '。请使用完整路径（父分组/页面名）区分'
          ELSE '目录中未找到「' || x.target || '」。可用路径：' || (SELECT string_agg(a.path, '、' ORDER BY a.pos) FROM i a WHERE a.tree = x.tree) END AS reason FROM x LEFT JOIN i ON i.tree = x.tree AND i.pos = x.spot""",
    "outline_group_pages": _ASKED + """, g AS (SELECT x.tree, x.target, i.*, (SELECT min(e.pos) FROM i e WHERE e.tree = i.tree AND e.pos > i.pos AND e.level <= i.level) AS stop FROM x JOIN i ON i.tree = x.tree AND i.pos = x.spot)
        SELECT tree, target, is_group AS own, pos, name, path FROM g WHERE NOT is_group OR pos % 3 = 0
        UNION ALL SELECT g.tree, g.target, false, i.pos, i.name, i.path FROM g JOIN i ON i.tree = g.tree AND NOT i.is_group AND i.pos > g.pos AND (stop IS NULL OR i.pos < stop) WHERE g.is_group""",
    "adjacent_collapse": """
        WITH c AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS c FROM events),
        i AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM c)
        SELECT user_id, min(event_id) AS first_event_id, any_value(event_type) AS event_type, count(*) AS times FROM i GROUP BY user_id, island""",
    "running_limit": "SELECT user_id, event_id, event_type, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS n_purchases FROM events",
    "tree_paths": _TREE + " SELECT id, depth, path FROM p",
    "subtree_size": _TREE + ", x AS (SELECT unnest(up) AS id FROM p) SELECT id, count(*) AS size FROM x GROUP BY id",
    "outline_paths": _PATHS + " SELECT tree, pos, path, CASE WHEN NOT is_group THEN CAST(sum(CASE WHEN is_group THEN 0 ELSE 1 END) OVER (PARTITION BY tree ORDER BY pos) - 1 AS BIGINT) END AS page_index FROM p JOIN o USING (tree, pos)",
    "outline_members": f"""WITH {_OUT}, g AS (SELECT tree, pos, level, (SELECT min(e.pos) FROM o e WHERE e.tree = o.tree AND e.pos > o.pos AND e.level <= o.level) AS stop FROM o WHERE is_group)
        SELECT g.tree, g.pos AS group_pos, o.pos FROM g JOIN o ON o.tree = g.tree AND NOT o.is_group AND o.pos > g.pos AND (stop IS NULL OR o.pos < stop)""",
    "outline_targets": _PATHS + """, i AS (SELECT tree, pos, name, path FROM p JOIN o USING (tree, pos)), w AS (SELECT DISTINCT tree, target FROM (SELECT tree, name AS target FROM i UNION ALL SELECT tree, path FROM i)),
        h AS (SELECT w.tree, w.target, i.path, i.path = w.target AS s1, i.name = w.target AS s2, ends_with(i.path, w.target) AS s3 FROM w JOIN i ON i.tree = w.tree),
        c AS (SELECT tree, target, count(*) FILTER (s1) AS n1, count(*) FILTER (s2) AS n2, count(*) FILTER (s3) AS n3, min(path) FILTER (s1) AS p1, min(path) FILTER (s2) AS p2, min(path) FILTER (s3) AS p3, count(DISTINCT path) FILTER (s1 OR s2 OR s3) AS n FROM h GROUP BY tree, target)
        SELECT tree, target, CASE WHEN n1 = 1 THEN p1 WHEN n2 = 1 THEN p2 WHEN n3 = 1 THEN p3 END AS path, n AS n_candidates FROM c""",
    "outline_wanted": _PATHS + """, i AS (SELECT tree, pos, name, path FROM p JOIN o USING (tree, pos)),
        w AS (SELECT DISTINCT tree, want FROM (SELECT tree, path AS want FROM i WHERE pos % 3 = 0 UNION ALL SELECT tree, name || CASE WHEN tree % 2 = 0 THEN '?' ELSE '' END FROM i WHERE pos % 4 = 1))
        SELECT DISTINCT tree, pos, name, CAST(NULL AS VARCHAR) AS error FROM i WHERE EXISTS (SELECT 1 FROM w WHERE w.tree = i.tree AND (want = name OR want = path))
        UNION ALL SELECT tree, NULL, want, 'no page of this name' FROM w WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.tree = w.tree AND (want = name OR want = path))""",
    "flow_merge_nodes": _FLOW + " SELECT doc, merged, text, first_at // 1000000 AS seg, CAST(first_at % 1000000 AS INTEGER) AS seq FROM n",
    "flow_merge_edges": _FLOW + ' SELECT doc, seg, seq, "from", "to" FROM e',
    "segment_stitch": _FLOW + """, s AS (SELECT doc, seg, arg_min(merged, seq) AS head, arg_max(merged, seq) AS tail FROM m GROUP BY doc, seg), p AS (SELECT doc, seg, tail AS "from", lead(head) OVER (PARTITION BY doc ORDER BY seg) AS "to" FROM s)
        SELECT doc, seg, "from", "to" FROM p WHERE "to" IS NOT NULL AND "from" <> "to" AND NOT EXISTS (SELECT 1 FROM e WHERE e.doc = p.doc AND e."from" = p."from") QUALIFY row_number() OVER (PARTITION BY doc, "from" ORDER BY seg) = 1""",
    "flow_degree": _FLOW + " SELECT doc, merged, in_degree, out_degree, type FROM d",
    "flow_mermaid": _FLOW + """, l AS (SELECT n.doc, 0 AS part, first_at AS o, '    ' || n.merged || CASE WHEN type = 'process' THEN '[' || t || ']' ELSE '([' || t || '])' END AS line FROM (SELECT *, replace(replace(text, '"', ''''), chr(10), ' ') AS t FROM n) n JOIN d ON d.doc = n.doc AND d.merged = n.merged
          UNION ALL SELECT doc, 1, seg * 1000000 + seq, '    ' || "from" || ' --> ' || "to" FROM e)
        SELECT doc, '```mermaid' || chr(10) || 'flowchart TD' || chr(10) || string_agg(line, chr(10) ORDER BY part, o) || chr(10) || '```' AS mermaid FROM l GROUP BY doc""",
    "flow_main": _FLOW + " SELECT doc, merged, arg_min(seg, seg * 1000000 + seq) AS seg, arg_min(seq, seg * 1000000 + seq) AS k FROM m WHERE seq % 2 = 0 GROUP BY doc, merged",
    "flow_branches": _FLOW + f""", b AS (SELECT r.doc, r.seg, r.seq, r.text, CASE WHEN r.seq % 3 = 0 THEN 'nowhere' WHEN r.seq % 3 = 1 THEN coalesce(t.merged, CAST(r.seq - 1 AS VARCHAR)) ELSE '' END AS target, h.merged AS node
            FROM r JOIN m h ON h.doc = r.doc AND h.seg = r.seg AND h.seq = 0 LEFT JOIN m t ON t.doc = r.doc AND t.seg = r.seg AND t.seq = r.seq - 1 WHERE r.seq > 0),
        q AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY doc, node, {sql_merge_key('text')} ORDER BY seg, seq) = 1)
        SELECT h.doc, h.node, coalesce(string_agg(text, '|' ORDER BY seg, seq), '') AS conditions, coalesce(string_agg(target, '|' ORDER BY seg, seq), '') AS targets
        FROM (SELECT DISTINCT doc, merged AS node FROM m WHERE seq = 0) h LEFT JOIN q ON q.doc = h.doc AND q.node = h.node GROUP BY h.doc, h.node""",
    "flow_exceptions": _FLOW + " SELECT doc, seg, seq, text FROM r WHERE length(text) % 2 = 1 QUALIFY row_number() OVER (PARTITION BY doc, k ORDER BY seg, seq) = 1",
    "sector_listing": "SELECT n_regionkey AS sector_id, n_nationkey AS image_id, CASE WHEN n_nationkey % 3 <> 0 THEN n_name ELSE CAST(n_nationkey AS VARCHAR) END AS image_name FROM nation",
    "sector_designs": "SELECT n_regionkey AS sector_id, n_nationkey AS image_id, count(c_custkey) AS n_layers, max(c_custkey % 300 + 10) AS width, max(c_custkey % 200 + 20) AS height, count(c_custkey) = 0 AS failed FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_nationkey % 7 <> 0 GROUP BY ALL",
    "directory_listing": "SELECT s_nationkey AS folder_id, s_suppkey AS project_id, s_name AS project, CASE WHEN s_suppkey % 9 <> 0 THEN (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) END AS n_sectors, CASE WHEN s_suppkey % 9 = 0 THEN 'HTTP 403' END AS error FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation)",
    "slice_files": """
        WITH s AS (SELECT DISTINCT p_partkey, p_name, p_size, 'https://x/' || p_partkey || '.png' AS url, p_partkey % 40 + 1 AS w, p_partkey % 30 + 1 AS h FROM lineitem JOIN part ON l_partkey = p_partkey)
        SELECT p_name AS name, url, replace(p_name, ' ', '_') || '_' || md5(url)[:8] || '@2x.png' AS file_name, url || '?x-oss-process=image/resize,w_' || (w * 2) || ',h_' || (h * 2) || '/format,png' AS scale_url FROM s WHERE p_size <= 40""",
    "content_cache_key": "SELECT doc_id, md5(coalesce(lang, '') || '::' || coalesce(text, '')) AS key FROM documents",
    "cache_resume": f"WITH {_KEYED} SELECT key, min(doc_id) AS doc_id FROM k WHERE key NOT IN (SELECT key FROM done WHERE NOT coalesce(failed, false)) GROUP BY key",
    "cache_lookup": f"WITH {_KEYED}, r AS (SELECT key, arg_max(quality, written_at) AS quality FROM done WHERE NOT coalesce(failed, false) GROUP BY key) SELECT k.key, doc_id, quality FROM k LEFT JOIN r ON r.key = k.key",
    "cache_totals": "SELECT count(*) AS n_entries, CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS n_bytes FROM documents",
    "similar_tables": f"""
        WITH RECURSIVE t AS (SELECT conv_id AS doc, turn AS seq, CASE WHEN length(text) % 4 = 0 THEN role || (length(text) % 3) ELSE '' END AS title, string_split(text, ' ')[1:2] AS h, string_split(text, '. ') AS rows, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
        k AS (SELECT *, [{{'title': title, 'h': h}}] AS kept, CAST(0 AS BIGINT) AS place FROM t WHERE n = 1 UNION ALL
          SELECT t.*, CASE WHEN p IS NULL THEN list_append(k.kept, {{'title': t.title, 'h': t.h}}) ELSE k.kept END, coalesce(p, len(k.kept)) FROM k JOIN t ON t.doc = k.doc AND t.n = k.n + 1,
            LATERAL (SELECT list_min(list_filter(range(len(k.kept)), lambda i: (t.title <> '' AND k.kept[i + 1].title = t.title) OR (len(k.kept[i + 1].h) = len(t.h) AND {sql_text_similarity('k.kept[i + 1].h[1]', 't.h[1]')} > 0.6
              AND (len(t.h) < 2 OR {sql_text_similarity('k.kept[i + 1].h[2]', 't.h[2]')} > 0.6)))) AS p)),
        r AS (SELECT doc, place, seq, i, rows[i] AS row, min(seq) OVER (PARTITION BY doc, place) AS first_seq FROM (SELECT *, unnest(range(1, len(rows) + 1)) AS i FROM k)),
        d AS (SELECT * FROM r QUALIFY seq = first_seq OR row_number() OVER (PARTITION BY doc, place, {sql_merge_key("replace(row, ' ', '|')")} ORDER BY seq, i) = 1)
        SELECT doc, first_seq AS seq, any_value(title) AS title, any_value(headers) AS headers, string_agg(replace(row, ' ', '|'), ';' ORDER BY d.seq, i) AS rows
        FROM d JOIN (SELECT doc AS k_doc, place AS k_place, arg_min(title, seq) AS title, arg_min(array_to_string(h, '|'), seq) AS headers FROM k GROUP BY ALL) ON k_doc = doc AND k_place = place GROUP BY doc, first_seq, place""",
    "adjacent_tables": f"""
        WITH RECURSIVE t AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _ADJACENT.items())}, CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE l_returnflag END AS headers, CAST(l_partkey AS VARCHAR) AS row FROM lineitem),
        k AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY pos) AS n FROM t),
        f AS (SELECT *, n AS g, title AS g_title FROM k WHERE n = 1 UNION ALL
          SELECT k.*, CASE WHEN joins THEN f.g ELSE k.n END, CASE WHEN joins THEN f.g_title ELSE k.title END FROM f JOIN k ON k.doc = f.doc AND k.n = f.n + 1,
            LATERAL (SELECT k.headers <> '' AND k.headers = f.headers AND k.source IS NOT DISTINCT FROM f.source AND (coalesce(k.title, '') = '' OR k.title = coalesce(f.g_title, '')) AS joins))
        SELECT doc, min(pos) AS pos, any_value(headers) AS headers, arg_min_null(g_title, pos) AS title, any_value(source) AS source, string_agg(row, '|' ORDER BY pos) AS rows, coalesce(string_agg(notes, '；' ORDER BY pos) FILTER (notes <> ''), '') AS notes FROM f GROUP BY doc, g""",
}
