"""Targets of an outline explained, and the pages they stand for."""

from tessella.operators import tree

ITEMS = "tree string, pos int, level int, name string, is_group boolean, has_page boolean, row int"
OUTLINE = [
    ("t", 0, 0, "A", True, True, 1), ("t", 1, 1, "home", False, None, 1), ("t", 2, 1, "B", True, None, 1), ("t", 3, 2, "home", False, None, 1),
    ("t", 4, 0, "C", True, False, 1), ("t", 5, 1, "flow", False, None, 1), ("pages", 0, 0, "x", False, None, 1),
]


def _found(spark, wanted, **options):
    items = tree.level_paths(spark.createDataFrame(OUTLINE, ITEMS))
    targets = tree.explained_targets(items, spark.createDataFrame(wanted, "tree string, target string"), **options)
    pages = sorted((r.tree, r.target, not r.own, r.pos, r.path) for r in tree.group_pages(items, targets).collect())
    return {(r.tree, r.target): (r.path, r.candidates, r.reason) for r in targets.collect()}, pages


def test_reasons_and_candidates(spark):
    wanted = [("t", "A"), ("t", "home"), ("t", "home"), ("t", "B/home"), ("t", "nowhere"), ("t", "low"), ("pages", None), ("none", "x")]
    got, pages = _found(spark, wanted)
    assert got == {
        ("t", "A"): ("A", None, None), ("t", "home"): (None, ["A/home", "A/B/home"], "「home」匹配到 2 个节点：A/home、A/B/home。请使用完整路径（父分组/页面名）区分"), ("t", "B/home"): ("A/B/home", None, None),
        ("t", "nowhere"): (None, [], "目录中未找到「nowhere」。可用路径：A、A/home、A/B、A/B/home、C、C/flow"), ("t", "low"): ("C/flow", None, None), ("pages", ""): ("x", None, None), ("none", "x"): (None, [], "目录中没有任何节点"),
    }
    assert pages == [
        ("pages", "", True, 0, "x"), ("t", "A", False, 0, "A"), ("t", "A", True, 1, "A/home"), ("t", "A", True, 3, "A/B/home"), ("t", "B/home", True, 3, "A/B/home"), ("t", "low", True, 5, "C/flow"),
    ]


def test_groups_only_and_empty_tables(spark):
    got, pages = _found(spark, [("t", "C"), ("t", "flow"), ("pages", "x")], groups_only=True)
    assert got == {("t", "C"): ("C", None, None), ("t", "flow"): (None, [], "目录中未找到「flow」。可用路径：A、A/B、C"), ("pages", "x"): (None, [], "目录中没有任何分组")}
    assert pages == [("t", "C", True, 5, "C/flow")]
    assert _found(spark, []) == ({}, [])
