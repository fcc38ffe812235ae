"""Tables with like headers and readings of one page against plain loops."""

import random

from tessella.operators import alike, pages, structures, tables

WORDS = ["No", "Name", "name", "Names", "Price", "Prices list", "", " ", "时间", "时间 段", "奖励", "x", None]
TABLE = "page int, seq long, title string, headers array<string>, rows array<array<string>>, notes string, is_panel boolean, node int"


def like(a, b):
    """Header similarity, plainly."""
    def text(x, y):
        if not x or not y:
            return 0.0
        x, y = x.lower().strip(), y.lower().strip()
        return 1.0 if x == y else 0.8 if x in y or y in x else len(set(x) & set(y)) / len(set(x) | set(y))
    if not a or not b:
        return 0.0
    return 0.3 if len(a) != len(b) else sum(text(x, y) > 0.6 for x, y in zip(a, b)) / len(a)


def made(seed, n):
    random.seed(seed)
    headers = [[random.choice(WORDS) for _ in range(random.choice([0, 1, 2, 2, 3, 6]))] for _ in range(n // 2)] + [None]
    title = lambda: random.choice(["", None, "", "A", "a ", "B"])
    return [(random.randrange(3), i, title(), random.choice(headers), [[str(random.randrange(4))] for _ in range(random.randrange(4))], "n", False, 0) for i in range(n)]


def test_links_are_all_pairs_above_the_bound(spark):
    rows = made(1, 120)
    for bound in (0.7, 0.8):
        heads = spark.createDataFrame([(r[0], r[1], r[3]) for r in rows], "doc int, node long, headers array<string>")
        got = sorted((r.node, r.other) for r in alike.header_links(heads, bound).collect())
        want = sorted((a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] > b[1] and like(a[3], b[3]) > bound)
        assert got == want and len(want) > 20


def test_read_tables_are_kept_as_a_loop_keeps_them(spark):
    own, read = made(2, 20), made(3, 90)
    want = []
    for page in range(3):
        kept = [("dom", r) for r in own if r[0] == page]
        for r in read:
            if r[0] == page and not any(like(k[1][3], r[3]) > 0.8 for k in kept):
                kept.append(("vlm", r))
        want += [(page, place, source, r[3]) for place, (source, r) in enumerate(kept)]
    frame = lambda rows: spark.createDataFrame(rows, TABLE)
    got = sorted(((r.page, r.place, r.source, r.headers) for r in pages.merged_tables(frame(own), frame(read)).collect()), key=repr)
    assert got == sorted(want, key=repr)


def test_similar_tables_are_merged_as_a_loop_merges_them(spark):
    rows = made(4, 110)
    key = lambda t: "".join((t or "").lower().split())
    want = []
    for page in range(3):
        out = []
        for r in (r for r in rows if r[0] == page):
            first = next((o for o in out if (o[1] and r[2] and key(o[1]) == key(r[2])) or like(o[2], r[3]) > 0.7), None)
            if first is None:
                out.append([r[1], r[2], r[3], list(r[4])])
            else:
                known = {"|".join(x) for x in first[3]}
                for row in r[4]:
                    if "|".join(row) not in known:
                        known.add("|".join(row))
                        first[3].append(row)
        want += [(page, *o) for o in out]
    got = [(r.page, r.seq, r.title, r.headers, r.rows) for r in tables.similar_merged(spark.createDataFrame(rows, TABLE), "page").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_structures_of_one_and_of_several_readings(spark):
    item = "struct<name:string,type:string,description:string>"
    schema = f"page int, seg int, failed boolean, page_type string, layout string, visual_hierarchy string, components array<{item}>, interactions array<string>, states array<string>, key_info array<string>, states_detail array<struct<element:string,detail:string>>, kind string"
    detail = [("Bar", "d"), ("Axure", "d")]
    rows = [
        (1, 0, False, None, "l", "v", [("A", "t", "d"), ("A", "t", "d"), ("B", "翻页", "d")], ["x", "x"], None, ["3/6", "2024/1/2 and more of it"], detail, "k"),
        (2, 1, False, "", "second", "w", [("a ", "T", "e"), ("C", None, None)], ["Y，"], [None], [], detail, "k"), (2, 0, False, "p", "", "", [("A", "t", "d")], ["y", "z"], ["s"], None, None, "k"),
        (2, 2, True, "q", "bad", "", [("D", "t", "d")], None, None, None, None, "k"), (3, 0, True, "q", "bad", "", None, None, None, None, None, "k"), (None, 0, False, "n", None, None, None, ["i"], None, None, None, "k"),
    ]
    got = {r.page: r for r in structures.merged_structures(spark.createDataFrame(rows, schema)).collect()}
    plain = lambda r: (r.n_segments, r.page_type, r.layout, r.visual_hierarchy, [tuple(c) for c in r.components], r.interactions, r.states, r.key_info, [tuple(d) for d in r.states_detail])
    assert plain(got[1]) == (1, "", "l", "v", [("A", "t", "d"), ("A", "t", "d")], ["x", "x"], [], ["2024/1/2 and more of it"], [("Bar", "d")])
    assert plain(got[2]) == (2, "p", "[第1段] \n[第2段] second", "w", [("A", "t", "d"), ("C", "", "")], ["y", "z"], ["s", ""], [], [])
    assert plain(got[3]) == (0, "", "", "", [], [], [], [], []) and got[None].interactions == ["i"]
    assert structures.merged_structures(spark.createDataFrame([], schema)).count() == 0
