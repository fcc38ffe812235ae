"""Hard negatives, HTML extraction and fill-in-middle against brute force, made pages and exact round trips."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from tessella.llm import extract, fim, negatives, queries
from tests.compare import SF, duck_rows, spark_rows

NEW = ["op11_hard_negatives", "op12_html_extraction", "op13_fill_in_middle"]
VECTORS = "vec_id long, embedding array<double>, label int, id string, v string, block int, found string"


@pytest.mark.parametrize("name", NEW)
def test_sql_agrees_on_an_empty_table(spark, name):
    columns, rows = spark_rows(queries.QUERIES[name](spark, SF).limit(0))
    assert columns == duck_rows(queries.ORACLES[name])[0] and rows == []


def mined(rows, every=100, low=80, high=100, k=5, scale=256):
    """Brute force over (id, vector, label) in Python's integers."""
    usable = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = min(usable.get(i, (v, label)), (v, label))
    whole = {i: [math.floor(scale * x) for x in v] for i, (v, _) in usable.items()}
    out = []
    for a in usable:
        if a % every:
            continue
        score = {b: sum(x * y for x, y in zip(whole[a], whole[b])) for b in usable if b != a}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if usable[b][1] == usable[a][1]][:k]:
            found = [b for b in order if usable[b][1] != usable[a][1] and low * score[p] <= 100 * score[b] <= high * score[p]][:k]
            out += [(a, p, i + 1, b, score[p], score[b]) for i, b in enumerate(found)]
    return sorted(out)


def test_hard_negatives_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 64)  # several blocks and packs
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 8)
    random.seed(4)
    centre = [[random.gauss(0, 1) for _ in range(7)] for _ in range(4)]
    near = lambda c: [x + random.gauss(0, 0.4) for x in centre[c]]
    rows = [(i, near(i % 4), [0, 0, 1, random.randrange(3)][i % 4]) for i in range(400)]
    rows += [(400 + i, rows[i % 9][1], i % 2) for i in range(60)]  # ties
    rows += [(None, near(0), 1), (500, None, 1), (510, near(1), None), (520, [1.0, None], 1), (530, [float("nan")], 1), (540, [float("inf"), 1.0], 1)]
    rows += [(7, rows[7][1], 2), (20, rows[20][1], rows[20][2]), (600, [], 1), (610, [0.5, 0.5], 0), (-20, near(2), 1), (620, [0.0] * 7, 0), (630, [1e9] * 7, 1), (640, [3e8, -2e8, 1.0], 0)]
    table = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], VECTORS)
    got = sorted(tuple(r) for r in negatives.hard_negatives(table, every=20).collect())
    want = mined(rows, 20)
    assert got == want and len(want) > 150
    assert negatives.hard_negatives(table.limit(0)).collect() == []
    alike = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in [(i, [1.0, 2.0], i % 2) for i in range(300)]], VECTORS)
    assert sorted(tuple(r) for r in negatives.hard_negatives(alike).collect()) == mined([(i, [1.0, 2.0], i % 2) for i in range(300)])


def test_scores_beyond_doubles_and_longs_stay_exact():
    x = np.array([[2.0**40, 3, 1, 0], [2.0**40, 4, 1, 0], [2.0**100, 1, 0, 0]])
    codes, norms = negatives.quantised(x, negatives.fit_centroids(x[:1]))
    data, kind = negatives.packed(x)
    row = {"ids": np.arange(3).tobytes(), "labels": np.zeros(3, np.int64).tobytes(), "n": 3, "x": data, "kind": kind, "codes": codes.tobytes(), "norms": norms.tobytes()}
    rows = negatives.Rows(row, 4, negatives.fit_centroids(x[:1]))
    q = np.array([2.0**30, 1, 0, 0])
    assert [int(s) for s in rows.scores(q, np.arange(3))] == [2**70 + 3, 2**70 + 4, 2**130 + 1]
    least, greatest = rows.bounds(q)
    assert all(a <= s <= b for a, s, b in zip(least, rows.scores(q, np.arange(3)), greatest))


def test_bounds_hold_and_discard_most_rows():
    rng = np.random.default_rng(0)
    x = np.floor(256 * (rng.normal(size=(20, 16))[rng.integers(0, 20, 3000)] + 0.2 * rng.normal(size=(3000, 16))))
    books = negatives.fit_centroids(x[:1000])
    codes, norms = negatives.quantised(x, books)
    data, kind = negatives.packed(x)
    rows = negatives.Rows({"ids": np.arange(3000).tobytes(), "labels": np.zeros(3000, np.int64).tobytes(), "n": 3000, "x": data, "kind": kind, "codes": codes.tobytes(), "norms": norms.tobytes()}, 16, books)
    for q in x[:20]:
        least, greatest = rows.bounds(q)
        exact = x @ q
        assert ((least <= exact) & (exact <= greatest)).all()
        assert (greatest >= negatives.kth_greatest(least, 5)).mean() < 0.2


LONG = "<p>" + "This sentence belongs to the article and has enough words to count. " * 3 + "</p>"
TEXT = " ".join(["This sentence belongs to the article and has enough words to count."] * 3)
OTHER = "<p>" + "Some other words about us, our offers and what we do all day. " * 9 + "</p>"
PAGES = {
    None: "",
    "": "",
    "just text\n here": "just text here",
    "<script>var a = '<p>no</p>';</script><style>p{}</style><title>t</title>": "",
    "<p>foo<b>bar</b> baz<br>qux &amp; &eacute; &#x41; a&nbsp;b &lt;i&gt;</p><div>next</div>": "foobar baz qux & é A a b <i> next",
    f'<body class="no-sidebar"><div id="header"><a href=/>Home</a> Name</div><div id="menu"><ul><li><a href=a>A</a><li><a href=b>B</a></ul></div><div class="content"><h1>Title</h1>{LONG}<p>Short.</p><ul><li>one<li>two</ul></div>'
    f'<div class="leftSidebar">{OTHER}</div><div class="comments">{OTHER}</div><div id="footer">Imprint</div>': f"Title {TEXT} Short. one two",
    f'<main><article><header><h1>T</h1></header><section><h2>A</h2>{LONG}{LONG}</section><section><h2>B</h2><p>Tiny.</p></section><form><p>Subscribe</p></form><section id="comments"><article class="comment">{OTHER}</article></section>'
    f"<footer>By X</footer></article></main><aside>{OTHER}</aside>": f"T A {TEXT} {TEXT} B Tiny.",
    f"<table><tr><td class=nav><a href=1>x</a><a href=2>y</a><td>{LONG}{LONG}</table>": f"{TEXT} {TEXT}",
    f"<div><div><a href=1>Home page</a> <a href=2>News page</a> <a href=3>Sport page</a></div><div><h1>Head</h1>{LONG}<p>See <a href=q>that</a>.</p></div></div>": f"Head {TEXT} See that.",
    f'<div class="cookie-banner">{OTHER}</div><div role="alert">{OTHER}</div><div class=post><h2>Hello</h2>{LONG}</div><div style="display: none">{OTHER}</div>': f"Hello {TEXT}",
    "<article><p>a <b>b <i>c</p><p>d</b> e</i><![foo[ x ]]></article><!-- open <p>f": "a b c d e",
    "<nav><a href=1>only</a></nav><form><p>a form</p></form>": "",
    "<div>" * 3000 + "x y" + "</div>" * 3000: "x y",
    "<article>" + "<p>word " * 20_000 + "</article>": " ".join(["word"] * 20_000),
}


def test_pages_give_their_articles(spark):
    rows = [(i if i != 3 else None, None if i == 2 else f"u{i}", html, "t", 5) for i, html in enumerate(PAGES)]
    table = spark.createDataFrame(rows + rows[4:5], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((r.page_id is None, r.page_id, r.url, r.text, r.n_chars) for r in extract.extract_pages(table).collect())
    want = [(i == 3, i if i != 3 else None, None if i == 2 else f"u{i}", text, len(text)) for i, text in enumerate(PAGES.values())]
    assert got == sorted(want + want[4:5], key=lambda r: (r[0], r[1] or 0))
    assert extract.extract_pages(table.limit(0)).collect() == []


@pytest.mark.parametrize("piece", ["<!--", "<a ", "</a ", "<?", "<!d", '<a href="', "<![CDATA[", "&#", "<", "<p>", "<b><div>", "<a href=1>", "<li>", "</p>"])
def test_broken_pages_take_time_in_proportion(piece):
    assert isinstance(extract.main_text(piece * 20_000), str)  # a scan a mark would take minutes


def plain_fim(doc_id, text):
    """The contract with plain slices."""
    text = text or ""
    units = re.findall(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 50:
        return (doc_id, len(units), "plain", None, None, sha(text), sha(text))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < 80 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, len(units), form, len(prefix), len(middle), sha(output), sha(text))


def test_fill_in_middle_equals_plain_slices_and_round_trips(spark):
    random.seed(1)
    texts = [None, "", " \t\n", "x", " a  b ", "é　中文 😀\x00 \x1c\x85 z", "a <P> b", "<S>", "x<M>", "<P", "S> <", "long " * 50_000]
    texts += ["".join(random.choice("ab <>PSM\n\té😀") for _ in range(random.randrange(40))) for _ in range(300)]
    rows = [(i if i != 4 else None, t, "n", 1.5, "f") for i, t in enumerate(texts)] + [(-7, "minus seven", "n", 1.5, "f")] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, n string, id double, form string")
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in fim.fim_digest(table).collect()), key=key) == sorted((plain_fim(r[0], r[1]) for r in rows), key=key)
    made = fim.fill_in_middle(table).collect()
    assert sorted(fim.restored(r.output, r.form) for r in made) == sorted(r[1] or "" for r in rows)
    assert {r.form for r in made} == {"plain", "psm", "spm"} and fim.fim_digest(table.limit(0)).collect() == []
    assert {r.form for r in fim.fill_in_middle(table, rate=100, spm_rate=0).collect()} == {"plain", "psm"}
