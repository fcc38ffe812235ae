"""Each pipeline stage against a brute-force reading of its own input."""

import numpy as np
import pytest

import corpus_pipeline as pipeline
from tessella.llm import bpe, queries, secrets

SF = "/root/testdata/sf0.001"
COLUMNS = pipeline.COLUMNS


@pytest.fixture(scope="module")
def staged(spark):
    from tessella.llm.common import written

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, SF), f"test-{name}")
        out.append((docs.toPandas(), after.toPandas()))
        docs = after
    return out, docs


def test_order_and_columns(staged):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_dedup", "secret_scan", "source_mix", "bpe_encode"]
    assert all(list(after.columns) == COLUMNS for _, after in staged[0])


def test_language_stage_keeps_what_has_letters_and_writes_the_language(staged):
    before, after = staged[0][0]
    assert set(after.doc_id) == set(before[before.text.fillna("").str.contains(r"[^\W\d_]", regex=True)].doc_id)
    both = before.merge(after, on="doc_id")
    assert (both.text_x == both.text_y).all() and (both.lang_x == both.lang_y).mean() > 0.97 and both.lang_y.notna().all()


CASES = [
    (1, None, "en", "s", 0), (2, "", None, None, 0), (None, "½ ① 12", "en", "s", 6), (4, "中文字", None, "s", 3), (9, "the cat and the dog", "en", "s", 19),
    (9, "the cat and the dog", "en", "s", 19), (None, "the bird and the fish", None, None, 21), (7, "der hund und die katze " * 20_000, "de", "t", 460_000), (8, "password=abcdef99 und der", "de", None, 25),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, h string, root long, spans string, copies int"


def cases(spark, rows=CASES):
    """Documents with nulls, repeated rows and columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, "i", "h", 7, "s", 9) for r in rows], SCHEMA)


def test_language_stage_by_hand(spark):
    out = pipeline.language_id(spark, cases(spark), SF)
    assert out.columns == COLUMNS
    assert sorted((r.doc_id or 0, r.lang) for r in out.collect()) == [(0, "en"), (7, "de"), (8, "de"), (9, "en"), (9, "en")]
    unlabelled = cases(spark, [(i, t, None, s, n) for i, t, _, s, n in CASES])
    assert sorted(r.doc_id or 0 for r in pipeline.language_id(spark, unlabelled, SF).collect()) == [0, 4, 7, 8, 9, 9]


def test_dedup_stage_by_hand(spark):
    out = pipeline.near_dedup(spark, cases(spark), SF)
    assert out.columns == COLUMNS and sorted((r.doc_id or 0, (r.text or "")[:5]) for r in out.collect()) == sorted(
        {(i or 0, (t or "")[:5]) for i, t, *_ in CASES}
    )


def test_mix_stage_by_hand(spark):
    """Certain copies and sums by source; repeated rows share their copies."""
    rows = [(1, "a b c", "en", "s", 5)] * 3 + [(2, "d e f g", "en", "t", 7), (None, "x y", None, None, 3), (3, None, "en", "s", 0), (4, "", "en", "t", 0)]
    out = [(r.doc_id, r.text, r.source) for r in pipeline.source_mix(spark, cases(spark, rows), SF).collect()]
    # Targets: s 15 * 1.5 * 5 / 8 = 14.1 of 9 words, t 5.6 of 4, null 2.8 of 2: one or two copies of each.
    want = {(1, "a b c", "s"): 4, (2, "d e f g", "t"): 1, (None, "x y", None): 1, (3, None, "s"): 1, (4, "", "t"): 1}
    assert {x: out.count(x) for x in set(out)} == want


def test_encode_stage_by_hand(spark):
    out = pipeline.bpe_encode(spark, cases(spark), SF).collect()
    assert sorted((r.doc_id or 0, r.n_tokens == len(r.ids), r.n_tokens > 0) for r in out) == sorted((i or 0, True, bool(t)) for i, t, *_ in CASES)


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES])
def test_stages_take_an_empty_table(spark, stage):
    assert stage(spark, cases(spark, []), SF).count() == 0


def test_dedup_stage_keeps_one_of_each_group(staged):
    before, after = staged[0][1]
    kept = list(after.itertuples())
    sets = {}
    for r in before.itertuples():
        w = (r.text or "").encode().lower().split()
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    like = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    ids = [r.doc_id for r in kept]
    assert not any(like(sets[a], sets[b]) for i, a in enumerate(ids) for b in ids[:i])
    assert all(any(like(sets[g], sets[o]) for o in sets if o < g) for g in set(before.doc_id) - set(ids))


def test_dedup_stage_keeps_one_where_ids_are_null_or_repeat(spark):
    words = lambda c: " ".join(f"{c}{i}" for i in range(60))
    texts = [(1, "a", ""), (1, "a", " more"), (1, "c", ""), (None, "b", ""), (None, "b", " more"), (None, "d", ""), (None, "d", "")]
    docs = spark.createDataFrame([(i, words(c) + end, "en", "s", 0) for i, c, end in texts], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text[0]) for r in pipeline.near_dedup(spark, docs, SF).collect()]
    assert sorted(kept, key=str) == sorted([(1, "a"), (1, "c"), (None, "b"), (None, "d")], key=str)


def test_secret_stage_masks_and_loses_no_document(spark, staged):
    before, after = staged[0][2]
    assert sorted(before.doc_id) == sorted(after.doc_id) and (after.n_chars == after.text.str.len()).all()
    left = secrets.secret_digest(spark.createDataFrame(after[COLUMNS])).filter("n_assign + n_access + n_hex > 0").count()
    assert left == 0
    same = before.merge(after, on="doc_id")
    assert (same.text_x != same.text_y).sum() == same.text_y.str.contains("[SECRET]", regex=False).sum()


def test_secret_stage_masks_by_hand(spark):
    rows = [(1, 'say token: "abcdef99" now', "en", "s", 25), (2, "nothing", "en", None, 7), (None, "AKIA" + "Z" * 16, None, "s", 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: (r.text, r.n_chars) for r in pipeline.secret_scan(spark, docs, SF).collect()}
    assert out == {1: ('say [SECRET]" now', 17), 2: ("nothing", 7), None: ("[SECRET]", 8)}


def test_mix_stage_repeats_whole_documents(staged):
    before, after = staged[0][3]
    counts = after.groupby("doc_id").size()
    assert counts.max() <= 2 and set(after.text) <= set(before.text)
    words = lambda df: df.text.str.split().str.len().sum()
    assert words(after) == pytest.approx(1.5 * words(before), rel=0.02)


def test_last_stage_encodes_every_copy(spark, staged):
    docs = staged[1]
    path = queries.tokenizer_path("word_bpe_49k.json")
    want = sorted((r.doc_id, np.frombuffer(bpe.encoded_texts([r.text], path)[0], "<u4").tolist()) for r in docs.collect())
    assert sorted((r.doc_id, r.ids) for r in pipeline.bpe_encode(spark, docs, SF).collect()) == want
