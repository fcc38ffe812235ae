"""The ten operators against brute force, exact round trips and held-out accuracy, edge cases included."""

import hashlib
import json
import random
import re
import tracemalloc
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from tessella.llm import bpe, components, langid, mixing, neardup, queries, secrets, sharding, substring, tokenfile, vectors
from tests.compare import SF, duck_rows, spark_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, id string, d long"
VECTORS = "vec_id long, embedding array<float>, label int, id string, v string"
BYTE, WORD = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("word_bpe_49k.json")
COPY = " ".join(f"w{i}" for i in range(40))
EDGES = [None, "", " \t\n", "x", "one two", COPY, COPY, COPY + " more", "word " * 30_000, "AKIA" + "Q" * 16 + " login: bob12", "é　中文 😀\x00", "<|endoftext|> a<|startoftext|>"]


def docs(spark, texts=EDGES):
    """Texts as documents with null and repeated ids and columns whose names clash with inner ones."""
    rows = [(None if i == 2 else i, t, [None, "en", "de"][i % 3], [None, "s", "t"][i % 3], 0, "h", "i", 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[5:6] if len(rows) > 6 else rows, DOCS)


DIGESTS = {
    "op1": secrets.secret_digest, "op2": mixing.mix_digest, "op4": sharding.shard_digest, "op6": lambda d: bpe.bpe_digest(d, WORD), "op7": neardup.near_duplicate_digest,
    "op8": substring.substring_digest, "op10": langid.language_digest, "op3": lambda d: tokenfile.read_tokens(tokenfile.write_tokens(d, BYTE)),
}


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_edge_cases_give_a_row_a_document(spark, name):
    assert DIGESTS[name](docs(spark)).count() == len(EDGES) + 1


def test_edge_cases_have_their_defined_values(spark):
    """Null, empty, blank, very long and repeated texts by id (2 is a null id): sizes, words, spans, tokens and languages."""
    rows = {name: defaultdict(list) for name in DIGESTS}
    for name, digest in DIGESTS.items():
        for r in digest(docs(spark)).collect():
            rows[name][r.doc_id].append(r)
    one = lambda name, i: rows[name][i][0]
    texts = {None if i == 2 else i: t or "" for i, t in enumerate(EDGES)}
    for i, t in texts.items():
        words = t.encode().split()
        assert one("op2", i)["size"] == len(words) and one("op2", i).taken in (0, len(words), 2 * len(words))
        assert (one("op4", i)["size"], one("op4", i).text_crc32) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
        assert one("op8", i).n_words == len(words) and one("op6", i).n_tokens == one("op3", i).n_tokens - 1 == 0 if not t else True
        assert one("op10", i).lang_pred == langid.UND if not re.search("[^\\W\\d_]", t) else True
    assert (one("op1", 9).n_access, one("op1", 0).spans, one("op1", 9).spans) == (1, "", "access:0:20")
    # Copies (5, repeated, and 6) and what contains them (7): only later documents lose the 40 words; one word 30,000 times keeps one window.
    assert [(r.n_removed, r.n_words) for i in (5, 6, 7) for r in rows["op8"][i]] == [(0, 40), (0, 40), (40, 40), (40, 41)] and one("op8", 8).n_removed == 29_999
    assert {(r.component_id, r.kept) for i in (5, 6, 7) for r in rows["op7"][i]} == {(5, True), (5, False)} and one("op7", 0).kept and one("op7", None).kept
    assert sorted(r.start for i in texts for r in rows["op3"][i]) == sorted(np.cumsum([0] + [r.n_tokens for i in [None, *sorted(k for k in texts if k is not None)] for r in rows["op3"][i]])[:-1].tolist())


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_empty_tables_give_no_rows(spark, name):
    assert DIGESTS[name](docs(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == duck_rows(queries.ORACLES[name])


def test_secrets_report_weak_parts_only_together(spark):
    key = "Ab1" * 6
    texts = [f"login: alice and {key}", "login: alice", key, f"{key} https://x.example", "https://x.example", f"login: alice{' ' * 300}{key}", 'api_key = "abcdef" deadbeef' * 3]
    rows = {r.doc_id: r for r in secrets.secret_digest(docs(spark, texts)).collect()}
    kinds = {i: re.findall("[a-z]+", r.spans) for i, r in rows.items()}
    assert kinds[0] == ["ident", "secret"] and kinds[1] == [] and kinds[None] == [] and kinds[3] == ["secret"] and kinds[4] == [] and kinds[5] == []
    assert rows[6].n_assign == 3


def test_secrets_link_upper_case_parts_and_loose_runs(spark):
    loose = "k3v-9xq2_mm81-zt40b"
    texts = [
        "USERNAME=bob\nPASSWORD=hunter22", f"DB_USER=bob\n{loose}", f"clientId: bob {loose}", f"HOST=db.example\n{loose}", f"HTTPS://X.example {loose}",
        loose, "HOST=db-1-internal-example", "Login: first-last-2024-01", f"AWS_ACCESS_KEY_ID=abc {'Ab1' * 6}", f"user: bob host: db-1-internal-example {'a1' * 20}",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r.doc_id: re.findall("[a-z]+", r.spans) for r in secrets.secret_digest(df).collect()}
    assert kinds == {0: ["ident", "assign"], 1: ["ident", "secret"], 2: ["ident", "secret"], 3: ["secret"], 4: ["secret"], 5: [], 6: [], 7: [], 8: ["ident", "secret"], 9: ["ident", "endpoint", "hex"]}


def test_masked_spans_do_not_overlap(spark):
    row = docs(spark, ['password="abcdef0123456789abcdef012345" end'])
    spans = secrets.scan_secrets(row).select("spans")
    out = row.crossJoin(spans).select(secrets.mask_secrets(F.col("text"), F.col("spans")).alias("m")).first().m
    assert out == '[SECRET]" end'


def test_very_many_spans_in_one_text(spark):
    """100,000 spans, weak parts and loose runs among them, in one text: positions and the masked text by brute force."""
    text = "é " + "".join(f"token={i:07d}é user: bob{i} k3v-9xq2_mm81-{i:06d} " for i in range(33_400))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = secrets.scan_secrets(df).first()
    want = [(m.start(), 0, m.end()) for m in re.finditer("token=[0-9]+", text)] + [(m.start(), 3, m.end()) for m in re.finditer("user: bob[0-9]+", text)]
    want += [(m.start(), 4, m.end()) for m in re.finditer("k3v-9xq2_mm81-[0-9]+", text)]
    assert len(want) > 100_000 and sorted(map(tuple, found.spans)) == sorted(want)
    out, at = [], 0
    for start, _, end in sorted(want):
        out += [text[at:start], "[SECRET]"]
        at = end
    rows = spark.createDataFrame([(text, [tuple(s) for s in found.spans])], "text string, spans array<struct<start:int,ord:int,end:int>>")
    assert rows.select(secrets.mask_secrets(F.col("text"), F.col("spans"))).first()[0] == "".join([*out, text[at:]])


def test_mix_meets_its_targets(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), None, rng.choice(["a", "b", "b", "b", None]), 0, "", "", 0) for i in range(600)]
    df = spark.createDataFrame(rows, DOCS)
    out, again = (sorted(map(tuple, mixing.mix_digest(df).collect())) for _ in range(2))
    assert out == again
    source = {r[0]: r[3] for r in rows}
    taken, target, size = defaultdict(int), {}, {}
    for doc_id, n, total, goal, got in out:
        assert n == len(rows[doc_id][1].split()) and got <= 2 * n and (not n or got % n == 0)
        taken[source[doc_id]] += got
        target[source[doc_id]], size[source[doc_id]] = goal, total
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values())) and all(target[s] <= 2 * size[s] + 1e-6 for s in target)


def test_mix_takes_short_documents_as_often_as_it_should(spark):
    """A thousand sources alike in sizes, so a thousand draws: shares taken against the probabilities, sixth by sixth."""
    rng, n, k = random.Random(5), 300, 1000
    sizes = sorted(min(400, int(rng.lognormvariate(3, 1.2)) + 1) for _ in range(n))
    base = spark.createDataFrame([(i, " ".join(["w"] * w)) for i, w in enumerate(sizes)], "i long, text string")
    docs = base.crossJoin(F.broadcast(spark.range(k).withColumnRenamed("id", "s"))).select((F.col("s") * n + F.col("i")).alias("doc_id"), "text", F.col("s").cast("string").alias("source"))
    out = mixing.mix_sources(docs, weights=(1.0,), share=0.5).groupBy((F.col("id") % n).alias("i")).agg(F.sum("copies").alias("taken")).collect()
    shares, left, capped = {r.i: r.taken / k for r in out}, sum(sizes) / 2, 0
    while True:  # the probabilities by hand, the longest first
        c = (left - sum(sizes[n - capped :])) / sum(w * w for w in sizes[: n - capped])
        if c * sizes[n - capped - 1] < 1:
            break
        capped += 1
    p = [min(1.0, c * w) for w in sizes]
    for sixth in range(6):
        at = range(sixth * 50, sixth * 50 + 50)
        assert sum(shares[i] for i in at) / 50 == pytest.approx(sum(p[i] for i in at) / 50, abs=0.006, rel=0.04)
    words = sum(shares[i] * sizes[i] for i in range(n))
    assert 0.99 * left < words <= left


def test_mix_equals_a_plain_simulation(spark):
    """The same draws in plain Python: targets, inclusion probabilities, ranks and the one document that closes the gap."""
    rng = random.Random(11)
    rows = [(i, " ".join(["w"] * int(rng.lognormvariate(2, 1.5))), None, rng.choice(["a", "b", "b", "c", "d", "e", None]), 0, "", "", 0) for i in range(500)]
    df = spark.createDataFrame(rows, DOCS)
    drawn = df.select("doc_id", "source", F.size(F.filter(F.split("text", " "), lambda w: w != "")).alias("size"), mixing.uniform(F.col("doc_id"), F.xxhash64("text"), seed=mixing.SEED).alias("u"), F.xxhash64("text").alias("h")).collect()
    by = defaultdict(list)
    for r in drawn:
        by[r.source].append(r)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    size, weight = {s: sum(r["size"] for r in by[s]) for s in names}, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= 2 * size[s]}
        for s in over or free:
            target[s] = 2.0 * size[s] if over else weight[s] * level
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    want = {}
    for s in names:
        certain = min(2, int(target[s] / size[s] + 1e-12)) if size[s] else 0
        words = target[s] - certain * size[s] if certain < 2 else 0
        want |= {r.doc_id: certain for r in by[s]}
        some = [r for r in by[s] if r["size"]] if words > 0 else []
        sure = []
        while some:
            c = (words - sum(r["size"] for r in sure)) / sum(r["size"] ** 2 for r in some)
            more = [r for r in some if c * r["size"] >= 1]
            if not more:
                break
            sure, some = sure + more, [r for r in some if r not in more]
        words -= sum(r["size"] for r in sure)
        taken = list(sure)
        some = sorted(((r.u * (1 - c * r["size"]) / ((1 - r.u) * c * r["size"]), r.doc_id, r.h, r) for r in some), key=lambda x: x[:3]) if some else []
        near, first = mixing.CLOSE * target[s], True
        while (words > near or first) and (some := [x for x in some if x[3]["size"] <= words]):
            first = False
            for x in list(some):
                if x[3]["size"] > words:
                    break
                words -= x[3]["size"]
                taken.append(x[3])
                some.remove(x)
            if words > near and (closing := [x for x in some if words - near <= x[3]["size"] <= words]):
                taken.append(closing[0][3])
                break
        for r in taken:
            want[r.doc_id] += 1
    out = mixing.mix_sources(df).collect()
    assert {r.id: r.copies for r in out} == want
    assert all(r.target == pytest.approx(target[r.source]) for r in out)
    for s in names:  # close to the target, or nothing that could be drawn still fits
        gap = target[s] - sum(r.copies * r["size"] for r in out if r.source == s)
        assert gap >= -1e-6
        assert gap <= mixing.CLOSE * target[s] or not [r for r in out if r.source == s and 0 < r["size"] <= gap and r.copies == int(target[s] / size[s] + 1e-12) < 2]


def test_bits_pack_and_unpack():
    rng = np.random.default_rng(0)
    for bits in (1, 7, 8, 15, 16, 17, 24):
        ids = rng.integers(0, 2**bits, 1001)
        assert (tokenfile.unpack(tokenfile.pack(ids, bits), 1001, bits) == ids).all()
    assert [tokenfile.vocabulary_bits(n) for n in (1, 2, 50_257, 65_536, 65_537)] == [1, 1, 16, 16, 17]


def test_token_files_hold_what_the_library_gives(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    texts = [t for t in EDGES if t] + ["Hello, world,\nnew line", " two  spaces ", "a b c​d"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in tokenfile.read_tokens(tokenfile.write_tokens(df, BYTE, file_ids=500)).collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_read_at_random(spark, tmp_path):
    ids = [np.arange(n, dtype=np.uint32) for n in (0, 70_000, 3)]
    uri = f"file://{tmp_path}/f.tok"
    assert tokenfile.write_file(uri, [1, None, 3], ids, 17) == 70_003
    file = tokenfile.TokenFile(uri)
    assert file.read(65_530, 10).tolist() == list(range(65_530, 65_540)) and [d for d, _, _ in file.documents()] == [1, None, 3]


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    library.no_truncation(), library.no_padding()
    rng = random.Random(1)
    parts = ["a", "É", "İ", "σΣ", "中", "😀", " ", "　", "\n", "'s", "12", "!?", "<|endoftext|>", "</w>", "́", "꟎", "՘", "aaaa", "won't", "½"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(2000)] + [t for t in EDGES if t]
    for text, raw in zip(texts, bpe.encoded_texts(texts, WORD)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids
        assert bpe.load(WORD).decode(np.array(ids, dtype=np.int64)).decode() == library.decode(ids, skip_special_tokens=False)


def test_bpe_tables_are_loaded_in_little_memory():
    """Several workers of an executor load the tables at once, beside a JVM that has grown; 148 MB each before, 34 since."""
    tracemalloc.start()
    try:
        bpe.Bpe(WORD)
        assert tracemalloc.get_traced_memory()[1] < 60 * 2**20
    finally:
        tracemalloc.stop()


def test_bpe_character_classes_are_whole():
    """Looked for in blocks, a class has the characters it has over all at once, and the library's light form answers as the whole one."""
    from tokenizers import Tokenizer

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    assert all(bpe.characters(kind) == "".join(regex.findall(kind, every)) for kind in (r"[\p{L}\p{N}]", r"[\p{N}]"))
    library = Tokenizer.from_file(WORD)
    with open(WORD, encoding="utf-8") as f:
        unknown, lower = bpe.recent_characters(json.load(f))
    doubtful = [c for c in bpe.characters(r"[\p{L}\p{N}]") if unicodedata.category(c) == "Cn"]
    split = library.pre_tokenizer.pre_tokenize_str
    assert unknown == {c for c in doubtful if len(split(c + "a")) == 2 and len(split(c + "!")) == 1}
    assert lower == {ord(c): low for c in doubtful if (low := library.normalizer.normalize_str(c)) != c}


def test_bpe_splits_plain_chunks_by_the_short_pattern():
    """Every character of the short pattern's range beside letters, digits, marks and quotes splits as by the whole pattern, without it being asked."""
    tables = bpe.load(WORD)
    chars = [c for c in map(chr, range(0x21, 0x250)) if bpe.CHUNK.fullmatch(c)]
    chunks = [part for c in chars for part in (c, c + "a", "a" + c, c + "1!", "it's" + c, "'" + c + "ll", "½" + c + "é")]
    want = [[p.encode() for p in tables.piece.findall(bpe.lowered(c, tables.recent))] for c in chunks]
    assert [tables.pieces(c) for c in chunks] == want
    whole, tables.piece = tables.piece, None
    try:
        assert tables.pieces("Straße,") == ["straße".encode(), b","] and tables.pieces("don't7") == [b"don", b"'t", b"7"]
    finally:
        tables.piece = whole


def test_shards_are_the_least_cut_and_keep_groups(spark):
    """Sizes, checksums, gapless slots, whole groups, and the largest shard as small as any cut of the groups in order can make it."""
    rng = random.Random(2)
    texts = [rng.choice(["a" * 50, "b", None, "é" * 9, f"t{i}" * rng.randint(1, 9)]) for i in range(800)]
    df = docs(spark, texts)
    plain = {r.doc_id: r for r in df.select("doc_id", "text", F.xxhash64("text").alias("x")).collect()}
    rows = sharding.shard_digest(df).collect()
    sizes, slots, groups, by_hash = defaultdict(int), defaultdict(list), defaultdict(set), defaultdict(int)
    for r in rows:
        raw = (plain[r.doc_id].text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        groups[plain[r.doc_id].x].add(r.shard)
        by_hash[plain[r.doc_id].x] += r["size"]
    assert len(rows) == len(texts) + 1 and all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(g) == 1 for g in groups.values())
    assert all(0 <= s < sharding.SHARDS for s in sizes)
    ordered = [by_hash[h] for h in sorted(by_hash)]

    def fits(capacity):
        n, at = 1, 0
        for size in ordered:
            if size > capacity:
                return False
            n, at = (n + 1, size) if at + size > capacity else (n, at + size)
        return n <= sharding.SHARDS

    assert max(sizes.values()) == next(c for c in range(1, sum(ordered) + 1) if fits(c))


def test_shard_capacity_is_the_least():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 40))]
        pieces = sharding.Pieces([(i, i, s) for i, s in enumerate(sizes)])
        k = rng.randint(1, 8)
        best = [[10**9] * (k + 1) for _ in range(len(sizes) + 1)]
        best[0] = [0] * (k + 1)
        for i in range(1, len(sizes) + 1):
            for j in range(1, k + 1):
                best[i][j] = min(max(best[m][j - 1], sum(sizes[m:i])) for m in range(i))
        assert pieces.capacity(k, False) == best[-1][k]


def vector_rows(spark, n=400):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist(), 0, "", "") for i in range(n)]
    rows += [(n, None, 0, "", ""), (n + 20, [float("nan")] * 16, 0, "", ""), (n + 40, [0.0] * 16, 0, "", ""), (None, [1.0] * 16, 0, "", ""), (20, rows[20][1], 0, "", ""), (n + 60, rows[40][1], 0, "", "")]
    return spark.createDataFrame(rows, VECTORS)


def test_nearest_edge_cases(spark):
    df = vector_rows(spark)
    plain = {r.vec_id: np.array(r.embedding, dtype=float) for r in df.collect() if r.vec_id is not None and r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)}
    assert recall(vectors.nearest(df).collect(), plain, 20, 20) >= 0.9


def recall(rows, plain, every, k):
    """Share of the true nearest that were found; every row is checked for its score and the whole for its shape."""
    ids = np.array(sorted(plain))
    x = np.zeros((len(ids), max(map(len, plain.values()))))
    for i, v in enumerate(ids):
        x[i, : len(plain[v])] = plain[v]
    at = {int(v): i for i, v in enumerate(ids)}
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.score == pytest.approx(float(x[at[r.query_id]] @ x[at[r.vec_id]])) and r.vec_id != r.query_id
        found[r.query_id].append((-r.score, r.vec_id))
    assert set(found) == {v for v in at if v % every == 0} and all(len(f) == min(k, len(ids) - 1) and f == sorted(f) for f in found.values())
    hits = 0
    for q, f in found.items():
        score = x @ x[at[q]]
        score[at[q]] = -np.inf
        hits += len({v for _, v in f} & {int(v) for v in ids[np.lexsort((ids, -score))[:k]]})
    return hits / sum(map(len, found.values()))


def test_nearest_recall_beyond_one_block(spark):
    """Over 8192 rows whose lengths differ by orders of magnitude, with a large group of copies, where less than a tenth is reranked."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(9000, 24)) * np.exp(rng.normal(size=(9000, 1)) * 0.8)
    x[3000:6000] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert recall(vectors.nearest(df, every=100).collect(), dict(enumerate(x)), 100, 20) >= 0.9


def test_footrule_equals_brute_force():
    rng = np.random.default_rng(7)
    order = np.array([rng.permutation(40)[:8] for _ in range(300)])
    files = vectors.InvertedFiles.post(order, 40)
    beyond = int(vectors.BEYOND * 8)
    place = lambda o, p: o.tolist().index(p) if p in o else beyond
    for q in order[:20]:
        assert files.footrule(q).tolist() == [sum(abs(place(q, p) - place(o, p)) for p in {*q.tolist(), *o.tolist()}) for o in order]
    assert sum(len(o) for o in order) == len(files.members) and files.footrule(order[5])[5] == 0


@pytest.mark.parametrize("search", [vectors.nearest, vectors.exact_top_k])
def test_empty_vectors(spark, search):
    assert search(spark.createDataFrame([], VECTORS)).count() == 0
    assert search(spark.createDataFrame([(0, [1.0], 0, "", "")], VECTORS)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_nearest_recall_on_the_table(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    plain = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows.collect()}
    assert recall(vectors.nearest(rows).collect(), plain, 20, 20) >= 0.9


def test_exact_scores_are_not_clipped(spark):
    rows = [(0, [1.0, 1e6]), (1, [1.0, 1e6]), (2, [-1.0, 1e6 + 0.5]), (3, [2.0**25, 3.0]), (100, [2.0**11, 2.0**-10]), (200, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(1024 * c)) for c in v] for i, v in rows}
    want = []
    for q in (0, 100, 200):
        scores = sorted(((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q))
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, vectors.exact_top_k(df).collect())) == want and want[1][3] == 1048576000001048576
    with pytest.raises(Exception, match="int64|long|too large|Overflow"):
        vectors.exact_top_k(spark.createDataFrame([(0, [2.0**60]), (1, [2.0**60])], "vec_id long, embedding array<double>")).collect()


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 101), (102, None)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100


def _sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(25):
        base = [f"v{rng.randint(0, 5000)}" for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"n{rng.randint(0, 9)}"
            texts.append(" ".join(copy))
    texts += [None, "", "a b", "A B"]
    sets, root = _sets(texts), list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                if root[i] != root[j] and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    low, high = sorted((root[i], root[j]))
                    root = [low if r == high else r for r in root]
                    changed = True
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicate_digest(df).collect()}
    assert got == {i: (len(sets[i]), root[i], root[i] == i) for i in range(len(texts))}


def test_links_at_exactly_the_threshold(spark):
    """75 of 100 shingles link, 74 of 100 do not; null ids keep one text a component."""
    word = lambda c, n: [f"{c}{i}" for i in range(n)]
    # Of two texts with a shared head of k + 4 words (k shingles) and m more each, k of k + 2m shingles are shared.
    pair = lambda c, shared, rest: [" ".join(word(c, shared + 4) + word(c + t, rest)) for t in "pq"]
    texts = pair("a", 150, 25) + pair("b", 149, 26) + pair("d", 150, 25)
    ids = [0, 1, 2, 3, None, None]
    sets = _sets(texts)
    assert [100 * len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in (0, 2)] == [75.0, 100 * 149 / 201]
    rows = near_rows(spark, list(zip(ids, texts)))
    assert [r.component_id for r in rows if r.doc_id is not None] == [0, 0, 2, 3] and sum(r.kept for r in rows if r.doc_id is None) == 1


def near_rows(spark, rows):
    found = neardup.near_duplicate_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0))


def test_large_buckets_of_unlike_texts_and_hot_leaders(spark, monkeypatch):
    """Blocks of a few nodes, joins by shuffle only: a bucket of many near copies of two kinds still gives their links."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr("tessella.llm.common.BROADCAST_ROWS", 0)
    rng = random.Random(9)
    base = [f"v{i}" for i in range(120)]
    half = base[:80] + [f"o{i}" for i in range(40)]
    texts = []
    for kind in (base, half):
        for _ in range(30):
            copy = list(kind)
            for at in rng.sample(range(120), rng.randint(0, 2)):
                copy[at] = f"n{rng.randint(0, 99)}"
            texts.append(" ".join(copy))
    sets, root = _sets(texts), list(range(len(texts)))
    for _ in range(8):
        for i in range(len(texts)):
            for j in range(i):
                if root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    low, high = sorted((root[i], root[j]))
                    root = [low if r == high else r for r in root]
    assert [r.component_id for r in near_rows(spark, list(enumerate(texts)))] == root


@pytest.mark.parametrize("broadcast", [True, False])
def test_repeated_windows_equal_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("tessella.llm.common.BROADCAST_ROWS", 0)
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(55)]
    texts = [None, ""]
    for _ in range(40):
        w = [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.7:
            a = rng.randint(0, 30)
            at = rng.randint(0, len(w))
            w[at:at] = passage[a : a + rng.randint(15, 25)]
        texts.append(" ".join(w))
    texts += ["z " * 70, texts[5], texts[5]]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        w, gone = (t or "").split(), set()
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            gone.update(range(s, s + 20)) if k in seen else seen.add(k)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.substring_digest(df).collect()} == want


@pytest.mark.parametrize("ids", [(1, 1, 2), (None, None, None), (1, 1, None)])
def test_repeated_rows_are_one_document(spark, ids):
    other = " ".join(f"o{i}" for i in range(40))
    rows = [(ids[0], COPY), (ids[1], COPY), (ids[2], other), (ids[2], other), (9, "a " + other)]
    got = sorted((r.id or 0, r.n_removed, r.kept) for r in substring.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    first = ids[2] is not None  # null ids come last, so the passage of 9 is the earlier one there
    assert got == sorted([(ids[0] or 0, 0, COPY)] * 2 + [(ids[2] or 0, 0 if first else 40, other if first else "")] * 2 + [(9, 40, "a") if first else (9, 0, "a " + other)])


def test_language_held_out_accuracy(spark):
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    held = rows.filter("held_out").select("lang", "lang_pred", "score").collect()
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in held)


def test_predictions_equal_brute_force(spark):
    """Profiles and out-of-place distances in plain Python, over whole texts."""

    def counts(text):
        out = Counter()
        letters = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in unicodedata.normalize("NFC", text or "").lower())
        for word in letters.split():
            marked = f"_{word}_"
            out.update(g for n in (1, 2, 3) for i in range(len(marked) - n + 1) if word and (g := marked[i : i + n]) != "_")
        return out

    def top(c):
        return sorted(c, key=lambda g: (-c[g], g))[: langid.PROFILE]

    rows = spark.read.parquet(f"{SF}/documents.parquet")
    plain = rows.collect()
    learned = [r for r in plain if r.lang and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    profiles = {lang: top(sum((counts(r.text) for r in learned if r.lang == lang), Counter())) for lang in {r.lang for r in learned}}
    assert langid.fit_profiles(rows.filter(~langid.held_out(F.col("doc_id"))).withColumnRenamed("doc_id", "id")) == profiles
    rank = {lang: {g: i for i, g in enumerate(grams)} for lang, grams in profiles.items()}
    want = {}
    for r in plain:
        own = top(counts(r.text))
        far = {lang: sum(abs(rank[lang][g] - i) if g in rank[lang] else langid.PROFILE for i, g in enumerate(own)) for lang in rank}
        best = min(sorted(far), key=far.get)
        want[r.doc_id] = (best, 1 - far[best] / (langid.PROFILE * len(own))) if own else (langid.UND, 0.0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.language_digest(rows).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()} and all(got[k][1] == pytest.approx(v[1]) for k, v in want.items())


def test_letters_are_of_category_l():
    model = langid.Profiles({"en": ["a", "_a"], "de": ["b"]})
    assert [model.predict(t) for t in ("½ ① Ⅷ ²", None, "", "１２")] == [(langid.UND, 0.0)] * 4 and model.predict("ª")[0] == "de"


def test_very_long_texts_are_counted_in_pieces(monkeypatch):
    text = "".join(random.Random(3).choices("abcäß 1中.\n", k=5000)) + "x" * 700
    whole = [a.tolist() for a in next(langid.text_counts([text]))]
    monkeypatch.setattr(langid, "PIECE_CHARS", 300)
    assert [a.tolist() for a in next(langid.text_counts([text]))] == whole and len(langid.pieces_of(text)) > 10


def test_out_of_place_distance_by_hand():
    model = langid.Profiles({"aa": ["a", "_a", "a_"], "bb": ["b"]})
    assert model.predict("aaa")[0] == "aa" and model.predict("bb")[0] == "bb" and model.predict("12 !") == (langid.UND, 0.0)


def test_repeated_rows_stay_one_document_across_batches():
    h, d, s = [1, 1, 1, 1, 1, 1, 2, 2, 2, 2], [5, 5, 5, 5, 7, 7, 5, 6, 6, 4], [0, 0, 0, 9, 0, 0, 1, 1, 1, 0]
    g = [3] * 9 + [4]  # the last window agrees with others in one hash only
    for size in range(1, 10):
        batches = [substring._batch(*(np.array(x[i : i + size]) for x in (h, g, d, s)), np.ones(len(h[i : i + size]), int), False) for i in range(0, len(h), size)]
        got = [(r["d"], r["s"]) for b in substring._repeated(True)(batches) for r in b.to_pylist()]
        assert got == [(5, 9), (7, 0), (7, 0), (6, 1), (6, 1)]
