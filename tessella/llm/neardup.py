"""MinHash near-duplicates: universal hash minima, banding, signature check, exact check, components.

1. One scan shingles every whole text (five words) and takes ``BANDS * ROWS`` universal-hash minima.
   Documents with equal shingle sets become one node, so copies are never compared.
2. Nodes meet in band buckets. A bucket is pre-aggregated to its least node (leader) and size; every
   member is paired with the leader, so a bucket of any size gives one pair a member.
3. Pairs that the signatures leave possible are confirmed on the full shingle sets; confirmed links
   give components.
4. Buckets that still hold several components are worked off in pairs of blocks: nodes of different
   components are compared by signature, and where those leave it possible by full sets, until they
   are one component. Sets are sent only for nodes with a possible partner in the block pair. So no
   link between different texts is lost to the leaders, nothing is capped, and a task returns at most a
   link a member.

At similarity 0.75 exactly a pair misses all bands with probability (1 - 0.75^5)^40 = 2e-5, and an
estimate from 200 minima falls below ``POSSIBLE`` with probability 3e-9; both fall fast as the
similarity grows.

Defined cases: a null or empty text, or one of white space, has no shingles, links with nothing and
is its own component; fewer than five words are one shingle; the component is named by its least
non-null id (if it has none it is named null, and of its texts the one with the least hash is kept); equal texts are one component whatever their ids; repeated rows
give repeated result rows; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import in_batches, slices, small, written
from tessella.llm.components import connected_components

WORDS = 5
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: Pairs whose estimated similarity is below this almost surely fail 0.75 (see the probability above).
POSSIBLE = 0.56
BLOCK = 256

_rng = np.random.default_rng(7)
_A = _rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_W = _rng.integers(0, 2**64, WORDS, dtype=np.uint64) | np.uint64(1)
_R = _rng.integers(0, 2**64, ROWS, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(0, 2**64, BANDS, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def other_word_hashes(words: list[bytes]) -> np.ndarray:
    """A second 64-bit hash of each word, independent of the first."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words, itertools.repeat(977)), dtype=np.uint64, count=len(words))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; bytes lower-case and split as the contract says."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    if len(h) < WORDS:
        return mixed((h * _W[: len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))
    n = len(h) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for i in range(WORDS):
        total += h[i : i + n] * _W[i]
    return np.unique(mixed(total))


def minima(items: np.ndarray) -> np.ndarray:
    """The universal-hash minima of a set."""
    x = (items ^ (items >> np.uint64(32))).astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (_A[:, None] * x[None, i : i + 2048] + _B[:, None]).min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key a band; the band's number is part of it."""
    rows = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    return mixed((rows * _R).sum(axis=2, dtype=np.uint64) + _BAND).astype(np.int64)


def short(sig: np.ndarray) -> np.ndarray:
    """One byte a minimum, for the signature check."""
    return ((sig * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def similarity(matches: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity from matching signature bytes (1 in 256 match by chance)."""
    return (matches / HASHES - 1 / 256) / (1 - 1 / 256)


def _signed(docs: DataFrame) -> DataFrame:
    """``id, th`` (hash of the text)``, n, set_key, bands, sig`` of every row."""

    def run(batches):
        for batch in slices(batches, 2):
            n, keys, sigs = [], [], []
            for text in batch.column(2).to_pylist():
                items = shingles(text)
                n.append(len(items))
                keys.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                sigs.append(minima(items))
            sig = np.array(sigs, dtype=np.uint32).reshape(len(n), HASHES)
            bands = pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * BANDS, band_keys(sig).ravel())
            raw = pa.array([r.tobytes() for r in short(sig)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), bands, raw],
                names=["id", "th", "n", "set_key", "bands", "sig"],
            )

    return in_batches(docs.select("id", "th", "text")).mapInArrow(run, "id long, th long, n long, set_key binary, bands array<long>, sig binary")


def _possible(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, a_sig, b_sig, a_n, b_n) that sizes and signatures leave possible, as (a, b)."""
    pairs = pairs.filter((100 * F.least("a_n", "b_n") >= 75 * F.greatest("a_n", "b_n")))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3))
            ok = similarity((x == y).sum(axis=1)) >= POSSIBLE
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])

    return in_batches(pairs.select("a", "b", "a_sig", "b_sig")).mapInArrow(run, "a long, b long")


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted`` (node and other columns, one row a node) with ``items``, the node's shingle set.

    Only the documents that stand for wanted nodes are shingled again.
    """
    other = [c for c in wanted.columns if c != "node"]
    wanted = written(wanted.join(nodes.select("node", "rep_th", "rep_id"), "node"), "near-wanted")
    where = (F.col("th") == F.col("rep_th")) & F.col("id").eqNullSafe(F.col("rep_id"))
    found = docs.join(small(wanted), where).select("text", "node", *other)

    def run(batches):
        for batch in slices(batches, 0):
            sets = [shingles(t).view(np.int64) for t in batch.column(0).to_pylist()]
            ends = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, np.concatenate(sets) if sets else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists], names=[*batch.schema.names[1:], "items"])

    schema = T.StructType([*found.drop("text").schema.fields, T.StructField("items", T.ArrayType(T.LongType()))])
    return written(in_batches(found).mapInArrow(run, schema), "near-sets")


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link by their full sets.

    ``a`` sends its set once for each pair to where ``b`` is. A ``b`` of very many pairs is in as many places
    as its pairs have blocks of ``BLOCK``, so no place gets more sets than that.
    """
    places = pairs.groupBy(F.col("b").alias("p_b")).agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("places"))
    places = written(places, "near-places")
    dealt = pairs.join(small(places), F.col("b") == F.col("p_b")).select("a", "b", F.pmod(F.xxhash64("a"), F.col("places")).cast("int").alias("at"))
    where = "array<struct<b:bigint,at:int>>"
    wanted = dealt.groupBy(F.col("a").alias("node")).agg(F.collect_list(F.struct("b", "at")).alias("to")).withColumn("places", F.lit(0))
    leads = places.select(F.col("p_b").alias("node"), F.array().cast(where).alias("to"), "places")
    wanted = wanted.unionByName(leads).groupBy("node").agg(F.flatten(F.collect_list("to")).alias("to"), F.max("places").alias("places"))
    sets = _sets(wanted, nodes, docs)
    left = sets.select(F.col("node").alias("a"), F.inline("to"), F.col("items").alias("a_items"))
    right = sets.filter("places > 0").select(F.col("node").alias("k"), F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("k_at"), F.col("items").alias("b_items"))
    both = F.size(F.array_intersect("a_items", "b_items"))
    linked = left.join(right, (F.col("b") == F.col("k")) & (F.col("at") == F.col("k_at"))).filter(100 * both >= 75 * (F.size("a_items") + F.size("b_items") - both))
    return written(linked.select("a", "b").distinct(), "near-links")


def _dealt(members: DataFrame) -> DataFrame:
    """Members (key, node, root) of buckets that hold several components, dealt to block pairs (i, j).

    A bucket's largest component never meets itself. Its members and the others are cut into blocks
    by hash; blocks of others (the lower numbers) meet all blocks, so each pair of nodes of different
    components meets in one task of bounded size, whatever the bucket's size.
    """
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy(F.col("key").alias("m_key")).agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("all"))
    main = main.select("m_key", F.col("main.root").alias("main"), F.col("main.n").alias("n_main"), (F.col("all") - F.col("main.n")).alias("n_rest")).filter("n_rest > 0")
    # Written first, as the buckets were, so that the join's own shuffle can be split at a key of very many members.
    rows = members.join(small(written(main, "near-main")), F.col("key") == F.col("m_key"))
    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("rest_blocks", blocks("n_rest")).withColumn("main_blocks", blocks("n_main"))
    in_main = F.col("root") == F.col("main")
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    rows = rows.withColumn("own", F.when(in_main, F.col("rest_blocks") + part("main_blocks")).otherwise(part("rest_blocks")))
    last = F.when(in_main, F.col("rest_blocks") - 1).otherwise(F.col("rest_blocks") + F.col("main_blocks") - 1)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.select("key", "band", "node", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _partners(x: int, second: np.ndarray, label: np.ndarray, n: np.ndarray, sig: np.ndarray, bands: np.ndarray, band: int) -> np.ndarray:
    """Of ``second`` the nodes of other components that sizes and signatures leave possible for node ``x``, likest
    first. A pair that shares an earlier band is left to that band's bucket."""
    y = second[label[second] != label[x]]
    y = y[100 * np.minimum(n[y], n[x]) >= 75 * np.maximum(n[y], n[x])]
    estimate = similarity((sig[y] == sig[x]).sum(axis=1))
    y, estimate = y[estimate >= POSSIBLE], estimate[estimate >= POSSIBLE]
    y = y[np.argsort(-estimate, kind="stable")]
    return y[~(bands[y, :band] == bands[x, :band]).any(axis=1)]


def _columns(table: pa.Table):
    """The columns of a block pair as arrays: node, label of the component, own block, n, sig, bands."""
    node, root, own, n = (table.column(c).to_numpy() for c in ("node", "root", "own", "n"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
    bands = pc.list_flatten(table.column("bands")).to_numpy().reshape(-1, BANDS)
    return node, np.unique(root, return_inverse=True)[1], own, n, sig, bands


def _with_partners(dealt: DataFrame, facts: DataFrame) -> DataFrame:
    """Those rows of the block pairs whose node has a possible partner there. Only signatures are sent, so a
    large bucket of unlike texts sends no set at all."""
    fields = dealt.columns

    def run(key, table):
        _, label, own, n, sig, bands = _columns(table)
        first, second = np.flatnonzero(own == key[1].as_py()), np.flatnonzero(own == key[2].as_py())
        band, wanted = table.column("band")[0].as_py(), np.zeros(len(own), dtype=bool)
        for x in first.tolist():
            y = _partners(x, second, label, n, sig, bands, band)
            wanted[y] = True
            wanted[x] |= len(y) > 0
        return table.select(fields).filter(pa.array(wanted))

    return dealt.join(facts, "node").groupBy("key", "i", "j").applyInArrow(run, dealt.select(*fields).schema)


def _linked_across(dealt: DataFrame, facts: DataFrame) -> DataFrame:
    """Links (a, b) between components within block pairs, confirmed on the full sets.

    A task keeps its own union of components, so it returns at most a link a member.
    """

    def run(key, table):
        node, label, own, n, sig, bands = _columns(table)
        first, second = np.flatnonzero(own == key[1].as_py()), np.flatnonzero(own == key[2].as_py())
        band, items = table.column("band")[0].as_py(), table.column("items").combine_chunks()
        sets, a, b = {}, [], []

        def of(x: int) -> np.ndarray:
            if x not in sets:
                sets[x] = items[x].values.to_numpy(zero_copy_only=False)
            return sets[x]

        for x in first.tolist():
            for z in _partners(x, second, label, n, sig, bands, band).tolist():
                if label[z] == label[x]:
                    continue
                both = len(np.intersect1d(of(x), of(z), assume_unique=True))
                if 100 * both >= 75 * (int(n[x]) + int(n[z]) - both):
                    a.append(node[x])
                    b.append(node[z])
                    label[label == label[z]] = label[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.join(facts, "node").groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, th`` (xxhash64 of the text)``, n_shingles, component_id, kept, root`` of every row; ``root`` tells
    components apart that share a least id, null without shingles."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).withColumn("th", F.xxhash64("text"))
    signed = written(_signed(rows), "near-signed")
    # One node for each distinct non-empty set, standing for its least (id, text hash).
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "th"))
    nodes = signed.filter("n > 0").groupBy("set_key").agg(first.alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), "set_key", F.col("rep.id").alias("rep_id"), F.col("rep.th").alias("rep_th"), "n", "bands", "sig")
    nodes = written(nodes, "near-nodes")
    facts = nodes.select("node", "n", "sig")

    members = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("size")).filter("size > 1")
    # Written first, so that the join has a shuffle of its own, which Spark splits where a key holds very many members.
    buckets = written(buckets.select(F.col("key").alias("b_key"), "leader", "size"), "near-buckets")
    met = written(members.join(small(buckets), F.col("key") == F.col("b_key")).select("key", "band", "node", "leader", "size"), "near-met")

    pairs = met.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    left = facts.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("sig").alias("a_sig"))
    right = facts.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("sig").alias("b_sig"))
    possible = written(_possible(pairs.join(left, "a").join(right, "b")), "near-possible")
    links = _confirmed(possible, nodes, rows)

    rooted = connected_components(links).select(F.col("node").alias("r_node"), "root")
    placed = met.filter("size > 2").join(rooted, F.col("node") == F.col("r_node"), "left").withColumn("root", F.coalesce("root", "node"))
    dealt = written(_dealt(placed.select("key", "band", "node", "root")), "near-dealt")
    facts = nodes.select("node", "n", "sig", "bands")
    dealt = written(_with_partners(dealt, facts), "near-partners")
    items = _sets(dealt.select("node").distinct(), nodes, rows).select("node", "items")
    more = written(_linked_across(dealt, items.join(facts, "node")), "near-more")
    rooted = connected_components(links.unionByName(more)).select(F.col("node").alias("r_node"), "root")

    named = nodes.select("node", "set_key", "rep_id", "rep_th").join(rooted, F.col("node") == F.col("r_node"), "left").withColumn("root", F.coalesce("root", "node"))
    place = F.struct(F.col("rep_id").isNull().alias("no"), F.col("rep_id").alias("id"), F.col("rep_th").alias("th"))
    least = written(named.groupBy(F.col("root").alias("c_root")).agg(F.min(place).alias("least")), "near-least")
    classes = named.join(small(least), F.col("root") == F.col("c_root")).select(F.col("set_key").alias("c_key"), "least", "root")
    joined = signed.select("id", "th", "n", F.when(F.col("n") > 0, F.col("set_key")).alias("set_key")).join(classes, F.col("set_key") == F.col("c_key"), "left")
    own = F.when(F.col("n") > 0, F.col("least.id")).otherwise(F.col("id"))
    # Where no document of a component has an id, the one with the least hash of the text stands for it.
    kept = F.col("id").eqNullSafe(own) & (F.col("id").isNotNull() | (F.col("n") == 0) | F.col("th").eqNullSafe(F.col("least.th")))
    return joined.select("id", "th", F.col("n").alias("n_shingles"), own.alias("component_id"), kept.alias("kept"), "root")


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`near_duplicates`."""
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM inter JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 75 * (p.n + q.n - i)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.y) AS component_id, d.doc_id = min(r.y) AS kept
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""
