"""Secret scans: multipart credential linking by an interval join (DataFrame functions only).

Strong spans (the base kinds ``assign``, ``access``, ``hex``) are always reported. Weak candidates
(``ident`` a login or client id, ``secret`` a high-entropy run too weak to report alone,
``endpoint`` a URL or host setting) are reported only when complementary parts co-occur within a
scope: disjoint spans of one document at most ``scope`` code points apart.

- ``ident`` needs a secret part (``assign``, ``hex`` or ``secret``),
- ``secret`` needs an identifier part (``access`` or ``ident``) or an endpoint,
- ``endpoint`` needs an identifier part and a secret part, disjoint from each other too.

A run of letters and digits is a ``secret`` only where it stands on its own: not as a piece of another part (a
login, an assigned value, a host setting) or of a URL with its path, so no text confirms itself.

Defined cases: a null text is scanned as empty (no spans); null or repeated ids and repeated rows
give one result row each; documents are linked by (id, hash of text), so rows that agree in both
share their spans; only the id and text columns are read, so other columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.arrays import BLOCK, bound, scan
from tessella.llm.common import written

# Fixed patterns of the base kinds.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_ASSIGN_VALUE = 6
# Weak parts of the linking method, in any case as the assign kind.
IDENT = r"""(?i)(access_?key_?id|client_?id|user_?name|username|user|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]+)"""
SECRET = r"[A-Za-z0-9+/_-]{16,}"
ENDPOINT = r"""(?i)(https?://[A-Za-z0-9.:-]+|(host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/-]+)"""
#: A URL with its path; runs within it are no secrets of their own.
URL = r"""(?i)https?://[^\x00-\x20"'<>)\]]+"""
MIN_IDENT_VALUE = 3
SCOPE = 200

#: Kinds in listed order; the first three are the base.
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
_SPAN = "array<struct<start:int,ord:int,end:int>>"


def _spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    """Spans (start, ord, end) in code points of the leftmost non-overlapping matches.

    Splitting by the pattern gives the stretches between the matches, so a running sum over both
    gives positions without leaving the JVM. ``keep`` drops failing matches after they consumed
    their text.
    """
    order = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(found, F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))

    def emit(at: Column, x: Column, _: Column) -> Column:
        start = at + F.length(x["gap"])
        kept = F.lit(True) if keep is None else F.coalesce(keep(x["m"]), F.lit(False))
        return F.struct(kept.alias("kept"), F.struct(start.alias("start"), F.lit(order).alias("ord"), (start + F.length(x["m"])).alias("end")).alias("span"))

    all_spans = scan(pairs, F.lit(0), lambda at, x: at + F.length(x["gap"]) + F.length(x["m"]), emit, "int", f"struct<kept:boolean,span:{_SPAN[6:-1]}>")
    spans = F.transform(F.filter(all_spans, lambda e: e["kept"]), lambda e: e["span"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def _random(run: Column) -> Column:
    """A run that may be random: letters and digits together."""
    return run.rlike("[A-Za-z]") & run.rlike("[0-9]")


def _rendered(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["ord"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _bins(rows: DataFrame, scope: int, wider: int = 0) -> DataFrame:
    """A row for each bin of ``scope`` code points that a span touches, and ``wider`` bins to either side."""
    at = lambda c: F.floor(F.col(c) / F.lit(scope)).cast("int")
    return rows.withColumn("bin", F.explode(F.sequence(at("start") - wider, at("end") + wider)))


def _parts(scanned: DataFrame, scope: int) -> DataFrame:
    """All parts of the documents with weak ones, a row a span; of the runs those that overlap no other part and no URL."""
    span = lambda spans: open_docs.select("id", "h", F.explode(spans).alias("s")).select("id", "h", "s.start", "s.ord", "s.end").distinct()
    open_docs = scanned.filter((F.size("weak") > 0) | (F.size("runs") > 0))
    others, runs = span(F.concat("base", "weak")), span("runs")
    taken = _bins(others.unionByName(span("urls")), scope).select(F.col("id").alias("o_id"), F.col("h").alias("o_h"), F.col("bin").alias("o_bin"), F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    overlap = F.col("id").eqNullSafe(F.col("o_id")) & (F.col("h") == F.col("o_h")) & (F.col("bin") == F.col("o_bin")) & (F.col("o_start") < F.col("end")) & (F.col("start") < F.col("o_end"))
    hit = _bins(runs, scope).join(taken, overlap).select(F.col("id").alias("o_id"), F.col("h").alias("o_h"), F.col("start").alias("o_start")).distinct()
    free = runs.join(hit, F.col("id").eqNullSafe(F.col("o_id")) & (F.col("h") == F.col("o_h")) & (F.col("start") == F.col("o_start")), "left_anti")
    return written(others.unionByName(free), "secret-spans")


def _linked(scanned: DataFrame, scope: int) -> DataFrame:
    """Interval join of weak candidates with all parts: (id, h, added spans).

    Each span is posted to the scope-wide bins it touches; candidates also look one bin to either
    side. Spans of a kind do not overlap, so a bin holds a bounded number whatever the document's
    length, and no bin is ever shared between documents.
    """
    parts = _parts(scanned, scope)
    weak = _bins(parts.filter(F.col("ord") > 2), scope, 1)
    other = _bins(parts, scope).select(
        F.col("id").alias("o_id"), F.col("h").alias("o_h"), F.col("start").alias("o_start"), F.col("ord").alias("o_ord"), F.col("end").alias("o_end"), F.col("bin").alias("o_bin")
    )
    near = (F.col("o_start") - F.col("end")).between(0, scope) | (F.col("start") - F.col("o_end")).between(0, scope)
    hits = weak.join(other, F.col("id").eqNullSafe(F.col("o_id")) & (F.col("h") == F.col("o_h")) & (F.col("bin") == F.col("o_bin")) & near)
    of = lambda *kinds: F.col("o_ord").isin(*[KINDS.index(k) for k in kinds])
    ends = lambda name, kinds: (F.max(F.when(of(*kinds), F.col("o_start"))).alias(f"{name}_last"), F.min(F.when(of(*kinds), F.col("o_end"))).alias(f"{name}_first"))
    scored = hits.groupBy("id", "h", "start", "ord", "end").agg(*ends("ident", ("access", "ident")), *ends("secret", ("assign", "hex", "secret")), F.max(of("endpoint")).alias("endpoint"))
    ident, secret = F.col("ident_last").isNotNull(), F.col("secret_last").isNotNull()
    # Two disjoint ones are there if and only if the first to end of one kind ends before the last of the other begins.
    apart = (F.col("ident_first") <= F.col("secret_last")) | (F.col("secret_first") <= F.col("ident_last"))
    kept = scored.filter(
        ((F.col("ord") == KINDS.index("ident")) & secret) | ((F.col("ord") == KINDS.index("secret")) & (ident | F.col("endpoint"))) | ((F.col("ord") == KINDS.index("endpoint")) & apart)
    )
    return kept.groupBy("id", "h").agg(F.collect_list(F.struct("start", "ord", "end")).alias("added"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Find secrets in every whole text; one row per input row.

    Returns ``id, h`` (hash of the text), ``base`` and ``spans`` (arrays of start, ord, end; ``ord``
    indexes :data:`KINDS`). See the module for the defined cases.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    scanned = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).select(
        "id",
        F.md5(text).alias("h"),
        F.concat(
            _spans(text, "assign", ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_ASSIGN_VALUE),
            _spans(text, "access", ACCESS),
            _spans(text, "hex", HEX),
        ).alias("base"),
        F.concat(
            _spans(text, "ident", IDENT, lambda m: F.length(F.regexp_extract(m, IDENT, 2)) >= MIN_IDENT_VALUE),
            _spans(text, "endpoint", ENDPOINT),
        ).alias("weak"),
        _spans(text, "secret", SECRET, _random).alias("runs"),
        _spans(text, "endpoint", URL).alias("urls"),
    )
    scanned = written(scanned, "secret-parts")  # a few spans per document; the texts are scanned once
    added = _linked(scanned, scope).select(F.col("id").alias("a_id"), F.col("h").alias("a_h"), "added")
    joined = scanned.join(added, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("h") == F.col("a_h")), "left")
    return joined.select("id", "h", "base", F.concat("base", F.coalesce("added", F.array().cast(_SPAN))).alias("spans"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`scan_secrets`."""
    count = lambda k: F.size(F.filter("base", lambda s: s["ord"] == KINDS.index(k))).cast("long")
    return scan_secrets(docs).select(
        F.col("id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_rendered(F.col("base")), 256).alias("base_sha256"),
        _rendered(F.col("spans")).alias("spans"),
    )


def mask_secrets(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with each span replaced; overlapping spans are replaced once together.

    A block of spans is cut out of the text first, so that a span is cut out of a short stretch.
    """
    merged = F.array_sort(spans)

    def emit(at: Column, s: Column, begin: Column) -> Column:
        return F.struct(at.alias("at"), F.greatest(at, s["start"]).alias("upto"), (s["start"] >= at).alias("opens"), begin.alias("begin"), F.greatest(at, s["end"]).alias("end"))

    kind = "struct<at:int,upto:int,opens:boolean,begin:int,end:int>"
    gaps = scan(merged, F.lit(0), lambda at, s: F.greatest(at, s["end"]), emit, "int", kind)

    def block_text(block: Column) -> Column:
        first, last = F.element_at(block, 1)["begin"], F.element_at(block, -1)["end"]
        piece = lambda stretch: F.array_join(
            F.transform(block, lambda g: F.concat(F.substring(stretch, g["at"] - first + 1, g["upto"] - g["at"]), F.when(g["opens"], F.lit(mask)).otherwise(F.lit("")))), ""
        )
        return bound(F.substring(text, first + 1, last - first), piece)

    def run(all_gaps: Column) -> Column:
        begins = F.sequence(F.lit(1), F.size(all_gaps), F.lit(BLOCK))
        done = F.array_join(F.transform(begins, lambda at: bound(F.slice(all_gaps, at, BLOCK), block_text)), "")
        return F.concat(done, F.substring(text, F.element_at(all_gaps, -1)["end"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, bound(gaps, run)).otherwise(text)


def _sql_spans(kind: str, pattern: str, keep: str = "true") -> str:
    """DuckDB rows (doc_id, ord, s, e) of one kind: the same split-and-sum on lists."""
    quoted = pattern.replace("'", "''")
    return f"""
      SELECT doc_id, {KINDS.index(kind)} AS ord, s, s + length(m) AS e FROM (
        SELECT doc_id, m, (list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0))::BIGINT AS s
        FROM (SELECT doc_id, found, gap, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS m
              FROM (SELECT doc_id, regexp_extract_all(t, '{quoted}') AS found, regexp_split_to_array(t, '{quoted}') AS gap FROM d))
      ) WHERE {keep}"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  {_sql_spans("assign", ASSIGN, f"length(regexp_extract(m, '{ASSIGN.replace(chr(39), chr(39) * 2)}', 2)) >= {MIN_ASSIGN_VALUE}")}
  UNION ALL {_sql_spans("access", ACCESS)}
  UNION ALL {_sql_spans("hex", HEX)}),
named AS (
  {_sql_spans("ident", IDENT, f"length(regexp_extract(m, '{IDENT.replace(chr(39), chr(39) * 2)}', 2)) >= {MIN_IDENT_VALUE}")}
  UNION ALL {_sql_spans("endpoint", ENDPOINT)}),
taken AS (SELECT * FROM base UNION ALL SELECT * FROM named UNION ALL {_sql_spans("endpoint", URL)}),
runs AS ({_sql_spans("secret", SECRET, "regexp_matches(m, '[A-Za-z]') AND regexp_matches(m, '[0-9]')")}),
weak AS (SELECT * FROM named UNION ALL SELECT * FROM runs r WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.doc_id = r.doc_id AND t.s < r.e AND r.s < t.e)),
parts AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
near AS (SELECT w.doc_id, w.ord, w.s, w.e, p.ord AS p_ord, p.s AS p_s, p.e AS p_e FROM weak w JOIN parts p ON w.doc_id = p.doc_id AND (p.s - w.e BETWEEN 0 AND {SCOPE} OR w.s - p.e BETWEEN 0 AND {SCOPE})),
added AS (
  SELECT DISTINCT doc_id, ord, s, e FROM near n
  WHERE (ord = 3 AND p_ord IN (0, 2, 4)) OR (ord = 4 AND p_ord IN (1, 3, 5))
     OR (ord = 5 AND p_ord IN (1, 3) AND EXISTS (SELECT 1 FROM near m WHERE m.doc_id = n.doc_id AND m.ord = 5 AND m.s = n.s AND m.p_ord IN (0, 2, 4) AND (m.p_e <= n.p_s OR n.p_e <= m.p_s)))),
names AS (SELECT unnest([0, 1, 2, 3, 4, 5]) AS ord, unnest(['assign', 'access', 'hex', 'ident', 'secret', 'endpoint']) AS kind),
b AS (SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS txt FROM base JOIN names USING (ord) GROUP BY doc_id),
a AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS txt
      FROM (SELECT * FROM base UNION ALL SELECT * FROM added) JOIN names USING (ord) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.txt, '')) AS base_sha256, coalesce(a.txt, '') AS spans
FROM d LEFT JOIN b ON d.doc_id = b.doc_id LEFT JOIN a ON d.doc_id = a.doc_id
"""
