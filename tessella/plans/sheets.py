"""Queries of the sheet, translation, token and file operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import text as T
from tessella.operators import i18n, sequence, sheet
from tessella.plans.common import sql_trim, table
from tessella.session import shared_folder
from tessella.sources import sheets, xlsx

# Rows of ``part`` as a sheet: some brands are blank, some rows all blank.
_BLANK_BRAND, _BLANK_ROW = "p_partkey % 7 = 0", "p_partkey % 11 = 0"


def _part_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey + 2 AS _row",
        f"CASE WHEN {_BLANK_ROW} THEN array('', ' ', null, '') ELSE array(p_name, CASE WHEN {_BLANK_BRAND} THEN '' ELSE p_brand END, p_type, CAST(p_size AS STRING)) END AS cells",
    )
    head = spark.range(1).selectExpr("CAST(1 AS BIGINT) AS _row", "array('Name', 'Brand', '', 'Size') AS cells")
    return head.unionByName(part)


def sheet_read(spark, sf_dir):
    """A pruned and limited read."""
    return sheet.flat_rows(sheet.read_sheet(_part_grid(spark, sf_dir), columns=["BRAND", 4, "name"], limit=200))


def sheet_read_all(spark, sf_dir):
    """All rows and columns, an unnamed column included."""
    return sheet.flat_rows(sheet.read_sheet(_part_grid(spark, sf_dir), limit=0))


def sheet_headers(spark, sf_dir):
    """Headers of two sheets: unnamed columns stay if they have a cell, and all of them if none is named."""
    part = table(spark, sf_dir, "part").selectExpr("p_partkey + 1 AS _row", f"array(p_name, '', p_type, '', CASE WHEN {_BLANK_ROW} THEN ' ' ELSE '' END, null) AS cells")
    found = []
    for name, head in (("named", "array('Name', '', ' ', 'Unused', '', '')"), ("unnamed", "array('', ' ', null, '', '', '')")):
        grid = spark.range(1).selectExpr("CAST(1 AS BIGINT) AS _row", f"{head} AS cells").unionByName(part)
        found += [(name, i, h) for i, h in enumerate(sheet.read_sheet(grid, limit=0).headers, 1)]
    return spark.createDataFrame(found, "sheet string, place int, header string")


def sheet_totals(spark, sf_dir):
    """Totals of a limited read."""
    return sheet.read_sheet(_part_grid(spark, sf_dir), limit=200).totals


def sheet_rows_lookup(spark, sf_dir):
    """Rows by their numbers."""
    return sheet.flat_rows(sheet.read_sheet(_part_grid(spark, sf_dir), rows=[3, 5, 13, 17, 99_999_999], limit=0))


def sheet_read_column(spark, sf_dir):
    """One column up to its five-hundredth filled cell."""
    return sheet.read_column(_part_grid(spark, sf_dir), "brand")


def sheet_column_lookup(spark, sf_dir):
    """Cells of one column by row number."""
    return sheet.read_column(_part_grid(spark, sf_dir), 2, rows=[1, 2, 9, 40, 41])


_CUT_ROWS = {"sheet": "event_id % 5", "_row": "CAST(floor(event_id / 5) AS BIGINT) + 1", "blank": "value < 20 OR (CAST(floor(event_id / 5) AS BIGINT) % 900 >= 820 AND event_id % 5 < 3)"}


def sheet_blank_tail_cut(spark, sf_dir):
    """Where reading of each sheet ends."""
    rows = table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in _CUT_ROWS.items()])
    return sequence.blank_cut(rows, F.col("blank"), ["sheet"], "_row", 50)


def token_backfill(spark, sf_dir):
    """Names take the number of the next marker of their user."""
    events = table(spark, sf_dir, "events").filter("user_id IS NOT NULL")
    marker = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return sequence.filled(events, marker, ["user_id"], "event_id", "marker", backward=True).filter("event_type <> 'signup' AND marker IS NOT NULL").select("user_id", "event_id", "event_type", "marker")


def sheet_list(spark, sf_dir):
    """Sheet names of token streams built from each user's events."""
    token = F.when(F.col("event_type") == "signup", F.concat(F.lit('"C*'), (F.col("event_id") % 1000).cast("string"), F.lit('"'))).otherwise(F.concat(F.lit('"B:'), "event_type", F.lit('"')))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", token.alias("t")))), lambda s: s["t"]), ",")
    return sheets.sheet_list(table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("file_id")).agg(F.concat(F.lit("["), listed, F.lit("]")).alias("raw")))


_HEADERS = ["中文", "英文", "印尼语", "备注"]


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents a row, in two of three languages by turns; the third is blank, as null or white space."""
    docs = table(spark, sf_dir, "documents")
    row = F.floor(F.col("doc_id") / 2)
    slot = (F.col("doc_id") % 2 + row) % 3
    wide = docs.groupBy((row + 2).alias("_row")).agg(*[F.max(F.when(slot == i, F.col("text"))).alias(h) for i, h in enumerate(_HEADERS[:3])])
    blank = F.when(F.col("_row") % 4 < 2, F.lit(" "))
    return wide.select("_row", *[F.coalesce(h, blank).alias(h) for h in _HEADERS[:3]], F.lit("note").alias(_HEADERS[3]))


def i18n_export(spark, sf_dir):
    """Whole document texts as translations."""
    return i18n.export_translations(_wide(spark, sf_dir), _HEADERS).entries


def i18n_missing(spark, sf_dir):
    """The audit of blank cells."""
    found = i18n.export_translations(_wide(spark, sf_dir), _HEADERS).missing
    return found.select("row", F.md5("key").alias("key_md5"), F.array_join("langs", ",").alias("langs"))


def i18n_key_counts(spark, sf_dir):
    """Keys of each language."""
    return i18n.key_counts(i18n.export_translations(_wide(spark, sf_dir), _HEADERS).entries)


_WIDE_SQL = "SELECT r, " + ", ".join(f"coalesce(max(CASE WHEN slot = {i} THEN text END), CASE WHEN r % 4 < 2 THEN ' ' END) AS c{i}" for i in range(3)) + ", 'note' AS c3 FROM (SELECT text, CAST(floor(doc_id / 2) AS BIGINT) + 2 AS r, (doc_id % 2 + CAST(floor(doc_id / 2) AS BIGINT)) % 3 AS slot FROM documents) GROUP BY r"
_I18N_SQL = f"""
WITH wide AS ({_WIDE_SQL}),
v AS (SELECT r, {', '.join(f"{sql_trim(f'coalesce(c{i}, {chr(39) * 2})')} AS c{i}" for i in range(4))} FROM wide),
d AS (SELECT *, CASE WHEN c0 <> '' THEN 'txt_' || (CASE WHEN unicode(c0) > 65535 THEN 55296 + (unicode(c0) - 65536) // 1024 ELSE unicode(c0) END) || r ELSE 'txt_row_' || r END AS k
      FROM v WHERE NOT (c0 <> '' AND c1 = '' AND c2 = '')),
e AS (SELECT r, k, 'zh' AS lang, c0 AS t FROM d UNION ALL SELECT r, k, 'en', c1 FROM d UNION ALL SELECT r, k, 'in', CASE WHEN c2 = '' THEN c1 ELSE c2 END FROM d),
p AS (SELECT r, k, lang, t, list_filter(list_transform(string_split_regex(t, '\\r?\\n'), lambda x: {sql_trim('x')}), lambda x: x <> '') AS ls FROM e WHERE t <> ''),
o AS (SELECT lang, r, -1 AS i, k AS "key", t AS text FROM p WHERE NOT contains(t, chr(10))
      UNION ALL SELECT lang, r, i - 1, k || '_' || (i - 1), ls[i] FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM p WHERE contains(t, chr(10)))),
entries AS (SELECT lang, "key", arg_max(text, r * 1000000 + i) AS text FROM o GROUP BY lang, "key")
"""

_HEADER_LIST = ["中文", "简体中文", "繁体中文 (TW)", " English ", "Bahasa Indonesia", "melayu / Malay", "Português (portugu)", "备注", "", "日本語 japanese", "한국어", "ID 文案", "Notes-EN", "français", "key"]
_RULES = [i18n.HeaderRule("notes en", "en"), i18n.HeaderRule("^한", "ko", "regex"), i18n.HeaderRule("KEY", "key", "exact")]


def header_language(spark, sf_dir):
    """Language of headers, each carrying a nation's name in front of it or not."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = nations.select("n_nationkey", F.explode(F.array(*[F.lit(h) for h in _HEADER_LIST])).alias("header"))
    return named.select("n_nationkey", "header", i18n.header_language(F.col("header"), _RULES).alias("lang"))


def _header_sql() -> str:
    key = lambda x: f"regexp_replace(lower({x}), '[^A-Za-z0-9_\\x{{4e00}}-\\x{{9fa5}}\\x{{3040}}-\\x{{30ff}}\\x{{ac00}}-\\x{{d7af}}]+', '', 'g')"
    cases = [
        f"WHEN {key('h')} <> '' AND (contains({key('h')}, 'notesen') OR contains('notesen', {key('h')})) THEN 'en'",
        "WHEN regexp_matches(h, '(?i)^한') THEN 'ko'",
        "WHEN lower(h) = 'key' THEN 'key'",
        *[f"WHEN regexp_matches(h, '(?i){p}') THEN '{lang}'" for p, lang in i18n.HEADER_LANGUAGES],
    ]
    values = ", ".join(f"('{h}')" for h in _HEADER_LIST)
    return f"SELECT n_nationkey, raw AS header, CASE WHEN h = '' THEN NULL {' '.join(cases)} END AS lang FROM nation, (SELECT raw, trim(raw) AS h FROM (VALUES {values}) v(raw))"


def xlsx_roundtrip(spark, sf_dir):
    """``part`` written as one workbook a brand and read back."""
    part = table(spark, sf_dir, "part")
    cells = F.array(F.col("p_name"), F.lit(""), F.col("p_type"), F.col("p_size").cast("string"), F.concat(F.lit("<&\">"), F.col("p_brand")))
    rows = part.select(F.col("p_brand").alias("book"), F.concat(F.lit("s/"), (F.col("p_partkey") % 3).cast("string")).alias("sheet"), (F.col("p_partkey") + 1).alias("_row"), cells.alias("cells"))
    listed = [r.path for r in xlsx.write_workbooks(rows, f"{shared_folder(spark)}/books").select("path").collect()]  # a name a book
    found = xlsx.read_workbooks(spark.read.format("binaryFile").load(listed))
    return found.select("sheet", "_row", F.array_join("cells", "|").alias("cells"))


def a1_columns(spark, sf_dir):
    """Column letters of numbers, and back."""
    letters = T.column_letters(F.col("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", letters.alias("letters"), T.column_index(letters).alias("back"))


_NONBLANK = f"NOT ({_BLANK_ROW})"
_BRAND = f"CASE WHEN {_BLANK_BRAND} THEN NULL ELSE p_brand END"
_LETTERS = """
WITH RECURSIVE s AS (SELECT p_partkey, p_partkey + 1 AS n, '' AS l FROM part
  UNION ALL SELECT p_partkey, (n - 1) // 26, chr(CAST(65 + (n - 1) % 26 AS INTEGER)) || l FROM s WHERE n > 0)
SELECT p_partkey, l AS letters, p_partkey AS back FROM s WHERE n = 0"""

#: Documents as files: some of a type without sheets, some whose stream failed or names nothing.
_FILE = {
    "file_id": "doc_id", "name": "source", "type": "CASE doc_id % 7 WHEN 0 THEN 'newdoc' WHEN 1 THEN 'sheet' WHEN 2 THEN 'mosheet' END", "list_error": "CASE WHEN doc_id % 3 = 1 THEN 'HTTP 500' END",
    "raw": "CASE WHEN doc_id % 3 < 2 THEN concat('x[\"B:', lang, '\",\"C*', doc_id % 5, '\"]') END",
}


def sheet_fallback(spark, sf_dir):
    """Sheets of documents by their stream, or by conversations as exported workbooks."""
    files = table(spark, sf_dir, "documents").selectExpr(*[f"{e} AS {n}" for n, e in _FILE.items()])
    cells = table(spark, sf_dir, "conversations").selectExpr("conv_id AS file_id", "role AS sheet", "turn + 1 AS _row", "CASE WHEN turn % 4 = 2 THEN array(' ', '') ELSE array(role, '', substr(text, 1, 3)) END AS cells")
    return sheets.sheets_with_fallback(files, cells).withColumn("headers", F.array_join("headers", "|"))


QUERIES = {
    "sheet_fallback": sheet_fallback,
    "sheet_read": sheet_read,
    "sheet_read_all": sheet_read_all,
    "sheet_headers": sheet_headers,
    "sheet_totals": sheet_totals,
    "sheet_rows_lookup": sheet_rows_lookup,
    "sheet_read_column": sheet_read_column,
    "sheet_column_lookup": sheet_column_lookup,
    "sheet_blank_tail_cut": sheet_blank_tail_cut,
    "token_backfill": token_backfill,
    "sheet_list": sheet_list,
    "i18n_export": i18n_export,
    "i18n_missing": i18n_missing,
    "i18n_key_counts": i18n_key_counts,
    "header_language": header_language,
    "xlsx_roundtrip": xlsx_roundtrip,
    "a1_columns": a1_columns,
}
ORACLES = {
    "sheet_fallback": f"""
        WITH f AS (SELECT {', '.join(f'{e} AS "{n}"' for n, e in _FILE.items())}, lang, doc_id FROM documents),
        b AS (SELECT conv_id AS file_id, role AS name, count(*) FILTER (turn > 0 AND turn % 4 <> 2) AS "rows", max(CASE WHEN turn = 0 THEN role END) AS h1, max(CASE WHEN turn = 0 THEN nullif(substr(text, 1, 3), '') END) AS h2 FROM conversations GROUP BY ALL),
        u AS (SELECT *, coalesce(nullif(name, ''), CAST(file_id AS VARCHAR)) AS document FROM f)
        SELECT file_id, document, NULL AS source, NULL AS fallback_reason, 'no sheets in type ' || type AS error, NULL AS name, NULL::INTEGER AS "index", NULL::BIGINT AS "rows", NULL::INTEGER AS cols, NULL AS headers FROM u WHERE type = 'newdoc'
        UNION ALL SELECT file_id, document, '{sheets.STREAM}', NULL, NULL, lang, CAST(doc_id % 5 AS INTEGER), NULL, NULL, NULL FROM u WHERE coalesce(type, '') <> 'newdoc' AND doc_id % 3 = 0 AND lang <> ''
        UNION ALL SELECT u.file_id, document, '{sheets.EXPORT}', coalesce(list_error, '{sheets.NO_TOKEN}'), NULL, b.name, NULL, b."rows", CASE WHEN b.name IS NOT NULL THEN CAST((h1 IS NOT NULL)::INTEGER + (h2 IS NOT NULL)::INTEGER AS INTEGER) END, CASE WHEN b.name IS NOT NULL THEN concat_ws('|', h1, h2) END
          FROM u LEFT JOIN b ON b.file_id = u.file_id WHERE coalesce(type, '') <> 'newdoc' AND NOT (doc_id % 3 = 0 AND coalesce(lang, '') <> '')""",
    "sheet_read": f'SELECT p_partkey + 2 AS _row, {_BRAND} AS "Brand", CAST(p_size AS VARCHAR) AS "Size", p_name AS "Name" FROM part WHERE {_NONBLANK} ORDER BY p_partkey LIMIT 200',
    "sheet_read_all": f'SELECT p_partkey + 2 AS _row, p_name AS "Name", {_BRAND} AS "Brand", p_type AS "Col3", CAST(p_size AS VARCHAR) AS "Size" FROM part WHERE {_NONBLANK}',
    "sheet_headers": f"""
        WITH h AS (SELECT * FROM (VALUES ('named', 1, 'Name', (SELECT count(*) FROM part WHERE p_name <> '')), ('named', 2, '', 0), ('named', 3, ' ', 1), ('named', 4, 'Unused', 0),
            ('named', 5, '', (SELECT count(*) FROM part WHERE {_BLANK_ROW})), ('named', 6, '', 0), ('unnamed', 1, '', 1), ('unnamed', 2, ' ', 0), ('unnamed', 3, '', 1), ('unnamed', 4, '', 0), ('unnamed', 5, '', 1), ('unnamed', 6, '', 0)) AS t(sheet, i, raw, n_cells)),
        k AS (SELECT *, max(trim(raw) <> '') OVER (PARTITION BY sheet) AS any_named FROM h)
        SELECT sheet, CAST(row_number() OVER (PARTITION BY sheet ORDER BY i) AS INTEGER) AS place, CASE WHEN trim(raw) = '' THEN 'Col' || i ELSE raw END AS header FROM k WHERE trim(raw) <> '' OR n_cells > 0 OR NOT any_named""",
    "sheet_totals": f"SELECT least(count(*), 200) AS kept_rows, least(count(*), 200) AS total_rows, count(*) >= 200 AS truncated FROM part WHERE {_NONBLANK}",
    "sheet_rows_lookup": f'SELECT p_partkey + 2 AS _row, p_name AS "Name", {_BRAND} AS "Brand", p_type AS "Col3", CAST(p_size AS VARCHAR) AS "Size" FROM part WHERE {_NONBLANK} AND p_partkey + 2 IN (3, 5, 13, 17, 99999999)',
    "sheet_read_column": f"""
        WITH c AS (SELECT p_partkey + 2 AS _row, CASE WHEN {_BLANK_ROW} THEN ' ' WHEN {_BLANK_BRAND} THEN '' ELSE p_brand END AS value FROM part),
        n AS (SELECT *, sum(CASE WHEN trim(value) <> '' THEN 1 ELSE 0 END) OVER (ORDER BY _row) AS filled FROM c)
        SELECT _row, value FROM n WHERE filled < 500 OR (filled = 500 AND trim(value) <> '')""",
    "sheet_column_lookup": f"SELECT p_partkey + 2 AS _row, CASE WHEN {_BLANK_ROW} THEN ' ' WHEN {_BLANK_BRAND} THEN '' ELSE p_brand END AS value FROM part WHERE p_partkey + 2 IN (2, 9, 40, 41)",
    "sheet_blank_tail_cut": f"""
        WITH r AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _CUT_ROWS.items())} FROM events),
        n AS (SELECT *, sum(CASE WHEN blank THEN 0 ELSE 1 END) OVER (PARTITION BY sheet ORDER BY _row) AS run FROM r),
        k AS (SELECT *, row_number() OVER (PARTITION BY sheet, run, blank ORDER BY _row) AS nth FROM n)
        SELECT sheet, min(CASE WHEN blank AND nth >= 50 THEN _row END) AS cut FROM k GROUP BY sheet""",
    "token_backfill": """
        WITH f AS (SELECT *, first_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS marker FROM events)
        SELECT user_id, event_id, event_type, marker FROM f WHERE event_type <> 'signup' AND marker IS NOT NULL""",
    "sheet_list": """
        WITH f AS (SELECT *, first_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS marker FROM events)
        SELECT user_id AS file_id, event_type AS name, CAST(min(marker % 1000) AS INTEGER) AS index FROM f WHERE event_type <> 'signup' AND marker IS NOT NULL GROUP BY ALL""",
    "i18n_export": _I18N_SQL + "SELECT * FROM entries",
    "i18n_key_counts": _I18N_SQL + "SELECT lang, count(*) AS n_keys, (SELECT count(DISTINCT n) > 1 FROM (SELECT count(*) AS n FROM entries GROUP BY lang)) AS uneven FROM entries GROUP BY lang",
    "i18n_missing": _I18N_SQL
    + """SELECT r AS "row", md5(CASE WHEN c0 = '' THEN 'txt_row_' || r ELSE c0 END) AS key_md5,
        CASE WHEN c0 = '' THEN 'zh' WHEN c1 = '' AND c2 = '' THEN 'en,in' WHEN c1 = '' THEN 'en' ELSE 'in' END AS langs FROM d WHERE c0 = '' OR c1 = '' OR c2 = ''""",
    "header_language": _header_sql(),
    "xlsx_roundtrip": """SELECT 's_' || (p_partkey % 3) AS sheet, p_partkey + 1 AS _row, p_name || '||' || p_type || '|' || p_size || '|<&">' || p_brand AS cells FROM part""",
    "a1_columns": _LETTERS,
}
