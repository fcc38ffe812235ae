"""What the query modules share: tables, derived rectangles, and SQL fragments for the DuckDB side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.session import shared_table

#: White space as the library trims it, as an RE2 class.
WS = r"[\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

#: A unique order of an order's line items.
SEQ = "CAST(l_linenumber AS BIGINT) * 10000000000000 + l_partkey * 10000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT)"

#: A unique place of a line item in the whole table; these five columns repeat in no row.
PLACE = "(((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey) * 64 + CAST(l_quantity AS BIGINT)"
#: The fields of :data:`PLACE`, the orders it holds in 63 bits, and the lines of an order that :func:`placed` tells apart beyond them.
_FITS = "l_linenumber BETWEEN 0 AND 7 AND l_partkey BETWEEN 0 AND 999999 AND l_suppkey BETWEEN 0 AND 9999 AND l_quantity >= 0 AND l_quantity < 64"
_ORDERS, _ORDER_STEP, _LINES = 1_800_000, 8 * 1_000_000 * 10_000 * 64, 1_000_000
_PLACED = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")

#: Layer rectangles derived from line items, as expressions both engines understand.
RECT = {
    "doc": "l_orderkey",
    "seq": SEQ,
    "x": "CAST(l_partkey % 50 * 5 AS BIGINT)",
    "y": "CAST(l_suppkey % 40 * 5 AS BIGINT)",
    "w": "CAST(10 + l_quantity * 4 AS BIGINT)",
    "h": "CAST(10 + l_quantity * 3 AS BIGINT)",
    "type": "CASE WHEN l_suppkey % 9 = 0 THEN 'text' WHEN l_suppkey % 9 = 1 THEN 'image' ELSE 'rect' END",
    "fill": "CASE WHEN l_partkey % 3 = 0 THEN '#ffffff' WHEN l_partkey % 3 = 1 THEN 'rgba(1,2,3,1)' ELSE 'rgba(1,2,3,0.5)' END",
    "is_slice": "l_partkey % 11 = 0",
    "image_url": "CASE WHEN l_suppkey % 9 = 1 THEN 'u' END",
}
RECT_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in RECT.items()) + " FROM lineitem"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` (its keys, quantity and flag) with ``place``: :data:`PLACE`, and the like where that does not hold.

    :data:`PLACE` is longer than 63 bits for later orders, and runs over for large keys. Lines of such an order are numbered
    within it, in the same order of the five columns, so places are unique and ascend with them throughout; an order
    whose lines fit keeps its places however the table grows. Orders up to 7 billion have places. The numbered
    table is written once, as its readers read it several times.
    """
    rows = table(spark, sf_dir, "lineitem").select(*_PLACED, "l_returnflag")
    fits = F.expr(f"l_orderkey BETWEEN 0 AND {_ORDERS - 1} AND {_FITS}")
    if rows.filter(~fits).isEmpty():
        return rows.withColumn("place", F.expr(PLACE))
    order = Window.partitionBy("l_orderkey").orderBy(*_PLACED[1:])  # one window holds both
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = rows.withColumns({"_wide": F.max(~fits).over(whole), "_n": F.row_number().over(order)})
    base = f"CASE WHEN l_orderkey < {_ORDERS} THEN l_orderkey * {_ORDER_STEP}L ELSE {_ORDERS * _ORDER_STEP}L + (l_orderkey - {_ORDERS}) * {_LINES}L END"
    known = " AND ".join(f"{c} IS NOT NULL" for c in _PLACED)
    place = F.expr(f"CASE WHEN NOT ({known}) THEN NULL WHEN _wide THEN {base} + _n ELSE {PLACE} END")
    return shared_table(numbered.withColumn("place", place).drop("_wide", "_n"), "places")


def derived(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns by expression."""
    return df.selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()])


def select_sql(columns: dict[str, str], source: str) -> str:
    """The same columns as a SELECT."""
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {source}"


def rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer rectangles of :data:`RECT`."""
    return derived(table(spark, sf_dir, "lineitem"), RECT)


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_squash(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', '', 'g')"


def sql_merge_key(x: str) -> str:
    return f"regexp_replace({sql_squash(f'lower({x})')}, '[，。、；：！？]', '', 'g')"


def sql_anchors(values: str, tolerance: int) -> str:
    """Anchored clusters of a list."""
    ones = f"list_transform(list_sort(list_distinct({values})), lambda v: [v])"
    return f"list_reduce({ones}, lambda a, b: CASE WHEN b[1] - a[len(a)] > {tolerance} THEN list_concat(a, b) ELSE a END)"


def sql_nearest(keys: str, value: str) -> str:
    return f"list_sort(list_transform(range(len({keys})), lambda i: {{'d': abs({value} - {keys}[i + 1]), 'i': i}}))[1].i"


def sql_text_similarity(a: str, b: str) -> str:
    x, y = f"trim(lower({a}))", f"trim(lower({b}))"
    chars = lambda t: f"list_distinct(string_split({t}, ''))"
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL OR {a} = '' OR {b} = '' THEN 0.0 WHEN {x} = {y} THEN 1.0 WHEN contains({x}, {y}) OR contains({y}, {x}) THEN 0.8 "
        f"ELSE len(list_intersect({chars(x)}, {chars(y)}))::DOUBLE / len(list_distinct(list_concat({chars(x)}, {chars(y)}))) END"
    )
