"""Places of line items whose keys are longer than the packed number has room for."""

import duckdb
from pyspark.sql import functions as F

from tessella.plans import canvases, common, flows, shapes
from tests.compare import SF

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _grown(spark, folder, orders=9_000_000, parts=1_200_000, suppliers=60_000):
    """The small line items beside a copy of them with large keys."""
    rows = spark.read.parquet(f"{SF}/lineitem.parquet")
    far = rows.withColumns({"l_orderkey": F.col("l_orderkey") + orders, "l_partkey": F.col("l_partkey") + parts, "l_suppkey": F.col("l_suppkey") + suppliers})
    rows.unionByName(far).write.parquet(f"{folder}/lineitem.parquet")
    for name, key, more in (("part", "p_partkey", parts),):
        own = spark.read.parquet(f"{SF}/{name}.parquet")
        own.unionByName(own.withColumn(key, F.col(key) + more)).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_places_are_unique_and_ascend_with_the_columns(spark, tmp_path):
    rows = common.placed(spark, _grown(spark, tmp_path)).withColumn("packed", F.expr("CASE WHEN l_orderkey < 1000000 THEN " + common.PLACE + " END")).collect()
    rows.sort(key=lambda r: tuple(r[k] for k in KEYS))
    places = [r["place"] for r in rows]
    assert len(rows) == 2 * spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert all(a < b for a, b in zip(places, places[1:]))
    assert all(r["place"] == r["packed"] for r in rows if r["packed"] is not None)


def test_an_early_order_with_a_large_key_keeps_its_order(spark, tmp_path):
    lines = [(3, 1, 5, 7, 1.0, "A"), (3, 1, 1_000_000, 7, 1.0, "A"), (3, 2, 4, 10_000, 1.0, "A"), (4, 1, 1, 1, 1.0, "A"), (5, None, 1, 1, 1.0, "A")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = sorted(common.placed(spark, str(tmp_path)).collect(), key=lambda r: (r["l_orderkey"], r["l_linenumber"] or 0, r["l_partkey"]))
    places = [r["place"] for r in rows]
    assert places[:3] == [3 * 8 * 64 * 10**10 + n for n in (1, 2, 3)] and places[4] is None
    assert places[3] == (((4 * 8 + 1) * 10**6 + 1) * 10**4 + 1) * 64 + 1


def test_queries_by_place_hold_on_large_keys(spark, tmp_path):
    sf_dir = _grown(spark, tmp_path)
    whole = spark.read.parquet(f"{SF}/lineitem.parquet").filter("l_partkey % 3 = 0 AND l_partkey % 15 <> 0 AND l_quantity >= 18 AND l_linenumber >= 2").count()
    found = canvases.canvas_containers(spark, sf_dir)
    assert found.count() == found.select("doc", "seq").distinct().count() == 2 * whole
    assert flows.slice_files(spark, sf_dir).count() > flows.slice_files(spark, SF).count()


def test_fragment_chains_hold_on_large_keys(spark, tmp_path):
    """The rows of the query's SQL, with its place in 128 bits; only the places' own values differ."""
    rows, far = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet"), {"l_orderkey": 9_000_000, "l_partkey": 1_200_000, "l_suppkey": 60_000}
    rows.unionByName(rows.withColumns({k: F.col(k) + n for k, n in far.items()})).write.parquet(f"{tmp_path}/lineitem.parquet")
    wide = "((((l_orderkey::HUGEINT * 8 + l_linenumber) * 10000000 + l_partkey) * 100000 + l_suppkey) * 64 + CAST(l_quantity AS BIGINT))"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
        want = db.execute(shapes.ORACLES["run_chain_fragments"].replace(common.PLACE, wide)).fetchall()
    found = [tuple(r) for r in shapes.run_chain_fragments(spark, str(tmp_path)).collect()]
    without = lambda rows: sorted((d, p, x, y, w, h) for d, p, _, x, y, w, h in rows)
    assert without(found) == without(want) and len({r[2] for r in found}) == len(found) > 0
