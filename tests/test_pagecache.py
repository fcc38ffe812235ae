"""The two-level cache of pages: replays, failures, lost runs and odd rows."""

from pyspark.sql import functions as F

from tessella.operators import pagecache

PARTS = "page string, kind string, type string, pos long, content string, extra string"


def _run(spark, parts, store, bad="none"):
    """The rows of a run and the contents that it worked on."""
    queued = []

    def work(gaps):
        queued.extend(r.content for r in gaps.collect())
        return gaps.select("key", F.concat(F.lit("r:"), F.coalesce("content", F.lit("-"))).alias("result"), F.coalesce(F.col("content") == bad, F.lit(False)).alias("failed"))

    rows = pagecache.process_pages(spark.createDataFrame(parts, PARTS), work, store).collect()
    return {(r.page, r.kind, r.pos): (r.level, r.result, r.failed) for r in rows}, sorted(str(q) for q in queued)


def test_replays_work_on_gaps_only(spark, tmp_path):
    store = f"file://{tmp_path}/s"
    parts = [("a", "segment", "page", 1, "x", "e"), ("a", "segment", "page", 2, "bad", "e"), ("a", "image", "image", 1, "x", "e"), ("b", "segment", "page", 1, "y", "e")]
    first, queued = _run(spark, parts, store, bad="bad")
    assert queued == ["bad", "x", "x", "y"] and first[("a", "segment", 2)] == (None, None, True) and first[("b", "segment", 1)] == (None, "r:y", False)
    second, queued = _run(spark, parts, store)  # the failure alone is open; its page has no entry, the others have
    assert queued == ["bad"]
    assert second == {("a", "segment", 1): ("part", "r:x", False), ("a", "segment", 2): (None, "r:bad", False), ("a", "image", 1): ("page", "r:x", False), ("b", "segment", 1): ("page", "r:y", False)}
    third, queued = _run(spark, parts, store)
    assert queued == [] and {level for level, _, _ in third.values()} == {"page"}
    moved = [("b", "segment", "page", 1, "z", "e"), ("b", "segment", "page", 2, "y", "e")]  # other places: another page, the same part
    fourth, queued = _run(spark, moved, store)
    assert queued == ["z"] and fourth[("b", "segment", 2)] == ("part", "r:y", False)


def test_a_run_lost_between_parts_and_pages(spark, tmp_path, monkeypatch):
    store, parts = f"file://{tmp_path}/s", [("a", "segment", "page", 1, "x", None), ("a", "segment", "page", 2, "y", None)]

    def lost(rows):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(pagecache, "page_entries", lost)
        try:
            _run(spark, parts, store)
        except RuntimeError:
            pass
    again, queued = _run(spark, parts, store)
    assert queued == [] and {v[0] for v in again.values()} == {"part"}
    assert {v[0] for v in _run(spark, parts, store)[0].values()} == {"page"}


def test_odd_rows(spark, tmp_path):
    assert _run(spark, [], f"file://{tmp_path}/e") == ({}, [])
    long = "w" * 300_000
    parts = [(None, "segment", None, None, None, "x"), ("p", None, "page", 1, long, "x"), ("p", None, "page", 1, long, "x")]
    rows, queued = _run(spark, parts, f"file://{tmp_path}/s")
    assert queued == ["None", long] and rows == {(None, "segment", None): (None, "r:-", False), ("p", None, 1): (None, "r:" + long, False)}
    rows, queued = _run(spark, parts, f"file://{tmp_path}/s")
    assert queued == [] and rows[("p", None, 1)] == ("page", "r:" + long, False) and rows[(None, "segment", None)][:2] == ("part", "r:-")
