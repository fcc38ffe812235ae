"""Fetched files: what their bytes are, and a content-addressed sink with a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators.documents import is_unsafe_svg
from tessella.session import shared_checkpoint

#: Largest file taken, in bytes (fixed value of the service).
MOST_BYTES = 64 * 1024 * 1024
#: How the picture formats start, as patterns over the first sixteen bytes in hex (fixed values of the formats).
STARTS = {
    "png": "^89504E470D0A1A0A", "jpeg": "^FFD8FF", "gif": "^47494638(37|39)61", "webp": "^52494646.{8}57454250",
    "avif": "^.{8}6674797061766966", "tiff": "^(49492A00|4D4D002A)", "ico": "^00000100",
}
MANIFEST = "file_name string, name string, url string, sha256 string, format string, n_bytes long, width long, height long, reason string"


def _number(body: Column, *places: int) -> Column:
    """The bytes at ``places`` (from 1) as a number, the first the highest."""
    digits = F.concat(*[F.hex(F.substring(body, p, 1)) for p in places])
    return F.conv(F.when(digits != "", digits), 16, 10).cast("long")


def inspected(files: DataFrame, body: str = "body") -> DataFrame:
    """``files`` with ``sha256, format, n_bytes, width, height, reason`` instead of ``body``'s own claim.

    ``reason`` says why a file is refused: ``empty_asset`` (null too), ``too_large``, ``html_response`` (a page that
    poses as a picture), ``unsafe_svg`` or ``invalid_image``; a refused file has neither format nor size. Width and
    height are those of PNG and GIF headers, null for other formats. Bytes are judged, never names.
    """
    data = F.coalesce(F.col(body), F.lit(b""))
    size = F.octet_length(data).cast("long")
    start = F.hex(F.substring(data, 1, 16))
    head = F.lower(F.decode(F.substring(data, 1, 1024), "ISO-8859-1"))
    text = F.try_validate_utf8(data.cast("string"))
    found = F.lit(None).cast("string")
    for name, pattern in STARTS.items():
        found = F.coalesce(found, F.when(start.rlike(pattern), F.lit(name)))
    drawn = head.rlike(r"^(\x{EF}\x{BB}\x{BF})?[\s\x{A0}]*(<\?xml|<svg|<!--)")
    is_svg = drawn & text.rlike(r"(?i)<svg[\s>]")
    reason = (
        F.when(size == 0, "empty_asset").when(size > MOST_BYTES, "too_large").when(head.rlike(r"^[\s\x{A0}]*(<!doctype html|<html)"), "html_response")
        .when(F.coalesce(is_svg, F.lit(False)), F.when(is_unsafe_svg(text), "unsafe_svg")).when(found.isNull(), "invalid_image")
    )
    kind = F.when(F.coalesce(is_svg, F.lit(False)), F.lit("svg")).otherwise(found)
    width = F.when(kind == "png", _number(data, 17, 18, 19, 20)).when(kind == "gif", _number(data, 8, 7))
    height = F.when(kind == "png", _number(data, 21, 22, 23, 24)).when(kind == "gif", _number(data, 10, 9))
    rows = files.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return rows.select(
        *[c for c in files.columns if c not in {"sha256", "format", "n_bytes", "width", "height", "reason"}],
        F.sha2(data, 256).alias("sha256"), F.when(good, kind).alias("format"), size.alias("n_bytes"),
        F.when(good, width).alias("width"), F.when(good, height).alias("height"), "reason",
    )


def read_manifest(spark, path: str) -> DataFrame:
    """Files the sink at ``path`` has committed or refused, a row a run and file; empty before its first run."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest") if store.exists(folder) else spark.createDataFrame([], MANIFEST)


def store_assets(files: DataFrame, path: str) -> DataFrame:
    """Write the bodies of ``files`` (``file_name, name, url, body``) below ``path``; returns this run's manifest rows.

    ``path`` is a URI that driver and executors share. A body lies at ``objects/<two digits>/<sha256>``, so equal
    bodies are one object and a task that is run again, or twice at once, writes the same bytes to the same place:
    an object is written beside it and then moved. The manifest is appended once all objects are there, by Spark's
    own commit: a run that is lost before leaves no rows, and the next one writes what is missing. Files
    that the manifest holds as good are skipped, refused ones are tried again. Of rows with one file
    name the first by URL, digest and name is taken; a null file name is left out.
    """
    spark = files.sparkSession
    known = read_manifest(spark, path).filter("reason IS NULL").select("file_name").distinct()
    todo = inspected(files.filter("file_name IS NOT NULL").join(known, "file_name", "left_anti").select("file_name", "name", "url", "body"))
    # Bodies stay where they are: the first of each name is found on narrow rows.
    todo = shared_checkpoint(todo.withColumn("row", F.monotonically_increasing_id()))
    narrow = todo.drop("body").groupBy("file_name").agg(F.min_by("row", F.struct("url", "sha256", "name", "row")).alias("row"))
    taken = todo.join(narrow.select("row"), "row", "left_semi")

    def write(batches):
        import uuid

        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for digest, body in zip(batch.column("sha256").to_pylist(), batch.column("body")):
                folder = f"{root}/objects/{digest[:2]}"
                if target.get_file_info(f"{folder}/{digest}").type == fs.FileType.NotFound:
                    target.create_dir(folder, recursive=True)
                    beside = f"{folder}/.{digest}.{uuid.uuid4().hex}"
                    with target.open_output_stream(beside) as out:
                        out.write(body.as_buffer())
                    target.move(beside, f"{folder}/{digest}")
            yield batch.select(["row"])

    rows = [f.split()[0] for f in MANIFEST.split(", ")]
    placed = taken.filter("reason IS NULL").select("row", "sha256", "body").mapInArrow(write, "row long")
    stored = taken.select("row", *rows).join(placed, "row", "left_semi").unionByName(taken.filter("reason IS NOT NULL").select("row", *rows))
    run = shared_checkpoint(stored.select(*rows))
    run.write.mode("append").parquet(f"{path}/manifest")
    return run


def stored_bodies(spark, path: str) -> DataFrame:
    """``file_name, sha256, body`` of the sink's good files, read back by Spark."""
    listed = read_manifest(spark, path).filter("reason IS NULL").groupBy("file_name").agg(F.min("sha256").alias("sha256"))
    objects = spark.read.format("binaryFile").load(f"{path}/objects/*/*").select(F.element_at(F.split("path", "/"), -1).alias("o_digest"), F.col("content").alias("body"))
    return listed.join(objects, F.col("sha256") == F.col("o_digest")).select("file_name", "sha256", "body")
