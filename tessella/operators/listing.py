"""Directory listings: three-level descent with failures as rows, sectors with names and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def directory(folders: DataFrame, projects: DataFrame, sectors: DataFrame) -> DataFrame:
    """``folder_id, project_id, project, n_sectors, error``: projects of folders with their sector count.

    ``folders`` has ``folder_id``, ``projects`` has ``folder_id, project_id, project, error`` and
    ``sectors`` has ``project_id``. A failed project is a row with its error and no count; a folder
    without projects has none.
    """
    counts = sectors.groupBy("project_id").agg(F.count("*").alias("n_sectors"))
    joined = projects.join(folders.select("folder_id").distinct(), "folder_id").join(counts, "project_id", "left")
    count = F.when(F.col("error").isNull(), F.coalesce("n_sectors", F.lit(0)))
    return joined.select("folder_id", "project_id", "project", count.alias("n_sectors"), "error")


def sector_images(sectors: DataFrame, names: DataFrame) -> DataFrame:
    """``sector_id, image_id, image_name``: each listed image with its name, or its id if it has none.

    ``sectors`` has ``sector_id, images`` (array of ids), ``names`` has ``image_id, name``.
    """
    each = sectors.select("sector_id", F.explode("images").alias("image_id"))
    known = names.groupBy("image_id").agg(F.min("name").alias("name"))
    joined = each.join(known, "image_id", "left")
    return joined.select("sector_id", "image_id", F.coalesce("name", F.col("image_id").cast("string")).alias("image_name"))


def sector_designs(images: DataFrame, layers: DataFrame) -> DataFrame:
    """``sector_id, image_id, n_layers, width, height, failed``: size and layer count of each image's
    design; an image without layers has failed."""
    size = layers.groupBy("image_id").agg(F.count("*").alias("n_layers"), F.max(F.col("x") + F.col("w")).alias("width"), F.max(F.col("y") + F.col("h")).alias("height"))
    joined = images.join(size, "image_id", "left")
    return joined.select("sector_id", "image_id", F.coalesce("n_layers", F.lit(0)).alias("n_layers"), "width", "height", F.col("n_layers").isNull().alias("failed"))


def slice_plan(slices: DataFrame, existing: DataFrame, names: DataFrame | None = None, scale: str = "2x", image_format: str = "png") -> DataFrame:
    """``name, url, file_name, scale_url`` of slices still to fetch.

    ``slices`` has ``seq, name, url, w, h``: wanted names only if ``names`` (``name``) is given, the
    first slice of each URL, without files that ``existing`` (``file_name``) already has.
    """
    from tessella.functions.urls import scale_url, slice_file_name
    from tessella.operators.sequence import keep_first

    wanted = slices.join(names.select("name").distinct(), "name", "left_semi") if names is not None else slices
    first = keep_first(wanted.filter(F.col("url").isNotNull() & (F.col("url") != "")), [F.col("url")], ["seq"])
    named = first.select(
        "name", "url", slice_file_name(F.col("name"), F.col("url"), scale, image_format).alias("file_name"),
        scale_url(F.col("url"), F.col("w"), F.col("h"), scale, image_format=image_format).alias("scale_url"),
    )
    return named.join(existing.select("file_name").distinct(), "file_name", "left_anti").select("name", "url", "file_name", "scale_url")
