"""URL expressions: ids, host allow-lists and scaled image addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.text import js_round

#: Factors of the named scales, relative to the logical size at 1x (fixed values of the service).
SCALES = {"1x": 1.0, "2x": 2.0, "3x": 3.0, "ios_1x": 1.0, "ios_2x": 2.0, "ios_3x": 3.0, "android_mdpi": 1.0, "android_hdpi": 1.5, "android_xhdpi": 2.0, "android_xxhdpi": 3.0}


def host(url: Column) -> Column:
    """Lower-case host of a URL; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def query_parameter(url: Column, name: str) -> Column:
    """Value of a query parameter, also within a fragment's own query; null if missing."""
    found = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
    return F.when(found != "", found)


def path_id(url: Column, segment: str) -> Column:
    """The path part after ``/segment/``; null if missing."""
    found = F.regexp_extract(url, rf"/{segment}/([A-Za-z0-9_-]+)", 1)
    return F.when(found != "", found)


def is_allowed_asset(url: Column, suffixes: Sequence[str]) -> Column:
    """https, no credentials in the URL, and a host that equals or lies under an allowed suffix."""
    name = host(url)
    listed = F.lit(False)
    for suffix in suffixes:
        listed = listed | (name == suffix) | name.endswith(f".{suffix}")
    credentials = url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*@")
    return F.coalesce(url.rlike("(?i)^https://") & ~credentials & listed, F.lit(False))


def scale_url(url: Column, w: Column, h: Column, scale: str, stored: int = 4, image_format: str = "png") -> Column:
    """Address of an image at a named scale; null without a URL or size.

    ``original`` is the stored file, converted only if another format than png is wanted, and
    ``android_xxxhdpi`` has the stored size, whatever that is.
    """
    convert = f"format,{image_format}"
    if scale == "original":
        made = url if image_format == "png" else F.concat(url, F.lit(f"?x-oss-process=image/{convert}"))
    else:
        lw, lh = F.greatest(F.lit(1), js_round(w)), F.greatest(F.lit(1), js_round(h))
        factor = stored if scale == "android_xxxhdpi" else SCALES[scale] if scale[0].isdigit() else SCALES[scale] * stored / 4
        sw, sh = js_round(lw * factor), js_round(lh * factor)
        same = (sw == lw * stored) & (sh == lh * stored)
        resize = F.when(same, F.lit("")).otherwise(F.concat(F.lit("resize,w_"), F.greatest(F.lit(1), sw).cast("string"), F.lit(",h_"), F.greatest(F.lit(1), sh).cast("string"), F.lit("/")))
        made = F.concat(url, F.lit("?x-oss-process=image/"), resize, F.lit(convert))
    return F.when((url != "") & (w != 0) & (h != 0), made)


def slice_file_name(name: Column, url: Column, scale: str, extension: str) -> Column:
    """``clean_hash@scale.ext`` with eight digits of the URL's MD5."""
    from tessella.functions.text import safe_slice_name

    return F.concat(safe_slice_name(name), F.lit("_"), F.substring(F.md5(url), 1, 8), F.lit(f"@{scale}.{extension}"))
