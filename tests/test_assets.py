"""The content-addressed sink: what bytes are, skips, retries and lost runs."""

import hashlib
import os
import struct

from tessella.sources import assets

PNG = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 70_000) + b"\x08\x06"
GIF = b"GIF89a" + struct.pack("<HH", 300, 5) + b";"
SVG = "﻿<?xml version='1.0'?><svg width='1'><path d='M0 0'/></svg>".encode()
BODIES = {
    "png": (PNG, "png", 640, 70_000, None), "gif": (GIF, "gif", 300, 5, None), "jpg": (b"\xff\xd8\xff\xe0rest", "jpeg", None, None, None), "webp": (b"RIFF\x01\x02\x03\x04WEBPVP8 ", "webp", None, None, None),
    "svg": (SVG, "svg", None, None, None), "active": (b"<svg><script>x</script></svg>", None, None, None, "unsafe_svg"), "page": (b" \n<!DOCTYPE HTML><p>", None, None, None, "html_response"),
    "none": (None, None, None, None, "empty_asset"), "blank": (b"", None, None, None, "empty_asset"), "text": (b"hello", None, None, None, "invalid_image"), "xml": (b"<?xml version='1.0'?><a/>", None, None, None, "invalid_image"),
    "broken": (b"<svg>\xff\xfe</svg>", None, None, None, "invalid_image"), "short": (b"\x89PNG\r\n\x1a\n", "png", None, None, None),
}
SCHEMA = "file_name string, name string, url string, body binary, extra int"


def _files(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)


def _objects(root):
    return sorted(f for _, _, names in os.walk(f"{root}/objects") for f in names)


def test_bytes_decide(spark):
    found = assets.inspected(_files(spark, [(n, n, None, b[0]) for n, b in BODIES.items()]))
    got = {r.file_name: (r.format, r.width, r.height, r.reason) for r in found.collect()}
    assert got == {n: b[1:] for n, b in BODIES.items()}
    assert {r.file_name: r.sha256 for r in found.collect()} == {n: hashlib.sha256(b[0] or b"").hexdigest() for n, b in BODIES.items()}


def test_skips_what_is_there_and_tries_refused_files_again(spark, tmp_path):
    path = f"file://{tmp_path}/sink"
    first = [("a", "A", "u2", PNG), ("a", "A", "u1", GIF), ("b", "B", "u3", GIF), ("c", "C", "u4", b""), (None, "D", "u5", PNG)]
    run = {r.file_name: (r.url, r.format, r.reason) for r in assets.store_assets(_files(spark, first), path).collect()}
    assert run == {"a": ("u1", "gif", None), "b": ("u3", "gif", None), "c": ("u4", None, "empty_asset")}
    assert _objects(f"{tmp_path}/sink") == [hashlib.sha256(GIF).hexdigest()]
    run = {r.file_name: r.format for r in assets.store_assets(_files(spark, [("a", "A", "u2", PNG), ("c", "C", "u4", PNG)]), path).collect()}
    assert run == {"c": "png"}
    assert {r.file_name: bytes(r.body) for r in assets.stored_bodies(spark, path).collect()} == {"a": GIF, "b": GIF, "c": PNG}
    assert assets.store_assets(_files(spark, []), path).count() == 0


def test_a_run_lost_before_its_commit(spark, tmp_path, monkeypatch):
    path, rows = f"file://{tmp_path}/sink", [(f"f{i}", "n", f"u{i}", PNG + bytes([i])) for i in range(5)]
    plain = assets.shared_checkpoint
    calls = []

    def lost(df):
        calls.append(1)
        if len(calls) == 2:
            df.collect()  # the objects are written
            raise RuntimeError("lost")
        return plain(df)

    with monkeypatch.context() as patch:
        patch.setattr(assets, "shared_checkpoint", lost)
        try:
            assets.store_assets(_files(spark, rows), path)
        except RuntimeError:
            pass
    before = _objects(f"{tmp_path}/sink")
    assert len(before) == 5 and assets.read_manifest(spark, path).count() == 0
    assert assets.store_assets(_files(spark, rows), path).count() == 5 and _objects(f"{tmp_path}/sink") == before
    assert assets.store_assets(_files(spark, rows), path).count() == 0
