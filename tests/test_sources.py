import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.sources import images, records, sinks


def gradient(h=20, w=33):
    y, x = np.mgrid[0:h, 0:w]
    return np.stack([(x * 7) % 256, (y * 11) % 256, (x + y) % 256], 2).astype(np.uint8)


def filtered_png(a, kind):
    """A PNG whose rows use one of the five row filters."""
    import struct

    h, w, c = a.shape
    raw, above = b"", np.zeros(w * c, int)
    for y in range(h):
        row = a[y].reshape(-1).astype(int)
        left = np.concatenate([np.zeros(c, int), row[:-c]])
        corner = np.concatenate([np.zeros(c, int), above[:-c]])
        p = left + above - corner
        d = [np.abs(p - left), np.abs(p - above), np.abs(p - corner)]
        paeth = np.where((d[0] <= d[1]) & (d[0] <= d[2]), left, np.where(d[1] <= d[2], above, corner))
        guess = [0, left, above, (left + above) // 2, paeth][kind]
        raw += bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes()
        above = row
    chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    assert (images.decode_png(filtered_png(gradient(), kind)) == gradient()).all()


def test_png_round_trips():
    a = gradient()
    for image in (a, a[..., 0]):
        assert (images.decode(sinks.encode_png(image)) == image).all()
    mask = a[..., 0] > 100
    assert (images.as_mask(images.decode(sinks.encode_png(mask))) == mask).all()
    with pytest.raises(images.ImageError):
        images.decode_png(sinks.encode_png(a), max_pixels=10)


def test_tiff_pyramid_and_windows():
    a = gradient(70, 90)
    data = sinks.encode_tiff([a, a[::2, ::2]], tile=32, mpp=0.5)
    levels = images.tiff_levels(data)
    assert [(v.width, v.height) for v in levels] == [(90, 70), (45, 35)]
    assert 10000 / levels[0].resolution[0] == pytest.approx(0.5)
    assert (images.read_level(data, levels[0]) == a).all()
    assert (images.read_level(data, levels[0], 30, 20, 40, 30) == a[20:50, 30:70]).all()
    mask = a[..., 0] > 128
    one = sinks.encode_tiff(sinks.mask_pyramid(mask), tile=16)
    assert (images.read_level(one, images.tiff_levels(one)[0]).astype(bool) == mask).all()
    with pytest.raises(images.ImageError):
        images.read_level(data, levels[0], 80, 0, 20, 10)


def test_masks_change_size_only_within_their_aspect():
    m = np.zeros((10, 20), bool)
    m[2, 3] = True
    assert images.as_mask(m, (20, 40)).sum() == 4
    with pytest.raises(images.ImageError):
        images.as_mask(m, (20, 20))
    with pytest.raises(images.ImageError):
        images.as_mask(np.zeros((4, 4), bool))
    with pytest.raises(images.ImageError):
        images.as_rgb(np.zeros((4, 4), np.float32))


def test_images_and_headers(spark, tmp_path):
    a = gradient(40, 50)
    (tmp_path / "ok.png").write_bytes(sinks.encode_png(a))
    (tmp_path / "bad.png").write_bytes(b"nothing")
    got = {r.path.rpartition("/")[2]: r for r in images.images(spark, str(tmp_path), "*.png").collect()}
    assert bytes(got["ok.png"].data) == a.tobytes() and got["bad.png"].h is None and got["bad.png"].error_type
    (tmp_path / "s.tif").write_bytes(sinks.encode_tiff([a, a[::2, ::2]], 16, 0.25))
    h = images.headers(spark, str(tmp_path)).first()
    assert (h.width, h.height, h.downsamples) == (50, 40, [1.0, 2.0]) and h.mpp_x == pytest.approx(0.25)
    images.register(spark)
    tiles = spark.read.format("tiled_image").option("path", str(tmp_path / "s.tif")).option("tile", 16).load()
    seen = np.zeros_like(a)
    for r in tiles.collect():
        seen[r.y : r.y + r.h, r.x : r.x + r.w] = np.frombuffer(bytes(r.data), np.uint8).reshape(r.h, r.w, 3)
    assert (seen == a).all()


def test_mask_files(spark, tmp_path):
    bits = lambda m: bytearray(np.packbits(m).tobytes())
    one = np.ones((8, 8), bool)
    rows = [("s", 0, 0, 8, 8, bits(one), 24, 16), ("s", 4, 4, 8, 8, bits(one), 24, 16), ("s", 0, 0, 8, 8, bits(one), 24, 16), ("t", 0, 0, 8, 8, bits(one), 10**6, 10**6)]
    t = spark.createDataFrame(rows, "slide string, x int, y int, w int, h int, bits binary, plane_w int, plane_h int")
    made = sinks.mask_files(t)
    got = {r.slide: r for r in made.collect()}
    assert got["s"].pixels_set == 64 + 64 - 16 and got["t"].tiff is None and "budget" in got["t"].error
    assert len(images.tiff_levels(bytes(got["s"].tiff))) == 4
    done = sinks.write_files(made.filter("tiff IS NOT NULL").withColumn("name", F.concat("slide", F.lit(".tif"))), str(tmp_path / "out"), "name", "tiff").first()
    assert done.error is None and (tmp_path / "out" / "s.tif").read_bytes() == bytes(got["s"].tiff)


def test_manifests(spark, tmp_path):
    (tmp_path / "slides").mkdir()
    for n in ("b.svs", "a.SVS", "notes.txt"):
        (tmp_path / "slides" / n).write_bytes(b"x")
    (tmp_path / "list.txt").write_text("# comment\n\nx/y.svs\n")
    (tmp_path / "m.csv").write_text("slide_path,stain\nq.svs,HE\n")
    found = records.discover(records.folder(spark, str(tmp_path / "slides")), records.list_file(spark, str(tmp_path / "list.txt")), records.manifest(spark, str(tmp_path / "m.csv")))
    assert found.count() == 4 and found.filter("stain = 'HE'").count() == 1
    (tmp_path / "n.csv").write_text("name\nq\n")
    with pytest.raises(ValueError):
        records.manifest(spark, str(tmp_path / "n.csv"))
    (tmp_path / "meta.csv").write_text("file_path,age\nq.svs,7\nq.svs,8\n")
    assert records.metadata(spark, [str(tmp_path / "meta.csv")]).filter("key = 'q.svs'").count() == 2


def test_damaged_statuses_are_rows(spark, tmp_path):
    docs = {"r_20260101T000000Z_2": json.dumps({"slide_path": "a", "state": "completed", "started_at": "2026-01-01T00:00:00Z"}), "r2": "[1]", "r3": "{", "r4": "{}", "r5": '{"state": "odd"}'}
    for k, v in docs.items():
        (tmp_path / k).mkdir()
        (tmp_path / k / "x_status.json").write_text(v)
    got = {r.folder: r for r in records.statuses(spark, f"{tmp_path}/*/*_status.json").collect()}
    assert len(got) == 5 and [k for k, r in got.items() if r.read_error is None] == ["r_20260101T000000Z_2"] and got["r_20260101T000000Z_2"].suffix == 2


def test_tile_lists(spark, tmp_path):
    (tmp_path / "a.json").write_text('﻿{"plane_mpp": 0.5, "plane_dims": [64, 32], "tiles": [{"x": 0, "y": 0, "w": 8, "h": 8}]}')
    (tmp_path / "b.json").write_text('[{"x": 1, "y": 2, "w": 3, "h": 4, "col": 5}]')
    (tmp_path / "c.json").write_text('{"other": 1}')
    got = {r.path.rpartition("/")[2]: r for r in images.tile_lists(spark, str(tmp_path)).collect()}
    assert (got["a.json"].plane_w, got["a.json"].x) == (64, 0.0) and got["b.json"].col == 5 and got["c.json"].problem == "no list of tiles"


def test_verified_has_three_answers(spark):
    c = spark.createDataFrame([("a", bytearray(b"xy")), ("b", bytearray(b"xy")), ("c", bytearray(b"x"))], "path string, content binary")
    listing = spark.createDataFrame([("a", 2, "7b8b965ad4bca0e41ab51de7b31363a1"), ("b", 2, None), ("c", 2, None)], "path string, length int, md5 string")
    got = {r.path: r.verified for r in images.verified(c, listing).collect()}
    assert got["b"] is None and got["c"] is False and got["a"] is (__import__("hashlib").md5(b"xy").hexdigest() == "7b8b965ad4bca0e41ab51de7b31363a1")


def test_reports_have_no_odd_numbers(spark, tmp_path):
    rows = [("s", float("nan"), {"a": float("inf"), "b": 1.0}, [1.5, float("-inf"), None], (float("nan"), 2)), ("t", None, None, None, None)]
    made = spark.createDataFrame(rows, "slide string, x double, m map<string,double>, l array<double>, n struct<f:double,i:int>")
    sinks.write_reports(made, f"file://{tmp_path}/reports")
    got = {p.parent.name: json.loads(p.read_text()) for p in tmp_path.glob("reports/*/*.json")}
    assert got == {"slide=s": {"m": {"a": None, "b": 1.0}, "l": [1.5, None, None], "n": {"i": 2}}, "slide=t": {}}


def test_json_has_no_odd_numbers():
    assert sinks.canonical_json({"b": float("nan"), "a": [float("inf"), 1.5]}) == '{"a":[null,1.5],"b":null}'


@pytest.mark.parametrize("target", [0.4, 0.7, 1.0, 1.9])
def test_windows_fit_together_to_the_plane(target):
    a = gradient(150, 210)
    levels = [a, a[::2, ::2]]
    data = sinks.encode_tiff(levels, tile=64, mpp=0.5)
    found = images.tiff_levels(data)
    whole, plan = images.plane_at(data, 0.5, target)
    assert plan.level == (1 if target >= 0.95 else 0) and whole.shape[:2] == (plan.height, plan.width)
    assert plan.achieved == pytest.approx(target, rel=0.02)
    out = np.zeros_like(whole)
    for y in range(0, plan.height, 37):
        for x in range(0, plan.width, 41):
            part = images.window_at(data, found, plan, x, y, 41, 37)
            out[y : y + part.shape[0], x : x + part.shape[1]] = part
    assert np.abs(out.astype(int) - whole).max() <= 1
    banded, _ = images.plane_at(data, 0.5, target, band=16)
    assert np.abs(banded.astype(int) - whole).max() <= 1


def test_planes_of_files(spark, tmp_path):
    a = gradient(64, 64)
    (tmp_path / "a.tif").write_bytes(sinks.encode_tiff([a, a[::2, ::2]], 32, 0.5))
    (tmp_path / "b.tif").write_bytes(sinks.encode_tiff([a], 32))
    (tmp_path / "c.tif").write_bytes(b"II*")
    got = {r.path.rpartition("/")[2]: r for r in images.analysis_planes(spark, str(tmp_path), 1.0).collect()}
    assert (got["a.tif"].h, got["a.tif"].level) == (32, 1) and got["a.tif"].achieved_mpp == pytest.approx(1.0)
    assert got["b.tif"].error == "the scale is not known" and got["c.tif"].error_type is not None


def test_thumbnails_are_bounded():
    a = gradient(100, 200)
    data = sinks.encode_tiff([a, a[::2, ::2]], tile=32)
    assert images.thumbnail(data, 50).shape == (25, 50, 3) and images.thumbnail(data).shape == (50, 100, 3)
    with pytest.raises(images.ImageError):
        images.thumbnail(data, max_pixels=10)


def test_bound_of_pixels_is_that_of_the_configuration(spark, tmp_path):
    from tilewright.plans import config

    assert images.MAX_PIXELS == config.DEFAULTS["read"]["max_pixels"] == 67_108_864
    (tmp_path / "a.png").write_bytes(sinks.encode_png(np.zeros((8, 8, 3), np.uint8)))
    assert images.images(spark, str(tmp_path), "*.png", max_pixels=63).first().error_type == "ImageError"
    a = gradient(64, 64)
    (tmp_path / "a.tif").write_bytes(sinks.encode_tiff([a, a[::2, ::2]], 32, 0.5))
    found = [images.analysis_planes(spark, str(tmp_path), 1.0, max_pixels=n).first().error_type for n in (1023, 1024)]
    assert found == ["ImageError", None]
