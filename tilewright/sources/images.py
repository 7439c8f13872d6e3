"""Images and masks from bytes: PNG, uncompressed or deflated TIFF (with pyramid levels), NPY.

Decoders are plain NumPy and zlib, so executors need no imaging library; a file that cannot be read
becomes a row with its error."""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tilewright.operators.kernels import resized, resized_nearest
from tilewright.shipping import ship

#: Pixels of an image that are decoded at most; how far a mask's shape may be off.
MAX_PIXELS, ASPECT = 64 * 1024 * 1024, 0.01


class ImageError(ValueError):
    pass


def png_size(data: bytes) -> tuple[int, int, int, int]:
    """(width, height, bit depth, colour type)"""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ImageError("not a PNG")
    return struct.unpack(">IIBB", data[16:26])


def decode_png(data: bytes, max_pixels: int = MAX_PIXELS) -> np.ndarray:
    """(h, w) or (h, w, channels) 8-bit samples; one-bit images as 0 and 255; palettes resolved."""
    w, h, depth, kind = png_size(data)
    if w * h > max_pixels:
        raise ImageError(f"{w * h} pixels are more than {max_pixels}")
    if depth == 16:
        raise ImageError("16-bit samples")
    if data[28]:
        raise ImageError("interlaced")
    at, parts, palette = 8, [], None
    while at < len(data):
        n, name = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if name == b"IDAT":
            parts.append(body)
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        at += n + 12
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    stride, step = (w * channels * depth + 7) // 8, max(1, channels * depth // 8)
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(h, stride + 1)
    out = np.zeros((h, stride), np.uint8)
    above = np.zeros(stride, np.int64)
    for y in range(h):
        above = _unfiltered(int(raw[y, 0]), raw[y, 1:].astype(np.int64), above, step)
        out[y] = above
    if depth < 8:
        bits = np.unpackbits(out, axis=1).reshape(h, -1, depth)
        values = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(2)[:, :w]
        return palette[values] if palette is not None and kind == 3 else (values * (255 // ((1 << depth) - 1))).astype(np.uint8)
    out = out.reshape(h, w, channels) if channels > 1 else out
    return palette[out] if kind == 3 else out


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return row
    if kind == 1:  # each sample adds the one before: a running sum
        return row.reshape(-1, step).cumsum(0).ravel() % 256 if len(row) % step == 0 else row
    if kind == 2:
        return (row + above) % 256
    out = np.zeros(len(row) + step, np.int64)
    up = np.concatenate([np.zeros(step, np.int64), above])
    for i in range(len(row)):
        a, b, c = int(out[i]), int(up[i + step]), int(up[i])
        if kind == 3:
            guess = (a + b) // 2
        else:
            p = a + b - c
            pa, pb, pc = abs(p - a), abs(p - b), abs(p - c)
            guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
        out[i + step] = (row[i] + guess) % 256
    return out[step:]


def decode_npy(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


@dataclass
class TiffLevel:
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    tile: tuple[int, int] | None
    rows_per_strip: int
    offsets: list[int] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    resolution: tuple[float, float] | None = None
    unit: int = 2
    description: str = ""


_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 16: "Q"}


def tiff_levels(data: bytes) -> list[TiffLevel]:
    """The levels of a classic TIFF, in file order."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack(order + "H", data[2:4])[0] != 42:
        raise ImageError("not a TIFF")
    at, out = struct.unpack(order + "I", data[4:8])[0], []
    while at:
        n = struct.unpack(order + "H", data[at : at + 2])[0]
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack(order + "HHI", data[at + 2 + 12 * k : at + 10 + 12 * k])
            if kind not in _TYPES:
                continue
            fmt = _TYPES[kind]
            size = struct.calcsize("<" + fmt) * count
            body = data[at + 10 + 12 * k : at + 14 + 12 * k]
            if size > 4:
                where = struct.unpack(order + "I", body)[0]
                body = data[where : where + size]
            tags[tag] = body[:count].rstrip(b"\0").decode("latin-1") if kind == 2 else struct.unpack(order + fmt * count, body[:size])
        one = lambda t, d: tags.get(t, (d,))[0]
        ratio = lambda t: tags[t][0] / tags[t][1] if t in tags and tags[t][1] else None
        tile = (one(322, 0), one(323, 0)) if 322 in tags else None
        x, y = ratio(282), ratio(283)
        out.append(TiffLevel(one(256, 0), one(257, 0), one(277, 1), one(258, 1), one(259, 1), tile, one(278, one(257, 0)), list(tags.get(324, tags.get(273, ()))), list(tags.get(325, tags.get(279, ()))), (x, y) if x and y else None, one(296, 2), tags.get(270, "")))
        at = struct.unpack(order + "I", data[at + 2 + 12 * n : at + 6 + 12 * n])[0]
    return out


def read_level(data: bytes, level: TiffLevel, x: int = 0, y: int = 0, w: int | None = None, h: int | None = None) -> np.ndarray:
    """A window of a level; only the tiles or strips that it touches are decoded."""
    w, h = w if w is not None else level.width - x, h if h is not None else level.height - y
    if x < 0 or y < 0 or x + w > level.width or y + h > level.height or w < 1 or h < 1:
        raise ImageError("window outside the level")
    if level.compression not in (1, 8, 32946):
        raise ImageError(f"compression {level.compression} is not supported")
    tw, th = level.tile or (level.width, level.rows_per_strip)
    across = -(-level.width // tw)
    out = np.zeros((h, w, level.samples), np.uint8)
    for r in range(y // th, (y + h - 1) // th + 1):
        for c in range(x // tw, (x + w - 1) // tw + 1):
            k = r * across + c
            body = data[level.offsets[k] : level.offsets[k] + level.counts[k]]
            if level.compression != 1:
                body = zlib.decompress(body)
            rows = th if level.tile else min(th, level.height - r * th)
            if level.bits == 1:
                stride = (tw + 7) // 8
                block = (np.unpackbits(np.frombuffer(body, np.uint8, rows * stride).reshape(rows, stride), axis=1)[:, :tw] * 255)[..., None]
            elif level.bits == 8:
                block = np.frombuffer(body, np.uint8, rows * tw * level.samples).reshape(rows, tw, level.samples)
            else:
                raise ImageError(f"{level.bits}-bit samples")
            y0, x0 = max(y, r * th), max(x, c * tw)
            y1, x1 = min(y + h, r * th + rows), min(x + w, (c + 1) * tw)
            out[y0 - y : y1 - y, x0 - x : x1 - x] = block[y0 - r * th : y1 - r * th, x0 - c * tw : x1 - c * tw]
    return out[..., 0] if level.samples == 1 else out


@dataclass
class ScalePlan:
    """The level that a plane at some scale is read from, and the plane's size."""

    level: int
    ratio: float
    width: int
    height: int
    achieved: float


def scale_plan(levels: list[TiffLevel], mpp: float, target: float, tolerance: float = 0.1) -> ScalePlan:
    """The coarsest level that is at least as fine as the target (within the tolerance), else the finest."""
    scales = [mpp * levels[0].width / v.width for v in levels]
    fit = [(s, k) for k, s in enumerate(scales) if s <= target * (1 + tolerance)]
    scale, k = max(fit) if fit else min((s, k) for k, s in enumerate(scales))
    ratio = target / scale
    w, h = (max(1, round(v / ratio)) for v in (levels[k].width, levels[k].height))
    return ScalePlan(k, ratio, w, h, levels[k].width * scale / w)


def window_at(data: bytes, levels: list[TiffLevel], plan: ScalePlan, x: int, y: int, w: int, h: int) -> np.ndarray:
    """A window of the plane, from the stretch of the level that it stands for and one pixel more each way, so that
    windows fit together as if the plane had been read at once."""
    if x < 0 or y < 0 or x >= plan.width or y >= plan.height:
        raise ImageError("window outside the plane")
    w, h = min(w, plan.width - x), min(h, plan.height - y)
    level = levels[plan.level]
    sx, sy = level.width / plan.width, level.height / plan.height
    x0, x1, y0, y1 = x * sx, (x + w) * sx, y * sy, (y + h) * sy
    left, top = max(0, int(x0) - 1), max(0, int(y0) - 1)
    right, bottom = min(level.width, int(np.ceil(x1)) + 1), min(level.height, int(np.ceil(y1)) + 1)
    part = read_level(data, level, left, top, right - left, bottom - top)
    return resized(part, h, w, (y0 - top, y1 - top, x0 - left, x1 - left))


def plane_at(data: bytes, mpp: float | None, target: float, max_pixels: int = MAX_PIXELS, band: int = 512) -> tuple[np.ndarray, ScalePlan]:
    """The whole plane at a scale, read in bands."""
    levels = tiff_levels(data)
    if mpp is None or not np.isfinite(mpp) or mpp <= 0:
        raise ImageError("the scale is not known")
    plan = scale_plan(levels, mpp, target)
    if plan.width * plan.height > max_pixels:
        raise ImageError(f"a plane of {plan.width} x {plan.height} is over {max_pixels} pixels")
    rows = [as_rgb(window_at(data, levels, plan, 0, y, plan.width, band)) for y in range(0, plan.height, band)]
    return np.concatenate(rows), plan


def thumbnail(data: bytes, edge: int = 1024, max_pixels: int = MAX_PIXELS) -> np.ndarray:
    """The smallest level, no larger than an edge; refused if that level itself is too large to read."""
    level = min(tiff_levels(data), key=lambda v: v.width * v.height)
    if level.width * level.height > max_pixels:
        raise ImageError(f"the smallest level has {level.width * level.height} pixels")
    a, scale = as_rgb(read_level(data, level)), min(1.0, edge / max(level.width, level.height))
    return a if scale == 1 else resized(a, max(1, round(a.shape[0] * scale)), max(1, round(a.shape[1] * scale)))


def analysis_planes(spark: SparkSession, path: str, target: float, pattern: str = "*.tif*", max_pixels: int = MAX_PIXELS) -> DataFrame:
    """(path, h, w, data, level, achieved_mpp, error_type, error): each pyramid's plane at a scale; the scale of a
    file is that of its resolution tags."""
    ship(spark)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "h", "w", "data", "level", "achieved_mpp", "error_type", "error"]
        for f in frames:
            out = []
            for p, content in zip(f["path"], f["content"]):
                try:
                    top = tiff_levels(content)[0]
                    mpp = {2: 25400.0, 3: 10000.0}.get(top.unit, 25400.0) / top.resolution[0] if top.resolution else None
                    a, plan = plane_at(content, mpp, target, max_pixels)
                    out.append((p, a.shape[0], a.shape[1], a.tobytes(), plan.level, plan.achieved, None, None))
                except Exception as e:
                    out.append((p, None, None, None, None, None, type(e).__name__, str(e)[:300]))
            yield pd.DataFrame(out, columns=names).astype({"h": "Int32", "w": "Int32", "level": "Int32"})

    return files(spark, path, pattern).select("path", "content").mapInPandas(run, "path string, h int, w int, data binary, level int, achieved_mpp double, error_type string, error string")


def decode(data: bytes, max_pixels: int = MAX_PIXELS) -> np.ndarray:
    if data[:4] == b"\x89PNG":
        return decode_png(data, max_pixels)
    if data[:6] == b"\x93NUMPY":
        return decode_npy(data)
    level = tiff_levels(data)[0]
    if level.width * level.height > max_pixels:
        raise ImageError(f"{level.width * level.height} pixels are more than {max_pixels}")
    return read_level(data, level)


def as_rgb(a: np.ndarray) -> np.ndarray:
    """8-bit RGB: gray is repeated, alpha goes; other samples are refused."""
    if a.dtype == bool:
        a = a.astype(np.uint8) * 255
    if a.dtype != np.uint8 or a.ndim not in (2, 3) or a.size == 0:
        raise ImageError("not a nonempty 8-bit image")
    if a.ndim == 2:
        a = a[..., None]
    if a.shape[2] in (1, 2):
        return np.repeat(a[..., :1], 3, axis=2)
    if a.shape[2] in (3, 4):
        return a[..., :3]
    raise ImageError(f"{a.shape[2]} channels")


def as_mask(a: np.ndarray, shape: tuple[int, int] | None = None, allow_empty: bool = False) -> np.ndarray:
    """Nonzero pixels; brought to a shape of the same aspect (within one per cent), else refused."""
    if a.ndim == 3:
        a = a[..., :3].any(-1) if a.shape[2] >= 3 else a[..., 0]
    mask = a > 0
    if not allow_empty and not mask.any():
        raise ImageError("the mask is empty")
    if shape and mask.shape != shape:
        if abs((mask.shape[1] / mask.shape[0]) / (shape[1] / shape[0]) - 1) > ASPECT:
            raise ImageError("the mask has another aspect")
        mask = resized_nearest(mask, *shape)
    return mask


def files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, content) of files that Spark can reach."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)


def images(spark: SparkSession, path: str, pattern: str = "*", max_pixels: int = MAX_PIXELS) -> DataFrame:
    """(path, h, w, data, error_type, error): decoded RGB of each file; data is row-major."""
    ship(spark)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for p, content in zip(f["path"], f["content"]):
                try:
                    a = as_rgb(decode(content, max_pixels))
                    out.append((p, a.shape[0], a.shape[1], a.tobytes(), None, None))
                except Exception as e:
                    out.append((p, None, None, None, type(e).__name__, str(e)[:300]))
            yield pd.DataFrame(out, columns=["path", "h", "w", "data", "error_type", "error"]).astype({"h": "Int32", "w": "Int32"})

    return files(spark, path, pattern).select("path", "content").mapInPandas(run, "path string, h int, w int, data binary, error_type string, error string")


def headers(spark: SparkSession, path: str, pattern: str = "*.tif*") -> DataFrame:
    """(path, width, height, levels, downsamples, mpp_x, mpp_y, error): pyramids without their pixels."""
    ship(spark)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for p, content in zip(f["path"], f["content"]):
                row = {"path": p, "width": None, "height": None, "levels": None, "downsamples": None, "mpp_x": None, "mpp_y": None, "error": None}
                try:
                    levels = tiff_levels(content)
                    top = levels[0]
                    row |= {"width": top.width, "height": top.height, "levels": [{"w": v.width, "h": v.height} for v in levels], "downsamples": [top.width / v.width for v in levels]}
                    if top.resolution:  # pixels per inch or centimetre
                        per = {2: 25400.0, 3: 10000.0}.get(top.unit, 25400.0)
                        row |= {"mpp_x": per / top.resolution[0], "mpp_y": per / top.resolution[1]}
                except Exception as e:
                    row["error"] = f"{type(e).__name__}: {e}"[:300]
                out.append(row)
            yield pd.DataFrame(out, columns=list(row)).astype({"width": "Int32", "height": "Int32"})

    return files(spark, path, pattern).select("path", "content").mapInPandas(run, "path string, width int, height int, levels array<struct<w: int, h: int>>, downsamples array<double>, mpp_x double, mpp_y double, error string")


class _Band(InputPartition):
    def __init__(self, y: int, h: int):
        super().__init__((y, h))
        self.y, self.h = y, h


class TiledImageSource(DataSource):
    """spark.read.format("tiled_image").option("path", file).option("level", 0).option("tile", 512).load(): the tiles of
    one level of a TIFF pyramid, a partition for each row of tiles."""

    @classmethod
    def name(cls) -> str:
        return "tiled_image"

    def schema(self) -> str:
        return "path string, level int, col int, row int, x int, y int, w int, h int, data binary, error string"

    def reader(self, schema) -> DataSourceReader:
        return _TiledReader(self.options)


class _TiledReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.level, self.tile = options["path"].removeprefix("file://"), int(options.get("level", 0)), int(options.get("tile", 512))

    def _open(self):
        with open(self.path, "rb") as f:
            data = f.read()
        return data, tiff_levels(data)[self.level]

    def partitions(self):
        _, level = self._open()
        return [_Band(y, min(self.tile, level.height - y)) for y in range(0, level.height, self.tile)]

    def read(self, partition):
        data, level = self._open()
        for col, x in enumerate(range(0, level.width, self.tile)):
            w = min(self.tile, level.width - x)
            try:
                pixels, error = as_rgb(read_level(data, level, x, partition.y, w, partition.h)).tobytes(), None
            except Exception as e:  # this tile alone has failed
                pixels, error = None, f"{type(e).__name__}: {e}"[:300]
            yield (self.path, self.level, col, partition.y // self.tile, x, partition.y, w, partition.h, pixels, error)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(TiledImageSource)


def tile_lists(spark: SparkSession, path: str) -> DataFrame:
    """(path, plane_mpp, plane_w, plane_h, ord, x, y, w, h, col, row) from JSON documents with a list of tiles, or
    a bare list; a document that is neither has `problem`."""
    schema = "plane_mpp double, plane_dims array<int>, tiles array<struct<x: double, y: double, w: double, h: double, col: int, row: int>>"
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.trim(F.regexp_replace("value", "^﻿", "")).alias("v"))
    doc = F.from_json(F.when(F.startswith("v", F.lit("[")), F.concat(F.lit('{"tiles":'), "v", F.lit("}"))).otherwise(F.col("v")), schema)
    rows = raw.withColumn("d", doc).select("path", "d.plane_mpp", F.try_element_at("d.plane_dims", F.lit(1)).alias("plane_w"), F.try_element_at("d.plane_dims", F.lit(2)).alias("plane_h"), F.when(F.col("d.tiles").isNull(), "no list of tiles").alias("problem"), F.posexplode_outer("d.tiles").alias("ord", "t"))
    return rows.select("path", "plane_mpp", "plane_w", "plane_h", "problem", "ord", "t.*")


def verified(copies: DataFrame, listing: DataFrame) -> DataFrame:
    """(path, length, md5) of copies against the provider's listing (path, length, md5 or null): verified is null where
    there is no checksum to compare."""
    both = copies.select("path", F.length("content").alias("got_length"), F.md5("content").alias("got_md5")).join(listing, "path", "left")
    size, sum_ = F.col("got_length") == F.col("length"), F.when(F.col("md5").isNotNull(), F.col("got_md5") == F.lower("md5"))
    return both.withColumn("verified", F.when(~size, F.lit(False)).otherwise(sum_))


def json_document(data: bytes) -> dict:
    return json.loads(data.decode("utf-8-sig"))
