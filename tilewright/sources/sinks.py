"""Encoders and writers: PNG, tiled one-bit TIFF pyramids, JSON reports, summaries."""

from __future__ import annotations

import json
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from tilewright.functions.guards import is_finite
from tilewright.shipping import ship


def encode_png(a: np.ndarray) -> bytes:
    """A boolean mask as a one-bit PNG, 8-bit gray or RGB as such."""
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    h, w = a.shape[:2]
    rows = np.packbits(a, axis=1) if a.dtype == bool else a.reshape(h, -1)
    depth, kind = (1, 0) if a.dtype == bool else (8, 0 if a.ndim == 2 else 2)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rows], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def encode_tiff(levels: list[np.ndarray], tile: int = 512, mpp: float | None = None) -> bytes:
    """A tiled, deflated TIFF with a page for each level: booleans as one bit, else 8-bit gray or RGB."""
    out, pages = bytearray(b"II*\0\0\0\0\0"), []
    for a in levels:
        bits, samples = (1, 1) if a.dtype == bool else (8, 1 if a.ndim == 2 else 3)
        offsets, counts = [], []
        for y in range(0, a.shape[0], tile):
            for x in range(0, a.shape[1], tile):
                block = np.zeros((tile, tile, *a.shape[2:]), a.dtype)
                part = a[y : y + tile, x : x + tile]
                block[: part.shape[0], : part.shape[1]] = part
                body = zlib.compress((np.packbits(block, axis=1) if bits == 1 else block).tobytes())
                offsets.append(len(out))
                counts.append(len(body))
                out += body + b"\0" * (len(body) % 2)
        tags = {256: (4, [a.shape[1]]), 257: (4, [a.shape[0]]), 258: (3, [bits]), 259: (3, [8]), 262: (3, [2 if samples == 3 else 1]), 277: (3, [samples]), 322: (3, [tile]), 323: (3, [tile]), 324: (4, offsets), 325: (4, counts)}
        if mpp:
            per = round(10000 / (mpp * levels[0].shape[1] / a.shape[1]) * 1000)
            tags |= {282: (5, [per, 1000]), 283: (5, [per, 1000]), 296: (3, [3])}
        pages.append(dict(sorted(tags.items())))
    link = 4
    for tags in pages:
        entries = []
        for tag, (kind, values) in tags.items():
            body = struct.pack("<" + {3: "H", 4: "I", 5: "I"}[kind] * len(values), *values)
            count = len(values) // (2 if kind == 5 else 1)
            if len(body) > 4:
                where = len(out)
                out += body + b"\0" * (len(body) % 2)
                body = struct.pack("<I", where)
            entries.append(struct.pack("<HHI", tag, kind, count) + body.ljust(4, b"\0"))
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def mask_pyramid(mask: np.ndarray, levels: int = 4) -> list[np.ndarray]:
    return [mask[:: 1 << k, :: 1 << k] for k in range(levels)]


def mask_files(tiles: DataFrame, key: str = "slide", max_bytes: int = 512 << 20) -> DataFrame:
    """(slide, tiff, pixels_set, error): each slide's tile masks (x, y, w, h, bits, plane_w, plane_h) together in one pyramid.
    Supports may overlap and come in any order: bits are joined by OR.  A plane over the byte budget is an
    error of its slide."""
    ship(tiles.sparkSession)

    def build(f: pd.DataFrame) -> pd.DataFrame:
        pw, ph = int(f["plane_w"].iloc[0]), int(f["plane_h"].iloc[0])
        row = {key: f[key].iloc[0], "tiff": None, "pixels_set": None, "error": None}
        if pw * ph // 8 > max_bytes:
            row["error"] = f"a plane of {pw} x {ph} is over the budget of {max_bytes} bytes"
        else:
            plane = np.zeros((ph, pw), bool)
            for x, y, w, h, bits in zip(f["x"], f["y"], f["w"], f["h"], f["bits"]):
                part = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(w * h)).reshape(int(h), int(w)).astype(bool)
                plane[y : y + h, x : x + w] |= part[: ph - y, : pw - x]
            row |= {"tiff": encode_tiff(mask_pyramid(plane)), "pixels_set": int(plane.sum())}
        return pd.DataFrame([row])

    kind = dict(tiles.dtypes)[key]
    return tiles.select(key, "x", "y", "w", "h", "bits", "plane_w", "plane_h").groupBy(key).applyInPandas(build, f"{key} {kind}, tiff binary, pixels_set long, error string")


def write_files(rows: DataFrame, folder: str, name: str, content: str) -> DataFrame:
    """Writes each row's bytes as folder/name through a temporary sibling, on the executors; (path, bytes, error) of
    each.  The folder must be one that all executors share."""
    ship(rows.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import uuid

        for f in frames:
            out = []
            for n, c in zip(f["n"], f["c"]):
                path = os.path.join(folder, n)
                try:
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    part = f"{path}.{uuid.uuid4().hex}.part"
                    with open(part, "wb") as file:
                        file.write(c)
                    os.replace(part, path)
                    out.append((path, len(c), None))
                except OSError as e:
                    out.append((path, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "bytes", "error"]).astype({"bytes": "Int64"})

    return rows.select(F.col(name).alias("n"), F.col(content).alias("c")).mapInPandas(run, "path string, bytes long, error string")


def json_safe(value):
    """NaN and infinities as null, at any depth."""
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, dict):
        return {str(k): json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [json_safe(v) for v in value]
    return value


def canonical_json(value) -> str:
    return json.dumps(json_safe(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _finite(column: Column, kind: DataType) -> Column:
    """column with its NaN and infinite numbers as null, inside structs, arrays and map values too."""
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when(is_finite(column), column)
    if isinstance(kind, StructType):
        fields = F.struct(*[_finite(column.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(column.isNotNull(), fields)
    if isinstance(kind, ArrayType):
        return F.transform(column, lambda x: _finite(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(column, lambda _, x: _finite(x, kind.valueType))
    return column


def write_reports(reports: DataFrame, path: str, key: str = "slide") -> None:
    """A JSON document a row, in a folder for each slide; NaN and infinities become null at any depth."""
    safe = [_finite(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in reports.schema]
    reports.select(*safe).write.mode("append").partitionBy(key).json(path)


def write_summary(rows: DataFrame, path: str) -> None:
    """A batch's summary (a row for each slide of the batch) as one CSV and one JSON file."""
    one = rows.coalesce(1)
    one.write.mode("overwrite").option("header", True).csv(f"{path}/summary_csv")
    one.write.mode("overwrite").json(f"{path}/summary_json")
