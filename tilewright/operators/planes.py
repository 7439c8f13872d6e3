"""Dense planes in Spark: packing pixels into rows, and kernels on one plane a row.

A plane row is (plane, h, w, data BINARY).  A kernel that fails gives a row with the error and null
measurements and never takes its neighbours with it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators import kernels
from tilewright.shipping import ship


def packed_planes(pixels: DataFrame, h: int, w: int, channels: list[str], key: str = "plane") -> DataFrame:
    """(plane, h, w, data): the channels of all pixels in row-major order; missing pixels are 0.

    The pixels of one plane meet in one row, which bounds planes by their own size and not by the
    table's."""
    at = (F.col("y") * w + F.col("x")).cast("int")
    each = pixels.select(key, F.struct(at.alias("at"), *[F.col(c).cast("int").alias(c) for c in channels]).alias("p"))
    lists = each.groupBy(key).agg(F.array_sort(F.collect_list("p")).alias("p"))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            data = []
            for pixels_ in f["p"]:
                a = np.zeros((h * w, len(channels)), np.uint8)
                if len(pixels_):
                    rows = np.array([[p["at"], *[p[c] for c in channels]] for p in pixels_])
                    a[rows[:, 0]] = rows[:, 1:]
                data.append(a.tobytes())
            yield pd.DataFrame({key: f[key], "h": h, "w": w, "data": data})

    ship(pixels.sparkSession)
    return lists.mapInPandas(pack, f"{key} {dict(pixels.dtypes)[key]}, h int, w int, data binary")


def labelled_pixels(mask: DataFrame, h: int, w: int, eight: bool = True, key: str = "plane") -> DataFrame:
    """(plane, y, x, label) of a mask's pixels: label is the smallest y * w + x of their region."""
    planes = packed_planes(mask.withColumn("v", F.lit(1)), h, w, ["v"], key)

    def regions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k, data in zip(f[key], f["data"]):
                labels = kernels.label(np.frombuffer(data, np.uint8).reshape(h, w) > 0, eight)
                y, x = np.nonzero(labels)
                yield pd.DataFrame({key: k, "y": y.astype(np.int32), "x": x.astype(np.int32), "label": (labels[y, x] - 1).astype(np.int32)})

    return planes.mapInPandas(regions, f"{key} {dict(mask.dtypes)[key]}, y int, x int, label int")


def per_plane(planes: DataFrame, kernel: Callable[[np.ndarray, pd.Series], dict], schema: str, key: str = "plane", channels: int = 3, extra: list[str] | None = None) -> DataFrame:
    """(plane, schema..., error_type, error): kernel(image, row) of each plane; image is (h, w, channels), or
    (h, w) for one channel."""
    names = [p.strip().split()[0] for p in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for _, row in f.iterrows():
                made = dict.fromkeys(names) | {key: row[key], "error_type": None, "error": None}
                try:
                    a = np.frombuffer(row["data"], np.uint8).reshape(int(row["h"]), int(row["w"]), channels)
                    made |= kernel(a[..., 0] if channels == 1 else a, row)
                except Exception as e:  # an error is a value of this plane
                    made |= {"error_type": type(e).__name__, "error": str(e)[:500]}
                out.append(made)
            yield pd.DataFrame(out, columns=[key, *names, "error_type", "error"])

    ship(planes.sparkSession)
    used = planes.select(key, "h", "w", "data", *(extra or []))
    return used.mapInPandas(run, f"{key} {dict(planes.dtypes)[key]}, {schema}, error_type string, error string")
