"""Artifact classes of tiles, from class maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.guards import fraction
from tilewright.operators.grid import footprint_join
from tilewright.operators.metadata import last_wins

#: The class map's numbers.
CLASSES = {"tissue": 1, "fold": 2, "darkspot": 3, "pen": 4, "bubble": 5, "out_of_focus": 6, "background": 7}
ARTIFACTS = ("fold", "darkspot", "pen", "bubble", "out_of_focus")


def class_id(name: str | int) -> int:
    """A class by name or number."""
    if name in CLASSES:
        return CLASSES[name]
    if isinstance(name, int) and not isinstance(name, bool) and name in CLASSES.values():
        return name
    raise ValueError(f"{name!r} is no class; there are {', '.join(CLASSES)}")


def class_fractions(tiles: DataFrame, class_map: DataFrame, classes: tuple[str, ...] = ARTIFACTS, key: str = "slide", digits: int = 4, placed: bool = False) -> DataFrame:
    """(key, col, row, area, fractions..., background_fraction): shares of a tile's footprint in each class,
    rounded; class_map: (key, mx, my, cls), placed as in footprint_join."""
    area = ((F.col("mx1") - F.col("mx0")) * (F.col("my1") - F.col("my0"))).cast("long")
    hits = footprint_join(tiles.withColumn("area", area), class_map, key, placed=placed)
    counts = [F.round(fraction(F.count_if(F.col("cls") == class_id(c)), F.first("area")), digits).alias(f"{c}_fraction") for c in (*classes, "background")]
    return hits.groupBy(key, "col", "row").agg(F.first("area").alias("area"), *counts)


def labelled(tiles: DataFrame, classes: tuple[str, ...] = ARTIFACTS, least: float | None = 0.25) -> DataFrame:
    """tiles with has_artifact and artifact_label: the class of the largest fraction among those that reach
    the limit, the first in class order on ties; without a limit there is no verdict."""
    if least is None:
        return tiles.withColumns({"has_artifact": F.lit(None).cast("boolean"), "artifact_label": F.lit(None).cast("string")})
    shares = F.array(*[F.struct((-F.col(f"{c}_fraction")).alias("f"), F.lit(k).alias("k"), F.lit(c).alias("c")) for k, c in enumerate(classes)])
    reach = F.filter(shares, lambda s: -s["f"] >= least)
    return tiles.withColumns({"has_artifact": F.size(reach) > 0, "artifact_label": F.when(F.size(reach) > 0, F.array_min(reach)["c"])})


def merged(tiles: DataFrame, artifacts: DataFrame, order: str = "ord", key: str = "slide") -> DataFrame:
    """tiles with the artifact columns of the same (key, col, row); missing places are equal to each other,
    of several artifact rows the last counts, tiles without one have nulls."""
    place = [key, "col", "row"]
    right = last_wins(artifacts, place, [order]).drop(order)
    named = right.select(*[F.col(c).alias(f"__{c}") if c in place else F.col(c) for c in right.columns])
    on = tiles[key].eqNullSafe(named[f"__{key}"]) & tiles["col"].eqNullSafe(named["__col"]) & tiles["row"].eqNullSafe(named["__row"])
    return tiles.join(named, on, "left").drop(*[f"__{c}" for c in place])


def polygons(class_map, cls: str | int, model_mpp: float, plane_mpp: float) -> list[list[list[float]]]:
    """Closed rings around the regions of a class (a NumPy map), in pixels of the tile plane."""
    from tilewright.operators.kernels import outlines

    scale = model_mpp / plane_mpp
    return [[[x * scale, y * scale] for x, y in ring] for ring in outlines(class_map == class_id(cls))]


def finest_model(available: list[float], wanted: float | None = None) -> float | None:
    """The scale of the model to use: the wanted one if it is there, else the finest; none without any."""
    return wanted if wanted in available else min(available, default=None)


def fits_plane(class_shape: tuple[int, int], plane: tuple[int, int], model_mpp: float, plane_mpp: float, most: float = 0.02) -> bool:
    """Whether a class map (h, w) can belong to a plane (w, h): sides within two per cent."""
    scale = model_mpp / plane_mpp
    return all(abs(c * scale / p - 1) <= most for c, p in ((class_shape[1], plane[0]), (class_shape[0], plane[1])))


def region_stats(labels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, area, y0, x0, y1, x1) of each region; labels: (keys, y, x, label)."""
    return labels.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("area"), F.min("y").alias("y0"), F.min("x").alias("x0"), (F.max("y") + 1).alias("y1"), (F.max("x") + 1).alias("x1"))


def largest_region(regions: DataFrame, keys: list[str]) -> DataFrame:
    """The region of the greatest area of each key, the smallest label on ties."""
    best = Window.partitionBy(*keys).orderBy(F.col("area").desc(), "label")
    return regions.withColumn("__r", F.row_number().over(best)).filter("__r = 1").drop("__r")
