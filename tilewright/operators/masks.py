"""Masks as sets of pixels, packed planes and their pyramids.

In relations a mask is the rows (plane, y, x) of its set pixels.  Dense planes are packed bits in
BINARY columns, most significant bit first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIXEL = ["plane", "y", "x"]


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(PIXEL).union(b.select(PIXEL)).distinct()


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(PIXEL).intersect(b.select(PIXEL))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pixels of a that are not in b."""
    return a.select(PIXEL).join(b.select(PIXEL).distinct(), PIXEL, "left_anti")


def combine(a: DataFrame, b: DataFrame, how: str = "union") -> DataFrame:
    if how not in ("union", "intersection"):
        raise ValueError(f"masks combine by union or intersection, not {how!r}")
    return union(a, b) if how == "union" else intersection(a, b)


def support(tissue: DataFrame, *excluded: DataFrame) -> DataFrame:
    """Tissue without folds, pen or other excluded pixels."""
    for other in excluded:
        tissue = difference(tissue, other)
    return tissue


def within(soft: DataFrame, hard: DataFrame, radius: int = 2) -> DataFrame:
    """Hysteresis: soft pixels with a hard one within a square of the radius.  The hard side is spread and
    the match is an equality semi-join."""
    steps = F.array(*[F.lit(d) for d in range(-radius, radius + 1)])
    near = hard.select("plane", "y", F.explode(steps).alias("dy"), "x").select("plane", (F.col("y") + F.col("dy")).alias("y"), "x", F.explode(steps).alias("dx"))
    near = near.select("plane", "y", (F.col("x") + F.col("dx")).alias("x")).distinct()
    return soft.join(near, PIXEL, "left_semi")


def dilate(mask: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Pixels reached from the mask by any of the (dy, dx) offsets; not clipped to a plane."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets])
    rows = mask.select("plane", "y", "x", F.explode(steps).alias("s"))
    return rows.select("plane", (F.col("y") + F.col("s.dy")).alias("y"), (F.col("x") + F.col("s.dx")).alias("x")).distinct()


def erode(mask: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Pixels of which all offsets are in the mask."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets])
    rows = mask.select("plane", "y", "x", F.explode(steps).alias("s"))
    hit = rows.select("plane", (F.col("y") - F.col("s.dy")).alias("y"), (F.col("x") - F.col("s.dx")).alias("x"))
    return hit.groupBy(PIXEL).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(offsets)).select(PIXEL)


def disk(radius: int) -> list[tuple[int, int]]:
    return [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]


def halved(mask: DataFrame) -> DataFrame:
    """Next level of a mask pyramid: every second pixel each way."""
    return mask.filter("y % 2 = 0 AND x % 2 = 0").select("plane", (F.col("y") / 2).cast("int").alias("y"), (F.col("x") / 2).cast("int").alias("x"))


def pyramid(mask: DataFrame, levels: int = 4) -> DataFrame:
    """(plane, level, y, x) of all levels.  A pixel is in every level whose stride divides it, so one pass
    over the mask makes them all."""
    rows = mask.select("plane", "y", "x", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    step = F.expr("shiftleft(1, level)")
    return rows.filter((F.col("y") % step == 0) & (F.col("x") % step == 0)).select("plane", "level", (F.col("y") / step).cast("int").alias("y"), (F.col("x") / step).cast("int").alias("x"))


def packed(mask: DataFrame) -> DataFrame:
    """(plane, y, byte_x, bits): rows of eight pixels as one number, first pixel highest.  Set pixels may
    come in any order and more than once."""
    bit = F.expr("shiftleft(1, 7 - x % 8)")
    return mask.groupBy("plane", "y", F.floor(F.col("x") / 8).cast("int").alias("byte_x")).agg(F.bit_or(bit).alias("bits"))


def unpacked(rows: DataFrame) -> DataFrame:
    each = rows.select("plane", "y", "byte_x", "bits", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k"))
    return each.filter(F.expr("shiftright(bits, 7 - k) & 1 = 1")).select("plane", "y", (F.col("byte_x") * 8 + F.col("k")).alias("x"))


def subtracted(target: DataFrame, other: DataFrame, tissue: DataFrame) -> DataFrame:
    """(plane, px, overlap_px, kept_px, tissue_px, fraction): target without other, as a share of the whole
    tissue (the denominator is not reduced)."""
    marks = [m.select(*PIXEL, F.lit(v).alias("k")) for m, v in ((target.distinct(), 1), (other.distinct(), 2), (tissue.distinct(), 4))]
    each = marks[0].union(marks[1]).union(marks[2]).groupBy(PIXEL).agg(F.bit_or("k").alias("k"))
    n: dict[str, Column] = {"px": F.expr("count_if(k & 1 = 1)"), "overlap_px": F.expr("count_if(k & 3 = 3)"), "kept_px": F.expr("count_if(k & 3 = 1)"), "tissue_px": F.expr("count_if(k & 4 = 4)")}
    found = each.groupBy("plane").agg(*[c.alias(name) for name, c in n.items()])
    return found.withColumn("fraction", F.try_divide(F.col("kept_px").cast("double"), F.col("tissue_px").cast("double")))
