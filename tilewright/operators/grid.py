"""Tile grids, footprints of tiles on masks, and the choice of pyramid levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.guards import fraction, is_finite

#: Side of a tile in pixels of the tile plane, and of a block of the footprint join in mask pixels.
TILE, BLOCK = 512, 64


def tile_grid(slides: DataFrame, tile: int = TILE, width: str = "w", height: str = "h") -> DataFrame:
    """slides, a row for each tile: col, row, x, y, tw, th.  Tiles do not overlap; those at the right and
    lower edge are clipped; a plane without pixels has none."""
    some = slides.filter((F.col(width) > 0) & (F.col(height) > 0))
    last = lambda c: F.ceil(F.col(c) / tile).cast("int") - 1
    rows = some.withColumn("row", F.explode(F.sequence(F.lit(0), last(height))))
    cells = rows.withColumn("col", F.explode(F.sequence(F.lit(0), last(width))))
    x, y = F.col("col") * tile, F.col("row") * tile
    return cells.withColumns({"x": x, "y": y, "tw": F.least(F.lit(tile), F.col(width) - x), "th": F.least(F.lit(tile), F.col(height) - y)})


def window_origin(start: Column, size: Column, extent: Column) -> Column:
    """Origin of a window that is moved inside an extent."""
    return F.greatest(F.lit(0), F.least(start, extent - size))


def footprint(x: Column, y: Column, w: Column, h: Column, sx: Column, sy: Column, mask_w: Column, mask_h: Column) -> dict[str, Column]:
    """The mask pixels mx0 <= x < mx1, my0 <= y < my1 that a tile covers, at least one each way."""
    mx0 = F.least(F.greatest(F.floor(x * sx), F.lit(0)), mask_w - 1).cast("int")
    my0 = F.least(F.greatest(F.floor(y * sy), F.lit(0)), mask_h - 1).cast("int")
    mx1 = F.greatest(F.least(F.ceil((x + w) * sx), mask_w), mx0 + 1).cast("int")
    my1 = F.greatest(F.least(F.ceil((y + h) * sy), mask_h), my0 + 1).cast("int")
    return {"mx0": mx0, "mx1": mx1, "my0": my0, "my1": my1}


def footprint_join(tiles: DataFrame, pixels: DataFrame, key: str = "slide", block: int = BLOCK, placed: bool = False) -> DataFrame:
    """Each tile (with mx0, mx1, my0, my1) with the pixels (key, mx, my) of its footprint.  The range join
    is an equality join on blocks of the mask: a tile is listed in each block that it touches.  Both sides are
    dealt out, and tiles are what is held: an estimate of rows that were exploded is far below their size, and by it
    either side might be sent to the driver whole.  placed: pixels have their blocks already, as long columns bx
    and by; if they are dealt out by key, bx and by they are not moved again."""
    spread = tiles.withColumn("bx", F.explode(F.sequence(F.floor(F.col("mx0") / block), F.floor((F.col("mx1") - 1) / block))))
    spread = spread.withColumn("by", F.explode(F.sequence(F.floor(F.col("my0") / block), F.floor((F.col("my1") - 1) / block))))
    if not placed:
        pixels = pixels.withColumns({"bx": F.floor(F.col("mx") / block), "by": F.floor(F.col("my") / block)})
    inside = (F.col("mx") >= F.col("mx0")) & (F.col("mx") < F.col("mx1")) & (F.col("my") >= F.col("my0")) & (F.col("my") < F.col("my1"))
    return spread.hint("shuffle_hash").join(pixels, [key, "bx", "by"]).filter(inside).drop("bx", "by")


def tile_overlap(tiles: DataFrame, mask: DataFrame, key: str = "slide", placed: bool = False) -> DataFrame:
    """(key, col, row, covered, area, overlap) of each tile with any mask pixel set; mask: (key, mx, my) of
    the pixels that are set, placed as in footprint_join."""
    area = (F.col("mx1") - F.col("mx0")) * (F.col("my1") - F.col("my0"))
    found = footprint_join(tiles.withColumn("area", area.cast("long")), mask, key, placed=placed).groupBy(key, "col", "row", "area").agg(F.count(F.lit(1)).alias("covered"))
    return found.select(key, "col", "row", "covered", "area", fraction(F.col("covered"), F.col("area")).alias("overlap"))


def two_pass_drop(tiles: DataFrame, drop_below: float | None, coarse: str = "coarse", refined: str = "refined", read_error: str = "read_error") -> DataFrame:
    """tiles with dropped_pass1, dropped_pass2 and kept.  Pass 1 looks at the coarse fraction before a tile
    is read, pass 2 at the refined one (the coarse one where none was made); equality survives; no limit
    drops nothing; a tile that could not be read is neither dropped in pass 2 nor kept."""
    failed = F.coalesce(F.col(read_error), F.lit(False))
    if drop_below is None:
        one = two = F.lit(False)
    else:
        one = F.coalesce(F.col(coarse) < drop_below, F.lit(False))
        two = ~one & ~failed & F.coalesce(F.coalesce(F.col(refined), F.col(coarse)) < drop_below, F.lit(False))
    # A tile that pass 1 drops is never read, so it cannot fail.
    return tiles.withColumns({"dropped_pass1": one, "dropped_pass2": two, "kept": ~one & ~two & ~failed})


def select_tiles(overlaps: DataFrame) -> DataFrame:
    """Tiles with any tissue: the comparison is on the unrounded overlap."""
    return overlaps.filter(F.col("overlap") > 0)


def level_mpps(mpp: Column, downsamples: Column) -> Column:
    """Microns per pixel of each pyramid level; null without a usable base value."""
    return F.when(is_finite(mpp) & (mpp > 0), F.transform(downsamples, lambda d: mpp * d))


def level_plan(slides: DataFrame, target: float, tolerance: float = 0.1) -> DataFrame:
    """slides (mpp, downsamples, levels as array of (w, h)) with level, ratio, plane_w, plane_h, achieved
    and direction: the coarsest level whose scale is at most target * (1 + tolerance), else the finest."""
    pairs = F.transform(level_mpps(F.col("mpp"), F.col("downsamples")), lambda m, l: F.struct(m.alias("m"), l.alias("l")))
    bound = F.filter(pairs, lambda p: p["m"] <= target * (1 + tolerance))
    found = slides.withColumn("__p", pairs).withColumn("__at", F.when(F.size(bound) > 0, F.array_max(bound)).otherwise(F.array_min(F.col("__p"))))
    size = F.element_at("levels", F.col("__at.l") + 1)
    found = found.withColumns({"level": F.col("__at.l"), "ratio": F.lit(float(target)) / F.col("__at.m"), "__w": size["w"], "__h": size["h"]})
    found = found.withColumns({"plane_w": F.greatest(F.lit(1), F.rint(F.col("__w") / F.col("ratio")).cast("int")), "plane_h": F.greatest(F.lit(1), F.rint(F.col("__h") / F.col("ratio")).cast("int"))})
    direction = F.when(F.abs(F.col("ratio") - 1) < 1e-9, "native").when(F.col("ratio") > 1, "down").otherwise("up")
    return found.withColumns({"achieved": F.col("__w") * F.col("__at.m") / F.col("plane_w"), "direction": direction}).drop("__p", "__at", "__w", "__h")


def outliers(tiles: DataFrame, n: int, key: str = "slide", order: list[str] | None = None) -> DataFrame:
    """(key, kind, rank, ...) tiles worth a look: unreadable and unrefined ones all, of those dropped in
    either pass the first n, of the kept ones the n of least focus."""
    order = order or ["ord"]
    branches = [
        (0, "read_error", F.col("read_error"), order, None),
        (1, "reseg_error", F.col("reseg_error"), order, None),
        (2, "dropped_pass1", F.col("dropped_pass1"), order, n),
        (3, "dropped_pass2", F.col("dropped_pass2"), order, n),
        (4, "low_focus", F.col("kept") & F.col("focus").isNotNull(), ["focus", *order], n),
    ]
    kinds = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(g).alias("g"), F.lit(name).alias("kind"))) for g, name, c, _, _ in branches]))
    # A row for each kind that a tile is of.  Kinds without a limit are ranked apart, so that of the others all
    # but the first n are dropped before the shuffle.
    rows = tiles.withColumn("__k", F.explode(kinds)).withColumns({"group_ord": F.col("__k.g"), "kind": F.col("__k.kind")}).drop("__k")
    focus = F.when(F.col("group_ord") == 4, F.col("focus"))
    rank = F.row_number().over(Window.partitionBy(key, "group_ord").orderBy(focus, *order))
    whole = rows.filter("group_ord < 2").withColumn("rank", rank)
    return whole.unionByName(rows.filter("group_ord >= 2").withColumn("rank", rank).filter(F.col("rank") <= n))
