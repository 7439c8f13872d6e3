"""Acceptance of slides: magnification, scale, integrity, quarantine and the gates of later stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions.guards import finite_or_null, is_finite

#: Least objective power, target scale with tolerance (absolute), plausible scales, plausible
#: products of scale and power, and the power at which a pixel is one micron.
LEAST_POWER, TARGET_MPP, MPP_TOLERANCE = 20.0, 0.5, 0.05
PLAUSIBLE, PRODUCT, UNIT_POWER = (0.1, 10.0), (5.0, 15.0), 10.0


def magnification(power: Column, least: float = LEAST_POWER) -> Column:
    """Whether the objective power suffices; null where it is not known."""
    p = finite_or_null(power)
    return F.when(p.isNotNull(), p >= least)


def _plausible(v: Column) -> Column:
    return F.coalesce(v.between(*PLAUSIBLE), F.lit(False))


def scale_check(slides: DataFrame, target: float = TARGET_MPP, tolerance: float = MPP_TOLERANCE) -> DataFrame:
    """slides (mpp_x, mpp_y, objective_power) with effective_mpp, scale_source, implausible, mpp_passed.

    A stated scale counts if both axes are plausible, or if it is finer and its product with the objective
    power fits on both axes; else the scale is derived from a positive power; else there is none."""
    x, y, power = (finite_or_null(F.col(c)) for c in ("mpp_x", "mpp_y", "objective_power"))
    fits = [F.coalesce((m > 0) & (m < PLAUSIBLE[0]) & (m * power).between(*PRODUCT), F.lit(False)) for m in (x, y)]
    stated, fine = _plausible(x) & _plausible(y), fits[0] & fits[1]
    derived = F.when(power > 0, UNIT_POWER / power)
    effective = F.when(stated | fine, F.greatest(x, y)).when(_plausible(derived), derived)
    source = F.when(stated, "stated").when(fine, "stated sub-floor").when(_plausible(derived), "derived from objective")
    return slides.withColumns({"effective_mpp": effective, "scale_source": source, "implausible": effective.isNull(), "mpp_passed": F.coalesce(effective <= target + tolerance, F.lit(False))})


def effective_scale(slides: DataFrame) -> DataFrame:
    """After scale_check: a derived scale replaces the stated one, which stays as raw_mpp_x, raw_mpp_y."""
    derived = F.coalesce(F.startswith("scale_source", F.lit("derived")), F.lit(False))
    out = slides.withColumns({"raw_mpp_x": F.col("mpp_x"), "raw_mpp_y": F.col("mpp_y")})
    return out.withColumns({c: F.when(derived, F.col("effective_mpp")).otherwise(F.col(c)) for c in ("mpp_x", "mpp_y")})


def integrity(width: Column, height: Column, downsamples: Column, spot_reads: Column) -> Column:
    """Whether a pyramid is sound: positive size, downsamples from 1 strictly upwards, all spot reads good."""
    ordered = F.forall(F.sequence(F.lit(2), F.size(downsamples)), lambda k: F.element_at(downsamples, k.cast("int")) > F.element_at(downsamples, (k - 1).cast("int")))
    shape = (width > 0) & (height > 0) & (F.size(downsamples) > 0) & (F.abs(F.try_element_at(downsamples, F.lit(1)) - 1) < 1e-6)
    return F.coalesce(shape & F.when(F.size(downsamples) < 2, F.lit(True)).otherwise(ordered) & F.forall(spot_reads, lambda ok: F.coalesce(ok, F.lit(False))), F.lit(False))


def quarantine(slides: DataFrame, policies: dict[str, Column], integrity_ok: Column, enforced: str | None = None) -> DataFrame:
    """slides with flags (names of failed policies, in order) and decision: broken slides always go to
    quarantine; a policy only flags unless it is the enforced one."""
    flags = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in policies.items()]))
    bad = ~F.coalesce(integrity_ok, F.lit(False))
    hold = bad | F.array_contains(flags, enforced) if enforced else bad
    return slides.withColumns({"flags": flags, "decision": F.when(hold, "quarantine").otherwise("accept")})


def gates(slides: DataFrame) -> DataFrame:
    """After scale_check: plane_gate (why whole-slide stages are refused) and tile_gate (why tile stages
    are), null where they may run."""
    none = F.lit("no plausible scale")
    coarse = F.format_string("scale %.4f is coarser than the target", "effective_mpp")
    return slides.withColumns({"plane_gate": F.when(F.col("implausible"), none), "tile_gate": F.when(F.col("implausible"), none).when(~F.col("mpp_passed"), coarse)})


def valid_tiles(tiles: DataFrame, plane_w: str, plane_h: str, most: int, key: str = "slide", order: str = "ord") -> DataFrame:
    """Tiles of a given list (x, y, w, h as doubles) that can be used: whole numbers, inside the plane, not
    larger than a tile; of equal ones the first.  Bad rows stay, with `problem`."""
    from pyspark.sql import Window

    parts = [F.col(c) for c in ("x", "y", "w", "h")]
    x, y, w, h = parts
    whole = F.lit(True)
    for c in parts:
        whole &= F.coalesce(is_finite(c) & (c == F.floor(c)), F.lit(False))
    problem = (
        F.when(~whole, "not whole numbers")
        .when((w < 1) | (h < 1), "empty")
        .when((w > most) | (h > most), "larger than a tile")
        .when((x < 0) | (y < 0) | (x + w > F.col(plane_w)) | (y + h > F.col(plane_h)), "outside the plane")
    )
    first = F.row_number().over(Window.partitionBy(key, "problem", "x", "y", "w", "h").orderBy(order))
    out = tiles.withColumn("problem", problem)
    return out.withColumn("problem", F.coalesce("problem", F.when(first > 1, "duplicate")))
