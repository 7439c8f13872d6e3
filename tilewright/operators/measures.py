"""Statistics of planes and tiles.

Sums that are compared across engines are kept in integers and divided once at the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.guards import count_true, fraction

#: Bins of the threshold histogram, the range of a usable local minimum, its fallback.
HISTOGRAM_BINS, MINIMUM_RANGE, MIDDLE = 30, (1.0, 4.0), 2.5


def percentiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """(keys, named points): exact percentiles with linear interpolation, nulls left out."""
    got = df.groupBy(*keys).agg(F.percentile(value, F.array(*[F.lit(p) for p in points.values()])).alias("__p"))
    return got.select(*keys, *[F.col("__p")[k].alias(name) for k, name in enumerate(points)])


def coverage(pixels: DataFrame, flag: Column, keys: list[str]) -> DataFrame:
    """(keys, px, set_px, coverage)"""
    got = pixels.groupBy(*keys).agg(F.count(F.lit(1)).alias("px"), count_true(flag).alias("set_px"))
    return got.withColumn("coverage", fraction(F.col("set_px"), F.col("px")))


def histogram(pixels: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n) of integer values."""
    return pixels.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def otsu(counts: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """(keys, threshold) from (keys, v, n): the value that splits the histogram with the greatest variance
    between the two sides (values up to the threshold, and above); the smallest on ties; the value
    itself where there is only one.  Histograms have at most 256 rows a key, so this is a window over
    small groups whatever the number of pixels."""
    upto = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole, mass = Window.partitionBy(*keys), F.col("n") * F.col("v")
    s = counts.select(*keys, F.col(value).alias("v"), "n")
    s = s.withColumns({"w0": F.sum("n").over(upto), "m0": F.sum(mass).over(upto), "w": F.sum("n").over(whole), "m": F.sum(mass).over(whole)})
    gap = (F.col("m") * F.col("w0") - F.col("m0") * F.col("w")).cast("double")
    between = F.try_divide(gap * gap, (F.col("w0") * (F.col("w") - F.col("w0"))).cast("double"))
    best = Window.partitionBy(*keys).orderBy(F.coalesce(between, F.lit(-1.0)).desc(), "v")
    return s.withColumn("__r", F.row_number().over(best)).filter("__r = 1").select(*keys, F.col("v").alias("threshold"))


def value_range(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def binned(df: DataFrame, keys: list[str], value: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(keys, lo, hi, bin, n): equal bins over each key's range, the last one closed; empty bins too."""
    edges = value_range(df, keys, value)
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    counts = df.join(edges, keys).groupBy(*keys, "lo", "hi", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # Empty bins are filled in from each key's own row.
    every = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts.select(*keys, "bin", "n"), [*keys, "bin"], "left").select(*keys, "lo", "hi", "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def minimum_threshold(bins: DataFrame, keys: list[str], count: int = HISTOGRAM_BINS, inside: tuple[float, float] = MINIMUM_RANGE, middle: float = MIDDLE) -> DataFrame:
    """(keys, threshold): left edge of the last strict local minimum of the histogram that lies inside the
    range; else of the deepest minimum (first on ties); else the middle of the range."""
    order = Window.partitionBy(*keys).orderBy("bin")
    edge = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / count
    low = (F.col("n") < F.lag("n").over(order)) & (F.col("n") < F.lead("n").over(order))
    marked = bins.withColumns({"edge": edge, "low": F.coalesce(low, F.lit(False))})
    ok = F.col("low") & (F.col("edge") > inside[0]) & (F.col("edge") < inside[1])
    last = F.max(F.when(ok, F.struct("bin", "edge")))["edge"]
    deepest = F.min(F.when(F.col("low"), F.struct("n", "bin", "edge")))["edge"]
    return marked.groupBy(*keys).agg(F.coalesce(last, deepest, F.lit(middle)).alias("threshold"))


def laplacian(pixels: DataFrame, keys: list[str], value: str, y: str = "y", x: str = "x") -> DataFrame:
    """pixels with `laplacian`: the four neighbours minus four times the pixel, mirrored at the border
    (the neighbour inside stands for the one outside).  Planes need two pixels each way."""
    across, down = Window.partitionBy(*keys, y).orderBy(x), Window.partitionBy(*keys, x).orderBy(y)
    sides = []
    for w in (across, down):
        before, after = F.lag(value).over(w), F.lead(value).over(w)
        sides += [F.coalesce(before, after), F.coalesce(after, before)]
    return pixels.withColumn("laplacian", sides[0] + sides[1] + sides[2] + sides[3] - 4 * F.col(value))


def variance_exact(value: Column) -> Column:
    """Population variance of integers from exact sums; null for no rows."""
    n, s, q = F.count(value), F.sum(value.cast("long")), F.sum((value * value).cast("long"))
    return F.try_divide((n * q - s * s).cast("double"), (n * n).cast("double"))


def focus(pixels: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, px, focus): variance of the Laplacian, high where a plane is sharp."""
    return laplacian(pixels, keys, value).groupBy(*keys).agg(F.count(F.lit(1)).alias("px"), variance_exact(F.col("laplacian")).alias("focus"))


def stretched(df: DataFrame, keys: list[str], value: str, low: float = 0.01, high: float = 0.99, hard: int = 200) -> DataFrame:
    """df with idx (0..255, halves to even) of the value between two percentiles, and hard (idx >= limit).
    A key without spread has index 0 and nothing hard."""
    p = percentiles(df, keys, value, {"p_low": low, "p_high": high})
    t = F.try_divide(F.col(value) - F.col("p_low"), F.col("p_high") - F.col("p_low"))
    idx = F.rint(255 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))).cast("int")
    return df.join(p, keys).withColumn("idx", idx).withColumn("hard", F.col("idx") >= hard)


def threshold_at(curve: DataFrame, keys: list[str], share: float, name: str) -> DataFrame:
    """(keys, name): the largest t whose count is at least share of the key's largest count; the smallest t
    where there is none.  curve: (keys, t, c)."""
    most = curve.withColumn("__m", F.max("c").over(Window.partitionBy(*keys)))
    reach = F.max(F.when(F.col("c") >= share * F.col("__m"), F.col("t")))
    return most.groupBy(*keys).agg(F.coalesce(reach, F.min("t")).alias(name))


def covariance(df: DataFrame, keys: list[str], channels: list[str]) -> DataFrame:
    """(keys, n, c_ab ...): sample covariance of each two channels, in one pass."""
    pairs = [(a, b) for k, a in enumerate(channels) for b in channels[k:]]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.covar_samp(a, b).alias(f"c_{a}_{b}") for a, b in pairs])


def channel_moments(df: DataFrame, keys: list[str], channels: list[str]) -> DataFrame:
    """(keys, n, mean_c ..., std_c ...): mean and population deviation of each channel."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in channels], *[F.stddev_pop(c).alias(f"std_{c}") for c in channels])


def tile_summary(tiles: DataFrame, key: str = "slide") -> DataFrame:
    """Counters and focus percentiles of each slide's tiles (after two_pass_drop).  Focus is that of every
    tile that was read, dropped in pass 2 or not."""
    read = ~F.col("dropped_pass1") & ~F.coalesce(F.col("read_error"), F.lit(False))
    got = tiles.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_tiles"),
        count_true(F.col("dropped_pass1")).alias("n_dropped_pass1"),
        count_true(F.col("dropped_pass2")).alias("n_dropped_pass2"),
        count_true(~F.col("dropped_pass1") & F.col("read_error")).alias("n_read_failed"),
        count_true(F.col("kept")).alias("n_kept"),
        F.percentile(F.when(read, F.col("focus")), F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).alias("__p"),
    )
    named = [F.col("__p")[k].alias(n) for k, n in enumerate(("focus_p5", "focus_p50", "focus_p95"))]
    return got.select(key, "n_tiles", "n_dropped_pass1", "n_dropped_pass2", "n_read_failed", "n_kept", fraction(F.col("n_kept"), F.col("n_tiles")).alias("kept_fraction"), *named)
