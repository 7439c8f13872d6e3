"""Thresholds, verdicts and timings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.guards import is_finite


def resolve_bounds(metrics: DataFrame, thresholds: DataFrame, key: list[str]) -> DataFrame:
    """metrics (key, metric, stain, alias) with min, max and band: the bounds under the stain's own name,
    else its alias, else the global ones (null stain).  An entry without bounds for a stain still counts
    as that stain's: it does not fall back."""
    names = F.array(F.struct(F.lit(0).alias("r"), F.col("stain").alias("s")), F.struct(F.lit(1).alias("r"), F.col("alias").alias("s")), F.struct(F.lit(2).alias("r"), F.lit(None).cast("string").alias("s")))
    wanted = metrics.withColumn("__c", F.explode(F.filter(names, lambda c: c["s"].isNotNull() | (c["r"] == 2))))
    t = thresholds.select(F.col("metric").alias("__m"), F.col("stain").alias("__s"), "min", "max", F.lit(True).alias("__hit"))
    found = wanted.join(t, (wanted.metric == t["__m"]) & wanted["__c.s"].eqNullSafe(t["__s"]), "left")
    best = Window.partitionBy(*key, "metric").orderBy(F.col("__hit").isNull(), "__c.r")
    band = F.when(F.col("__hit").isNull(), "none").when(F.col("__c.r") == 0, "stain").when(F.col("__c.r") == 1, "alias").otherwise("global")
    return found.withColumn("__r", F.row_number().over(best)).filter("__r = 1").withColumn("band", band).drop("__c", "__m", "__s", "__hit", "__r")


def evaluated(metrics: DataFrame, value: str = "value") -> DataFrame:
    """metrics (value, min, max) with counted, flagged and reason.

    Without bounds a metric is not looked at.  Bounds that contradict each other and missing values are
    flagged but not counted; values that are not finite are counted and fail."""
    v, low, high = F.col(value), F.col("min"), F.col("max")
    bounded = low.isNotNull() | high.isNotNull()
    invalid = bounded & ((low.isNotNull() & ~is_finite(low)) | (high.isNotNull() & ~is_finite(high)) | F.coalesce(low > high, F.lit(False)))
    reason = (
        F.when(~bounded, None)
        .when(invalid, "invalid bounds")
        .when(v.isNull(), "missing")
        .when(~is_finite(v), "not finite")
        .when(F.coalesce(v < low, F.lit(False)), "below minimum")
        .when(F.coalesce(v > high, F.lit(False)), "above maximum")
    )
    return metrics.withColumns({"reason": reason, "counted": bounded & ~invalid & v.isNotNull(), "flagged": reason.isNotNull()})


def verdict(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, n_evaluated, n_flags, passed): passed is null where nothing was counted."""
    got = rows.groupBy(*key).agg(F.count_if("counted").alias("n_evaluated"), F.count_if("flagged").alias("n_flags"))
    return got.withColumn("passed", F.when(F.col("n_evaluated") > 0, F.col("n_flags") == 0))


def timing(rows: DataFrame, stage: str = "stage", component: str = "component", seconds: str = "seconds") -> DataFrame:
    """(stage, component, level, n, seconds) over components, stages and all, in one pass."""
    got = rows.rollup(stage, component).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.sum(seconds).alias("seconds"))
    return got.select(stage, component, F.col("level").cast("int").alias("level"), "n", "seconds")


def unattributed(total: F.Column, parts: F.Column) -> F.Column:
    """Seconds of a run that no component accounts for, never negative."""
    return F.greatest(F.lit(0.0), total - F.coalesce(parts, F.lit(0.0)))
