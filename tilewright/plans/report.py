"""Reports and whole runs over a table of slides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.guards import finite_or_null
from tilewright.operators import checks, folds, slide_measures, tissue, verdict
from tilewright.plans.config import Config


def status(error: F.Column, gate: F.Column | None = None) -> F.Column:
    """ok, failed or gated: a skipped measurement is a status with a reason, never a zero."""
    out = F.when(error.isNotNull(), "failed").otherwise("ok")
    return out if gate is None else F.when(gate.isNotNull(), "gated").otherwise(out)


def assembled(slides: DataFrame, parts: dict[str, DataFrame], key: str = "slide") -> DataFrame:
    """slides with each part's columns as a struct of its name (null where a slide has no such row)."""
    def add(out: DataFrame, item: tuple[str, DataFrame]) -> DataFrame:
        name, part = item
        fields = [finite_or_null(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in part.dtypes if c != key]
        return out.join(part.select(key, F.struct(*fields).alias(name)), key, "left")

    return reduce(add, parts.items(), slides)


def metrics_long(reports: DataFrame, paths: dict[str, str], key: str = "slide") -> DataFrame:
    """(key, stain, metric, value) of the named report fields."""
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(p).cast("double").alias("value")) for m, p in paths.items()])
    return reports.select(key, "stain", F.explode(each).alias("m")).select(key, "stain", "m.metric", "m.value")


def slide_run(slides: DataFrame, config: Config | None = None) -> DataFrame:
    """A report for each slide: acceptance, tissue, folds, focus and staining, verdict.

    slides: (slide, stain, mpp_x, mpp_y, objective_power, h, w, data) with the plane's pixels and `plane_mpp`.  Gated
    slides are not given to any pixel kernel."""
    config = config or Config()
    checked = checks.gates(checks.scale_check(slides, config.get("checks.target_mpp"), config.get("checks.tolerance")))
    planes = checked.filter("plane_gate IS NULL").select(F.col("slide").alias("plane"), "h", "w", "data", "stain", F.col("plane_mpp").alias("mpp"))
    t = tissue.segment(planes, config.get("tissue.method"))
    masked = planes.join(t.select("plane", F.col("mask").alias("tissue")), "plane")
    f = folds.detect(masked, config.get("folds.lines"))
    measured = slide_measures.measure(masked.join(f.select("plane", F.col("mask").alias("fold")), "plane"))
    named = lambda d: d.drop("mask").withColumnRenamed("plane", "slide")
    head = checked.select("slide", "stain", "effective_mpp", "scale_source", "mpp_passed", "plane_gate", "tile_gate")
    report = assembled(head, {"tissue": named(t), "folds": named(f), "measures": named(measured)})
    rows = config.threshold_rows()
    if not rows:
        return report
    spark = slides.sparkSession
    table = spark.createDataFrame(rows, "metric string, stain string, min double, max double")
    paths = {"tissue.coverage": "tissue.coverage", "folds.fold_fraction": "folds.fold_fraction", "focus": "measures.focus", "staining": "measures.staining"}
    long = metrics_long(report, paths).withColumn("alias", F.lit(None).cast("string"))
    judged = verdict.verdict(verdict.evaluated(verdict.resolve_bounds(long, table, ["slide"])), ["slide"])
    return assembled(report, {"verdict": judged})


def complete(states: DataFrame, key: str = "slide") -> DataFrame:
    """(key, complete): whether no component of a slide failed, was gated or degraded."""
    return states.groupBy(key).agg((F.count_if(F.col("status") != "ok") == 0).alias("complete"))
