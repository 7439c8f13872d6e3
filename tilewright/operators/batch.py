"""Batches: manifests, jobs, the run ledger, resuming and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.text import clean, error_class, fill, short_hash, slide_id, slide_key

COMPLETED, FAILED, RUNNING = "completed", "failed", "running"


def manifest_merge(rows: DataFrame, columns: list[str], path: str = "slide", order: str = "ord") -> DataFrame:
    """(key, slide, columns..., problem): one job for each slide; a column's value is the first that is not
    blank; values that differ are a problem of this job alone.  At most two different values of a column
    travel for each slide, whatever the number of its rows."""
    keyed = rows.withColumn("key", slide_key(F.col(path))).filter(clean(F.col(path)).isNotNull())
    aggs = [F.min(F.struct(order, F.col(path).alias("v")))["v"].alias("slide")]
    for c in columns:
        v = clean(F.col(c))
        aggs.append(F.min(F.when(v.isNotNull(), F.struct(F.col(order), v.alias("v"))))["v"].alias(c))
        aggs.append(F.min(v).alias(f"__lo_{c}"))
        aggs.append(F.max(v).alias(f"__hi_{c}"))
    got = keyed.groupBy("key").agg(*aggs)
    conflicts = [F.when(F.col(f"__lo_{c}") != F.col(f"__hi_{c}"), F.concat(F.lit(f"conflicting {c}: "), F.col(f"__lo_{c}"), F.lit(", "), F.col(f"__hi_{c}"))) for c in columns]
    return got.select("key", "slide", *columns, F.nullif(F.concat_ws("; ", *conflicts), F.lit("")).alias("problem"))


def job_keys(jobs: DataFrame, path: str = "slide") -> DataFrame:
    """jobs with slide_id and job_key: the id, with eight hex digits of the path's hash where it is not
    unique in the batch."""
    out = jobs.withColumn("slide_id", slide_id(F.col(path)))
    same = F.count(F.lit(1)).over(Window.partitionBy("slide_id"))
    return out.withColumn("job_key", F.when(same > 1, F.concat("slide_id", F.lit("~"), short_hash(F.col(path)))).otherwise(F.col("slide_id")))


def collisions(jobs: DataFrame, destination: str) -> DataFrame:
    """jobs with `collides`: whether another job writes to the same place."""
    return jobs.withColumn("collides", F.count(F.lit(1)).over(Window.partitionBy(destination)) > 1)


def folder_suffix(folder: F.Column) -> F.Column:
    """The number after a time stamp's end in a run folder's name (0 without one)."""
    return F.coalesce(F.nullif(F.regexp_extract(folder, r"(?:Z|UTC)_(\d+)$", 1), F.lit("")).try_cast("int"), F.lit(0))


def latest_runs(runs: DataFrame, key: list[str] | None = None, order: list[str] | None = None, state: str | None = None) -> DataFrame:
    """The latest run of each slide, of those in a state if one is given.  A maximum of the ordering columns
    is aggregated before anything is shuffled, so a slide with very many runs is no burden."""
    key, order = key or ["slide"], order or ["started", "suffix", "folder"]
    chosen = runs if state is None else runs.filter(F.col("state") == state)
    rest = [c for c in chosen.columns if c not in key and c not in order]
    best = chosen.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("__b"))
    return best.select(*key, "__b.*").select(chosen.columns)


def resume(jobs: DataFrame, latest: DataFrame, key: str = "slide", retry_failed: bool = False, force: bool = False) -> DataFrame:
    """jobs (fingerprint) with action: skip what is completed with the same fingerprint, skip what failed
    unless it is to be retried, run the rest."""
    runs = latest.select(key, F.col("state").alias("last_state"), F.col("fingerprint").alias("last_fingerprint"))
    both = jobs.join(runs, key, "left")
    same = F.col("fingerprint").eqNullSafe(F.col("last_fingerprint")) & F.col("last_state").isNotNull()
    action = F.lit("run") if force else F.when(same & (F.col("last_state") == COMPLETED), "skip completed").when(same & (F.col("last_state") == FAILED) & F.lit(not retry_failed), "skip failed").otherwise("run")
    return both.withColumn("action", action)


def resolved_template(jobs: DataFrame, template: str) -> DataFrame:
    """jobs with `resolved`: a template over {slide_id}, {job_key} and {run_dir}; null without a run."""
    filled = fill(F.lit(template), {"slide_id": F.col("slide_id"), "job_key": F.col("job_key"), "run_dir": F.coalesce("run_dir", F.lit(""))})
    return jobs.withColumn("resolved", F.when(F.lit("{run_dir}" not in template) | F.col("run_dir").isNotNull(), filled))


def summary_counts(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, n) of each dimension, all in one pass; a missing value is the text None."""
    named = [F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("None")).alias("value")) for d in dimensions]
    return rows.select(F.explode(F.array(*named)).alias("p")).groupBy("p.dimension", "p.value").agg(F.count(F.lit(1)).alias("n"))


def error_types(rows: DataFrame, message: str = "message") -> DataFrame:
    """(error_type, n) of messages that may list several errors, separated by semicolons."""
    each = rows.select(F.explode(F.split(message, ";")).alias("m")).select(F.trim("m").alias("m")).filter("m <> ''")
    return each.groupBy(F.coalesce(error_class(F.col("m")), F.lit("other")).alias("error_type")).agg(F.count(F.lit(1)).alias("n"))


def ordered_digest(rows: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys, n, digest): SHA-256 over the sorted digests of the rows of a key: one of fixed length for
    each row, so that order and partitioning do not matter."""
    each = rows.select(*keys, F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256).alias("d"))
    return each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list("d"))), 256).alias("digest"))
