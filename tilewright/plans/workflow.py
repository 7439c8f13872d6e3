"""Batches end to end: jobs from manifests, fingerprints, what to run again, outcomes, summaries.

A run's result is a table, not a folder: outcomes are appended under a batch id, and the next batch reads
them to decide what is left to do."""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import batch
from tilewright.plans.config import Config

#: What is later among the outcomes of a slide: of a batch, the one that has ended.
LATEST = ["started", "suffix", "folder", "finished"]
OUTCOMES = "slide string, job_key string, batch_id string, state string, started timestamp, finished timestamp, suffix int, folder string, stage string, error_type string, message string, fingerprint string"


def source_sha(folder: str | None = None) -> str:
    """Identity of the package's code: a hash over its files' names and contents."""
    root = folder or os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    digest = hashlib.sha256()
    for at, _, names in sorted(os.walk(root)):
        for n in sorted(names):
            if n.endswith(".py"):
                path = os.path.join(at, n)
                digest.update(os.path.relpath(path, root).encode())
                with open(path, "rb") as f:
                    digest.update(hashlib.sha256(f.read()).digest())
    return digest.hexdigest()


def batch_id(now: dt.datetime | None = None) -> str:
    """The time in UTC, and eight random digits: batches that start in the same second stay apart."""
    return f"{now or dt.datetime.now(dt.timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def fingerprints(jobs: DataFrame, config: Config, inputs: list[str], code: str | None = None) -> DataFrame:
    """jobs with `fingerprint`: whether a run would do the same again, from the job's own inputs, the
    configuration and the code."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in inputs]
    return jobs.withColumn("fingerprint", F.sha2(F.concat_ws("\x1f", *parts, F.lit(config.sha256), F.lit(code or source_sha())), 256))


def jobs(rows: DataFrame, columns: list[str], config: Config, code: str | None = None) -> DataFrame:
    """One job for each slide of a manifest, with key, problem, fingerprint and whether it collides."""
    made = batch.job_keys(batch.manifest_merge(rows, columns))
    return fingerprints(batch.collisions(made, "job_key"), config, ["slide", *columns], code)


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes so far; none if there is no table yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], OUTCOMES)
    return spark.read.schema(OUTCOMES).parquet(path)


def _record(rows: DataFrame, path: str, id: str, started: dt.datetime, state: Column, ended: bool, **says: str) -> None:
    """Appends an outcome for each row; `says` gives stage, error_type and message where rows have none."""
    texts = [F.lit(says.get(c)).cast("string").alias(c) if c not in rows.columns else F.col(c) for c in ("stage", "error_type", "message")]
    finished = F.current_timestamp() if ended else F.lit(None).cast("timestamp")
    rows.select(
        "slide", "job_key", F.lit(id).alias("batch_id"), state.alias("state"), F.lit(started).cast("timestamp").alias("started"), finished.alias("finished"),
        F.lit(0).alias("suffix"), F.lit(id).alias("folder"), *texts, "fingerprint",
    ).write.mode("append").parquet(path)


def run_batch(todo: DataFrame, path: str, process: Callable[[DataFrame], DataFrame], retry_failed: bool = False, force: bool = False, id: str | None = None) -> DataFrame:
    """Runs the jobs that are due through `process` (jobs in; slide, stage, error_type, message out, error_type
    null where all went well), appends their outcomes and returns them.  Jobs with a problem of their
    own fail without being run, and do not stop the others.  Before anything is run, the jobs are noted as
    running; a batch that ends by an error or an interrupt notes them as failed."""
    spark, id = todo.sparkSession, id or batch_id()
    latest = batch.latest_runs(outcomes(spark, path), order=LATEST)
    planned = batch.resume(todo, latest, retry_failed=retry_failed, force=force).filter("action = 'run'")
    bad = F.col("problem").isNotNull() | F.col("collides")
    due = planned.filter(~bad)
    now = dt.datetime.now(dt.timezone.utc)
    _record(due, path, id, now, F.lit(batch.RUNNING), False)
    broken = planned.filter(bad).withColumns({"stage": F.lit("manifest"), "error_type": F.lit("ManifestError"), "message": F.coalesce("problem", F.lit("another job has the same output"))})
    state = F.when(F.col("error_type").isNull(), batch.COMPLETED).otherwise(batch.FAILED)
    try:
        done = due.join(process(due), "slide", "left")
        _record(done.unionByName(broken, allowMissingColumns=True), path, id, now, state, True)
    except BaseException as e:
        _record(due, path, id, now, F.lit(batch.FAILED), True, stage="batch", error_type=type(e).__name__, message=str(e)[:300])
        raise
    return outcomes(spark, path).filter((F.col("batch_id") == id) & (F.col("state") != batch.RUNNING))


def summary(done: DataFrame) -> DataFrame:
    """(dimension, value, n) of the latest outcome of each slide."""
    last = batch.latest_runs(done, order=LATEST)
    return batch.summary_counts(last, ["state", "stage", "error_type"])


def reconciled(done: DataFrame, alive: DataFrame) -> DataFrame:
    """Outcomes with runs that still say running, but are not among the live ones, as failed."""
    lost = (F.col("state") == batch.RUNNING) & F.col("__alive").isNull()
    both = done.join(alive.select("slide", F.lit(True).alias("__alive")).distinct(), "slide", "left")
    return both.withColumns({"message": F.when(lost, "the run ended without a status").otherwise(F.col("message")), "state": F.when(lost, batch.FAILED).otherwise(F.col("state"))}).drop("__alive")
