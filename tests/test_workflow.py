import datetime as dt

import pytest
from pyspark.sql import functions as F

from tilewright.__main__ import main
from tilewright.plans import browser, workflow
from tilewright.plans.config import Config

ROWS = [("a/x.svs", 0, "HE"), ("a/y.svs", 1, "HE"), ("b/z.svs", 2, "HE"), ("b/z.svs", 3, "AT8")]


def manifest(spark):
    return spark.createDataFrame(ROWS, "slide string, ord int, stain string")


def process(jobs):
    bad = F.col("slide") == "a/y.svs"
    return jobs.select("slide", F.lit("slide").alias("stage"), F.when(bad, "ReadError").alias("error_type"), F.when(bad, "ReadError: cut off").alias("message"))


def test_batches_pick_up_where_the_last_one_ended(spark, tmp_path):
    path = f"file://{tmp_path}/outcomes"
    todo = workflow.jobs(manifest(spark), ["stain"], Config(), code="1")
    first = {r.slide: (r.state, r.error_type) for r in workflow.run_batch(todo, path, process, id="b1").collect()}
    assert first == {"a/x.svs": ("completed", None), "a/y.svs": ("failed", "ReadError"), "b/z.svs": ("failed", "ManifestError")}
    assert workflow.run_batch(todo, path, process, id="b2").count() == 0
    assert {r.slide for r in workflow.run_batch(todo, path, process, retry_failed=True, id="b3").collect()} == {"a/y.svs", "b/z.svs"}
    changed = workflow.jobs(manifest(spark), ["stain"], Config({"tiles": {"size": 64}}), code="1")
    assert workflow.run_batch(changed, path, process, id="b4").count() == 3
    got = {(r.dimension, r.value): r.n for r in workflow.summary(workflow.outcomes(spark, path)).collect()}
    assert got["state", "completed"] == 1 and got["error_type", "None"] == 1 and got["state", "failed"] == 2


def test_lost_runs_are_failed(spark):
    rows = [("a", "k", "b", "running", None, None, 0, "f", None, None, None, "p"), ("c", "k", "b", "running", None, None, 0, "f", None, None, None, "p")]
    done = spark.createDataFrame(rows, workflow.OUTCOMES)
    got = {r.slide: r.state for r in workflow.reconciled(done, spark.createDataFrame([("c",)], "slide string")).collect()}
    assert got == {"a": "failed", "c": "running"}


def test_identity_of_code(tmp_path):
    (tmp_path / "a.py").write_text("x")
    one = workflow.source_sha(str(tmp_path))
    (tmp_path / "a.py").write_text("y")
    assert one != workflow.source_sha(str(tmp_path))


def test_batches_of_the_same_second_stay_apart():
    now = dt.datetime(2024, 1, 2, 3, 4, 5)
    one, two = workflow.batch_id(now), workflow.batch_id(now)
    assert one != two and one.startswith("20240102_030405_")


def test_interrupted_batches_leave_failed_jobs(spark, tmp_path):
    path = f"file://{tmp_path}/outcomes"
    todo = workflow.jobs(manifest(spark), ["stain"], Config(), code="1")

    def stopped(jobs):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        workflow.run_batch(todo, path, stopped, id="b1")
    noted = {(r.slide, r.state) for r in workflow.outcomes(spark, path).collect()}
    assert noted == {(s, x) for s in ("a/x.svs", "a/y.svs") for x in ("running", "failed")}
    got = {(r.dimension, r.value): r.n for r in workflow.summary(workflow.outcomes(spark, path)).collect()}
    assert got["state", "failed"] == 2 and got["error_type", "KeyboardInterrupt"] == 2 and ("state", "running") not in got
    assert workflow.run_batch(todo, path, process, retry_failed=True, id="b2").count() == 3


def test_pages_are_safe():
    p = browser.batch_page("1", [{"slide": "<b>", "state": "failed", "message": None}])
    assert "<b>" not in p and "&lt;b&gt;" in p and "&ndash;" in p
    assert "0.5" in browser.report_page({"slide": "s", "tissue": {"coverage": 0.5, "mask": b"x"}})


def test_command_line(capsys):
    assert main(["plan", "--components", "focus"]) == 2
    assert main(["plan", "--components", "focus", "--supplied", "tissue_mask"]) == 0
    assert '"run"' in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["nothing"])
