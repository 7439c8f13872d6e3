import datetime as dt

import pytest

from tilewright.streaming import ledger


def at(minute):
    return dt.datetime(2026, 1, 1) + dt.timedelta(minutes=minute)


@pytest.fixture()
def folder(spark, tmp_path):
    def add(rows):
        spark.createDataFrame(rows, ledger.EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    add([(1, at(0), "running", 1.0, "a"), (2, at(1), "running", 2.0, "b")])
    return str(tmp_path / "in"), add, str(tmp_path / "cp")


def test_late_events_do_not_replace_newer_ones(spark, folder):
    path, add, cp = folder
    add([(1, at(5), "completed", 3.0, "a")])
    add([(1, at(2), "failed", 3.0, "a")])
    got = ledger.run_once(ledger.latest_state(ledger.events(spark, path)), "latest", cp, "complete")
    assert {r.slide: r.state for r in got.collect()} == {1: "completed", 2: "running"}


def test_only_new_work_passes(spark, folder):
    path, add, cp = folder
    add([(1, at(3), "running", 1.0, "a"), (1, at(3), "running", 1.0, "c")])
    got = ledger.run_once(ledger.new_work(ledger.events(spark, path)), "fresh", cp)
    assert sorted((r.slide, r.fingerprint) for r in got.collect()) == [(1, "a"), (1, "c"), (2, "b")]


def test_windows(spark, folder):
    path, add, cp = folder
    add([(3, at(500), "running", 1.0, "z")])
    got = ledger.run_once(ledger.rates(ledger.events(spark, path)), "rates", cp)
    assert [(r.state, r.n, r.seconds) for r in got.collect() if r.start == at(0)] == [("running", 2, 3.0)]


def test_silent_runs_fail(spark, folder):
    path, add, cp = folder
    add([(1, at(10), "completed", 1.0, "a")])
    add([(9, at(300), "completed", 1.0, "q")])
    stream = ledger.events(spark, path, per_trigger=1)
    got = ledger.run_once(ledger.reconciled(stream), "reconciled", cp)
    last = {}
    for r in got.orderBy("ts").collect():
        last.setdefault(r.slide, []).append(r.state)
    assert last[1][-1] == "completed" and "failed" in last[2]
