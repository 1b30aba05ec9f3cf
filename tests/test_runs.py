"""A run table: what readers see of whole, broken and competing runs."""

import datetime as dt

import pyarrow as pa
import pyarrow.orc as orc
import pytest

from laketally import sources
from laketally.plans import audit, runs
from laketally.plans.audit import run_audit
from laketally.plans.commits import Taken

NOW = dt.datetime(2026, 3, 10, 12)
LOG = "task_name string, period_type string, batch_no string, state int, complete_dt timestamp_ntz"


@pytest.fixture
def go(spark, tmp_path):
    """An audit of a lake with one good day and one that is missing."""
    orc_dir = tmp_path / "lake" / "ymd=20260308"
    orc_dir.mkdir(parents=True)
    orc.write_table(pa.table({"x": range(5)}), orc_dir / "part-0.orc")
    entry = {"name": "ods.t", "hdfs_path": f"{tmp_path}/lake", "format": "orc", "partition_template": "ymd=${data_date}"}
    config = sources.schedules_from_dicts(spark, [{"task_name": "t", "period_type": "daily", "tables": [entry]}])

    def run(*days, **options):
        now = options.setdefault("now", NOW)
        rows = [("t", "daily", d, 1, now - dt.timedelta(minutes=1)) for d in days]
        return run_audit(spark, config, log=spark.createDataFrame(rows, LOG), runs_path=f"{tmp_path}/runs", **options)

    return run


def seen(spark, tmp_path):
    path = f"{tmp_path}/runs"
    results = sorted((r.batch_no, r.status) for r in runs.read_run_results(spark, path).collect())
    return results, runs.read_run_errors(spark, path).count(), runs.RunTable(spark, path).mark()


def test_results_errors_and_mark_together(spark, go, tmp_path):
    assert seen(spark, tmp_path) == ([], 0, None)
    r = go("20260308", "20260309")
    assert not r.advanced
    assert seen(spark, tmp_path) == ([("20260308", "success"), ("20260309", "failed")], 1, None)
    later = NOW + dt.timedelta(minutes=5)
    assert go("20260308", now=later).advanced
    assert seen(spark, tmp_path)[2] == later
    assert go(now=later + dt.timedelta(hours=1)).advanced  # no task: the mark moves, nothing else
    results, errors, mark = seen(spark, tmp_path)
    assert len(results) == 3 and errors == 1 and mark == later + dt.timedelta(hours=1)
    kept = runs.read_run_results(spark, f"{tmp_path}/runs", data_date="20260309").collect()
    assert [r.status for r in kept] == ["failed"]


def test_broken_run_leaves_nothing(spark, go, tmp_path, monkeypatch):
    go("20260308")
    before = seen(spark, tmp_path)

    def lost(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(runs, "append_errors", lost)
    with pytest.raises(RuntimeError):
        go("20260308", "20260309", now=NOW + dt.timedelta(minutes=5))
    monkeypatch.undo()
    assert seen(spark, tmp_path) == before
    go("20260308", "20260309", now=NOW + dt.timedelta(minutes=5))
    assert len(seen(spark, tmp_path)[0]) == 3


def test_two_runs_at_once(spark, go, tmp_path, monkeypatch):
    """Another run starts from the same mark and commits first: this one cannot."""
    whole, calls = audit.audit_results, []

    def slow(*args, **options):
        if not calls:
            calls.append(1)
            go("20260308", now=NOW + dt.timedelta(minutes=1))
        return whole(*args, **options)

    monkeypatch.setattr(audit, "audit_results", slow)
    with pytest.raises(Taken):
        go("20260308")
    assert seen(spark, tmp_path) == ([("20260308", "success")], 0, NOW + dt.timedelta(minutes=1))
    assert runs.committed_runs(spark, f"{tmp_path}/runs").count() == 1


def test_named_runs_leave_the_mark(spark, go, tmp_path):
    go("20260308")
    mark = seen(spark, tmp_path)[2]
    r = go(names="t", data_date="20260308", now=NOW + dt.timedelta(hours=2))
    assert not r.advanced and r.summary["success"] == 1
    results, _, after = seen(spark, tmp_path)
    assert len(results) == 2 and after == mark


def test_start_and_reset(spark, go, tmp_path):
    assert go("20260308", init_now=True).advanced
    assert seen(spark, tmp_path) == ([], 0, NOW)
    dry = go("20260308", dry_run=True, now=NOW + dt.timedelta(hours=1))
    assert dry.summary["total"] == 1 and runs.committed_runs(spark, f"{tmp_path}/runs").count() == 1
    go("20260309", reset=True, now=NOW + dt.timedelta(hours=1))
    assert seen(spark, tmp_path)[2] is None
    with pytest.raises(ValueError, match="run table"):
        go("20260308", results_path="x")
