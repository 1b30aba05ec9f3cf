import datetime as dt
import json

import pyarrow as pa
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F

from laketally import sources
from laketally.operators import counting, history, results
from laketally.operators.jobs import audit_jobs
from laketally.plans import incremental
from laketally.plans.audit import choose_tasks, run_audit

NOW = dt.datetime(2026, 3, 10, 12)
LOG = "task_name string, period_type string, batch_no string, state int, complete_dt timestamp_ntz"


def write(folder, rows):
    folder.mkdir(parents=True, exist_ok=True)
    orc.write_table(pa.table({"x": range(rows)}), folder / "part-0.orc")


@pytest.fixture
def config(spark, tmp_path):
    entry = {"name": "ods.t", "hdfs_path": f"{tmp_path}/lake", "format": "orc", "partition_template": "ymd=${data_date}"}
    one = {"task_name": "t", "interface_id": "03041", "period_type": "daily", "tables": [entry]}
    return sources.schedules_from_dicts(spark, [one])


def log(spark, *days, task="t"):
    rows = [(task, "daily", d, 1, NOW - dt.timedelta(hours=1)) for d in days]
    return spark.createDataFrame(rows, LOG)


@pytest.fixture
def run(spark, config, tmp_path):
    def go(task_log, **options):
        options = {"now": NOW, **options}
        return run_audit(
            spark,
            config,
            log=task_log,
            results_path=f"{tmp_path}/results",
            errors_path=f"{tmp_path}/errors",
            state_path=f"{tmp_path}/state",
            **options,
        )

    return go


def mark(spark, tmp_path):
    return incremental.load_mark(spark, f"{tmp_path}/state")


def test_run_and_rerun(spark, run, tmp_path):
    write(tmp_path / "lake" / "ymd=20260308", 5)
    r = run(log(spark, "20260308", "20260309"))
    assert r.summary == {"total": 2, "success": 1, "partial": 0, "failed": 1}
    assert r.fetched == 2 and not r.advanced and not r.stalled
    assert mark(spark, tmp_path) is None

    stored = results.read_results(spark, f"{tmp_path}/results").orderBy("batch_no").collect()
    assert [(x["batch_no"], str(x["data_date"]), x["data_month"], x["row_count"], x["status"]) for x in stored] == [
        ("20260308", "2026-03-08", "202603", 5, "success"),
        ("20260309", "2026-03-09", "202603", -1, "failed"),
    ]
    assert stored[0]["error_msg"] is None and stored[0]["interface_id"] == "03041"
    error = json.loads(stored[1]["error_msg"])
    assert error == [{"file": "", "error": f"Failed to access path: Path does not exist: {tmp_path}/lake/ymd=20260309"}]
    assert spark.read.parquet(f"{tmp_path}/errors").count() == 1

    # The path appears, the same window runs again, both rows stay, the newest wins.
    write(tmp_path / "lake" / "ymd=20260309", 7)
    later = NOW + dt.timedelta(minutes=5)
    r = run(log(spark, "20260308", "20260309"), now=later)
    assert r.summary["success"] == 2 and r.advanced
    assert mark(spark, tmp_path) == later
    rows = results.read_results(spark, f"{tmp_path}/results")
    assert rows.count() == 4 and rows.select("id").distinct().count() == 4
    newest = history.latest_result(rows, "ods.t", data_date="20260309").first()
    assert (newest["row_count"], newest["created_at"]) == (7, later)


def test_failures_may_advance(spark, run, tmp_path):
    settings = incremental.WindowSettings(advance_on_failure=True)
    r = run(log(spark, "20260309"), settings=settings)
    assert r.summary["failed"] == 1 and r.advanced
    assert mark(spark, tmp_path) == NOW


def test_unconfigured_tasks_hold_the_mark(spark, run, tmp_path):
    incremental.save_mark(spark, f"{tmp_path}/state", NOW - dt.timedelta(days=3), NOW)
    two_days = log(spark, "20260309", task="ghost").selectExpr(
        "task_name", "period_type", "batch_no", "state", "complete_dt - INTERVAL '60' HOUR AS complete_dt"
    )
    r = run(two_days)
    assert r.summary["total"] == 0 and r.fetched == 1 and not r.advanced and r.stalled
    r = run(two_days.filter("false"), now=NOW + dt.timedelta(seconds=1))
    assert r.advanced and mark(spark, tmp_path) == NOW - dt.timedelta(days=2)


def test_dry_run_writes_nothing(spark, run, tmp_path):
    r = run(log(spark, "20260309"), dry_run=True)
    assert r.details.first()["status"] == "dry_run" and r.summary["total"] == 1
    r = run(log(spark), dry_run=True)
    assert not r.advanced
    assert not (tmp_path / "results").exists() and not (tmp_path / "state").exists()


def test_names_ignore_log_and_mark(spark, run, tmp_path):
    write(tmp_path / "lake" / "ymd=20260115", 2)
    r = run(log(spark, "20260309"), names="t,other", data_date="20260115")
    assert r.summary == {"total": 1, "success": 1, "partial": 0, "failed": 0}
    assert r.window is None and not r.advanced and mark(spark, tmp_path) is None


def test_all_configured_without_a_log(spark, run, tmp_path):
    write(tmp_path / "lake" / "ymd=20260309", 2)
    r = run(None)
    assert r.summary["success"] == 1 and not r.advanced


def test_cold_start_and_reset(spark, run, tmp_path):
    r = run(log(spark, "20260309"), init_now=True)
    assert r.summary["total"] == 0 and mark(spark, tmp_path) == NOW
    write(tmp_path / "lake" / "ymd=20260309", 2)
    r = run(log(spark, "20260309"), reset=True, now=NOW + dt.timedelta(seconds=30))
    assert r.window[0] == NOW + dt.timedelta(seconds=30) - dt.timedelta(hours=24)
    assert r.summary["success"] == 1 and r.advanced
    assert mark(spark, tmp_path) == r.window[1]
    run(log(spark, "20260309"), reset=True, init_now=True, now=NOW)
    assert mark(spark, tmp_path) == NOW


def test_bad_arguments(spark, run, tmp_path):
    with pytest.raises(ValueError, match="not a yyyyMMdd"):
        run(log(spark, "20260309"), data_date="2026-03-09")
    bad = sources.schedules_from_dicts(spark, [{"task_name": "t", "tables": [{"name": "x"}]}])
    with pytest.raises(ValueError, match="fields are missing"):
        run_audit(spark, bad, now=NOW, results_path=f"{tmp_path}/r")
    with pytest.raises(ValueError, match="results_path"):
        run_audit(spark, bad, now=NOW)


def test_named_date(spark, run, tmp_path):
    write(tmp_path / "lake" / "ymd=20260310", 4)
    r = run(None, data_date="${today}")
    assert [(x["data_month"], x["row_count"]) for x in r.details.collect()] == [("202603", 4)]


@pytest.fixture
def shanghai(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    yield
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_times_are_of_the_session_zone(spark, run, tmp_path, shanghai):
    """Mark, window, log and result times agree whatever the machine's zone."""
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "s.json").write_text(
        '{"last_end_time": "2026-03-10T09:00:00+08:00", "updated_at": "2026-03-10T09:00:01+08:00"}'
    )
    write(tmp_path / "lake" / "ymd=20260309", 4)
    instants = log(spark, "20260309").selectExpr(
        "task_name", "period_type", "batch_no", "state", "CAST(complete_dt AS TIMESTAMP) AS complete_dt"
    )
    r = run(instants)
    assert r.window == (dt.datetime(2026, 3, 10, 8, 50), NOW)
    assert r.summary["success"] == 1 and mark(spark, tmp_path) == NOW
    saved = "".join(p.read_text() for p in (tmp_path / "state").glob("part-*"))
    assert '"last_end_time":"2026-03-10T12:00:00.000+08:00"' in saved
    created = r.details.selectExpr("date_format(created_at, 'HH:mm') AS t").first()["t"]
    assert created == "12:00"


def test_jobs_without_a_result_are_kept(spark, config):
    done = choose_tasks(config)
    planned = audit_jobs(config, done, NOW.date())
    counts = counting.path_results(counting.count_files(planned)).filter("false")
    row = results.result_rows(planned, counts, NOW).first()
    assert (row["row_count"], row["status"], row["file_count"]) == (-1, "failed", 0)


def test_run_date_is_of_the_session_zone(spark, run, tmp_path, shanghai):
    write(tmp_path / "lake" / "ymd=20260309", 4)
    evening = dt.datetime(2026, 3, 9, 20, tzinfo=dt.timezone.utc)  # March 10 there
    done = log(spark, "").withColumn("complete_dt", F.expr("TIMESTAMP_NTZ'2026-03-10 03:00:00'"))
    r = run(done, now=evening)
    assert r.window == (dt.datetime(2026, 3, 9, 4), dt.datetime(2026, 3, 10, 4))
    assert [x["row_count"] for x in r.details.collect()] == [4]
    assert mark(spark, tmp_path) == dt.datetime(2026, 3, 10, 4)


def test_summary_is_counted_while_writing(spark, run, tmp_path, config):
    """The numbers of a run equal those of its tables, with a failed day, without any job, and over jobs of one run."""
    write(tmp_path / "lake" / "ymd=20260308", 5)
    r = run(log(spark, "20260308", "20260309", "20260307"))
    assert r.fetched == r.tasks.count() == 3
    assert r.summary == results.run_summary(r.details).first().asDict()
    assert r.summary["total"] == r.jobs.count() == 3
    none = run(log(spark, "20260308", task="other"))
    assert none.fetched == 1 and none.summary == {"total": 0, "success": 0, "partial": 0, "failed": 0}
