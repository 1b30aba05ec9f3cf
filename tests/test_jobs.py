import datetime as dt

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from laketally import sources
from laketally.operators import jobs, tasks
from laketally.plans.audit import choose_tasks

RUN = "2026-03-10"
LOG = "task_name string, period_type string, batch_no string, state int, complete_dt timestamp_ntz"


def at(hour, minute=0):
    return dt.datetime(2026, 3, 9, hour, minute)


def schedule(task, period=None, *tables, **ids):
    return {"task_name": task, "period_type": period, "tables": list(tables), **ids}


def table(name, template=None, **more):
    return {"name": name, "hdfs_path": f"/lake/{name}/", "format": "ORC", "partition_template": template, **more}


@pytest.fixture
def config(spark):
    return sources.schedules_from_dicts(
        spark,
        [
            schedule("d", None, table("d1", "ymd=${data_date}"), table("d2"), interface_id=7),
            schedule("h", "hourly", table("h1", "ymdh=${data_date}${data_hour}", delimiter="|")),
            schedule("m", "monthly", table("m1", "ym=${data_month}")),
            schedule("x", "daily", table("x1", "q=${quarter}")),
            schedule("d", "daily", table("d3")),
        ],
    )


def log(spark, *rows):
    return spark.createDataFrame([(*r[:3], *(r[3:] or (1, at(1)))) for r in rows], LOG)


def paths(df):
    return sorted((r["task_name"], r["batch_no"], r["hdfs_path"]) for r in df.collect())


def test_first_row_per_task_and_batch(spark):
    rows = log(
        spark,
        ("d", "daily", "20260309", 1, at(5)),
        ("d", "hourly", "20260309", 1, at(4)),
        ("d", "daily", "2026-03-09", 1, at(6)),
        ("d", None, None, 1, at(7)),
        ("d", "", "", 1, at(8)),
    )
    got = tasks.completed_tasks(rows).collect()
    assert sorted((r["batch_no"], r["period_type"], r["data_date"]) for r in got) == [
        ("", "daily", None), ("2026-03-09", "daily", "20260309"), ("20260309", "hourly", "20260309"),
    ]
    assert tasks.fetch_stats(rows).first().asDict() == {"records": 5, "tasks": 1, "task_batches": 3}


def test_jobs(spark, config):
    done = tasks.completed_tasks(
        log(
            spark,
            ("d", "daily", "20260301"),
            ("d", "daily", "20260302"),
            ("h", "hourly", "2026030107"),
            ("h", None, "2026030108"),
            ("m", "monthly", "202602"),
            ("x", "daily", "20260301"),
            ("ghost", "daily", "20260301"),
        )
    )
    assert paths(jobs.audit_jobs(config, done, RUN)) == [
        ("d", "20260301", "/lake/d1/ymd=20260301"),
        ("d", "20260301", "/lake/d2/"),
        ("d", "20260301", "/lake/d3/"),
        ("d", "20260302", "/lake/d1/ymd=20260302"),
        ("d", "20260302", "/lake/d2/"),
        ("d", "20260302", "/lake/d3/"),
        ("h", "2026030107", "/lake/h1/ymdh=2026030107"),
        ("m", "202602", "/lake/m1/ym=202602"),
    ]
    assert paths(jobs.unresolved_jobs(config, done, RUN)) == [
        ("x", "20260301", "/lake/x1/q=${quarter}")
    ]
    # A NULL period in the log reads as daily and does not fit an hourly task.
    left_out = jobs.period_mismatch(config, done).collect()
    assert [(r["task_name"], r["batch_no"], r["log_period"]) for r in left_out] == [
        ("h", "2026030108", "daily")
    ]
    assert [r["task_name"] for r in jobs.unconfigured_tasks(config, done).collect()] == ["ghost"]
    first = jobs.audit_jobs(config, done, RUN).filter("table_name = 'd1'").first()
    assert (first["interface_id"], first["platform_id"], first["format"], first["delimiter"]) == (
        "7", "", "orc", "\\n",
    )


def test_explicit_date_leaves_hourly_paths_unfilled(spark, config):
    done = choose_tasks(config)
    assert paths(jobs.audit_jobs(config, done, RUN, explicit_date="20260115")) == [
        ("d", "", "/lake/d1/ymd=20260115"),
        ("d", "", "/lake/d2/"),
        ("d", "", "/lake/d3/"),
        ("m", "", "/lake/m1/ym=202601"),
    ]
    left = jobs.unresolved_jobs(config, done, RUN, explicit_date="20260115")
    assert [p for _, _, p in paths(left)] == [
        "/lake/h1/ymdh=20260115${data_hour}", "/lake/x1/q=${quarter}",
    ]


def test_names_take_period_defaults(spark, config):
    done, unknown = tasks.explicit_tasks(config, " m , h,nobody,")
    assert paths(jobs.audit_jobs(config, done, RUN)) == [("m", "", "/lake/m1/ym=202602")]
    assert [r[0] for r in unknown.collect()] == ["nobody"]


def test_date_in_the_task_name(spark):
    config = sources.schedules_from_dicts(
        spark, [schedule("p_${data_date}07", "hourly", table("h1", "h=${data_date}${data_hour}"))]
    )
    done = tasks.completed_tasks(log(spark, ("p_2026030107", "hourly", "2026030107")))
    assert jobs.audit_jobs(config, done, RUN).count() == 0
    found = jobs.audit_jobs(config, done, RUN, by_pattern=True)
    assert [p for _, _, p in paths(found)] == ["/lake/h1/h=2026030107"]
    assert jobs.unconfigured_tasks(config, done).count() == 1
    assert jobs.unconfigured_tasks(config, done, by_pattern=True).count() == 0


def test_log_sources(spark, tmp_path):
    raw = spark.createDataFrame(
        [("a", "daily", "20260309", 1, at(1)), ("b", "daily", "20260309", 0, at(1)),
         ("c", "daily", "20260309", 1, at(2))],
        "job_code string, batch_type string, batch_no string, state int, complete_dt timestamp_ntz",
    )
    raw.write.parquet(str(tmp_path / "log"))
    names = {"task_name": "job_code", "period_type": "batch_type"}
    read = sources.read_task_log(spark, str(tmp_path / "log"), columns=names)
    kept = sources.task_log_window(read, at(1), at(2))
    assert [r["task_name"] for r in kept.collect()] == ["a"]
    assert [r["task_name"] for r in sources.task_log_window(read, at(2), at(3)).collect()] == ["c"]
    status = read.withColumn("status", F.lit("SUCCESS")).withColumnRenamed("complete_dt", "end_time")
    legacy = sources.task_log_distinct(status.union(status), at(1), at(3)).collect()
    assert sorted((r["task_name"], r["batch_no"], r["period_type"]) for r in legacy) == [
        ("a", "", None), ("b", "", None), ("c", "", None),
    ]


def test_schedules(spark, config, tmp_path):
    names = [r["task_name"] for r in sources.all_task_names(config).collect()]
    assert names == ["d", "h", "m", "x", "d"]
    assert len(sources.schedule_by_task(config, "d").first()["tables"]) == 2
    assert sources.schedule_by_task(config, "nobody").count() == 0
    config.write.json(str(tmp_path / "s"))
    again = sources.read_schedules(spark, str(tmp_path / "s"))
    assert sorted(again.collect(), key=str) == sorted(config.collect(), key=str)


def test_yaml_schedules(spark, tmp_path):
    pytest.importorskip("yaml")
    f = tmp_path / "config.yml"
    f.write_text(
        "schedules:\n- task_name: a\n  interface_id: '03041'\n  partner_id: 2\n"
        "  tables:\n  - {name: t, hdfs_path: /t, format: orc, threads: 3}\n"
    )
    row = sources.schedule_tables(sources.read_schedules(spark, str(f))).first()
    assert (row["interface_id"], row["partner_id"], row["period_type"]) == ("03041", "2", "daily")
    f.write_text("defaults: {}\n")
    with pytest.raises(PythonException, match="has no schedules"):
        sources.read_schedules(spark, str(f)).collect()


def test_violations(spark):
    bad = sources.schedules_from_dicts(
        spark,
        [{"tables": []}, {"task_name": "a"}, {"task_name": "b", "tables": [{"name": "t"}, table("u")]}],
    )
    found = sources.config_violations(bad).collect()
    assert sorted((r["rule"], r["ord"], r["field"]) for r in found) == [
        ("schedule_tables", 1, "tables"),
        ("schedule_task_name", 0, "task_name"),
        ("table_field", 2, "format"),
        ("table_field", 2, "hdfs_path"),
    ]
