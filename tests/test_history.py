import datetime as dt

import pytest
from pyspark.sql import functions as F

from laketally.operators import history, results
from laketally.schemas import AUDIT_RESULT

DAY = dt.date(2026, 3, 9)


def row(id, table="t", day=DAY, month="202603", rows=5, status="success", created=1, **more):
    values = {
        "id": id, "task_name": "k", "interface_id": "1", "platform_id": "", "partner_id": "2",
        "table_name": table, "hdfs_path": "/p", "period_type": "daily", "batch_no": "b",
        "data_date": day, "data_month": month, "data_hour": None, "row_count": rows,
        "file_count": 1, "total_size_bytes": 1, "status": status, "error_msg": None,
        "duration_ms": 1, "created_at": dt.datetime(2026, 3, 10, created), **more,
    }
    return tuple(values[f.name] for f in AUDIT_RESULT.fields)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), AUDIT_RESULT)


def test_ties_take_the_highest_id(spark):
    df = frame(spark, row(1), row(3), row(2), row(9, created=0))
    assert history.latest_result(df, "t").first()["id"] == 3
    assert [r["id"] for r in history.latest_per_table(df).collect()] == [3]


def test_date_wins_over_month(spark):
    df = frame(spark, row(1), row(2, day=dt.date(2026, 3, 1), created=5))
    assert history.latest_result(df, "t", data_date="20260309", data_month="202601").first()["id"] == 1
    assert history.latest_result(df, "t", data_month="202603").first()["id"] == 2
    assert history.latest_result(df, "t", data_month="202601").count() == 0


def test_case_insensitive(spark):
    df = frame(spark, row(1, table="Dw.Café"))
    assert history.latest_result(df, "dw.cafe ").count() == 0
    assert history.latest_result(df, "dw.cafe ", ci=True).count() == 1


def test_missing_arguments(spark):
    df = frame(spark, row(1))
    for lookup in (history.results_by_partner, history.results_by_interface):
        with pytest.raises(ValueError):
            lookup(df, "1")
    with pytest.raises(ValueError):
        history.results_by_period(df, "daily", data_month="202603")
    with pytest.raises(ValueError):
        history.results_by_period(df, "monthly")
    with pytest.raises(ValueError):
        history.latest_result(df, "t", data_date="2026-03-09")
    assert history.results_by_period(df, "daily", data_date="20260309").count() == 1


def test_rollup_counts_failed_rows_as_given(spark):
    df = frame(
        spark,
        row(1, rows=10),
        row(2, rows=-1, status="failed", created=2),
        row(3, table="u", rows=4),
        row(4, table="u", rows=7, platform_id="x", status="partial"),
        row(5, table="u", day=dt.date(2026, 3, 1)),
    )
    day = history.daily_rollup(df, "2026-03-10").collect()
    assert [r.asDict() for r in day] == [
        {"data_date": DAY, "total_tables": 3, "success_count": 1, "failed_count": 1,
         "total_rows": 10, "total_rows_counted": 11}
    ]
    assert [str(r["data_date"]) for r in history.daily_rollup(df).collect()] == ["2026-03-09", "2026-03-01"]


def test_monthly_rollup_keeps_repeats(spark):
    df = frame(spark, row(1, period_type="monthly"), row(2, period_type="monthly", rows=-1, status="failed"), row(3))
    assert [tuple(r) for r in history.monthly_rollup(df).collect()] == [("202603", 2, 1, 4, 5)]


def test_seven_days_are_eight_dates(spark):
    df = frame(spark, *[row(i, day=DAY - dt.timedelta(days=i)) for i in range(-2, 12)])
    assert [r["id"] for r in history.table_history(df, "t", DAY).collect()] == list(range(-2, 8))


def test_append_and_read(spark, tmp_path):
    path = str(tmp_path / "h")
    results.append_results(frame(spark, row(1), row(2, day=None, month=None)), path)
    results.append_results(frame(spark, row(3, month="202512", day=dt.date(2025, 12, 1))), path)
    rows = results.read_results(spark, path)
    assert rows.schema["data_month"].dataType.simpleString() == "string"
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]
    assert [r["data_month"] for r in rows.filter("id = 2").collect()] == [None]
    since = results.read_results(spark, path, since="2026-01-01")
    for pruned, ids in (
        (since, [1, 2]),  # a row without day and month goes by the time it was made
        (results.read_results(spark, path, data_date="20251201"), [3]),
        (results.read_results(spark, path, data_month="202603"), [1]),
    ):
        assert sorted(r["id"] for r in pruned.collect()) == ids
        plan = str(pruned._jdf.queryExecution())
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_json_defaults(spark):
    texts = ['{"row_count": 5, "errors": null}', "{}", "", None, "[1]", '{"row_count": "x"}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(results.count_result_from_json("t").alias("r")).select("r.*").collect()
    assert [r["row_count"] for r in got] == [5, -1, -1, -1, -1, -1]
    assert all((r["status"], r["file_count"], r["errors"]) == ("failed", 0, []) for r in got)


def test_path_error(spark):
    r = spark.range(1).select(results.path_error_result(F.lit("/p"), F.lit("no")).alias("r")).first()["r"]
    assert (r["row_count"], r["status"], [tuple(e) for e in r["errors"]]) == (-1, "failed", [("", "no")])
