"""Lookups and rollups over the result history."""

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laketally.functions.dates import as_date


def _newest_first():
    # created_at has whole seconds; the id makes the order total.
    return [F.desc("created_at"), F.desc("id")]


def _same(column: str, value: str, ci: bool):
    """Equality; `ci` ignores case, accents and trailing blanks."""
    c = F.col(column)
    return F.collate(c, "UNICODE_CI_AI_RTRIM") == F.lit(value) if ci else c == value


def _on_day(day: str):
    if len(day) != 8 or not day.isdigit():
        raise ValueError(f"not a yyyyMMdd date: {day}")
    return F.col("data_date") == F.lit(dt.datetime.strptime(day, "%Y%m%d").date())


def _on_day_or_month(data_date, data_month):
    if data_date:
        return _on_day(data_date)
    if data_month:
        return F.col("data_month") == data_month
    raise ValueError("give a data_date or a data_month")


def latest_rows(rows: DataFrame, keys) -> DataFrame:
    """The newest row of each key. Spark drops older ones before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(*_newest_first())
    return rows.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")


def latest_per_table(rows: DataFrame, data_date: str | None = None) -> DataFrame:
    """The newest row per table and date, of one day or of all."""
    rows = rows if data_date is None else rows.filter(_on_day(data_date))
    return latest_rows(rows, ["table_name", "data_date"])


def latest_per_table_platform(rows: DataFrame) -> DataFrame:
    return latest_rows(rows, ["table_name", "platform_id", "data_date"])


def latest_result(
    rows: DataFrame, table_name, *, data_date=None, data_month=None, platform_id="", ci=False
) -> DataFrame:
    """The newest row of a table on a platform; a date wins over a month."""
    kept = rows.filter(_same("table_name", table_name, ci) & _same("platform_id", platform_id, ci))
    if data_date or data_month:
        kept = kept.filter(_on_day_or_month(data_date, data_month))
    return kept.orderBy(*_newest_first()).limit(1)


def results_by_partner(rows, partner_id, *, data_date=None, data_month=None, ci=False):
    kept = rows.filter(
        _same("partner_id", partner_id, ci) & _on_day_or_month(data_date, data_month)
    )
    return kept.orderBy("table_name", *_newest_first())


def results_by_interface(rows, interface_id, *, data_date=None, data_month=None, ci=False):
    kept = rows.filter(
        _same("interface_id", interface_id, ci) & _on_day_or_month(data_date, data_month)
    )
    return kept.orderBy("table_name", *_newest_first())


def results_by_batch(rows, batch_no, *, ci=False) -> DataFrame:
    return rows.filter(_same("batch_no", batch_no, ci)).orderBy("task_name", *_newest_first())


def results_by_period(rows, period_type, *, data_date=None, data_month=None, ci=False) -> DataFrame:
    """Monthly results of a month; results of any period on a date."""
    if period_type == "monthly" and data_month:
        when = F.col("data_month") == data_month
    elif data_date:
        when = _on_day(data_date)
    else:
        raise ValueError("monthly results need a data_month, others a data_date")
    return rows.filter(_same("period_type", period_type, ci) & when).orderBy(
        "task_name", *_newest_first()
    )


def since_days(rows: DataFrame, run_date, days=7) -> DataFrame:
    """Rows dated `days` before the run date or later, without an upper bound."""
    return rows.filter(F.col("data_date") >= F.date_sub(as_date(run_date), days))


def table_history(rows: DataFrame, table_name, run_date, *, days=7, ci=False) -> DataFrame:
    kept = since_days(rows, run_date, days).filter(_same("table_name", table_name, ci))
    return kept.orderBy(F.desc("data_date"), *_newest_first())


def failed_results(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("status") == "failed").orderBy(*_newest_first())


def results_by_platform(rows: DataFrame, platform_id, *, ci=False) -> DataFrame:
    return rows.filter(_same("platform_id", platform_id, ci)).orderBy(*_newest_first())


def recent_results(rows: DataFrame, n=10) -> DataFrame:
    newest = rows.orderBy(*_newest_first()).limit(n)
    return newest.select("task_name", "table_name", "row_count", "status", "created_at")


def _rollup(rows: DataFrame, by: str, total: str, *extra) -> DataFrame:
    """Counts and rows per day or month. `total_rows` includes the -1 of
    failed rows, `total_rows_counted` does not."""
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias(total),
        F.count_if(F.col("status") == "success").alias("success_count"),
        *extra,
        F.sum("row_count").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("row_count") >= 0, F.col("row_count"))), F.lit(0)).alias(
            "total_rows_counted"
        ),
    )


def daily_rollup(rows: DataFrame, run_date=None, *, days=7) -> DataFrame:
    """Per date, over the newest row of each table and platform.

    With a run date only the last `days` days count, else all.
    """
    rows = rows if run_date is None else since_days(rows, run_date, days)
    failed = F.count_if(F.col("status") == "failed").alias("failed_count")
    daily = _rollup(latest_per_table_platform(rows), "data_date", "total_tables", failed)
    return daily.orderBy(F.desc("data_date"))


def monthly_rollup(rows: DataFrame) -> DataFrame:
    """Per month, over all rows of monthly tasks, repeats included."""
    monthly = rows.filter(F.col("period_type") == "monthly")
    return _rollup(monthly, "data_month", "total_tasks").orderBy(F.desc("data_month"))
