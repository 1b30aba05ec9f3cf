"""Result rows of a run, their sink and the run summary."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laketally.functions._cols import col
from laketally.functions.dates import as_timestamp, storage_date
from laketally.functions.text import normalise_delimiter
from laketally.operators.counting import PATH_KEYS
from laketally.schemas import AUDIT_RESULT, COUNT_RESULT

PARTITIONS = ["period_type", "data_month"]
#: What the history is looked up by besides its date.
LOOKUPS = ["task_name", "batch_no", "table_name", "partner_id", "interface_id", "platform_id"]


def count_result_from_json(text) -> Column:
    """A count result from its JSON text; absent fields get their defaults.

    Absent row_count is -1, absent status 'failed', other counts 0 and errors
    empty. Text that is not JSON gives all defaults.
    """
    r = F.from_json(col(text), COUNT_RESULT)
    defaults = {
        "path": F.lit(""),
        "row_count": F.lit(-1),
        "file_count": F.lit(0),
        "success_file_count": F.lit(0),
        "total_size_bytes": F.lit(0),
        "status": F.lit("failed"),
        "duration_ms": F.lit(0),
        "errors": F.array(),
    }
    return F.struct(
        *[
            F.coalesce(r[f.name], defaults[f.name].cast(f.dataType)).alias(f.name)
            for f in COUNT_RESULT.fields
        ]
    )


def path_error_result(path, error) -> Column:
    """The count result of a path that could not be counted at all."""
    zero = F.lit(0).cast("bigint")
    return F.struct(
        col(path).alias("path"),
        F.lit(-1).cast("bigint").alias("row_count"),
        zero.alias("file_count"),
        zero.alias("success_file_count"),
        zero.alias("total_size_bytes"),
        F.lit("failed").alias("status"),
        zero.alias("duration_ms"),
        F.array(F.struct(F.lit("").alias("file"), col(error).alias("error"))).alias("errors"),
    )


def result_rows(jobs: DataFrame, results: DataFrame, created_at) -> DataFrame:
    """One audit_result row per job: the job's columns and its path's counts.

    `created_at` is the time of the run, a datetime or a column. The id is a
    hash of that time and the job, so a retried task writes the same id. A job
    without a result is kept, as failed.
    """

    def filled(column, default):
        return F.coalesce(column, F.lit(default)).alias(column)

    created = F.date_trunc("second", as_timestamp(created_at).cast("timestamp"))
    keyed = jobs.withColumns(
        {"format": F.lower("format"), "delimiter": normalise_delimiter("delimiter")}
    )
    return keyed.join(results, PATH_KEYS, "left").select(
        F.xxhash64(
            created, "ord", "table_ord", "task_name", "batch_no", "hdfs_path", "format", "delimiter"
        ).alias("id"),
        "task_name",
        filled("interface_id", ""),
        filled("platform_id", ""),
        filled("partner_id", ""),
        "table_name",
        "hdfs_path",
        filled("period_type", "daily"),
        filled("batch_no", ""),
        storage_date("data_date").alias("data_date"),
        "data_month",
        "data_hour",
        filled("row_count", -1),
        filled("file_count", 0),
        filled("total_size_bytes", 0),
        filled("status", "failed"),
        F.when(F.size("errors") > 0, F.to_json("errors")).alias("error_msg"),
        filled("duration_ms", 0),
        created.alias("created_at"),
    )


def append_results(rows: DataFrame, path: str, *, more=()) -> None:
    """Append result rows to the history; all rows of one call appear or none.

    Errors and the mark are appended by calls of their own; `plans.runs` makes
    them visible together. `more` names columns kept besides a result's own.
    The history is partitioned by period and month. The rebalance hint gathers
    a partition's rows into few files and lets Spark split an overfull one. A
    file is sorted by task and batch and has Bloom filters on what lookups
    without a date ask for, so they read only the row groups that may hold it.
    """
    columns = [f.name for f in AUDIT_RESULT.fields]
    bloom = {f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKUPS}
    (
        rows.select(*columns, *more)
        .hint("rebalance", *PARTITIONS)
        .sortWithinPartitions(*PARTITIONS, "task_name", "batch_no")
        .write.mode("append")
        .options(**bloom, **{"parquet.bloom.filter.adaptive.enabled": "true"})
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def errors_beside(results_path: str) -> str:
    """The error table of a history, unless another place is named."""
    return results_path.rstrip("/") + "_errors"


def append_errors(errors: DataFrame, path: str, created_at) -> None:
    """Append all errors of a run, one row each, beside the history."""
    created = as_timestamp(created_at).cast("timestamp")
    errors.withColumn("created_at", created).write.mode("append").parquet(path)


def read_results(spark: SparkSession, path: str, **which) -> DataFrame:
    """The history, or the part of it that `filtered_results` keeps."""
    return filtered_results(spark.read.schema(AUDIT_RESULT).parquet(path), **which)


def filtered_results(rows: DataFrame, *, since=None, data_date=None, data_month=None) -> DataFrame:
    """Results since a date, on a day or in a month, or all.

    `since` is an ISO date, `data_date` yyyyMMdd and `data_month` yyyyMM. Each
    also selects months, so the files of others are never opened. A row without
    a day is placed by its month, one without both by the time it was made.
    """
    month = F.col("data_month")
    if since is not None:
        first = F.lit(str(since)).cast("date")
        rows = rows.filter(month.isNull() | (month >= str(since).replace("-", "")[:6]))
        by_day = F.coalesce("data_date", F.to_date("created_at")) >= first
        rows = rows.filter((F.col("data_date").isNull() & month.isNotNull()) | by_day)
    if data_date is not None:
        rows = rows.filter(month.isNull() | (month == data_date[:6]))
        rows = rows.filter(F.col("data_date") == storage_date(F.lit(data_date)))
    if data_month is not None:
        rows = rows.filter(month == data_month)
    return rows


def append_jdbc(rows: DataFrame, url: str, table: str, **options) -> None:
    """Append result rows to a database table, whose own key makes the id."""
    columns = [f.name for f in AUDIT_RESULT.fields if f.name != "id"]
    writer = rows.select(*columns).write.format("jdbc").mode("append")
    writer.options(url=url, dbtable=table, **options).save()


def summary_counts() -> list[Column]:
    """total, success, partial, failed; any other status counts as failed."""
    good = F.coalesce(F.col("status").isin("success", "partial"), F.lit(False))
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "partial").alias("partial"),
        F.count_if(~good).alias("failed"),
    ]


def run_summary(rows: DataFrame, by=()) -> DataFrame:
    """The `summary_counts` of results, of all or by some columns."""
    return rows.groupBy(*by).agg(*summary_counts())
