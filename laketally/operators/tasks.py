"""Completed tasks: one row per (task, batch), whatever the source."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laketally.functions._cols import or_default
from laketally.functions.batches import parse_batch_no
from laketally.sources.task_log import with_no_batch


def log_rows(log: DataFrame) -> DataFrame:
    """Log rows with defaults: period 'daily', batch ''. Nothing is trimmed."""
    return log.withColumns(
        {
            "period_type": or_default("period_type", "daily"),
            "batch_no": F.coalesce("batch_no", F.lit("")),
        }
    )


def completed_tasks(log: DataFrame, *, order_by=("complete_dt",)) -> DataFrame:
    """The first log row of every (task, batch), with its date parts.

    The batch is compared as it stands in the log. `order_by` says what comes
    first; the period breaks remaining ties so that the result is fixed.
    """
    first = Window.partitionBy("task_name", "batch_no").orderBy(*order_by, "period_type")
    return with_date_parts(
        log_rows(log).withColumn("n", F.row_number().over(first)).filter("n = 1")
    )


def with_date_parts(tasks: DataFrame) -> DataFrame:
    return parse_batch_no(tasks.select("task_name", "period_type", "batch_no"))


def fetch_stats(log: DataFrame) -> DataFrame:
    """Records, distinct tasks and distinct (task, batch) of a log."""
    per_batch = log_rows(log).groupBy("task_name", "batch_no").agg(F.count(F.lit(1)).alias("n"))
    per_task = per_batch.groupBy("task_name").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches")
    )
    return per_task.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.count(F.lit(1)).alias("tasks"),
        F.coalesce(F.sum("batches"), F.lit(0)).alias("task_batches"),
    )


def tasks_from_names(names: DataFrame) -> DataFrame:
    """Tasks known by name: each once, without a batch."""
    return with_no_batch(names.select("task_name").distinct())


def tasks_from_metadata(metadata: DataFrame) -> DataFrame:
    """Tasks given with their metadata, one batch or many per task."""
    return metadata.select(
        "task_name",
        "period_type",
        F.coalesce("batch_no", F.lit("")).alias("batch_no"),
        "data_date",
        "data_month",
        "data_hour",
    ).dropDuplicates(["task_name", "batch_no"])


def explicit_tasks(schedules: DataFrame, names) -> tuple[DataFrame, DataFrame]:
    """(tasks named that are configured, names that are not).

    `names` is a comma-separated string or a DataFrame with `task_name`.
    """
    if not isinstance(names, DataFrame):
        spark = schedules.sparkSession
        names = (
            spark.range(1)
            .select(F.explode(F.split(F.lit(names), ",")).alias("task_name"))
            .select(F.trim("task_name").alias("task_name"))
            .filter("task_name <> ''")
        )
    configured = schedules.select("task_name")
    return (
        tasks_from_names(names.join(configured, "task_name", "left_semi")),
        names.distinct().join(configured, "task_name", "left_anti"),
    )
