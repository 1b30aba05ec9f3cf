"""The log of finished scheduler tasks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketally.functions._cols import col
from laketally.functions.dates import as_timestamp


def read_task_log(spark: SparkSession, path=None, *, format="parquet", columns=None, **options):
    """Read a task log from files or, with `format="jdbc"`, from a database.

    `columns` maps our column names to the source's, for example
    `{"task_name": "job_code", "period_type": "batch_type"}`. Filters put on
    the result reach the source through the renaming.
    """
    reader = spark.read.format(format).options(**options)
    log = reader.load(path) if path else reader.load()
    names = {source: ours for ours, source in (columns or {}).items()}
    return log.select([F.col(c).alias(names.get(c, c)) for c in log.columns])


def task_log_window(
    log: DataFrame,
    start,
    end,
    *,
    state_col="state",
    done=1,
    time_col="complete_dt",
    data_date=None,
    date_filter=None,
) -> DataFrame:
    """Finished tasks of the half-open window [start, end).

    The bounds are plain comparisons, so they are pushed into a Parquet or
    JDBC source. `date_filter(data_date)` builds an extra condition for an
    optional business date; an absent date is passed as the empty string.
    """
    kept = log.filter(
        (col(state_col) == F.lit(done))
        & (col(time_col) >= as_timestamp(start))
        & (col(time_col) < as_timestamp(end))
    )
    if date_filter is not None:
        kept = kept.filter(date_filter(data_date or ""))
    return kept


def task_log_distinct(
    log: DataFrame, start, end, *, status_col="status", done="SUCCESS", time_col="end_time"
) -> DataFrame:
    """Names only: each task once, with an empty batch and no date parts."""
    names = task_log_window(
        log, start, end, state_col=status_col, done=done, time_col=time_col
    ).select("task_name")
    return with_no_batch(names.distinct())


def with_no_batch(names: DataFrame) -> DataFrame:
    """Completed-task rows of tasks known by name alone."""
    null = F.lit(None).cast("string")
    return names.select(
        "task_name",
        null.alias("period_type"),
        F.lit("").alias("batch_no"),
        null.alias("data_date"),
        null.alias("data_month"),
        null.alias("data_hour"),
    )
