"""Audit jobs: completed tasks matched with the tables they wrote."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketally.functions.dates import resolve_dates
from laketally.functions.paths import has_placeholder, render_path
from laketally.operators.patterns import name_candidates
from laketally.sources.schedules import schedule_tables

JOB_COLUMNS = [
    "task_name",
    "interface_id",
    "platform_id",
    "partner_id",
    "period_type",
    "table_name",
    "hdfs_path",
    "format",
    "delimiter",
    "data_date",
    "data_month",
    "data_hour",
    "batch_no",
]


def _matched(tables: DataFrame, tasks: DataFrame) -> DataFrame:
    """Schedule rows joined with the batches of their task, periods side by side.

    Always by key, splitting a hot task. Spark takes schedules that come out of an
    array for as small as the file they were read from and would broadcast millions.
    """
    return tasks.withColumnRenamed("period_type", "log_period").join(tables.hint("merge"), "task_name")


def _same_period():
    unset = F.coalesce("log_period", F.lit("")) == ""
    return unset | (F.col("log_period") == F.col("period_type"))


def build_jobs(
    schedules: DataFrame, tasks: DataFrame, run_date, *, explicit_date=None, by_pattern=False
):
    """All jobs, those with an unfilled path included, plus `ord, table_ord`.

    Names are compared as they stand. `by_pattern` also matches configured
    names whose date placeholders the name in the log has filled in.
    """
    if by_pattern:
        tasks = name_candidates(tasks, schedules)
    matched = _matched(schedule_tables(schedules), tasks).filter(_same_period())
    dates = resolve_dates(
        "period_type",
        run_date,
        explicit=None if explicit_date is None else F.lit(explicit_date),
        data_date="data_date",
        data_month="data_month",
        data_hour="data_hour",
    )
    dated = matched.withColumn("d", dates).drop("data_date", "data_month", "data_hour")
    dated = dated.select("*", "d.data_date", "d.data_month", "d.data_hour")
    path = render_path(
        "base_path", "partition_template", "data_date", "data_month", "data_hour"
    )
    return dated.select(
        "ord",
        "table_ord",
        *[path.alias(c) if c == "hdfs_path" else F.col(c) for c in JOB_COLUMNS],
    )


def audit_jobs(schedules: DataFrame, tasks: DataFrame, run_date, **options):
    """The jobs that can run; options as for `build_jobs`."""
    jobs = build_jobs(schedules, tasks, run_date, **options)
    return jobs.filter(~has_placeholder("hdfs_path"))


def unresolved_jobs(schedules: DataFrame, tasks: DataFrame, run_date, **options):
    """The jobs left out because their path still has a placeholder."""
    jobs = build_jobs(schedules, tasks, run_date, **options)
    return jobs.filter(has_placeholder("hdfs_path"))


def period_mismatch(schedules: DataFrame, tasks: DataFrame) -> DataFrame:
    """Batches left out because log and schedule name different periods."""
    configured = schedules.select(
        "ord", "task_name", F.coalesce("period_type", F.lit("daily")).alias("period_type")
    )
    return (
        _matched(configured, tasks)
        .filter(~_same_period())
        .select("ord", "task_name", "batch_no", "period_type", "log_period")
    )


def unconfigured_tasks(schedules: DataFrame, tasks: DataFrame, *, by_pattern=False) -> DataFrame:
    """Tasks of the log that no schedule names, literally or by a pattern."""
    configured = schedules.select("task_name").hint("merge")
    if by_pattern:
        named = name_candidates(tasks, schedules).join(configured, "task_name", "left_semi")
        found = named.select(F.col("log_name").alias("task_name"), "batch_no")
        return tasks.join(found, ["task_name", "batch_no"], "left_anti")
    return tasks.join(configured, "task_name", "left_anti")


def preview(jobs: DataFrame) -> DataFrame:
    """What a dry run reports: the jobs, uncounted."""
    return jobs.select(
        F.col("table_name").alias("table"),
        F.col("hdfs_path").alias("path"),
        "interface_id",
        "platform_id",
        "partner_id",
        F.lit("dry_run").alias("status"),
    )

