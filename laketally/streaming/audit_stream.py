"""Streams over the task log. The checkpoint takes the place of the mark."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketally.functions.dates import as_timestamp
from laketally.operators.jobs import audit_jobs
from laketally.operators.results import append_errors, append_results, errors_beside, run_summary
from laketally.operators.tasks import completed_tasks, log_rows, with_date_parts
from laketally.plans.audit import audit_results
from laketally.plans.scratch import stored


def _finished(log: DataFrame, done, init_time) -> DataFrame:
    """Finished tasks; `init_time` leaves out the history before a cold start."""
    kept = log.filter(F.col("state") == F.lit(done))
    if init_time is not None:
        kept = kept.filter(F.col("complete_dt") >= as_timestamp(init_time))
    return kept


def completed_task_stream(log: DataFrame, *, delay="10 minutes", done=1, init_time=None):
    """Each (task, batch) once, as long as repeats arrive within `delay`.

    State is kept for the delay only. Rows later than that are dropped, so the
    delay must cover the source's lateness; `task_history_stream` drops none.
    """
    tasks = log_rows(_finished(log, done, init_time))
    once = tasks.withWatermark("complete_dt", delay).dropDuplicatesWithinWatermark(
        ["task_name", "batch_no"]
    )
    return with_date_parts(once)


def task_history_stream(log: DataFrame, path: str, checkpoint: str, *, done=1, init_time=None):
    """Append every finished log row to a table; no state, nothing dropped.

    Repeats are resolved when the table is read, by `first_completions`. The
    file sink commits each micro-batch exactly once.
    """
    return (
        _finished(log, done, init_time)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def first_completions(history: DataFrame, *, order_by=("complete_dt",)) -> DataFrame:
    """The first row of each (task, batch) of a streamed history."""
    return completed_tasks(history, order_by=order_by)


class AuditFailed(Exception):
    """A micro-batch had failed or partial paths and will be replayed."""


def audit_stream(
    log: DataFrame,
    schedules: DataFrame,
    results_path: str,
    checkpoint: str,
    *,
    errors_path: str | None = None,
    clock=lambda: dt.datetime.now(dt.timezone.utc),
    done=1,
    init_time=None,
    advance_on_failure=False,
    order_by=("complete_dt",),
    by_pattern=False,
    **count_options,
):
    """Audit each micro-batch of the log and append its result rows.

    A batch with failed or partial paths raises after its rows are written, so
    its offset is not committed and it is audited again on restart; the history
    keeps both rows and readers take the newest. Returns the stream writer;
    the caller sets the trigger and starts it.
    """

    def audit_batch(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        done_tasks = stored(completed_tasks(batch, order_by=order_by), "tasks")
        jobs = stored(audit_jobs(schedules, done_tasks, now, by_pattern=by_pattern), "jobs")
        if jobs.isEmpty():
            return
        rows, errors = audit_results(jobs, now, **count_options)
        rows = stored(rows, "results")
        append_results(rows, results_path)
        append_errors(errors, errors_path or errors_beside(results_path), now)
        s = run_summary(rows).first()
        if not advance_on_failure and s["failed"] + s["partial"] > 0:
            raise AuditFailed(f"batch {batch_id}: {s['failed']} failed, {s['partial']} partial")

    return (
        _finished(log, done, init_time)
        .writeStream.foreachBatch(audit_batch)
        .option("checkpointLocation", checkpoint)
    )
