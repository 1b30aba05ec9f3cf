"""The audit run: tasks -> jobs -> counts -> result rows -> summary -> mark."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from laketally.functions.dates import as_timestamp, resolve_named_date
from laketally.operators.counting import count_files, path_errors, path_results
from laketally.operators.jobs import audit_jobs, preview
from laketally.operators.results import append_errors, append_results, errors_beside, result_rows, summary_counts
from laketally.operators.tasks import completed_tasks, explicit_tasks, tasks_from_names
from laketally.plans.incremental import (
    WindowSettings,
    advances,
    is_capped,
    load_mark,
    save_mark,
    stalls,
    window_bounds,
)
from laketally.plans.runs import RunTable
from laketally.plans.scratch import stored
from laketally.sources.schedules import validate
from laketally.sources.task_log import task_log_window


@dataclass(frozen=True)
class Run:
    """What a run did. `tasks` are the completed tasks it started from and
    `details` its result rows, or the preview of a dry run."""

    tasks: DataFrame | None
    jobs: DataFrame | None
    details: DataFrame | None
    errors: DataFrame | None
    summary: dict
    window: tuple | None = None
    fetched: int = 0
    advanced: bool = False
    stalled: bool = False


EMPTY = {"total": 0, "success": 0, "partial": 0, "failed": 0}


def audit_results(jobs: DataFrame, created_at, *, by_class=False, **count_options):
    """(result rows, error rows) of the jobs; every distinct path counts once.

    `by_class` is for `path_results`, anything else for `count_files`.

    The per-file counts are stored first: totals and errors both read them, and
    the files should be opened once.
    """
    counts = stored(count_files(jobs, **count_options), "file-counts")
    return result_rows(jobs, path_results(counts, by_class=by_class), created_at), path_errors(counts)


def choose_tasks(schedules, *, log=None, bounds=None, names=None, all_configured=False, **window):
    """Completed tasks from the named tasks, else all configured ones, else
    the log window, else, without a log, all configured ones."""
    if names is not None:
        return explicit_tasks(schedules, names)[0]
    if all_configured or log is None:
        return tasks_from_names(schedules)
    return completed_tasks(task_log_window(log, *bounds, **window))


def run_audit(
    spark: SparkSession,
    schedules: DataFrame,
    *,
    now: dt.datetime,
    log: DataFrame | None = None,
    results_path: str | None = None,
    errors_path: str | None = None,
    state_path: str | None = None,
    runs_path: str | None = None,
    settings: WindowSettings = WindowSettings(),
    data_date: str | None = None,
    names=None,
    all_configured=False,
    dry_run=False,
    init_now=False,
    reset=False,
    by_pattern=False,
    count_options: dict | None = None,
    **window,
) -> Run:
    """One audit run at the time `now`. A dry run counts nothing and changes
    neither the history nor the mark.

    Results, errors and mark go to `results_path`, `errors_path` and
    `state_path`, or all to a run table at `runs_path`, where they appear
    together; a run that another one overtook raises `Taken` there.

    `by_pattern` lets names in the log fill date placeholders of configured
    names. `count_options` go to `audit_results`, anything else to `task_log_window`.
    """
    if runs_path and (results_path or errors_path or state_path):
        raise ValueError("a run table takes the place of the other paths")
    if not dry_run and results_path is None and runs_path is None:
        raise ValueError("results_path or runs_path is needed unless dry_run is set")
    validate(schedules)
    data_date = explicit_date(spark, data_date, now)
    explicit = names is not None
    from_log = log is not None and not explicit and not all_configured
    bounds, capped = None, False
    table = RunTable(spark, runs_path) if runs_path else None
    mark = None
    if from_log:
        if state_path and reset and not dry_run:
            save_mark(spark, state_path, None, now)
        if not reset:
            mark = table.mark() if table else load_mark(spark, state_path) if state_path else None
        if (state_path or table) and mark is None and init_now:
            if table and not dry_run:
                table.finish(now, now)
            elif not dry_run:
                save_mark(spark, state_path, now, now)
            return Run(None, None, None, None, EMPTY, advanced=not dry_run)
        bounds, capped = next_window(spark, mark, now, settings)

    done = choose_tasks(
        schedules,
        log=log if from_log else None,
        bounds=bounds,
        names=names,
        all_configured=all_configured,
        **({"data_date": data_date, **window} if from_log else {}),
    )
    # The log may grow while the run lasts; its jobs must not. What the run tells
    # is counted while its tables are written.
    tasks_seen, jobs_seen, rows_seen = Observation(), Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    done = stored(done, "tasks", tasks_seen, n)
    fetched = tasks_seen.get["n"]
    jobs = audit_jobs(schedules, done, now, explicit_date=data_date, by_pattern=by_pattern)
    if dry_run:
        summary = {**EMPTY, "total": jobs.count()}
        return Run(done, jobs, preview(jobs), None, summary, bounds, fetched)

    jobs = stored(jobs, "jobs", jobs_seen, n)
    rows = errors = None
    summary = dict(EMPTY)
    if jobs_seen.get["n"]:
        rows, errors = audit_results(jobs, now, **(count_options or {}))
        rows = stored(rows, "results", rows_seen, *summary_counts())
        if table:
            table.append(rows, errors, now)
        else:
            append_results(rows, results_path)
            append_errors(errors, errors_path or errors_beside(results_path), now)
        summary = rows_seen.get

    flags = spark.range(1).select(
        advances(
            *[F.lit(n) for n in (summary["total"], summary["failed"], summary["partial"], fetched)],
            advance_on_failure=settings.advance_on_failure,
        ).alias("advance"),
        stalls(F.lit(summary["total"]), F.lit(fetched), F.lit(capped)).alias("stalled"),
    ).first()
    advanced = bool(from_log and (state_path or table) and flags["advance"])
    if table and from_log:
        table.finish(bounds[1] if advanced else mark, now)
    elif table:
        table.finish_beside(now)
    elif advanced:
        save_mark(spark, state_path, bounds[1], now)
    stalled = from_log and flags["stalled"]
    return Run(done, jobs, rows, errors, summary, bounds, fetched, advanced, stalled)


def next_window(spark: SparkSession, mark, now, settings: WindowSettings):
    """((start, end), is it capped) of the window after a mark."""
    mark, now = (as_timestamp(t).cast("timestamp_ntz") for t in (mark, now))
    bounds, capped = window_bounds(mark, now, settings), is_capped(mark, now, settings)
    w = spark.range(1).select(bounds.alias("w"), capped.alias("capped")).first()
    return (w["w"]["start_time"], w["w"]["end_time"]), w["capped"]


def explicit_date(spark: SparkSession, data_date: str | None, now) -> str | None:
    """A given date as yyyyMMdd, `${yesterday}` and `${today}` filled in."""
    if data_date is None:
        return None
    d = spark.range(1).select(resolve_named_date(F.lit(data_date), now).alias("d")).first()["d"]
    if d["error"]:
        raise ValueError(d["error"])
    return d["data_date"]
