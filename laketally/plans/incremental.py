"""The incremental window over the task log and the mark it starts from."""

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laketally.functions._cols import col
from laketally.functions.dates import as_timestamp
from laketally.schemas import STATE


@dataclass(frozen=True)
class WindowSettings:
    overlap_seconds: int = 600
    max_window_hours: float = 24.0  # 0 or less: no limit
    lookback_hours: float = 24.0
    advance_on_failure: bool = False

    @classmethod
    def resolve(cls, config=None, **explicit):
        """Settings from a configuration; an explicit argument wins over it."""
        known = cls.__dataclass_fields__
        given = {k: v for k, v in (config or {}).items() if k in known and v is not None}
        given |= {k: v for k, v in explicit.items() if v is not None}
        return cls(**given)


def _seconds(n) -> Column:
    return F.make_dt_interval(secs=F.lit(str(n)).cast("decimal(18,6)"))


def whole_second(ts) -> Column:
    """The timestamp without its fraction; keeps its type."""
    c = col(ts)
    return c - F.make_dt_interval(secs=(F.extract(F.lit("SECOND"), c) % 1).cast("decimal(18,6)"))


def window_bounds(last_end, now, settings: WindowSettings = WindowSettings()) -> Column:
    """Struct (start_time, end_time) of the next window, in whole seconds.

    From the mark minus the overlap up to now, at most `max_window_hours` past
    the mark itself. Without a mark, or when the mark lies ahead of now, the
    window is the lookback.
    """
    mark, now = col(last_end), col(now)
    lookback = _seconds(settings.lookback_hours * 3600)
    end = now
    if settings.max_window_hours > 0:
        # least() skips NULL, so without a mark the end is now.
        end = F.least(now, mark + _seconds(settings.max_window_hours * 3600))
    start = mark - _seconds(max(0, int(settings.overlap_seconds)))
    start = F.when(start < end, start).otherwise(end - lookback)
    return F.struct(whole_second(start).alias("start_time"), whole_second(end).alias("end_time"))


def is_capped(last_end, now, settings: WindowSettings = WindowSettings()) -> Column:
    """True when the window ends before now because of `max_window_hours`."""
    if settings.max_window_hours <= 0:
        return F.lit(False)
    limit = col(last_end) + _seconds(settings.max_window_hours * 3600)
    return F.coalesce(limit < col(now), F.lit(False))


def advances(
    total,
    failed,
    partial,
    fetched,
    *,
    dry_run=False,
    explicit=False,
    advance_on_failure=False,
) -> Column:
    """Whether a run may move the mark to the end of its window.

    A run of jobs moves it when all of them succeeded, or failures are allowed.
    A run without jobs moves it only when the log had no task at all. Dry runs
    and explicitly named tasks never move it.
    """
    dry_run, explicit, allowed = (
        c if isinstance(c, Column) else F.lit(bool(c))
        for c in (dry_run, explicit, advance_on_failure)
    )
    clean = (col(failed) == 0) & (col(partial) == 0)
    ran = (col(total) > 0) & (allowed | clean)
    idle = (col(total) == 0) & (col(fetched) == 0)
    return (ran | idle) & ~dry_run & ~explicit


def stalls(total, fetched, capped) -> Column:
    """True when the next window will be the same one again: the window is
    capped and none of the tasks in it is configured."""
    return (col(total) == 0) & (col(fetched) > 0) & col(capped)


def latest_state(states: DataFrame, by=()) -> DataFrame:
    """The mark saved last; NULL after a reset or when nothing is readable.

    Marks go by their number `seq`, those without one first. These go by when
    they were saved, and a mark that does not say so counts from its own time.
    """
    seq = F.coalesce("seq", F.lit(0)) if "seq" in states.columns else F.lit(0)
    saved = F.struct(seq, F.coalesce("updated_at", "last_end_time"), "last_end_time")
    return states.groupBy(*by).agg(F.max_by("last_end_time", saved).alias("last_end_time"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The saved marks, one JSON object per file. Unreadable ones become NULLs."""
    return spark.read.schema(STATE).option("multiLine", "true").json(path)


def load_mark(spark: SparkSession, path: str) -> dt.datetime | None:
    """The mark to start from, as wall-clock time of the session's zone.

    None when there is none, it was reset or cannot be read.
    """
    try:
        mark = latest_state(read_state(spark, path))
        return mark.select(F.col("last_end_time").cast("timestamp_ntz")).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def save_mark(spark: SparkSession, path: str, last_end, updated_at) -> None:
    """Append a mark, numbered one above the last. A reset appends one with a
    NULL `last_end`. Files of older marks may be deleted at any time."""
    try:
        last = read_state(spark, path).agg(F.max("seq")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = 0
    times = {"last_end_time": last_end, "updated_at": updated_at}
    row = spark.range(1).select(
        *[as_timestamp(t).cast("timestamp").alias(c) for c, t in times.items()],
        F.lit(last + 1).cast("long").alias("seq"),
    )
    row.write.mode("append").json(path)
