"""The first completion of every (task, batch) of a log that arrives out of order.

A key's earliest row is held until the watermark has passed it, so that no
earlier one can still be on time, and is then emitted. What comes after that is
not dropped: a row that would have been the first is `late`, any other a
`repeat`. Every finished row of the log leaves the stream exactly once.

Keys share state by the hash of their names: a call from Python to the state
store costs far more than a row, so a group of keys is read and written at once.
"""

import datetime as dt
import json
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from laketally.operators.tasks import log_rows, with_date_parts
from laketally.streaming.audit_stream import _finished

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# `at` in microseconds since 1970, so that no zone comes in; `tie` as text, since pandas has no whole numbers with nulls.
ROW = "task_name string, batch_no string, at long, tie string, period_type string"
OUTPUT = f"{ROW}, kind string"
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]
FIRST, REPEAT, LATE = "first", "repeat", "late"

# Fixed values for the life of a checkpoint: groups of keys, and into how many parts `keep` cuts what a group remembers.
GROUPS, SLICES = 1024, 8


class FirstCompletion(StatefulProcessor):
    """State of a group of keys, rows as JSON lists of (task_name, batch_no, at, tie, period_type).

    `held` has the earliest row so far of every key that has not been told, and
    the one timer of the group. `told` has the rows that were emitted, by slices
    of their time: telling rewrites the slices it adds to, forgetting drops whole ones.
    """

    def __init__(self, keep: dt.timedelta):
        self.keep_ms = keep // dt.timedelta(milliseconds=1)
        self.slice_ms = max(1, self.keep_ms // SLICES)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows string, timer long")
        self.told = handle.getMapState("told", "slice long", "rows string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        oldest = timerValues.getCurrentWatermarkInMs() - self.keep_ms
        held, timer = self._held()
        told = {}
        for _, (text,) in self.told.iterator():
            told.update((k, row) for k, row in _rows(text) if row[0] // 1000 >= oldest)
        before = held.copy()
        for frame in rows:
            out = []
            for task, batch, at, tie, period in zip(*(frame[c].tolist() for c in COLUMNS[:-1]), strict=True):
                name, row = (task, batch), (int(at), None if tie is None else int(tie), period)
                first, best = told.get(name), held.get(name)
                if first is not None:
                    out.append((name, row, LATE if row < first else REPEAT))
                elif best is None and row[0] // 1000 < oldest:
                    out.append((name, row, LATE))  # its key may have been told and forgotten
                elif best is None or row < best:
                    if best is not None:
                        out.append((name, best, REPEAT))
                    held[name] = row
                else:
                    out.append((name, row, REPEAT))
            yield from _frames(out)
        if held != before:
            self._hold(held, timer, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A timer is a millisecond after the row it is for.
        passed = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        held, _ = self._held()
        tell = {name: row for name, row in held.items() if row[0] // 1000 + 1 <= passed}
        yield from _frames([(name, row, FIRST) for name, row in tell.items()])
        slices = defaultdict(list)
        for name, row in tell.items():
            slices[row[0] // 1000 // self.slice_ms].append((name, row))
        for n, rows in slices.items():
            old = self.told.getValue((n,))
            self.told.updateValue((n,), (_text([*(_rows(old[0]) if old else ()), *rows]),))
        kept = [n for (n,) in self.told.keys()]
        for n in [n for n in kept if self._forgotten(n) <= passed]:
            self.told.removeKey((n,))
            kept.remove(n)
        forget = min(map(self._forgotten, kept), default=None)
        self._hold({name: row for name, row in held.items() if name not in tell}, None, forget)

    def _forgotten(self, n: int) -> int:
        """When no row of a slice is remembered any more."""
        return (n + 1) * self.slice_ms + self.keep_ms + 1

    def _held(self) -> tuple[dict, int | None]:
        text, timer = self.held.get() or ("[]", None)
        return dict(_rows(text)), timer

    def _hold(self, held: dict, timer: int | None, later: int | None) -> None:
        """Store what is held. `timer` is set so far; the new one is that of the earliest row, or `later` if that comes first."""
        due = min([row[0] // 1000 + 1 for row in held.values()] + [later] * (later is not None), default=None)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if due is None:
            self.held.clear()
        else:
            self.held.update((_text(held.items()), due))

    def close(self) -> None:
        pass


def _frames(out: list) -> Iterator[pd.DataFrame]:
    if out:
        rows = [(*name, at, None if tie is None else str(tie), period, kind) for name, (at, tie, period), kind in out]
        yield pd.DataFrame(rows, columns=COLUMNS)


def _rows(text: str) -> Iterator[tuple[tuple, tuple]]:
    return (((task, batch), (at, tie, period)) for task, batch, at, tie, period in json.loads(text))


def _text(rows) -> str:
    return json.dumps([(*name, *row) for name, row in rows], ensure_ascii=False, separators=(",", ":"))


def first_completion_stream(
    log: DataFrame, *, delay="10 minutes", keep=dt.timedelta(days=7), tie=None, done=1, init_time=None
) -> DataFrame:
    """All finished rows as (task_name, batch_no, complete_dt, tie, period_type, kind).

    `delay` is how far rows may be out of order; a first row is emitted that much
    after it. Its key is remembered for `keep` of log time, and a row older than
    that without a remembered key is `late`. `tie` names a number column that
    orders rows of the same time; the period comes last.

    State lives in RocksDB, which the session must name as its state store.
    """
    spark = log.sparkSession
    if spark.conf.get(PROVIDER) != ROCKSDB:
        raise ValueError(f"set {PROVIDER} to {ROCKSDB}")
    tasks = log_rows(_finished(log, done, init_time))
    watermarked = tasks.withWatermark("complete_dt", delay).select(
        "task_name",
        "batch_no",
        # A computed column is no event time to Spark, which would drop late rows.
        F.unix_micros("complete_dt").alias("at"),
        (F.lit(0) if tie is None else F.col(tie)).cast("long").cast("string").alias("tie"),
        "period_type",
        F.pmod(F.xxhash64("task_name", "batch_no"), F.lit(GROUPS)).alias("group"),
    )
    told = watermarked.groupBy("group").transformWithStateInPandas(
        FirstCompletion(keep), OUTPUT, "append", "eventtime"
    )
    return told.select(
        "task_name", "batch_no", F.timestamp_micros("at").alias("complete_dt"), F.col("tie").cast("long").alias("tie"), "period_type", "kind"
    )


def write_first_completions(rows: DataFrame, path: str, checkpoint: str):
    """The stream writer of one table, a folder per kind; the caller starts it.

    The file sink commits each micro-batch exactly once.
    """
    return (
        rows.writeStream.format("parquet")
        .partitionBy("kind")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def told_first(spark: SparkSession, path: str) -> DataFrame:
    """The completed tasks of such a table, with their date parts."""
    return with_date_parts(spark.read.parquet(path).where(F.col("kind") == FIRST))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late to be first, for a later reconciliation."""
    return spark.read.parquet(path).where(F.col("kind") == LATE).drop("kind")
