import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from laketally import sources
from laketally.operators import history, results
from laketally.operators.tasks import completed_tasks
from laketally.sources import task_log_window
from laketally.streaming import (
    audit_stream,
    completed_task_stream,
    first_completions,
    task_history_stream,
)

LOG = "task_name string, period_type string, batch_no string, state int, complete_dt timestamp"
T0 = dt.datetime(2026, 3, 9, 1)


@pytest.fixture
def source(spark, tmp_path):
    """(add a file of log rows, a stream that reads one file per batch)."""
    folder = tmp_path / "log"
    folder.mkdir()
    n = iter(range(1000))

    def add(*rows):
        # (task, batch, minutes after T0[, state])
        data = [(r[0], "daily", r[1], r[3] if len(r) > 3 else 1, T0 + dt.timedelta(minutes=r[2])) for r in rows]
        names = ["task_name", "period_type", "batch_no", "state", "complete_dt"]
        t = pa.table({c: list(v) for c, v in zip(names, zip(*data))})
        types = {"state": pa.int32(), "complete_dt": pa.timestamp("us", "UTC")}
        t = pa.table({c: t[c].cast(types[c]) if c in types else t[c] for c in names})
        pq.write_table(t, folder / f"{next(n):04d}.parquet")

    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return add, stream


def drain(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()


def tasks_of(df):
    return sorted((r["task_name"], r["batch_no"]) for r in df.collect())


def test_history_stream_keeps_late_rows(spark, source, tmp_path):
    add, stream = source
    path, check = str(tmp_path / "h"), str(tmp_path / "c")
    add(("a", "20260309", 50), ("b", "20260309", 51), ("c", "20260309", 51, 0))
    drain(task_history_stream(stream, path, check))
    add(("a", "20260309", 10), ("a", "20260308", -5000))
    drain(task_history_stream(stream, path, check))
    drain(task_history_stream(stream, path, check))
    rows = spark.read.parquet(path)
    assert rows.count() == 4
    assert tasks_of(first_completions(rows)) == [("a", "20260308"), ("a", "20260309"), ("b", "20260309")]


def test_dedup_within_the_delay(spark, source, tmp_path):
    add, stream = source
    path, check = str(tmp_path / "d"), str(tmp_path / "c")
    for minute in (0, 2, 4):
        add(*[(f"t{i}", "20260309", minute) for i in range(50)])
    writer = completed_task_stream(stream).writeStream.format("parquet")
    drain(writer.option("path", path).option("checkpointLocation", check))
    assert tasks_of(spark.read.parquet(path)) == sorted((f"t{i}", "20260309") for i in range(50))


def test_where_batch_and_stream_differ(spark, source, tmp_path):
    """On one log the history stream equals the batch; the deduplicating
    stream lacks what came later than its delay."""
    add, stream = source
    add(("a", "20260309", 0), ("b", "20260309", 3))
    add(("a", "20260309", 5), ("c", "20260309", 60))
    add(("d", "20260309", 61))  # a batch on, as Spark drops late rows by the mark before
    add(("b", "20260309", 62), ("late", "20260308", 1), ("d", "20260309", 63))
    history_path, dedup_path = str(tmp_path / "h"), str(tmp_path / "d")
    drain(task_history_stream(stream, history_path, str(tmp_path / "hc")))
    once = completed_task_stream(stream, delay="10 minutes").writeStream.format("parquet")
    drain(once.option("path", dedup_path).option("checkpointLocation", str(tmp_path / "dc")))

    log = spark.read.schema(LOG).parquet(str(tmp_path / "log"))
    batch = completed_tasks(task_log_window(log, T0, T0 + dt.timedelta(hours=2)))
    everything = tasks_of(batch)
    assert [t for t, _ in everything] == ["a", "b", "c", "d", "late"]
    assert tasks_of(first_completions(spark.read.parquet(history_path))) == everything
    streamed = tasks_of(spark.read.parquet(dedup_path))
    assert ("late", "20260308") not in streamed
    # The state of `b` had expired by its repeat an hour later.
    assert streamed.count(("b", "20260309")) == 2
    assert set(streamed) == set(everything) - {("late", "20260308")}


def test_cold_start_skips_history(spark, source, tmp_path):
    add, stream = source
    path = str(tmp_path / "h")
    add(("a", "20260309", -1), ("b", "20260309", 0))
    drain(task_history_stream(stream, path, str(tmp_path / "c"), init_time=T0))
    assert tasks_of(spark.read.parquet(path)) == [("b", "20260309")]


def test_failed_batch_is_replayed(spark, source, tmp_path):
    add, stream = source
    entry = {"name": "ods.t", "hdfs_path": f"{tmp_path}/lake", "format": "parquet", "partition_template": "ymd=${data_date}"}
    config = sources.schedules_from_dicts(spark, [{"task_name": "t", "tables": [entry]}])
    ticks = iter(range(1000))

    def start():
        return audit_stream(
            stream,
            config,
            f"{tmp_path}/results",
            f"{tmp_path}/check",
            errors_path=f"{tmp_path}/errors",
            clock=lambda: dt.datetime(2026, 3, 10) + dt.timedelta(minutes=next(ticks)),
        )

    def lake(day, rows):
        folder = tmp_path / "lake" / f"ymd={day}"
        folder.mkdir(parents=True)
        pq.write_table(pa.table({"x": list(range(rows))}), folder / "f")

    add(("t", "20260307", 1), ("t", "20260307", 2))
    add(("t", "20260308", 3))
    add(("t", "20260309", 4))
    lake("20260307", 1)
    lake("20260309", 3)
    with pytest.raises(StreamingQueryException, match="1 failed, 0 partial"):
        drain(start())
    rows = results.read_results(spark, f"{tmp_path}/results")
    assert sorted((r["batch_no"], r["status"]) for r in rows.collect()) == [
        ("20260307", "success"), ("20260308", "failed"),
    ]

    errors = spark.read.parquet(f"{tmp_path}/errors").collect()
    assert [e["hdfs_path"] for e in errors] == [f"{tmp_path}/lake/ymd=20260308"]

    lake("20260308", 2)
    drain(start())
    rows = results.read_results(spark, f"{tmp_path}/results")
    assert rows.count() == 4
    newest = history.latest_per_table(rows).orderBy("batch_no").collect()
    assert [(r["batch_no"], r["row_count"], r["status"]) for r in newest] == [
        ("20260307", 1, "success"), ("20260308", 2, "success"), ("20260309", 3, "success"),
    ]
