"""First completions of a log out of order, with restarts and late rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from laketally.operators import tasks
from laketally.streaming import first_completion as fc

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "task_name string, period_type string, batch_no string, state int, complete_dt timestamp, event_id long"


@pytest.fixture()
def session(spark):
    other = spark.newSession()
    other.conf.set(fc.PROVIDER, fc.ROCKSDB)
    other.conf.set("spark.sql.shuffle.partitions", "2")
    return other


def row(task, minute, event_id, batch="b", period="daily", state=1):
    return task, period, batch, state, T0 + dt.timedelta(minutes=minute), event_id


def arrive(spark, folder, rows):
    """One more file of the log; files are read in the order they come in."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, tmp_path, **options):
    log = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    rows = fc.first_completion_stream(log, tie="event_id", **options)
    writer = fc.write_first_completions(rows, str(tmp_path / "out"), str(tmp_path / "check"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def test_out_of_order_equals_batch(session, tmp_path):
    """Disorder within the delay: the firsts are those of the whole log; one restart for every file."""
    rng = random.Random(5)
    rows = [row(rng.choice("abcdef"), rng.randint(0, 400), i, rng.choice(["", "x", None]), state=rng.choice([0, 1, 1])) for i in range(200)]
    arrival = sorted(rows, key=lambda r: r[4] + dt.timedelta(minutes=rng.randint(0, 59)))
    for k in range(0, 200, 50):
        arrive(session, tmp_path / "log", arrival[k : k + 50])
        run(session, tmp_path, delay="60 minutes")
    arrive(session, tmp_path / "log", [row("end", 2000, 999)])
    out = run(session, tmp_path, delay="60 minutes")
    whole = session.createDataFrame(rows, SCHEMA).where("state = 1")
    want = tasks.completed_tasks(whole, order_by=("complete_dt", "event_id"))
    got = fc.told_first(session, str(tmp_path / "out")).where("task_name <> 'end'")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert out.where("kind = 'late'").count() == 0
    assert out.where("task_name <> 'end'").count() == whole.count()


def test_late_rows_are_kept(session, tmp_path):
    log = tmp_path / "log"
    arrive(session, log, [row("a", 100, 1), row("b", 100, 2)])
    arrive(session, log, [row("z", 200, 3), row("d", 170, 8)])
    arrive(session, log, [row("d", 165, 9)])  # in the batch whose watermark passes its key: still the first
    arrive(session, log, [row("a", 90, 4), row("a", 150, 5), row("c", 120, 6)])
    arrive(session, log, [row("z", 260, 7)])
    out = run(session, tmp_path, delay="10 minutes")
    kinds = sorted((r.task_name, r.tie, r.kind) for r in out.collect())
    assert kinds[:5] == [("a", 1, "first"), ("a", 4, "late"), ("a", 5, "repeat"), ("b", 2, "first"), ("c", 6, "first")]
    assert kinds[5:7] == [("d", 8, "repeat"), ("d", 9, "first")]
    late = fc.late_rows(session, str(tmp_path / "out")).collect()
    assert [(r.task_name, r.complete_dt) for r in late] == [("a", T0 + dt.timedelta(minutes=90))]


def test_state_expires(session, tmp_path):
    """A key is remembered for `keep`; then a rerun is a first again, and an old row late."""
    log, keep = tmp_path / "log", dt.timedelta(minutes=60)
    for rows in ([row("a", 0, 1)], [row("z", 100, 2)], [row("z", 300, 3)], [row("a", 320, 4), row("q", 10, 5)], [row("z", 600, 6)]):
        arrive(session, log, rows)
    out = run(session, tmp_path, delay="10 minutes", keep=keep)
    kinds = {(r.task_name, r.tie): r.kind for r in out.collect()}
    assert kinds[("a", 1)] == kinds[("a", 4)] == "first" and kinds[("q", 5)] == "late"


def test_told_again_waits_for_the_watermark(session, tmp_path):
    """A key that is forgotten as it comes again is held like any other; here an earlier row is still on time."""
    log, keep = tmp_path / "log", dt.timedelta(minutes=60)
    for rows in ([row("a", 0, 1)], [row("z", 40, 2)], [row("z", 41, 3)], [row("z", 300, 4)], [row("a", 320, 5)], [row("a", 315, 6)], [row("z", 400, 7)]):
        arrive(session, log, rows)
    out = run(session, tmp_path, delay="10 minutes", keep=keep)
    assert sorted((r.tie, r.kind) for r in out.where("task_name = 'a'").collect()) == [(1, "first"), (5, "repeat"), (6, "first")]


def test_keys_share_state(session, tmp_path, monkeypatch):
    """Calls to the state store follow the groups of keys, not the keys; no null and no large number is changed in it."""
    monkeypatch.setattr(fc, "GROUPS", 8, raising=False)
    big = 2**53
    arrive(session, tmp_path / "log", [row(f"é\"{i}" if i else None, i % 7, big + i, f"\n{i}") for i in range(200)])
    arrive(session, tmp_path / "log", [row("z", 100, 0)])
    log = session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    rows = fc.first_completion_stream(log, tie="event_id")
    query = fc.write_first_completions(rows, str(tmp_path / "out"), str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert max(p.stateOperators[0].customMetrics["numRegisteredTimers"] for p in query.recentProgress) <= 8
    firsts = session.read.parquet(str(tmp_path / "out")).where("kind = 'first' AND tie > 0").collect()
    assert sorted((r.tie - big, r.task_name, r.batch_no) for r in firsts) == [(i, f"é\"{i}" if i else None, f"\n{i}") for i in range(200)]


def test_needs_rocksdb(spark):
    other = spark.newSession()
    log = other.readStream.format("rate").load().select(F.lit("a").alias("task_name"))
    other.conf.set(fc.PROVIDER, "none")
    with pytest.raises(ValueError, match="providerClass"):
        fc.first_completion_stream(log)
