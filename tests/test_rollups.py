"""The maintained rollup against the whole history, and its commits."""

import datetime as dt
import random

import pytest

from laketally.operators import history
from laketally.plans import rollups
from laketally.plans.commits import Taken, commit, last_commit, last_number

SCHEMA = rollups.NEWEST


def rows(rng, n, start):
    out = []
    for i in range(n):
        day = None if rng.random() < 0.1 else dt.date(2026, rng.choice([1, 2, 3, 3]), rng.randint(1, 28))
        out.append((start + i, f"t{rng.randrange(5)}", rng.choice(["1", "2"]), day, rng.choice([-1, 0, 5, 70]),
                    rng.choice(["success", "failed", "partial"]), dt.datetime(2026, 4, 1, rng.randrange(3))))
    return out


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_runs_add_up_to_the_history(spark, tmp_path):
    """Runs with repeats, older rows that arrive later, and one applied twice."""
    rng, path, seen = random.Random(2), str(tmp_path / "r"), []
    for k in range(5):
        run = rows(rng, 60, 100 * k)
        if k:
            run += seen[:10]
        seen += run
        df = spark.createDataFrame(run, SCHEMA)
        rollups.apply_run(spark, path, df)
        if k == 2:
            rollups.apply_run(spark, path, df)
        whole = spark.createDataFrame(sorted(set(seen), key=str), SCHEMA)
        assert collected(rollups.read_daily(spark, path)) == collected(history.daily_rollup(whole))
        assert collected(rollups.read_newest(spark, path)) == collected(history.latest_per_table_platform(whole).select(*rollups.read_newest(spark, path).columns))
    recent = rollups.read_daily(spark, path, "2026-03-10")
    assert collected(recent) == collected(history.daily_rollup(whole, "2026-03-10"))
    assert all("month=202603" in f for f in recent.inputFiles())


def test_only_touched_months_are_read_and_written(spark, tmp_path):
    path = str(tmp_path / "r")
    row = lambda i, month: (i, "t", "1", dt.date(2026, month, 3), 1, "success", dt.datetime(2026, 4, 1))
    rollups.apply_run(spark, path, spark.createDataFrame([row(1, 1), row(2, 2)], SCHEMA))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "r").rglob("*.parquet")}
    rollups.apply_run(spark, path, spark.createDataFrame([row(3, 2)], SCHEMA))
    state = last_commit(spark, f"{path}/_commits")[1]["months"]
    assert {month: version.split("-")[0] for month, version in state.items()} == {"202601": "1", "202602": "2"}
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert {p.parent.name for p in (tmp_path / "r" / "daily").glob("version=2-*/*/*.parquet")} == {"month=202602"}


def test_uncommitted_version_is_invisible_and_written_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    rng = random.Random(1)
    first, second = (spark.createDataFrame(rows(rng, 30, k), SCHEMA) for k in (0, 50))
    rollups.apply_run(spark, path, first)
    before = collected(rollups.read_daily(spark, path))

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(rollups, "commit", broken)
    with pytest.raises(RuntimeError, match="lost"):
        rollups.apply_run(spark, path, second)
    assert collected(rollups.read_daily(spark, path)) == before
    monkeypatch.undo()
    rollups.apply_run(spark, path, second)
    assert collected(rollups.read_daily(spark, path)) == collected(history.daily_rollup(first.union(second)))


def test_a_commit_between_is_not_lost(spark, tmp_path, monkeypatch):
    """Another job commits while a run is applied: the run starts again from there."""
    path, rng = str(tmp_path / "r"), random.Random(3)
    first, second = (spark.createDataFrame(rows(rng, 30, k), SCHEMA) for k in (0, 50))
    write, calls = rollups._write_version, []

    def slow(*args):
        write(*args)
        if not calls:
            calls.append(1)
            rollups.apply_run(spark, path, first)

    monkeypatch.setattr(rollups, "_write_version", slow)
    rollups.apply_run(spark, path, second)
    assert collected(rollups.read_daily(spark, path)) == collected(history.daily_rollup(first.union(second)))
    assert last_number(spark, f"{path}/_commits") == 2


def test_empty_run_and_empty_rollup(spark, tmp_path):
    path = str(tmp_path / "r")
    assert rollups.read_daily(spark, path).count() == 0
    assert rollups.apply_run(spark, path, spark.createDataFrame([], SCHEMA)) == 0


def test_commits_are_exclusive(spark, tmp_path):
    folder = str(tmp_path / "c")
    assert last_commit(spark, folder) == (0, {})
    commit(spark, folder, 1, {"a": "é"})
    with pytest.raises(Taken):
        commit(spark, folder, 1, {"a": 2})
    assert last_commit(spark, folder) == (1, {"number": 1, "a": "é"})
    (tmp_path / "c" / "000000000002.json").write_text("")  # a writer that died
    assert last_commit(spark, folder) == (2, {"number": 1, "a": "é"})
