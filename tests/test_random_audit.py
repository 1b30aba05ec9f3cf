"""Whole runs on random configurations, logs and lakes against plain Python."""

import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pyarrow.orc as orc
import pyarrow.parquet as pq
import pytest

from laketally import sources
from laketally.plans.audit import run_audit
from tests import rules

NOW = dt.datetime(2026, 3, 10, 12)
LOG = "task_name string, period_type string, batch_no string, state int, complete_dt timestamp_ntz"
PERIODS = ["hourly", "daily", "monthly", "minutely", None]
TEMPLATES = [
    "ymd=${data_date}", "/ym=${data_month}", "ymdh=${data_date}${data_hour}/", "d=${data_date}/h=${data_hour}",
    "", None, "p=${other}",
]


def make_schedules(rng, root):
    """Every table has a folder of its own, so a path has one format."""
    ids = iter(range(1000))

    def table():
        i = next(ids)
        return {
            "name": f"ods.t{i}",
            "hdfs_path": f"{root}/t{i}" + rng.choice(["", "/"]),
            "format": rng.choice(["orc", "ORC", "Parquet", "textfile", "csv"]),
            "partition_template": rng.choice(TEMPLATES),
        }

    return [
        {
            "task_name": f"k{rng.randrange(12)}",
            "period_type": rng.choice(PERIODS),
            "tables": [table() for _ in range(rng.randrange(4))],
        }
        for _ in range(20)
    ]


def make_log(rng):
    days = ["20260308", "20260309", "2026-03-09"]
    batches = [*days, "2026030907", "2026030923", "202602", "202603", "2026030", "", None]
    n = 150
    # Distinct times, so that the first run of a batch is not a matter of taste.
    minutes = rng.sample(range(20 * 60), n)
    return [
        (
            f"k{rng.randrange(14)}",
            rng.choice(PERIODS),
            rng.choice(batches),
            rng.choice([1, 1, 1, 0]),
            NOW - dt.timedelta(minutes=m + 1),
        )
        for m in minutes
    ]


def write_file(rng, path, format):
    """Write a file of the format, or of another; returns its rows or None."""
    path.parent.mkdir(parents=True, exist_ok=True)
    written = rng.choice([format] * 4 + ["textfile", "orc"])
    rows = rng.randrange(5)
    if written == "orc":
        orc.write_table(pa.table({"x": pa.array(range(rows), pa.int64())}), path)
    elif written == "parquet":
        pq.write_table(pa.table({"x": pa.array(range(rows), pa.int64())}), path)
    else:
        path.write_bytes(b"".join(rng.choice([b"a", b"\n"]) for _ in range(rng.randrange(12))))
    if format == "textfile":
        return rules.text_rows(path.read_bytes(), b"\n")
    return rows if written == format else None


def make_lake(rng, wanted):
    """Fill most of the wanted paths; returns path -> rows of its files."""
    lake = {}
    for path, format in sorted(wanted):
        if rng.random() < 0.25:
            continue
        folder = Path(path)
        folder.mkdir(parents=True, exist_ok=True)
        lake[path] = []
        for i in range(rng.randrange(4)):
            sub = rng.choice([folder, folder, folder / "s", folder / "s" / "_h", folder / ".h"])
            name = rng.choice([f"f{i}", f"f {i}", f"_f{i}"])
            rows = write_file(rng, sub / name, format)
            if not (name.startswith("_") or sub.name.startswith(("_", "."))):
                lake[path].append(rows)
    return lake


def outcome(path, format, lake):
    if format == "csv" or path not in lake:
        return -1, 0, "failed"
    good = [r for r in lake[path] if r is not None]
    files = len(lake[path])
    status = "success" if len(good) == files else "partial" if good else "failed"
    return sum(good), files, status


@pytest.mark.parametrize("seed", range(4))
def test_random_run(spark, tmp_path, seed):
    rng = random.Random(seed)
    config, log = make_schedules(rng, tmp_path), make_log(rng)
    planned = list(rules.jobs(config, log, NOW.date()))
    lake = make_lake(rng, {(path, format) for _, _, _, path, format, _ in planned if format != "csv"})
    want = Counter(
        (task, batch, table, path, *dates, *outcome(path, format, lake))
        for task, batch, table, path, format, dates in planned
    )
    run = run_audit(
        spark,
        sources.schedules_from_dicts(spark, config),
        log=spark.createDataFrame(log, LOG),
        now=NOW,
        results_path=f"{tmp_path}/results",
        count_options={
            "tasks": 3,
            "levels": rng.choice([1, 2]),
            "split_bytes": rng.choice([1, 4, 1 << 20]),
        },
    )
    day = "date_format(data_date, 'yyyyMMdd')"
    columns = ["task_name", "batch_no", "table_name", "hdfs_path", day, "data_month", "data_hour"]
    rows = run.details.selectExpr(*columns, "row_count", "file_count", "status").collect()
    assert Counter(map(tuple, rows)) == want
    assert {k: run.summary[k] for k in ("success", "partial", "failed")} == {
        status: sum(n for row, n in want.items() if row[-1] == status)
        for status in ("success", "partial", "failed")
    }
    assert len(want) > 10
