import datetime as dt

import pytest
from pyspark.sql import functions as F

from laketally.plans import incremental
from laketally.plans.audit import next_window
from laketally.plans.incremental import WindowSettings

NOW = dt.datetime(2026, 3, 10, 12, 0, 0, 900_000)


def ago(**kw):
    return NOW.replace(microsecond=0) - dt.timedelta(**kw)


@pytest.mark.parametrize(
    "mark, settings, start, end, capped",
    [
        (ago(hours=1), {}, ago(hours=1, minutes=10), ago(), False),
        (ago(hours=1), {"overlap_seconds": 0}, ago(hours=1), ago(), False),
        (ago(hours=1), {"overlap_seconds": -5}, ago(hours=1), ago(), False),
        (None, {}, ago(hours=24), ago(), False),
        (None, {"lookback_hours": 0.5}, ago(minutes=30), ago(), False),
        (ago(days=3), {}, ago(days=3, minutes=10), ago(days=2), True),
        (ago(days=3), {"max_window_hours": 0}, ago(days=3, minutes=10), ago(), False),
        (ago(days=3), {"max_window_hours": 1.5}, ago(days=3, minutes=10), ago(hours=70.5), True),
        (ago(hours=-1), {}, ago(hours=24), ago(), False),
        # The overlap brings a mark just ahead of now back before it.
        (ago(minutes=-5), {}, ago(minutes=5), ago(), False),
    ],
)
def test_window(spark, mark, settings, start, end, capped):
    assert next_window(spark, mark, NOW, WindowSettings(**settings)) == ((start, end), capped)


def test_no_gap_while_catching_up(spark):
    mark, seen = ago(days=4), []
    while True:
        (start, end), capped = next_window(spark, mark, NOW, WindowSettings())
        assert start < mark <= end
        seen.append(end)
        mark = end
        if not capped:
            break
    assert seen[-1] == ago() and len(seen) in (4, 5)


def test_settings():
    config = {"overlap_seconds": 60, "max_window_hours": None, "other": 1}
    s = WindowSettings.resolve(config, overlap_seconds=5, lookback_hours=None)
    assert (s.overlap_seconds, s.max_window_hours, s.lookback_hours) == (5, 24.0, 24.0)
    assert WindowSettings.resolve(config).overlap_seconds == 60


@pytest.mark.parametrize(
    "run, flags, want",
    [
        ((3, 0, 0, 3), {}, True),
        ((3, 1, 0, 3), {}, False),
        ((3, 0, 1, 3), {}, False),
        ((3, 1, 1, 3), {"advance_on_failure": True}, True),
        ((0, 0, 0, 0), {}, True),
        ((0, 0, 0, 5), {}, False),
        ((0, 0, 0, 5), {"advance_on_failure": True}, False),
        ((3, 0, 0, 3), {"dry_run": True}, False),
        ((0, 0, 0, 0), {"dry_run": True}, False),
        ((3, 0, 0, 3), {"explicit": True}, False),
    ],
)
def test_advance(spark, run, flags, want):
    rule = incremental.advances(*[F.lit(n) for n in run], **flags)
    assert spark.range(1).select(rule).first()[0] is want


def test_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert incremental.load_mark(spark, path) is None
    t = [dt.datetime(2026, 3, d) for d in range(1, 6)]
    incremental.save_mark(spark, path, t[0], t[1])
    incremental.save_mark(spark, path, t[2], t[3])
    assert incremental.load_mark(spark, path) == t[2]
    (tmp_path / "state" / "broken.json").write_text('not json\n{"last_end_time": 5\n')
    assert incremental.load_mark(spark, path) == t[2]
    incremental.save_mark(spark, path, None, t[4])
    assert incremental.load_mark(spark, path) is None


def test_state_with_offset(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        '{\n  "last_end_time": "2026-01-09T12:34:56+08:00",\n  "updated_at": "2026-01-09T12:35:01+08:00"\n}'
    )
    assert incremental.load_mark(spark, str(tmp_path)) == dt.datetime(2026, 1, 9, 4, 34, 56)
    (tmp_path / "s.json").write_text('{"last_end_time": "2026-01-09T12:34:56"}')
    assert incremental.load_mark(spark, str(tmp_path)) == dt.datetime(2026, 1, 9, 12, 34, 56)
