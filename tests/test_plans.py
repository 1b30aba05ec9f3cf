"""What the plans must and must not contain."""

import datetime as dt

import pytest

from checks import inputs
from checks.queries import QUERIES
from laketally import sources
from laketally.operators import counting, history

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_reaches_the_scan(spark, capsys):
    log = inputs.table(spark, SF, "events").selectExpr("event_id AS state", "ts AS complete_dt")
    kept = sources.task_log_window(log, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))
    kept.explain("formatted")
    pushed = capsys.readouterr().out.split("PushedFilters:")[1]
    for part in ("GreaterThanOrEqual(ts", "LessThan(ts", "EqualTo(event_id,1)"):
        assert part in pushed


def test_counts_read_no_column(spark):
    scan = sources.scan_row_counts(spark, [f"{SF}/orders.parquet"], "parquet")
    assert "ReadSchema: struct<>" in plan(scan)


def test_rollup_reads_only_its_columns(spark):
    df = history.daily_rollup(inputs.history(spark, SF))
    read = plan(df).split("ReadSchema:")[1].splitlines()[0]
    assert "o_totalprice" not in read


@pytest.mark.parametrize(
    "name", ["latest_per_table", "daily_rollup", "completed_tasks"]
)
def test_groups_shrink_before_the_shuffle(spark, name):
    """A key with a third of all rows sends only its winners to one task."""
    text = plan(QUERIES[name](spark, SF))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:] and "Partial" in text[exchange:]


def test_errors_gather_before_the_shuffle(spark):
    text = plan(QUERIES["path_errors_inline"](spark, SF))
    assert "partial_collect_list" in text[text.index("Exchange hashpartitioning") :]


NATIVE = sorted(set(QUERIES) - {
    "count_parquet_footers", "count_text_ranges", "count_dispatch_by_format", "list_data_files", "count_files_again",
})


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_product(spark, name):
    if name.startswith("stream_") or name in ("daily_rollup_maintained", "run_table_results"):
        pytest.skip("only reads what its jobs have written")
    text = plan(QUERIES[name](spark, SF))
    for operator in ("Python", "MapInArrow", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert operator not in text


def test_listing_is_spread_twice(spark):
    roots = spark.range(3).selectExpr("concat('/r', id) AS hdfs_path", "'orc' AS format", "'x' AS delimiter")
    text = plan(sources.list_files(roots, tasks=5))
    assert text.count("RoundRobinPartitioning(5)") == 2 and text.count("MapInArrow") == 2
    text = plan(counting.count_files(roots, tasks=5))
    assert "shufflepartitionidpassthrough" in text and text.count("MapInArrow") == 1
