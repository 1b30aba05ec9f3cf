"""Lookups without a date open few row groups of a long history."""

import datetime as dt

from pyspark.sql import functions as F

from laketally.operators import history, results
from laketally.schemas import AUDIT_RESULT


def rows(run, n=40):
    day = dt.date(2026, 3, 1)
    for i in range(n):
        # Batches lie between each other's, so that minima and maxima do not tell runs apart.
        batch = f"{(i * 61 + run) * 7919 % 100_003:06d}"
        yield (run * n + i, f"task_{batch}", "i", "p", f"partner{run}", f"t{batch}", "/l", "daily", batch, day, "202603", None, 1, 1, 1, "success", None, 1, dt.datetime(2026, 3, 2))


def scanned(df):
    """Rows that the scan of a collected query gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numOutputRows").get().value()


def test_lookup_skips_files(spark, tmp_path):
    path = str(tmp_path / "history")
    for run in range(20):
        results.append_results(spark.createDataFrame(list(rows(run)), AUDIT_RESULT).coalesce(1), path)
    whole = results.read_results(spark, path)
    assert len(whole.inputFiles()) == 20 and whole.count() == 800
    batch, task = list(rows(7))[3][8], list(rows(7))[3][1]
    for found, n in (
        (whole.filter(F.col("batch_no") == batch), 1),
        (whole.filter(f"task_name = '{task}'"), 1),
        (whole.filter("partner_id = 'partner7'"), 40),
    ):
        assert len(found.collect()) == n
        assert 0 < scanned(found) <= 80, "a tenth of all rows"
    assert scanned(whole.filter("batch_no = 'none'")) <= 40
    assert len(history.results_by_batch(whole, batch).collect()) == 1
