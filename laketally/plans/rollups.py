"""The daily rollup, maintained from run to run.

Kept per month: the newest row of every table, platform and date, and the sums
of every day. A run's rows subtract the rows they replace and add themselves;
only the months they touch are read and written again. A new version of these
months is written beside the old one and becomes visible with its commit, which
names the version of every month, so rows and sums never differ and a run that
is applied twice changes nothing. Versions that no commit names may be deleted.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laketally.functions.dates import as_date
from laketally.plans.commits import Taken, commit, last_commit
from laketally.plans.scratch import stored

KEYS = ["table_name", "platform_id", "data_date"]
NEWEST = "id long, table_name string, platform_id string, data_date date, row_count long, status string, created_at timestamp"
SUMS = ["total_tables", "success_count", "failed_count", "total_rows", "total_rows_counted"]
DAILY = "data_date date, " + ", ".join(f"{c} long" for c in SUMS)
#: The folder of rows without a day.
NO_MONTH = "none"


def _commits(path: str) -> str:
    return f"{path}/_commits"


def _month():
    return F.coalesce(F.date_format("data_date", "yyyyMM"), F.lit(NO_MONTH))


def _versions(spark: SparkSession, path: str, name: str, schema: str, state: dict, months=None) -> DataFrame:
    """The committed rows of one table, of some months or of all."""
    paths = [f"{path}/{name}/version={v}/month={m}" for m, v in state.items() if months is None or m in months]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def apply_run(spark: SparkSession, path: str, rows: DataFrame, *, tries=5) -> int:
    """Bring the rollup up to date with a run's result rows; the commit's number.

    The driver sees the months the run touches. When another job commits first,
    the run is applied to what that one left.
    """
    columns = [c.split()[0] for c in NEWEST.split(", ")]
    rows = stored(rows.select(*columns), "rollup-run")
    months = [r.month for r in rows.select(_month().alias("month")).distinct().collect()]
    for _ in range(tries):
        number, content = last_commit(spark, _commits(path))
        state = content.get("months", {})
        if not months:
            return number
        version = f"{number + 1}-{uuid.uuid4().hex[:8]}"  # no other job writes there
        try:
            _write_version(spark, path, rows, state, months, version)
            commit(spark, _commits(path), number + 1, {"months": state | dict.fromkeys(months, version)})
            return number + 1
        except Taken:
            continue
    raise Taken(f"{path}: {tries} times")


def _write_version(spark, path: str, rows: DataFrame, state: dict, months: list[str], version: str) -> None:
    old = _versions(spark, path, "newest", NEWEST, state, months)
    both = old.withColumn("fresh", F.lit(False)).unionByName(_newest(rows).withColumn("fresh", F.lit(True)))
    # A key has at most the row it had and the run's newest; a row applied again loses to itself.
    order = Window.partitionBy(*KEYS).orderBy(F.desc("created_at"), F.desc("id"), "fresh")
    ranked = stored(both.withColumn("n", F.row_number().over(order)), "rollup-ranked")
    _write(ranked.filter("n = 1").drop("n", "fresh"), path, "newest", version)
    sign = F.when(F.expr("n = 1 AND fresh"), 1).when(F.expr("n = 2 AND NOT fresh"), -1)
    change = _sums(ranked.withColumn("sign", sign).filter("sign IS NOT NULL"))
    was = _versions(spark, path, "daily", DAILY, state, months)
    daily = was.unionByName(change).groupBy("data_date").agg(*[F.sum(c).alias(c) for c in SUMS])
    _write(daily, path, "daily", version)


def _newest(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy(*KEYS).orderBy(F.desc("created_at"), F.desc("id"))
    return rows.withColumn("n", F.row_number().over(order)).filter("n = 1").drop("n")


def _sums(signed: DataFrame) -> DataFrame:
    """What rows, each counted `sign` times, add to their days."""
    sign, rows = F.col("sign"), F.col("row_count")
    of = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("long")
    return signed.groupBy("data_date").agg(
        of(sign).alias("total_tables"),
        of(F.when(F.col("status") == "success", sign)).alias("success_count"),
        of(F.when(F.col("status") == "failed", sign)).alias("failed_count"),
        of(sign * rows).alias("total_rows"),
        of(F.when(rows >= 0, sign * rows)).alias("total_rows_counted"),
    )


def _write(rows: DataFrame, path: str, name: str, version: str) -> None:
    monthly = rows.withColumn("month", _month()).hint("rebalance", "month")
    monthly.write.partitionBy("month").parquet(f"{path}/{name}/version={version}")


def read_daily(spark: SparkSession, path: str, run_date=None, *, days=7) -> DataFrame:
    """The rollup as `daily_rollup` gives it, of all days or of the last ones.

    With a run date only the months from its first day on are opened.
    """
    state = last_commit(spark, _commits(path))[1].get("months", {})
    if run_date is None:
        return _versions(spark, path, "daily", DAILY, state).orderBy(F.desc("data_date"))
    first = F.date_sub(as_date(run_date), days)
    since = spark.range(1).select(F.date_format(first, "yyyyMM")).first()[0]
    months = [m for m in state if m != NO_MONTH and m >= since]
    return _versions(spark, path, "daily", DAILY, state, months).filter(F.col("data_date") >= first).orderBy(F.desc("data_date"))


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every table, platform and date."""
    return _versions(spark, path, "newest", NEWEST, last_commit(spark, _commits(path))[1].get("months", {}))
