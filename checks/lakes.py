"""Small lakes that Spark writes from the given tables, to be counted again."""

from functools import wraps

from pyarrow.fs import FileType
from pyspark.sql import functions as F

from checks.inputs import table
from laketally.plans.scratch import scratch_path
from laketally.sources.filesystems import session_opener


COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def written(df, path, format, partitions, **options):
    """Write a table by partition, splitting partitions that are too large.

    Small ones are not gathered into fewer tasks: here the time goes into the
    number of folders, not their bytes.
    """
    conf = df.sparkSession.conf
    before = conf.get(COALESCE)
    conf.set(COALESCE, "false")
    try:
        writer = df.hint("rebalance", *partitions).write.partitionBy(*partitions)
        writer.format(format).options(**options).mode("append").save(path)
    finally:
        conf.set(COALESCE, before)


def exists(spark, path: str) -> bool:
    fs, inner, _ = session_opener(spark)(path)
    return fs.get_file_info(inner).type != FileType.NotFound


def once(write):
    """Write a lake when a session first asks for it, or when it is gone."""
    paths = {}

    @wraps(write)
    def path(spark, sf_dir, *args):
        key = (spark.sparkContext.applicationId, sf_dir, *args)
        if key not in paths or not exists(spark, paths[key]):
            paths[key] = write(spark, sf_dir, *args)
        return paths[key]

    return path


@once
def order_lake(spark, sf_dir) -> str:
    path = scratch_path(spark, "orders-orc")
    written(table(spark, sf_dir, "orders"), path, "orc", ["o_orderstatus"])
    return path


@once
def text_lake(spark, sf_dir, delimiter: str) -> str:
    """Documents as text files by language, ended by the delimiter."""
    path = scratch_path(spark, "documents-text")
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    written(docs, path, "text", ["lang"], lineSep=delimiter)
    return path


@once
def staged_lake(spark, sf_dir) -> str:
    """Events by day, with some of them in folders that must not be read."""
    path = scratch_path(spark, "events-staged")
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    staged = F.col("event_type") == "error"
    hidden = F.col("event_type") == "signup"
    written(events.filter(~staged & ~hidden), path, "parquet", ["day"])
    written(events.filter(staged), f"{path}/_staging", "parquet", ["day"])
    written(events.filter(hidden), f"{path}/.tmp", "parquet", ["day"])
    return path


@once
def event_lake(spark, sf_dir) -> str:
    """Clicks as text by hour with two lines each, views as ORC by day,
    purchases as Parquet by month. Nothing is written for signups and errors."""
    path = scratch_path(spark, "events-lake")
    events = table(spark, sf_dir, "events").withColumns(
        {
            "ymd": F.date_format("ts", "yyyyMMdd"),
            "hour": F.date_format("ts", "HH"),
            "ym": F.date_format("ts", "yyyyMM"),
        }
    )

    def of(kind):
        return events.filter(F.col("event_type") == kind)

    facts = ["event_id", "user_id", "value"]
    lines = F.concat(F.col("event_id").cast("string"), F.lit("\n"), F.col("props")).alias("line")
    written(of("click").select(lines, "ymd", "hour"), f"{path}/click", "text", ["ymd", "hour"])
    written(of("view").select(*facts, "ymd"), f"{path}/view", "orc", ["ymd"])
    written(of("purchase").select(*facts, "ym"), f"{path}/purchase", "parquet", ["ym"])
    return path


def event_log(spark, sf_dir):
    """A task log of the event lake: a task per event type, a batch per folder."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type AS task_name",
        "CASE event_type WHEN 'click' THEN 'hourly' WHEN 'purchase' THEN 'monthly' ELSE 'daily' END AS period_type",
        """date_format(ts, CASE event_type WHEN 'click' THEN 'yyyyMMddHH'
                                WHEN 'purchase' THEN 'yyyyMM' ELSE 'yyyyMMdd' END) AS batch_no""",
        "1 AS state",
        "ts AS complete_dt",
    )


def event_schedules(spark, sf_dir, lake: str):
    """A schedule per event type but `error`. Clicks have a second table that
    was never written, signups a format that cannot be counted."""
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()

    def entry(name, folder, format, template):
        return F.struct(
            F.lit(name).alias("name"),
            F.lit(f"{lake}/{folder}").alias("hdfs_path"),
            F.lit(format).alias("format"),
            F.lit(template).cast("string").alias("partition_template"),
            F.lit(None).cast("string").alias("delimiter"),
        )

    click = F.array(
        entry("ods.click", "click", "TextFile", "ymd=${data_date}/hour=${data_hour}"),
        entry("ods.copy", "copy", "orc", "ymd=${data_date}"),
    )
    kind = F.col("event_type")
    return kinds.filter(kind != "error").select(
        F.xxhash64("event_type").alias("ord"),
        kind.alias("task_name"),
        F.lit("1").alias("interface_id"),
        F.lit("7").alias("platform_id"),
        F.lit("2").alias("partner_id"),
        F.expr(
            "CASE event_type WHEN 'click' THEN 'hourly' WHEN 'purchase' THEN 'monthly' ELSE 'daily' END"
        ).alias("period_type"),
        F.lit(None).cast("string").alias("loop_var"),
        F.when(kind == "click", click)
        .when(kind == "purchase", F.array(entry("ods.purchase", "purchase", "PARQUET", "/ym=${data_month}")))
        .when(kind == "view", F.array(entry("ods.view", "view/", "orc", "ymd=${data_date}")))
        .otherwise(F.array(entry("ods.signup", "signup", "csv", None)))
        .alias("tables"),
    )
