"""The registered queries: (spark, sf_dir) -> DataFrame."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import inputs, lakes
from checks.inputs import LOG_END, LOG_START, RUN_DATE, table
from laketally import functions as lf
from laketally import sources
from laketally.operators import counting, history, jobs, results, tasks, templates
from laketally.plans import audit, incremental, rollups, runs
from laketally.plans.incremental import WindowSettings
from laketally.plans.scratch import scratch_path, stored
from laketally.streaming import completed_task_stream, first_completion, first_completions, task_history_stream

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def string(c):
    return F.col(c).cast("string").alias(c)


def seconds(c, name):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name)


# Sources and counting


@query
def count_parquet_files(spark, sf_dir):
    roots = [f"{sf_dir}/{t}.parquet" for t in TABLES]
    counts = sources.scan_row_counts(spark, roots, "parquet")
    name = F.regexp_extract("file", r"/([a-z]+)\.parquet(?:/|$)", 1).alias("table_name")
    return counts.groupBy(name).agg(F.sum("row_count").alias("row_count"))


@query
def count_parquet_footers(spark, sf_dir):
    """The same tables by the audit's own count: listing, footers, status."""
    roots = spark.createDataFrame(
        [(f"{sf_dir}/{t}.parquet", "parquet", None) for t in TABLES],
        "hdfs_path string, format string, delimiter string",
    )
    paths = counting.path_status(counting.path_totals(counting.count_files(roots)))
    name = F.regexp_extract("hdfs_path", r"/([a-z]+)\.parquet$", 1).alias("table_name")
    return paths.select(name, "row_count", "status")


def folder(name, file="file"):
    return F.regexp_extract(file, f"/{name}=([^/]+)/", 1)


@query
def count_orc_files(spark, sf_dir):
    counts = sources.scan_row_counts(spark, [lakes.order_lake(spark, sf_dir)], "orc")
    return counts.groupBy(folder("o_orderstatus").alias("o_orderstatus")).agg(
        F.sum("row_count").alias("row_count")
    )


@query
def count_files_again(spark, sf_dir):
    """A lake counted twice with a ledger: the second time no file is opened."""
    ledger = scratch_path(spark, "ledger")
    roots = spark.range(1).select(
        F.lit(lakes.order_lake(spark, sf_dir)).alias("hdfs_path"), F.lit("orc").alias("format"), F.lit(None).cast("string").alias("delimiter")
    )
    counting.count_files(roots, ledger=ledger)
    noted = spark.read.parquet(ledger).count()
    again = counting.count_files(roots, ledger=ledger).filter("file IS NOT NULL")
    opened = spark.read.parquet(ledger).count() - noted
    rows = again.groupBy(folder("o_orderstatus").alias("o_orderstatus")).agg(F.sum("row_count").alias("row_count"))
    return rows.withColumn("opened", F.lit(opened))


def _text_scan(spark, sf_dir, delimiter):
    lake = lakes.text_lake(spark, sf_dir, delimiter)
    counts = sources.scan_row_counts(spark, [lake], "textfile", delimiter)
    return counts.groupBy(folder("lang").alias("lang")).agg(F.sum("row_count").alias("row_count"))


@query
def count_text_files(spark, sf_dir):
    return _text_scan(spark, sf_dir, "\n")


@query
def count_text_files_multibyte(spark, sf_dir):
    return _text_scan(spark, sf_dir, "~#")


@query
def count_text_ranges(spark, sf_dir):
    """Text files cut into byte ranges that are counted apart."""
    lake = lakes.text_lake(spark, sf_dir, "~#")
    roots = spark.range(1).select(
        F.lit(lake).alias("hdfs_path"), F.lit("TextFile").alias("format"), F.lit("~#").alias("delimiter")
    )
    counts = counting.count_files(roots, split_bytes=64 * 1024).filter("file IS NOT NULL")
    return counts.groupBy(folder("lang").alias("lang")).agg(
        F.sum("row_count").alias("row_count"), F.count("error").alias("errors")
    )


@query
def count_text_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", lf.text_row_count("text", "\n").alias("row_count"))


@query
def count_text_rows_multibyte(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", lf.text_row_count("text", ". ").alias("row_count"))


@query
def list_data_files(spark, sf_dir):
    """The rows of all files the listing finds; hidden ones would add folders."""
    lake = lakes.staged_lake(spark, sf_dir)
    roots = spark.range(1).select(
        F.lit(lake).alias("hdfs_path"), F.lit("parquet").alias("format"), F.lit(None).cast("string").alias("delimiter")
    )
    counts = counting.count_files(roots).filter("file IS NOT NULL")
    # Below the lake, so that it does not matter how its own path is written.
    below = F.substring_index("file", lake.rsplit("/", 1)[1], -1)
    return counts.groupBy(F.regexp_extract(below, "^/(.*)/[^/]+$", 1).alias("folder")).agg(F.sum("row_count").alias("row_count"))


@query
def count_dispatch_by_format(spark, sf_dir):
    """One path per format, and one whose format cannot be counted."""
    lake = lakes.event_lake(spark, sf_dir)
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    fmt = F.expr(
        """CASE event_type WHEN 'click' THEN 'TEXTFILE' WHEN 'purchase' THEN 'Parquet'
           WHEN 'view' THEN 'ORC' ELSE 'csv' END"""
    )
    roots = kinds.select(
        F.concat(F.lit(lake + "/"), "event_type").alias("hdfs_path"),
        fmt.alias("format"),
        F.lit(None).cast("string").alias("delimiter"),
    )
    paths = counting.path_status(counting.path_totals(counting.count_files(roots)))
    name = F.regexp_extract("hdfs_path", "/([a-z]+)$", 1)
    return paths.select(name.alias("event_type"), "format", "row_count", "status")


# Task log


@query
def task_log_window(spark, sf_dir):
    log = inputs.task_log(spark, sf_dir)
    kept = sources.task_log_window(log, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20, 12))
    return kept.select("event_id", "task_name", "period_type", "batch_no")


@query
def task_log_window_by_date(spark, sf_dir):
    log = inputs.task_log(spark, sf_dir)
    kept = sources.task_log_window(
        log,
        dt.datetime(2024, 1, 1),
        dt.datetime(2024, 2, 1),
        data_date="20240115",
        date_filter=lambda day: F.replace("batch_no", F.lit("-"), F.lit("")).startswith(day),
    )
    return kept.select("event_id", "task_name", "period_type", "batch_no")


@query
def task_log_distinct(spark, sf_dir):
    log = inputs.task_log(spark, sf_dir).withColumn(
        "status", F.when(F.col("state") == 1, "SUCCESS").otherwise("FAILED")
    )
    return sources.task_log_distinct(
        log, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20), time_col="complete_dt"
    ).select("task_name", "batch_no")


def finished(spark, sf_dir):
    log = inputs.task_log(spark, sf_dir)
    return sources.task_log_window(
        log, dt.datetime.fromisoformat(LOG_START), dt.datetime.fromisoformat(LOG_END)
    )


def completed(spark, sf_dir):
    return tasks.completed_tasks(finished(spark, sf_dir), order_by=("complete_dt", "event_id"))


@query
def completed_tasks(spark, sf_dir):
    return completed(spark, sf_dir)


@query
def fetch_stats(spark, sf_dir):
    return tasks.fetch_stats(finished(spark, sf_dir))


@query
def parse_batch_no(spark, sf_dir):
    log = inputs.task_log(spark, sf_dir).select("event_id", "period_type", "batch_no")
    return lf.parse_batch_no(log).drop("period_type", "batch_no")


@query
def incr_overlap_dedup(spark, sf_dir):
    """Two windows that overlap, read one after the other."""
    log = inputs.task_log(spark, sf_dir)
    t = dt.datetime
    first = sources.task_log_window(log, t(2024, 1, 1), t(2024, 1, 16))
    second = sources.task_log_window(log, t(2024, 1, 15, 23, 50), t(2024, 2, 1))
    both = first.unionByName(second)
    return tasks.completed_tasks(both, order_by=("complete_dt", "event_id")).select(
        "task_name", "batch_no", "period_type"
    )


def _log_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # A pattern, since a stream takes a plain path for a directory.
    return inputs.log_of(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def _drained(writer, path):
    writer.trigger(availableNow=True).start().awaitTermination()
    return path


@query
def stream_task_history(spark, sf_dir):
    """The log streamed into a table, repeats resolved when it is read."""
    path, check = scratch_path(spark, "history"), scratch_path(spark, "history-check")
    log = _log_stream(spark, sf_dir)
    _drained(task_history_stream(log, path, check), path)
    streamed = first_completions(spark.read.parquet(path), order_by=("complete_dt", "event_id"))
    return streamed.select("task_name", "batch_no", "period_type")


@query
def stream_dedup(spark, sf_dir):
    """Each (task, batch) once, by state kept for longer than the log."""
    path, check = scratch_path(spark, "dedup"), scratch_path(spark, "dedup-check")
    log = _log_stream(spark, sf_dir).withColumn("complete_dt", F.col("complete_dt").cast("timestamp"))
    once = completed_task_stream(log, delay="60 days").select("task_name", "batch_no")
    writer = once.writeStream.format("parquet").option("path", path)
    _drained(writer.option("checkpointLocation", check), path)
    return spark.read.parquet(path)


@query
def stream_first_completions(spark, sf_dir):
    """The log streamed up to a day out of order, a file per micro-batch, and a last row that closes it."""
    session = spark.newSession()
    session.conf.set(first_completion.PROVIDER, first_completion.ROCKSDB)
    path, log_path, check = (scratch_path(spark, f"first-{n}") for n in ("out", "log", "check"))
    log = inputs.task_log(session, sf_dir).withColumn("complete_dt", F.col("complete_dt").cast("timestamp"))
    arrival = F.unix_timestamp("complete_dt") + F.pmod(F.xxhash64("event_id"), F.lit(24 * 3600))
    dealt = log.withColumn("file", F.floor(arrival / (6 * 24 * 3600)))
    for (file,) in sorted(dealt.select("file").distinct().collect()):
        dealt.filter(F.col("file") == file).drop("file").coalesce(1).write.mode("append").parquet(log_path)
    last = log.limit(1).withColumns({"task_name": F.lit("end"), "state": F.lit(1), "complete_dt": F.lit("2025-01-01").cast("timestamp")})
    last.write.mode("append").parquet(log_path)
    stream = session.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(log_path)
    rows = first_completion.first_completion_stream(stream, delay="24 hours", keep=dt.timedelta(days=60), tie="event_id")
    _drained(first_completion.write_first_completions(rows, path, check), path)
    return first_completion.told_first(session, path).filter("task_name <> 'end'")


# Business dates and paths


def _dated(spark, sf_dir):
    """Completed tasks beside their schedules' periods, some with a given date."""
    configured = inputs.schedules(spark, sf_dir).select(
        "task_name", F.coalesce("period_type", F.lit("daily")).alias("period_type")
    )
    done = completed(spark, sf_dir).drop("period_type").join(configured, "task_name")
    given = F.when(F.length("task_name") % 4 == 0, F.lit("20240115"))
    return done.withColumn("explicit_date", given)


@query
def resolve_dates(spark, sf_dir):
    d = lf.resolve_dates(
        "period_type",
        RUN_DATE,
        explicit="explicit_date",
        data_date="data_date",
        data_month="data_month",
        data_hour="data_hour",
    )
    rows = _dated(spark, sf_dir).select("task_name", "batch_no", d.alias("d"))
    return rows.select("task_name", "batch_no", "d.*")


@query
def period_default_date(spark, sf_dir):
    log = inputs.task_log(spark, sf_dir)
    day = lf.period_default_date("period_type", F.col("complete_dt"))
    return log.select("event_id", day.alias("data_date"))


def _named_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        inputs.placeholders(
            """CASE o_orderkey % 6 WHEN 0 THEN '${yesterday}' WHEN 1 THEN '${today}' WHEN 2 THEN NULL
               WHEN 3 THEN date_format(o_orderdate, 'yyyy-MM-dd')
               WHEN 4 THEN concat(date_format(o_orderdate, 'yyyyMM'), '31')
               ELSE date_format(o_orderdate, 'yyyyMMdd') END AS name"""
        ),
    )


@query
def resolve_named_date(spark, sf_dir):
    d = lf.resolve_named_date("name", RUN_DATE).alias("d")
    return _named_dates(spark, sf_dir).select("o_orderkey", d).select("o_orderkey", "d.*")


@query
def audit_date_parse(spark, sf_dir):
    day = lf.storage_date("name").cast("string").alias("data_date")
    return _named_dates(spark, sf_dir).select("o_orderkey", day)


@query
def month_of_date(spark, sf_dir):
    month = lf.month_of_date("name").alias("data_month")
    return _named_dates(spark, sf_dir).select("o_orderkey", month)


TEMPLATE = "ym=${data_month}/ymd=${data_date}/h=${data_hour}/"


@query
def render_partition(spark, sf_dir):
    p = lf.render_partition(F.lit(TEMPLATE), "data_date", "data_month", "data_hour")
    return completed(spark, sf_dir).select("task_name", "batch_no", p.alias("partition"))


@query
def render_path(spark, sf_dir):
    """Bases and templates with and without slashes, and empty ones."""
    n = F.length("task_name")
    base = F.when(n % 5 == 0, "").when(n % 5 == 1, "/lake/a//").otherwise("/lake/b")
    template = F.when(n % 3 == 0, "").when(n % 3 == 1, F.lit("/" + TEMPLATE)).otherwise(F.lit(TEMPLATE))
    path = lf.render_path(base, template, "data_date", "data_month", "data_hour")
    return completed(spark, sf_dir).select("task_name", "batch_no", path.alias("hdfs_path"))


# Schedules and jobs


@query
def schedule_tables(spark, sf_dir):
    return sources.schedule_tables(inputs.schedules(spark, sf_dir))


@query
def config_violations(spark, sf_dir):
    found = sources.config_violations(inputs.broken_schedules(spark, sf_dir))
    return found.select("rule", "ord", F.coalesce("table_ord", F.lit(-1)).alias("table_ord"), "field")


@query
def schedule_by_task(spark, sf_dir):
    found = sources.schedule_by_task(inputs.schedules(spark, sf_dir), "view_77")
    return found.select("ord", "task_name", F.size("tables").cast("bigint").alias("n_tables"))


@query
def all_task_names(spark, sf_dir):
    return sources.all_task_names(inputs.schedules(spark, sf_dir))


@query
def tasks_all_configured(spark, sf_dir):
    chosen = audit.choose_tasks(inputs.schedules(spark, sf_dir), all_configured=True)
    return chosen.select("task_name", "batch_no")


@query
def tasks_from_names(spark, sf_dir):
    names = tasks.tasks_from_names(inputs.task_log(spark, sf_dir))
    return names.select("task_name", "batch_no", "period_type", "data_date")


@query
def tasks_from_metadata(spark, sf_dir):
    """Completed tasks handed over again as they are."""
    return tasks.tasks_from_metadata(completed(spark, sf_dir))


NAMES = " click_7, view_11 ,ghost_1,purchase_149,"


@query
def tasks_explicit(spark, sf_dir):
    known, _ = tasks.explicit_tasks(inputs.schedules(spark, sf_dir), NAMES)
    return known.select("task_name", "batch_no")


@query
def tasks_explicit_unknown(spark, sf_dir):
    return tasks.explicit_tasks(inputs.schedules(spark, sf_dir), NAMES)[1]


def _jobs(spark, sf_dir, **options):
    return jobs.audit_jobs(
        inputs.schedules(spark, sf_dir), completed(spark, sf_dir), RUN_DATE, **options
    )


@query
def audit_jobs(spark, sf_dir):
    return _jobs(spark, sf_dir)


@query
def audit_jobs_explicit_date(spark, sf_dir):
    """With a given date hourly paths stay unfilled, so those jobs drop out."""
    return _jobs(spark, sf_dir, explicit_date="20240115").select(
        "ord", "batch_no", "hdfs_path", "data_date", "data_month", "data_hour"
    )


@query
def audit_jobs_preview(spark, sf_dir):
    return jobs.preview(_jobs(spark, sf_dir))


@query
def unresolved_jobs(spark, sf_dir):
    left_out = jobs.unresolved_jobs(
        inputs.schedules(spark, sf_dir), completed(spark, sf_dir), RUN_DATE
    )
    return left_out.select("ord", "table_ord", "task_name", "batch_no", "hdfs_path")


@query
def period_mismatch(spark, sf_dir):
    return jobs.period_mismatch(inputs.schedules(spark, sf_dir), completed(spark, sf_dir))


@query
def unconfigured_tasks(spark, sf_dir):
    left_out = jobs.unconfigured_tasks(inputs.schedules(spark, sf_dir), completed(spark, sf_dir))
    return left_out.select("task_name", "batch_no")


def dated(spark, sf_dir):
    return tasks.completed_tasks(inputs.dated_log(spark, sf_dir), order_by=("complete_dt", "event_id"))


@query
def audit_jobs_by_pattern(spark, sf_dir):
    """Names of the log that fill in the date placeholders of configured names."""
    found = jobs.audit_jobs(inputs.dated_schedules(spark, sf_dir), dated(spark, sf_dir), RUN_DATE, by_pattern=True)
    return found.select("ord", "task_name", "batch_no", "hdfs_path", "data_date", "data_month", "data_hour")


@query
def unconfigured_by_pattern(spark, sf_dir):
    left_out = jobs.unconfigured_tasks(inputs.dated_schedules(spark, sf_dir), dated(spark, sf_dir), by_pattern=True)
    return left_out.select("task_name", "batch_no")


# Counts, results, summary


@query
def path_totals(spark, sf_dir):
    totals = counting.path_totals(inputs.file_counts(spark, sf_dir))
    return totals.drop("format", "delimiter")


@query
def path_status(spark, sf_dir):
    totals = counting.path_totals(inputs.file_counts(spark, sf_dir))
    return counting.path_status(totals).drop("format", "delimiter", "duration_ms")


@query
def path_errors(spark, sf_dir):
    return counting.path_errors(inputs.file_counts(spark, sf_dir)).drop("format", "delimiter")


@query
def path_errors_inline(spark, sf_dir):
    """Every error of a path in place, by file."""
    inline = counting.inline_errors(inputs.file_counts(spark, sf_dir))
    told = F.transform("errors", lambda e: F.concat(e["file"], F.lit(":"), e["error"]))
    return inline.select(
        "hdfs_path", F.size("errors").cast("bigint").alias("n"), F.array_join(told, ",").alias("errors")
    )


@query
def path_error_classes(spark, sf_dir):
    """Errors that differ by file and place, as classes of a path."""
    told = F.concat("error", F.lit(" in '"), F.coalesce("file", F.lit("?")), F.lit("' at /lake/x"), F.col("file_size"), F.lit(": byte "), F.col("file_size"))
    found = counting.error_classes(inputs.file_counts(spark, sf_dir).withColumn("error", told))
    return found.select("hdfs_path", "error_class", "files", F.col("example.file").alias("example_file"))


@query
def count_result_from_json(spark, sf_dir):
    text = F.expr(
        """CASE o_orderkey % 5 WHEN 0 THEN concat('{"path":"/p/', o_orderkey, '"}')
           WHEN 1 THEN 'not json'
           WHEN 2 THEN concat('{"row_count":', o_orderkey, ',"status":"success","duration_ms":5,"file_count":3}')
           WHEN 3 THEN concat('{"path":"/p","status":"partial","errors":[{"file":"f', o_custkey, '","error":"bad"},{"file":"g","error":"bad"}]}')
           END"""
    )
    r = table(spark, sf_dir, "orders").select(
        "o_orderkey", results.count_result_from_json(text).alias("r")
    )
    return r.select(
        "o_orderkey",
        "r.path",
        "r.row_count",
        "r.file_count",
        "r.status",
        "r.duration_ms",
        F.size("r.errors").cast("bigint").alias("n_errors"),
        F.coalesce(F.get("r.errors", F.lit(0))["file"], F.lit("")).alias("first_file"),
    )


@query
def audit_result_rows(spark, sf_dir):
    """Jobs joined with one count per path; here a path's count is its jobs."""
    planned = stored(_jobs(spark, sf_dir), "jobs")
    keyed = planned.withColumn("delimiter", lf.normalise_delimiter("delimiter"))
    n = F.length("hdfs_path") % 3
    counts = keyed.groupBy(*counting.PATH_KEYS).agg(F.count(F.lit(1)).alias("row_count")).select(
        *counting.PATH_KEYS,
        "row_count",
        F.lit(1).cast("bigint").alias("file_count"),
        F.lit(10).cast("bigint").alias("total_size_bytes"),
        F.when(n == 0, "success").when(n == 1, "partial").otherwise("failed").alias("status"),
        F.when(n == 0, F.expr("CAST(array() AS array<struct<file:string,error:string>>)"))
        .otherwise(F.array(F.struct(F.lit("f").alias("file"), F.lit("bad").alias("error"))))
        .alias("errors"),
        F.lit(0).cast("bigint").alias("duration_ms"),
    )
    rows = results.result_rows(planned, counts, F.lit("2024-01-31 01:02:03.5").cast("timestamp"))
    return rows.select(
        "task_name", "interface_id", "platform_id", "partner_id", "table_name", "hdfs_path",
        "period_type", "batch_no", string("data_date"), "data_month", "data_hour", "row_count",
        "file_count", "total_size_bytes", "status", "error_msg", "duration_ms",
        seconds("created_at", "created_at"),
    )


@query
def audit_append(spark, sf_dir):
    path = scratch_path(spark, "audit-result")
    results.append_results(inputs.history(spark, sf_dir), path)
    rows = results.read_results(spark, path)
    return rows.select("id", "table_name", "period_type", string("data_date"), "data_month", "row_count")


@query
def audit_read_since(spark, sf_dir):
    """The appended history from a date on, with rows that lack the day or the month."""
    path = scratch_path(spark, "audit-result")
    rows = inputs.history(spark, sf_dir)
    rows = rows.withColumn("data_date", F.when(F.col("id") % 11 != 0, F.col("data_date")))
    rows = rows.withColumn("data_month", F.when(F.col("id") % 7 != 0, F.col("data_month")))
    results.append_results(rows, path)
    rows = results.read_results(spark, path, since="2000-06-15")
    return rows.select("id", "table_name", string("data_date"), "row_count")


@query
def run_table_results(spark, sf_dir):
    """Three runs append to a run table; the second breaks before its commit and is seen by nobody."""
    path, rows = scratch_path(spark, "runs"), inputs.history(spark, sf_dir)
    errors = counting.path_errors(inputs.file_counts(spark, sf_dir))
    for k in range(3):
        run = runs.RunTable(spark, path)
        at = dt.datetime(2024, 1, k + 1, tzinfo=dt.timezone.utc)
        run.append(rows.filter(F.col("id") % 3 == k), errors.filter(F.length("file") % 3 == k), at)
        if k != 1:
            run.finish(at, at)
    seen = runs.read_run_results(spark, path, since="1995-06-15").groupBy("table_name").agg(F.count("*").alias("results"))
    told = runs.read_run_errors(spark, path).groupBy().agg(F.count("*").alias("errors"))
    marks = runs.committed_runs(spark, path).groupBy().agg(F.max("mark").alias("mark"))
    return seen.withColumns({"errors": F.lit(told.first()[0]), "mark": F.lit(marks.first()[0])})


@query
def run_summary(spark, sf_dir):
    by_day = results.run_summary(inputs.history(spark, sf_dir), by=["data_date"])
    return by_day.withColumn("data_date", F.col("data_date").cast("string"))


@query
def full_audit(spark, sf_dir):
    """Log -> jobs -> files of three formats -> status, over a written lake."""
    lake = lakes.event_lake(spark, sf_dir)
    log = lakes.event_log(spark, sf_dir)
    done = tasks.completed_tasks(log, order_by=("complete_dt", "event_id"))
    plan = jobs.audit_jobs(lakes.event_schedules(spark, sf_dir, lake), done, RUN_DATE)
    rows, _ = audit.audit_results(stored(plan, "jobs"), dt.datetime(2024, 1, 31))
    return rows.select(
        "task_name",
        "table_name",
        F.replace("hdfs_path", F.lit(lake), F.lit("")).alias("path"),
        "period_type",
        "batch_no",
        string("data_date"),
        "data_month",
        "data_hour",
        "row_count",
        "status",
        F.replace("error_msg", F.lit(lake), F.lit("")).alias("error_msg"),
    )


# History


def _lookup(rows: DataFrame):
    return rows.select("id", "table_name", string("data_date"), "row_count", "status")


@query
def latest_per_table(spark, sf_dir):
    return _lookup(history.latest_per_table(inputs.history(spark, sf_dir)))


@query
def latest_per_table_day(spark, sf_dir):
    return _lookup(history.latest_per_table(inputs.history(spark, sf_dir), "19980415"))


@query
def latest_per_table_platform(spark, sf_dir):
    return _lookup(history.latest_per_table_platform(inputs.history(spark, sf_dir)))


@query
def latest_result_date(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(
        history.latest_result(rows, "t1", data_date="19980709", data_month="199901", platform_id="2")
    )


@query
def latest_result_month(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.latest_result(rows, "t0", data_month="199506", platform_id="3"))


@query
def latest_result_any(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.latest_result(rows, "t7", platform_id="1"))


@query
def latest_result_ci(spark, sf_dir):
    """Compared without regard to case, accents and trailing blanks."""
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.latest_result(rows, "T7 ", platform_id="1", ci=True))


@query
def results_by_partner(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.results_by_partner(rows, "0", data_date="19950114"))


@query
def results_by_partner_month(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.results_by_partner(rows, "1", data_month="199804"))


@query
def results_by_interface(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.results_by_interface(rows, "3", data_month="199804"))


@query
def results_by_interface_date(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.results_by_interface(rows, "0", data_date="19950204"))


@query
def results_by_batch(spark, sf_dir):
    return _lookup(history.results_by_batch(inputs.history(spark, sf_dir), "19980415"))


@query
def results_by_period(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.results_by_period(rows, "monthly", data_month="199504"))


@query
def results_by_period_date(spark, sf_dir):
    rows = inputs.history(spark, sf_dir)
    return _lookup(history.results_by_period(rows, "daily", data_date="19980415"))


@query
def table_last_7_days(spark, sf_dir):
    return _lookup(history.table_history(inputs.history(spark, sf_dir), "t7", "2001-07-20"))


@query
def failed_results(spark, sf_dir):
    return _lookup(history.failed_results(inputs.history(spark, sf_dir)))


@query
def results_by_platform(spark, sf_dir):
    return _lookup(history.results_by_platform(inputs.history(spark, sf_dir), "2"))


@query
def recent_results(spark, sf_dir):
    rows = history.recent_results(inputs.history(spark, sf_dir))
    return rows.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query
def daily_rollup(spark, sf_dir):
    daily = history.daily_rollup(inputs.history(spark, sf_dir))
    return daily.withColumn("data_date", F.col("data_date").cast("string"))


@query
def daily_rollup_7_days(spark, sf_dir):
    daily = history.daily_rollup(inputs.history(spark, sf_dir), "2001-07-20")
    return daily.withColumn("data_date", F.col("data_date").cast("string"))


@query
def daily_rollup_maintained(spark, sf_dir):
    """The rollup kept up to date over five appended runs, one of them applied twice, and a repeat of old rows."""
    path, rows = scratch_path(spark, "rollup"), inputs.history(spark, sf_dir)
    parts = [rows.filter(F.col("id") % 5 == k) for k in (3, 0, 4, 1)]
    for part in [*parts, parts[1], rows.filter("id % 5 = 2 OR id % 10 = 1")]:
        rollups.apply_run(spark, path, part)
    return rollups.read_daily(spark, path).withColumn("data_date", F.col("data_date").cast("string"))


@query
def monthly_rollup(spark, sf_dir):
    return history.monthly_rollup(inputs.history(spark, sf_dir))


# Incremental window


def _windows(spark, sf_dir, mark, settings):
    """The next window after each event, as if each were the saved mark."""
    now = F.lit("2024-01-20 12:00:00.75").cast("timestamp_ntz")
    events = table(spark, sf_dir, "events").select("event_id", F.expr(mark).alias("mark"))
    w = events.select("event_id", incremental.window_bounds("mark", now, settings).alias("w"))
    return w.select(
        "event_id", seconds("w.start_time", "start_time"), seconds("w.end_time", "end_time")
    )


@query
def incr_window(spark, sf_dir):
    return _windows(spark, sf_dir, "ts", WindowSettings())


@query
def incr_window_cold(spark, sf_dir):
    cold = "CASE WHEN event_type <> 'error' THEN ts END"
    return _windows(spark, sf_dir, cold, WindowSettings(lookback_hours=0.5))


@query
def incr_window_chunked(spark, sf_dir):
    return _windows(spark, sf_dir, "ts", WindowSettings(overlap_seconds=0, max_window_hours=6))


@query
def incr_window_future(spark, sf_dir):
    ahead = "ts + INTERVAL '15' DAY"
    return _windows(spark, sf_dir, ahead, WindowSettings(max_window_hours=0))


@query
def state_latest(spark, sf_dir):
    """Saved marks of one source per user; an `error` event is a reset."""
    states = table(spark, sf_dir, "events").selectExpr(
        "user_id",
        "CASE WHEN event_type <> 'error' THEN ts - INTERVAL '1' HOUR END AS last_end_time",
        "ts AS updated_at",
    )
    latest = incremental.latest_state(states, by=["user_id"])
    return latest.select("user_id", seconds("last_end_time", "last_end_time"))


@query
def advance_decision(spark, sf_dir):
    """One run per order date; high-priority orders are its jobs."""
    high = F.col("o_orderpriority") == "2-HIGH"
    runs = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count_if(high).alias("total"),
        F.count_if(high & (F.col("o_orderstatus") == "P")).alias("failed"),
        F.count_if(high & (F.col("o_orderstatus") == "O")).alias("partial"),
        F.count_if(high | (F.col("o_orderpriority") == "5-LOW")).alias("fetched"),
    )
    advance = incremental.advances(
        "total",
        "failed",
        "partial",
        "fetched",
        dry_run=F.dayofmonth("day") == 1,
        explicit=F.dayofmonth("day") == 2,
        advance_on_failure=F.month("day") == 6,
    )
    stalled = incremental.stalls("total", "fetched", F.month("day") == 12)
    return runs.select(
        string("day"), advance.cast("bigint").alias("advance"), stalled.cast("bigint").alias("stalled")
    )


# Template expansion


@query
def template_range(spark, sf_dir):
    return templates.range_values(inputs.range_variables(spark, sf_dir))


@query
def template_enum(spark, sf_dir):
    return templates.enum_values(inputs.enum_variables(spark, sf_dir))


@query
def template_violations(spark, sf_dir):
    return templates.template_violations(
        inputs.bad_templates(spark, sf_dir), inputs.checked_variables(spark, sf_dir)
    )


@query
def expand_templates(spark, sf_dir):
    expanded = templates.expand_templates(
        inputs.templates(spark, sf_dir), inputs.loop_variables(spark, sf_dir)
    )
    return expanded.select(
        "ord",
        "combo",
        "task_name",
        "platform_id",
        F.col("tables")[0]["hdfs_path"].alias("hdfs_path"),
        F.col("tables")[0]["partition_template"].alias("partition_template"),
    )


@query
def expansion_groups(spark, sf_dir):
    groups = templates.expansion_groups(
        inputs.templates(spark, sf_dir), inputs.loop_variables(spark, sf_dir), block=64
    )
    return groups.select("ord", "start_idx", "count")


@query
def expanded_schedules(spark, sf_dir):
    """Expanded templates numbered in one sequence."""
    t, v = inputs.templates(spark, sf_dir), inputs.loop_variables(spark, sf_dir)
    numbered = templates.as_schedules(
        templates.expand_templates(t, v), templates.expansion_groups(t, v)
    )
    return numbered.select("ord", "task_name")
