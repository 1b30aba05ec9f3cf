"""Operator inputs derived from the given tables.

Every input is a projection of a whole table, so it grows with the data. The
same projections are written in SQL in `oracle.py`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DATE = "2024-01-31"
LOG_START, LOG_END = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def placeholders(sql: str) -> str:
    """SQL text whose `${...}` Spark must not take for a setting."""
    return sql.replace("${", "$' || '{")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_of(events: DataFrame) -> DataFrame:
    """A task log: one event is one run of the task `<type>_<user>`."""
    return events.selectExpr(
        "event_id",
        "concat(event_type, '_', user_id) AS task_name",
        """CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'minutely'
                WHEN event_id % 10 = 1 THEN 'daily'
                WHEN event_type = 'click' THEN 'hourly'
                WHEN event_type = 'purchase' THEN 'monthly' ELSE 'daily' END AS period_type""",
        """CASE WHEN event_id % 23 = 0 THEN '' WHEN event_id % 31 = 0 THEN NULL
                WHEN event_id % 7 = 0 THEN date_format(ts, 'yyyy-MM-dd')
                WHEN event_id % 29 = 0 THEN substring(date_format(ts, 'yyyyMMddHH'), 1, 9)
                WHEN event_type = 'click' THEN date_format(ts, 'yyyyMMddHH')
                WHEN event_type = 'purchase' THEN date_format(ts, 'yyyyMM')
                ELSE date_format(ts, 'yyyyMMdd') END AS batch_no""",
        "CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS state",
        "ts AS complete_dt",
    )


def task_log(spark, sf_dir) -> DataFrame:
    return log_of(table(spark, sf_dir, "events"))


def schedules(spark, sf_dir) -> DataFrame:
    """Four schedules per customer; none for the task type `error`."""
    kinds = "array('click', 'purchase', 'signup', 'view')"
    c = table(spark, sf_dir, "customer").select("*", F.posexplode(F.expr(kinds)).alias("k", "kind"))
    first = """named_struct('name', concat('ods.', kind), 'hdfs_path', concat('/lake/', kind, '/'),
        'format', CASE kind WHEN 'click' THEN 'ORC' WHEN 'purchase' THEN 'parquet'
                            WHEN 'view' THEN 'TextFile' ELSE 'csv' END,
        'partition_template', CASE kind
            WHEN 'click' THEN concat('/ymd=${data_date}/hour=${data_hour}/cust=', c_custkey)
            WHEN 'purchase' THEN 'ym=${data_month}' WHEN 'view' THEN 'ymd=${data_date}' END,
        'delimiter', CASE kind WHEN 'view' THEN '\\\\n' WHEN 'purchase' THEN '|' END)"""
    second = """named_struct('name', 'ods.extra', 'hdfs_path', '/lake/extra', 'format', 'orc',
        'partition_template', concat('seg=', c_mktsegment, '/x=${unknown}'),
        'delimiter', CAST(NULL AS STRING))"""
    return c.selectExpr(
        "c_custkey * 4 + k AS ord",
        "concat(kind, '_', c_custkey) AS task_name",
        "CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE concat('i', c_nationkey) END AS interface_id",
        "CAST(c_nationkey AS STRING) AS platform_id",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey % 3 AS STRING) END AS partner_id",
        "CASE kind WHEN 'click' THEN 'hourly' WHEN 'purchase' THEN 'monthly' WHEN 'view' THEN 'daily' END AS period_type",
        "CAST(NULL AS STRING) AS loop_var",
        placeholders(
            f"CASE WHEN kind = 'view' THEN array({first}, {second}) ELSE array({first}) END AS tables"
        ),
    )


def dated_log(spark, sf_dir) -> DataFrame:
    """Finished tasks whose names carry the date of their event, some of them no date at all."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_type
            WHEN 'click' THEN concat(user_id, '_click_', date_format(ts, 'yyyyMMddHH'))
            WHEN 'purchase' THEN concat('purchase_', date_format(ts, 'yyyyMM'), '_', user_id)
            WHEN 'view' THEN concat('view_', user_id, '_', CASE WHEN event_id % 9 = 0 THEN date_format(ts, 'yyyy1399')
                WHEN event_id % 9 < 4 THEN date_format(ts, 'yyyyMM01') ELSE date_format(ts, 'yyyyMMdd') END)
            WHEN 'signup' THEN CASE WHEN event_id % 5 = 0 THEN concat('signup_', user_id)
                ELSE concat('signup_', date_format(ts, 'yyyyMMdd'), '_', date_format(ts, 'HH'), '_', user_id, '_', date_format(ts, 'yyyyMM')) END
            ELSE concat('error_', date_format(ts, 'yyyyMMdd'), '_', user_id) END AS task_name""",
        "CAST(NULL AS STRING) AS period_type",
        """CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN date_format(ts, 'yyyyMMdd')
            ELSE date_format(ts, 'yyyyMMddHH') END AS batch_no""",
        "ts AS complete_dt",
    )


def dated_schedules(spark, sf_dir) -> DataFrame:
    """Seven patterns and one plain name per customer; those of `error` carry something else."""
    names = """array(concat(c_custkey, '_click_${data_date}06'), concat(c_custkey, '_click_${data_date}18'),
        concat('purchase_${data_month}_', c_custkey), concat('view_', c_custkey, '_${data_date}'),
        concat('view_', c_custkey, '_${data_month}01'), concat('signup_${data_date}_${data_hour}_', c_custkey, '_${data_month}'),
        concat('signup_', c_custkey), concat('error_${ghost}_', c_custkey))"""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.posexplode(F.expr(placeholders(names))).alias("k", "task_name"))
    entry = """named_struct('name', 'ods.t', 'hdfs_path', concat('/lake/k', k), 'format', 'orc', 'partition_template',
        CASE k WHEN 0 THEN 'ymd=${data_date}/h=06' WHEN 1 THEN 'ymd=${data_date}/h=18' WHEN 5 THEN 'ymd=${data_date}/h=${data_hour}'
        ELSE CASE WHEN k IN (2, 4) THEN 'ym=${data_month}' ELSE 'ymd=${data_date}' END END, 'delimiter', CAST(NULL AS STRING))"""
    return c.selectExpr(
        "c_custkey * 8 + k AS ord", "task_name", "CAST(NULL AS STRING) AS interface_id", "CAST(NULL AS STRING) AS platform_id",
        "CAST(NULL AS STRING) AS partner_id", "'daily' AS period_type", "CAST(NULL AS STRING) AS loop_var",
        placeholders(f"array({entry}) AS tables"),
    )


def broken_schedules(spark, sf_dir) -> DataFrame:
    """One schedule per customer, with fields missing here and there."""
    entry = """named_struct('name', c_name,
        'hdfs_path', CASE WHEN c_nationkey % 6 <> 0 THEN '/lake' END,
        'format', CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'orc' END,
        'partition_template', CAST(NULL AS STRING), 'delimiter', CAST(NULL AS STRING))"""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS ord",
        "CASE WHEN c_acctbal >= 0 THEN c_name END AS task_name",
        f"CASE WHEN c_nationkey % 5 <> 0 THEN array({entry}) END AS tables",
    )


def templates(spark, sf_dir) -> DataFrame:
    """One template per supplier with no, one or two loop variables."""
    entry = """named_struct('name', concat('ods.', s_name), 'hdfs_path', '/w/${region}', 'format', 'orc',
        'partition_template', 'ymd=${data_date}/slot=${slot}', 'delimiter', CAST(NULL AS STRING))"""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS ord",
        placeholders("concat('P_${region}_S', s_suppkey, '_${slot}') AS task_name"),
        "CAST(s_nationkey AS STRING) AS interface_id",
        placeholders("'${region}' AS platform_id"),
        "'2' AS partner_id",
        "'daily' AS period_type",
        "CASE s_suppkey % 4 WHEN 1 THEN 'region' WHEN 2 THEN 'region & slot' WHEN 3 THEN 'slot' END AS loop_var",
        placeholders(f"array({entry}) AS tables"),
    )


NO_VALUES = "CAST(NULL AS ARRAY<STRING>) AS values"


def loop_variables(spark, sf_dir) -> DataFrame:
    """`region`, a range over the nation keys; `slot`, the market segments."""
    region = table(spark, sf_dir, "nation").selectExpr(
        "'region' AS var", "'range' AS type", "CAST(min(n_nationkey) AS STRING) AS start",
        "CAST(max(n_nationkey) AS STRING) AS end", "'5' AS step", "2 AS pad", NO_VALUES,
    )
    slot = table(spark, sf_dir, "customer").selectExpr(
        "'slot' AS var", "'enum' AS type", "CAST(NULL AS STRING) AS start",
        "CAST(NULL AS STRING) AS end", "CAST(NULL AS STRING) AS step", "CAST(NULL AS INT) AS pad",
        "sort_array(collect_set(c_mktsegment)) AS values",
    )
    return region.unionByName(slot)


def range_variables(spark, sf_dir) -> DataFrame:
    """One range per part: upward, downward, empty and zero-filled ones."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('v', p_partkey) AS var", "'range' AS type", "CAST(p_size AS STRING) AS start",
        "CAST(p_size + p_partkey % 20 - 5 AS STRING) AS end",
        "CAST(CASE WHEN p_partkey % 4 = 0 THEN -2 ELSE p_partkey % 4 END AS STRING) AS step",
        "CAST(p_partkey % 4 AS INT) AS pad", NO_VALUES,
    )


def enum_variables(spark, sf_dir) -> DataFrame:
    """One enum per supplier."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS var", "'enum' AS type", "CAST(NULL AS STRING) AS start",
        "CAST(NULL AS STRING) AS end", "CAST(NULL AS STRING) AS step", "CAST(NULL AS INT) AS pad",
        "array(CAST(s_nationkey AS STRING), concat('x', s_suppkey)) AS values",
    )


def bad_templates(spark, sf_dir) -> DataFrame:
    """One template per part; most loop over something that cannot be."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS ord",
        """CASE p_partkey % 8 WHEN 0 THEN 'region' WHEN 1 THEN 'ghost' WHEN 2 THEN 'month'
           WHEN 3 THEN 'data_date' WHEN 4 THEN 'none' WHEN 5 THEN 'region& ghost'
           WHEN 6 THEN 'odd' END AS loop_var""",
    )


def checked_variables(spark, sf_dir) -> DataFrame:
    """The loop variables and, per nation-table scan, three unusable ones."""
    n = table(spark, sf_dir, "nation").groupBy().agg(F.count(F.lit(1)).alias("n"))
    entries = "array(named_struct('v','month','t','computed'), named_struct('v','none','t','enum'), named_struct('v','odd','t','list'))"
    odd = n.select(F.explode(F.expr(entries)).alias("e")).selectExpr(
        "e.v AS var", "e.t AS type", "CAST(NULL AS STRING) AS start", "CAST(NULL AS STRING) AS end",
        "CAST(NULL AS STRING) AS step", "CAST(NULL AS INT) AS pad", NO_VALUES,
    )
    return loop_variables(spark, sf_dir).unionByName(odd)


def history(spark, sf_dir) -> DataFrame:
    """Audit results: one order is one result row."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "concat('load_', o_custkey % 50) AS task_name",
        "CAST(o_custkey % 7 AS STRING) AS interface_id",
        "substring(o_orderpriority, 1, 1) AS platform_id",
        "CAST(o_custkey % 3 AS STRING) AS partner_id",
        "concat('t', o_custkey % 20) AS table_name",
        "concat('/lake/t', o_custkey % 20) AS hdfs_path",
        "CASE WHEN o_orderkey % 11 = 0 THEN 'monthly' ELSE 'daily' END AS period_type",
        "date_format(o_orderdate, 'yyyyMMdd') AS batch_no",
        "CAST(o_orderdate AS DATE) AS data_date",
        "date_format(o_orderdate, 'yyyyMM') AS data_month",
        "CAST(NULL AS STRING) AS data_hour",
        "CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_orderkey % 1000 END AS row_count",
        "o_orderkey % 10 AS file_count",
        "o_orderkey % 10 * 1000 AS total_size_bytes",
        "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'partial' ELSE 'failed' END AS status",
        "CAST(NULL AS STRING) AS error_msg",
        "o_orderkey % 100 AS duration_ms",
        "CAST(o_orderdate AS TIMESTAMP) AS created_at",
    )


def file_counts(spark, sf_dir) -> DataFrame:
    """Per-file counts: one line item is one file, one part is one path."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('/lake/p', l_partkey) AS hdfs_path",
        "'parquet' AS format",
        "'\\n' AS delimiter",
        """CASE WHEN l_partkey % 13 = 0 AND l_linenumber = 1 THEN NULL
                ELSE concat('/lake/p', l_partkey, '/f', l_orderkey, '_', l_linenumber) END AS file""",
        "CAST(floor(l_quantity) AS BIGINT) AS row_count",
        "CAST(floor(l_extendedprice) AS BIGINT) AS file_size",
        """CASE WHEN l_partkey % 13 = 0 AND l_linenumber = 1 THEN 'Path does not exist'
                WHEN l_partkey % 11 = 0 THEN 'not a footer'
                WHEN l_partkey % 3 = 0 AND (l_orderkey + l_linenumber) % 5 = 0 THEN 'bad footer'
           END AS error""",
        "CAST(l_linenumber AS BIGINT) AS duration_ms",
    )
