"""The same results in SQL, for DuckDB over the same tables."""

# Named subqueries; `with_` puts the ones a statement needs before it.
PARTS = {
    "log": """
        SELECT event_id, event_type || '_' || user_id AS task_name,
            CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'minutely'
                 WHEN event_id % 10 = 1 THEN 'daily' WHEN event_type = 'click' THEN 'hourly'
                 WHEN event_type = 'purchase' THEN 'monthly' ELSE 'daily' END AS period_type,
            CASE WHEN event_id % 23 = 0 THEN '' WHEN event_id % 31 = 0 THEN NULL
                 WHEN event_id % 7 = 0 THEN strftime(ts, '%Y-%m-%d')
                 WHEN event_id % 29 = 0 THEN substr(strftime(ts, '%Y%m%d%H'), 1, 9)
                 WHEN event_type = 'click' THEN strftime(ts, '%Y%m%d%H')
                 WHEN event_type = 'purchase' THEN strftime(ts, '%Y%m')
                 ELSE strftime(ts, '%Y%m%d') END AS batch_no,
            CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS state, ts AS complete_dt
        FROM events""",
    "parsed": """
        SELECT *,
            CASE WHEN coalesce(batch_no, '') = '' THEN NULL
                 WHEN period_type = 'hourly' AND length(digits) >= 10 THEN substr(digits, 1, 8)
                 WHEN period_type = 'daily' AND length(digits) >= 8 THEN substr(digits, 1, 8)
                 WHEN period_type = 'monthly' AND length(digits) >= 6 THEN NULL
                 WHEN length(digits) >= 10 THEN substr(digits, 1, 8)
                 WHEN length(digits) = 8 THEN digits END AS data_date,
            CASE WHEN coalesce(batch_no, '') = '' THEN NULL
                 WHEN period_type = 'hourly' AND length(digits) >= 10 THEN substr(digits, 1, 6)
                 WHEN period_type = 'daily' AND length(digits) >= 8 THEN substr(digits, 1, 6)
                 WHEN period_type = 'monthly' AND length(digits) >= 6 THEN substr(digits, 1, 6)
                 WHEN length(digits) >= 10 THEN substr(digits, 1, 6)
                 WHEN length(digits) = 8 THEN substr(digits, 1, 6)
                 WHEN length(digits) = 6 THEN digits END AS data_month,
            CASE WHEN coalesce(batch_no, '') = '' THEN NULL
                 WHEN period_type = 'hourly' AND length(digits) >= 10 THEN substr(digits, 9, 2)
                 WHEN period_type = 'daily' AND length(digits) >= 8 THEN NULL
                 WHEN period_type = 'monthly' AND length(digits) >= 6 THEN NULL
                 WHEN length(digits) >= 10 THEN substr(digits, 9, 2) END AS data_hour
        FROM (SELECT *, regexp_replace(batch_no, '[^0-9]', '', 'g') AS digits FROM {source}) q""",
    "firsts": """
        SELECT * FROM (
            SELECT event_id, task_name, coalesce(nullif(period_type, ''), 'daily') AS period_type,
                coalesce(batch_no, '') AS batch_no,
                row_number() OVER (PARTITION BY task_name, coalesce(batch_no, '')
                                   ORDER BY complete_dt, event_id) AS rn
            FROM log WHERE state = 1 AND complete_dt >= TIMESTAMP '2024-01-01'
                AND complete_dt < TIMESTAMP '2024-02-01') q
        WHERE rn = 1""",
    "sched": """
        SELECT c_custkey * 4 + k AS ord, kind || '_' || c_custkey AS task_name,
            CASE WHEN c_nationkey % 7 = 0 THEN '' ELSE 'i' || c_nationkey END AS interface_id,
            CAST(c_nationkey AS VARCHAR) AS platform_id,
            CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey % 3 AS VARCHAR) ELSE '' END AS partner_id,
            CASE kind WHEN 'click' THEN 'hourly' WHEN 'purchase' THEN 'monthly' ELSE 'daily' END AS period_type,
            kind, c_mktsegment, c_custkey
        FROM customer, (VALUES (0, 'click'), (1, 'purchase'), (2, 'signup'), (3, 'view')) AS t(k, kind)""",
    "sched_tables": """
        SELECT ord, CAST(0 AS BIGINT) AS table_ord, task_name, interface_id, platform_id, partner_id, period_type,
            'ods.' || kind AS table_name, '/lake/' || kind || '/' AS base_path,
            CASE kind WHEN 'click' THEN 'orc' WHEN 'purchase' THEN 'parquet'
                      WHEN 'view' THEN 'textfile' ELSE 'csv' END AS format,
            CASE kind WHEN 'click' THEN '/ymd=${data_date}/hour=${data_hour}/cust=' || c_custkey
                      WHEN 'purchase' THEN 'ym=${data_month}'
                      WHEN 'view' THEN 'ymd=${data_date}' END AS partition_template,
            CASE kind WHEN 'purchase' THEN '|' ELSE chr(92) || 'n' END AS delimiter
        FROM sched
        UNION ALL
        SELECT ord, CAST(1 AS BIGINT), task_name, interface_id, platform_id, partner_id, period_type,
            'ods.extra', '/lake/extra', 'orc', 'seg=' || c_mktsegment || '/x=${unknown}', chr(92) || 'n'
        FROM sched WHERE kind = 'view'""",
    "dated": """
        SELECT s.*, c.batch_no,
            CASE WHEN s.period_type = 'monthly' THEN NULL WHEN c.explicit_date IS NOT NULL THEN c.explicit_date
                 ELSE coalesce(c.data_date, d.day) END AS data_date,
            CASE WHEN c.explicit_date IS NOT NULL THEN substr(c.explicit_date, 1, 6)
                 WHEN s.period_type = 'monthly' THEN coalesce(c.data_month, '202312')
                 WHEN c.data_date IS NOT NULL THEN c.data_month ELSE substr(d.day, 1, 6) END AS data_month,
            CASE WHEN c.explicit_date IS NULL THEN c.data_hour END AS data_hour
        FROM {tasks} c JOIN {schedules} s ON s.task_name = c.task_name {period}
        JOIN (VALUES ('hourly', '20240131'), ('monthly', '20231231'), ('daily', '20240130')) AS d(period_type, day)
            ON d.period_type = s.period_type""",
    "all_jobs": """
        SELECT *, CASE WHEN partition_template IS NULL THEN base_path ELSE rtrim(base_path, '/') || '/' || ltrim(
            CASE WHEN data_hour IS NULL THEN p ELSE replace(p, '${data_hour}', data_hour) END, '/') END AS hdfs_path
        FROM (SELECT *, CASE WHEN data_month IS NULL THEN q ELSE replace(q, '${data_month}', data_month) END AS p
              FROM (SELECT *, CASE WHEN data_date IS NULL THEN partition_template
                        ELSE replace(partition_template, '${data_date}', data_date) END AS q FROM dated) a) b""",
    "dated_log": """
        SELECT event_id, event_type, user_id, ts AS complete_dt, 1 AS state, 'daily' AS period_type,
            CASE event_type WHEN 'click' THEN user_id || '_click_' || strftime(ts, '%Y%m%d%H')
                WHEN 'purchase' THEN 'purchase_' || strftime(ts, '%Y%m') || '_' || user_id
                WHEN 'view' THEN 'view_' || user_id || '_' || CASE WHEN event_id % 9 = 0 THEN strftime(ts, '%Y1399')
                    WHEN event_id % 9 < 4 THEN strftime(ts, '%Y%m01') ELSE strftime(ts, '%Y%m%d') END
                WHEN 'signup' THEN CASE WHEN event_id % 5 = 0 THEN 'signup_' || user_id
                    ELSE 'signup_' || strftime(ts, '%Y%m%d_%H_') || user_id || strftime(ts, '_%Y%m') END
                ELSE 'error_' || strftime(ts, '%Y%m%d') || '_' || user_id END AS task_name,
            CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN strftime(ts, '%Y%m%d') ELSE strftime(ts, '%Y%m%d%H') END AS batch_no
        FROM events""",
    "dated_firsts": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_name, batch_no ORDER BY complete_dt, event_id) AS rn
            FROM dated_log) q WHERE rn = 1""",
    "patterns": """
        SELECT c_custkey, k, c_custkey * 8 + k AS ord, kind, replace(replace(name, 'N', CAST(c_custkey AS VARCHAR)), 'Z', '$') AS task_name,
            '^' || replace(replace(replace(replace(name, 'N', CAST(c_custkey AS VARCHAR)), 'Z{data_date}', '(?P<d>[0-9]{8})'),
                'Z{data_month}', '(?P<m>[0-9]{6})'), 'Z{data_hour}', '(?P<h>[0-9]{2})') || '$' AS rx
        FROM customer, (VALUES (0, 'click', 'N_click_Z{data_date}06'), (1, 'click', 'N_click_Z{data_date}18'),
            (2, 'purchase', 'purchase_Z{data_month}_N'), (3, 'view', 'view_N_Z{data_date}'), (4, 'view', 'view_N_Z{data_month}01'),
            (5, 'signup', 'signup_Z{data_date}_Z{data_hour}_N_Z{data_month}'), (6, 'signup', 'signup_N')) AS t(k, kind, name)""",
    "named_jobs": """
        SELECT p.ord, p.k, p.task_name, f.task_name AS log_name, f.batch_no,
            CASE WHEN length(batch_no) >= 8 THEN substr(batch_no, 1, 8)
                 WHEN k = 0 OR k = 1 THEN substr(f.task_name, length(f.task_name) - 9, 8) WHEN k = 3 THEN right(f.task_name, 8)
                 WHEN k = 5 THEN substr(f.task_name, 8, 8) END AS data_date,
            CASE WHEN length(batch_no) >= 8 THEN substr(batch_no, 1, 6)
                 WHEN k = 0 OR k = 1 THEN substr(f.task_name, length(f.task_name) - 9, 6) WHEN k = 2 THEN substr(f.task_name, 10, 6)
                 WHEN k = 3 OR k = 4 THEN substr(right(f.task_name, 8), 1, 6) WHEN k = 5 THEN right(f.task_name, 6) END AS data_month,
            CASE WHEN k = 5 THEN substr(f.task_name, 17, 2) END AS data_hour
        FROM dated_firsts f JOIN patterns p ON p.c_custkey = f.user_id AND p.kind = f.event_type
            AND regexp_full_match(f.task_name, p.rx) AND NOT (p.k = 3 AND right(f.task_name, 4) = '1399')""",
    "hist": """
        SELECT o_orderkey AS id, 'load_' || (o_custkey % 50) AS task_name,
            CAST(o_custkey % 7 AS VARCHAR) AS interface_id, substr(o_orderpriority, 1, 1) AS platform_id,
            CAST(o_custkey % 3 AS VARCHAR) AS partner_id, 't' || (o_custkey % 20) AS table_name,
            CASE WHEN o_orderkey % 11 = 0 THEN 'monthly' ELSE 'daily' END AS period_type,
            strftime(o_orderdate, '%Y%m%d') AS batch_no, strftime(o_orderdate, '%Y-%m-%d') AS data_date,
            strftime(o_orderdate, '%Y%m') AS data_month,
            CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_orderkey % 1000 END AS row_count,
            CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'partial' ELSE 'failed' END AS status,
            o_orderdate AS created_at
        FROM orders""",
    "files": """
        SELECT '/lake/p' || l_partkey AS hdfs_path,
            CASE WHEN l_partkey % 13 = 0 AND l_linenumber = 1 THEN NULL
                 ELSE '/lake/p' || l_partkey || '/f' || l_orderkey || '_' || l_linenumber END AS file,
            CAST(floor(l_quantity) AS BIGINT) AS row_count, CAST(floor(l_extendedprice) AS BIGINT) AS file_size,
            CASE WHEN l_partkey % 13 = 0 AND l_linenumber = 1 THEN 'Path does not exist'
                 WHEN l_partkey % 11 = 0 THEN 'not a footer'
                 WHEN l_partkey % 3 = 0 AND (l_orderkey + l_linenumber) % 5 = 0 THEN 'bad footer' END AS error,
            CAST(l_linenumber AS BIGINT) AS duration_ms
        FROM lineitem""",
    "totals": """
        SELECT hdfs_path,
            CAST(coalesce(sum(row_count) FILTER (WHERE file IS NOT NULL AND error IS NULL), 0) AS BIGINT) AS row_count,
            count(file) AS file_count, count(*) FILTER (WHERE file IS NOT NULL AND error IS NULL) AS success_file_count,
            CAST(coalesce(sum(file_size) FILTER (WHERE file IS NOT NULL AND error IS NULL), 0) AS BIGINT) AS total_size_bytes,
            count(*) FILTER (WHERE file IS NULL AND error IS NOT NULL) AS path_errors,
            CAST(sum(duration_ms) AS BIGINT) AS duration_ms
        FROM files GROUP BY hdfs_path""",
    "named": """
        SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '${yesterday}' WHEN 1 THEN '${today}' WHEN 2 THEN NULL
            WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 4 THEN strftime(o_orderdate, '%Y%m') || '31'
            ELSE strftime(o_orderdate, '%Y%m%d') END AS name
        FROM orders""",
    "named_days": r"""
        SELECT o_orderkey, name, CASE WHEN regexp_full_match(name, '[0-9]{8}')
            THEN CAST(try_strptime(name, '%Y%m%d') AS DATE) END AS day FROM named""",
    "daily_latest": """
        SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY table_name, platform_id, data_date ORDER BY created_at DESC, id DESC) AS rn
            FROM hist {filter}) q WHERE rn = 1""",
    "templates": """
        SELECT s_suppkey AS ord, CASE s_suppkey % 4 WHEN 1 THEN 'region' WHEN 2 THEN 'region & slot'
            WHEN 3 THEN 'slot' END AS loop_var FROM supplier""",
    "region": """
        SELECT CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS ord, lpad(CAST(v AS VARCHAR), 2, '0') AS value
        FROM (SELECT unnest(range(lo, hi + 1, 5)) AS v
              FROM (SELECT min(n_nationkey) AS lo, max(n_nationkey) AS hi FROM nation) a) b""",
    "slot": """
        SELECT CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS ord, value
        FROM (SELECT DISTINCT c_mktsegment AS value FROM customer) q""",
    "expanded": """
        SELECT t.ord, CAST(0 AS BIGINT) AS combo, '${region}' AS r, '${slot}' AS s FROM templates t WHERE loop_var IS NULL
        UNION ALL SELECT t.ord, r.ord, r.value, '${slot}' FROM templates t, region r WHERE loop_var = 'region'
        UNION ALL SELECT t.ord, s.ord, '${region}', s.value FROM templates t, slot s WHERE loop_var = 'slot'
        UNION ALL SELECT t.ord, r.ord * (SELECT count(*) FROM slot) + s.ord, r.value, s.value
            FROM templates t, region r, slot s WHERE loop_var = 'region & slot'""",
    "groups": """
        SELECT ord, CAST(sum(n) OVER (ORDER BY ord) - n AS BIGINT) AS start_idx, n AS count
        FROM (SELECT ord, count(*) AS n FROM expanded GROUP BY ord) q""",
}


def with_(names: str, select: str, **fill) -> str:
    """A statement over named subqueries; `fill` replaces {words} in them."""
    bodies = []
    for name in names.split():
        body = PARTS[name]
        for word, text in fill.items():
            body = body.replace("{%s}" % word, text)
        bodies.append(f"{name} AS ({body})")
    return f"WITH {', '.join(bodies)} {select}"


def tasks(select: str, more: str = "") -> str:
    return with_(f"log firsts parsed {more}", select, source="firsts")


COMPLETED = "(SELECT *, CAST(NULL AS VARCHAR) AS explicit_date FROM parsed)"
GIVEN_SOME = "(SELECT *, CASE WHEN length(task_name) % 4 = 0 THEN '20240115' END AS explicit_date FROM parsed)"
GIVEN_ALL = "(SELECT *, '20240115' AS explicit_date FROM parsed)"
SAME_PERIOD = "AND s.period_type = c.period_type"


def jobs(select: str, given: str = COMPLETED) -> str:
    return with_(
        "log firsts parsed sched sched_tables dated all_jobs",
        select,
        source="firsts",
        tasks=given,
        schedules="sched_tables",
        period=SAME_PERIOD,
    )


JOB_COLUMNS = """ord, table_ord, task_name, interface_id, platform_id, partner_id, period_type, table_name,
    hdfs_path, format, delimiter, data_date, data_month, data_hour, batch_no"""
RUNNABLE = "FROM all_jobs WHERE NOT contains(hdfs_path, '${')"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def count_tables(extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count{extra} FROM {t}" for t in TABLES
    )


def lookup(where: str, tail: str = "") -> str:
    return with_("hist", f"SELECT id, table_name, data_date, row_count, status FROM hist WHERE {where} {tail}")


NEWEST = "ORDER BY created_at DESC, id DESC LIMIT 1"


def latest(keys: str, where: str = "TRUE") -> str:
    return with_(
        "hist",
        f"""SELECT id, table_name, data_date, row_count, status FROM (SELECT *, row_number() OVER (
            PARTITION BY {keys} ORDER BY created_at DESC, id DESC) AS rn FROM hist WHERE {where}) q WHERE rn = 1""",
    )


def daily(filter: str = "") -> str:
    return with_(
        "hist daily_latest",
        """SELECT data_date, count(*) AS total_tables, count(*) FILTER (WHERE status = 'success') AS success_count,
            count(*) FILTER (WHERE status = 'failed') AS failed_count, CAST(sum(row_count) AS BIGINT) AS total_rows,
            CAST(coalesce(sum(row_count) FILTER (WHERE row_count >= 0), 0) AS BIGINT) AS total_rows_counted
        FROM daily_latest GROUP BY data_date""",
        filter=filter,
    )


def windows(mark: str, overlap: str, limit: str | None, lookback: str) -> str:
    now = "TIMESTAMP '2024-01-20 12:00:00.75'"
    end = f"coalesce(least({now}, mark + INTERVAL '{limit}'), {now})" if limit else now
    return f"""
        SELECT event_id, strftime(date_trunc('second', CASE WHEN mark - INTERVAL '{overlap}' < e
                THEN mark - INTERVAL '{overlap}' ELSE e - INTERVAL '{lookback}' END), '%Y-%m-%d %H:%M:%S') AS start_time,
            strftime(date_trunc('second', e), '%Y-%m-%d %H:%M:%S') AS end_time
        FROM (SELECT event_id, mark, {end} AS e FROM (SELECT event_id, {mark} AS mark FROM events) a) b"""


TEXT_ROWS = "length(text) - length(replace(text, chr(10), ''))"
MARKS = "(length(text) - length(replace(text, '~#', ''))) // 2"

ORACLE = {
    "count_parquet_files": count_tables(),
    "count_parquet_footers": count_tables(", 'success' AS status"),
    "count_orc_files": "SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1",
    "count_files_again": "SELECT o_orderstatus, count(*) AS row_count, 0 AS opened FROM orders GROUP BY 1",
    "path_error_classes": with_(
        "files",
        """SELECT hdfs_path, error || ' in ? at <path>: byte <n>' AS error_class, count(*) AS files, min(coalesce(file, '')) AS example_file
        FROM files WHERE error IS NOT NULL GROUP BY ALL""",
    ),
    "count_text_files": f"SELECT lang, CAST(sum({TEXT_ROWS} + 1) AS BIGINT) AS row_count FROM documents GROUP BY lang",
    "count_text_files_multibyte": f"SELECT lang, CAST(sum({MARKS} + 1) AS BIGINT) AS row_count FROM documents GROUP BY lang",
    "count_text_ranges": f"SELECT lang, CAST(sum({MARKS} + 1) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS errors FROM documents GROUP BY lang",
    "count_text_rows": f"""SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE {TEXT_ROWS}
        + CASE WHEN ends_with(text, chr(10)) THEN 0 ELSE 1 END END AS row_count FROM documents""",
    "count_text_rows_multibyte": """SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE
        (length(text) - length(replace(text, '. ', ''))) // 2
        + CASE WHEN ends_with(text, '. ') THEN 0 ELSE 1 END END AS row_count FROM documents""",
    "list_data_files": """SELECT 'day=' || strftime(ts, '%Y%m%d') AS folder, count(*) AS row_count FROM events
        WHERE event_type NOT IN ('error', 'signup') GROUP BY 1""",
    "audit_jobs_by_pattern": with_(
        "dated_log dated_firsts patterns named_jobs",
        """SELECT * FROM (SELECT ord, task_name, batch_no, '/lake/k' || k || '/' || CASE
                WHEN k IN (0, 1, 5) THEN 'ymd=' || coalesce(data_date, '20240130') || '/h=' || CASE k WHEN 0 THEN '06' WHEN 1 THEN '18' ELSE data_hour END
                WHEN k IN (2, 4) THEN 'ym=' || CASE WHEN data_date IS NULL THEN '202401' ELSE data_month END
                ELSE 'ymd=' || coalesce(data_date, '20240130') END AS hdfs_path,
            coalesce(data_date, '20240130') AS data_date, CASE WHEN data_date IS NULL THEN '202401' ELSE data_month END AS data_month,
            data_hour FROM named_jobs) q WHERE hdfs_path IS NOT NULL""",
    ),
    "unconfigured_by_pattern": with_(
        "dated_log dated_firsts patterns named_jobs",
        """SELECT task_name, batch_no FROM dated_firsts
        EXCEPT ALL SELECT DISTINCT log_name, batch_no FROM named_jobs""",
    ),
    "count_dispatch_by_format": """SELECT event_type, CASE event_type WHEN 'click' THEN 'textfile' WHEN 'purchase' THEN 'parquet'
            WHEN 'view' THEN 'orc' ELSE 'csv' END AS format,
        CASE WHEN event_type IN ('view', 'purchase') THEN count(*) WHEN event_type = 'click' THEN 2 * count(*)
            ELSE -1 END AS row_count,
        CASE WHEN event_type IN ('click', 'purchase', 'view') THEN 'success' ELSE 'failed' END AS status
        FROM events GROUP BY event_type""",
    "task_log_window": with_(
        "log",
        """SELECT event_id, task_name, period_type, batch_no FROM log WHERE state = 1
        AND complete_dt >= TIMESTAMP '2024-01-10' AND complete_dt < TIMESTAMP '2024-01-20 12:00:00'""",
    ),
    "task_log_window_by_date": with_(
        "log",
        """SELECT event_id, task_name, period_type, batch_no FROM log WHERE state = 1
        AND complete_dt >= TIMESTAMP '2024-01-01' AND complete_dt < TIMESTAMP '2024-02-01'
        AND replace(batch_no, '-', '') LIKE '20240115%'""",
    ),
    "task_log_distinct": with_(
        "log",
        """SELECT DISTINCT task_name, '' AS batch_no FROM log WHERE state = 1
        AND complete_dt >= TIMESTAMP '2024-01-10' AND complete_dt < TIMESTAMP '2024-01-20'""",
    ),
    "completed_tasks": tasks(
        "SELECT task_name, period_type, batch_no, data_date, data_month, data_hour FROM parsed"
    ),
    "tasks_from_metadata": tasks(
        "SELECT task_name, period_type, batch_no, data_date, data_month, data_hour FROM parsed"
    ),
    "fetch_stats": with_(
        "log",
        """SELECT count(*) AS records, count(DISTINCT task_name) AS tasks,
            count(DISTINCT task_name || chr(1) || coalesce(batch_no, '')) AS task_batches
        FROM log WHERE state = 1 AND complete_dt >= TIMESTAMP '2024-01-01' AND complete_dt < TIMESTAMP '2024-02-01'""",
    ),
    "parse_batch_no": with_(
        "log parsed", "SELECT event_id, data_date, data_month, data_hour FROM parsed", source="log"
    ),
    "incr_overlap_dedup": with_("log firsts", "SELECT task_name, batch_no, period_type FROM firsts"),
    "stream_task_history": with_(
        "log firsts",
        "SELECT task_name, batch_no, period_type FROM firsts",
    ),
    "stream_first_completions": tasks(
        "SELECT task_name, period_type, batch_no, data_date, data_month, data_hour FROM parsed"
    ),
    "stream_dedup": with_(
        "log", "SELECT DISTINCT task_name, coalesce(batch_no, '') AS batch_no FROM log WHERE state = 1"
    ),
    "resolve_dates": with_(
        "log firsts parsed sched dated",
        "SELECT task_name, batch_no, data_date, data_month, data_hour FROM dated",
        source="firsts",
        tasks=GIVEN_SOME,
        schedules="sched",
        period="",
    ),
    "period_default_date": with_(
        "log",
        """SELECT event_id, strftime(CASE WHEN period_type IN ('hourly', 'minutely') THEN CAST(complete_dt AS DATE)
            WHEN period_type = 'monthly' THEN CAST(date_trunc('month', complete_dt) AS DATE) - 1
            ELSE CAST(complete_dt AS DATE) - 1 END, '%Y%m%d') AS data_date FROM log""",
    ),
    "resolve_named_date": with_(
        "named named_days",
        """SELECT o_orderkey, CASE WHEN name IS NULL OR name = '${yesterday}' THEN '20240130'
            WHEN name = '${today}' THEN '20240131' WHEN day IS NOT NULL THEN name END AS data_date,
            CASE WHEN name IS NOT NULL AND name NOT IN ('${yesterday}', '${today}') AND day IS NULL
                THEN 'not a yyyyMMdd date: ' || name END AS error FROM named_days""",
    ),
    "audit_date_parse": with_(
        "named named_days", "SELECT o_orderkey, CAST(day AS VARCHAR) AS data_date FROM named_days"
    ),
    "month_of_date": with_(
        "named named_days", "SELECT o_orderkey, strftime(day, '%Y%m') AS data_month FROM named_days"
    ),
    "render_partition": tasks(
        """SELECT task_name, batch_no, 'ym=' || coalesce(data_month, '${data_month}') || '/ymd='
            || coalesce(data_date, '${data_date}') || '/h=' || coalesce(data_hour, '${data_hour}') || '/' AS partition
        FROM parsed"""
    ),
    "render_path": tasks(
        """SELECT task_name, batch_no, CASE WHEN length(task_name) % 3 = 0 THEN base
            WHEN base = '' THEN t ELSE rtrim(base, '/') || '/' || ltrim(t, '/') END AS hdfs_path
        FROM (SELECT task_name, batch_no,
            CASE WHEN length(task_name) % 5 = 0 THEN '' WHEN length(task_name) % 5 = 1 THEN '/lake/a//'
                ELSE '/lake/b' END AS base,
            CASE WHEN length(task_name) % 3 = 1 THEN '/' ELSE '' END || 'ym=' || coalesce(data_month, '${data_month}')
                || '/ymd=' || coalesce(data_date, '${data_date}') || '/h=' || coalesce(data_hour, '${data_hour}') || '/' AS t
            FROM parsed) q"""
    ),
    "schedule_tables": with_(
        "sched sched_tables",
        """SELECT ord, table_ord, task_name, interface_id, platform_id, partner_id, period_type, table_name,
            base_path, format, partition_template,
            CASE WHEN delimiter = '|' THEN '|' ELSE chr(92) || 'n' END AS delimiter FROM sched_tables""",
    ),
    "config_violations": """
        SELECT 'schedule_task_name' AS rule, c_custkey AS ord, CAST(-1 AS BIGINT) AS table_ord, 'task_name' AS field
        FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'schedule_tables', c_custkey, -1, 'tables' FROM customer WHERE c_nationkey % 5 = 0
        UNION ALL SELECT 'table_field', c_custkey, 0, 'hdfs_path' FROM customer WHERE c_nationkey % 5 <> 0 AND c_nationkey % 6 = 0
        UNION ALL SELECT 'table_field', c_custkey, 0, 'format' FROM customer WHERE c_nationkey % 5 <> 0 AND c_mktsegment = 'MACHINERY'""",
    "schedule_by_task": with_(
        "sched", "SELECT ord, task_name, CAST(2 AS BIGINT) AS n_tables FROM sched WHERE task_name = 'view_77'"
    ),
    "all_task_names": with_("sched", "SELECT ord, task_name FROM sched"),
    "tasks_all_configured": with_("sched", "SELECT DISTINCT task_name, '' AS batch_no FROM sched"),
    "tasks_from_names": with_(
        "log",
        """SELECT DISTINCT task_name, '' AS batch_no, CAST(NULL AS VARCHAR) AS period_type,
            CAST(NULL AS VARCHAR) AS data_date FROM log""",
    ),
    "tasks_explicit": with_(
        "sched",
        "SELECT DISTINCT task_name, '' AS batch_no FROM sched WHERE task_name IN ('click_7', 'view_11', 'ghost_1', 'purchase_149')",
    ),
    "tasks_explicit_unknown": with_(
        "sched",
        """SELECT task_name FROM (VALUES ('click_7'), ('view_11'), ('ghost_1'), ('purchase_149')) AS n(task_name)
        WHERE task_name NOT IN (SELECT task_name FROM sched)""",
    ),
    "audit_jobs": jobs(f"SELECT {JOB_COLUMNS} {RUNNABLE}"),
    "audit_jobs_explicit_date": jobs(
        f"SELECT ord, batch_no, hdfs_path, data_date, data_month, data_hour {RUNNABLE}", GIVEN_ALL
    ),
    "audit_jobs_preview": jobs(
        f'SELECT table_name AS "table", hdfs_path AS path, interface_id, platform_id, partner_id, \'dry_run\' AS status {RUNNABLE}'
    ),
    "unresolved_jobs": jobs(
        "SELECT ord, table_ord, task_name, batch_no, hdfs_path FROM all_jobs WHERE contains(hdfs_path, '${')"
    ),
    "period_mismatch": tasks(
        """SELECT s.ord, s.task_name, p.batch_no, s.period_type, p.period_type AS log_period
        FROM parsed p JOIN sched s ON s.task_name = p.task_name WHERE p.period_type <> s.period_type""",
        "sched",
    ),
    "unconfigured_tasks": tasks(
        """SELECT task_name, batch_no FROM parsed p
        WHERE NOT EXISTS (SELECT 1 FROM sched s WHERE s.task_name = p.task_name)""",
        "sched",
    ),
    "path_totals": with_(
        "files totals",
        """SELECT hdfs_path, row_count, file_count, success_file_count, total_size_bytes, path_errors, duration_ms
        FROM totals""",
    ),
    "path_status": with_(
        "files totals",
        """SELECT hdfs_path, CASE WHEN path_errors > 0 THEN -1 ELSE row_count END AS row_count,
            CASE WHEN path_errors > 0 THEN 0 ELSE file_count END AS file_count,
            CASE WHEN path_errors > 0 THEN 0 ELSE success_file_count END AS success_file_count,
            CASE WHEN path_errors > 0 THEN 0 ELSE total_size_bytes END AS total_size_bytes,
            CASE WHEN path_errors > 0 THEN 'failed' WHEN success_file_count = file_count THEN 'success'
                WHEN success_file_count > 0 THEN 'partial' ELSE 'failed' END AS status FROM totals""",
    ),
    "path_errors": with_(
        "files",
        "SELECT hdfs_path, coalesce(file, '') AS file, error FROM files WHERE error IS NOT NULL",
    ),
    "path_errors_inline": with_(
        "files",
        """SELECT hdfs_path, count(*) AS n,
            string_agg(coalesce(file, '') || ':' || error, ',' ORDER BY coalesce(file, ''), error) AS errors
        FROM files WHERE error IS NOT NULL GROUP BY hdfs_path""",
    ),
    "count_result_from_json": """
        SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '/p/' || o_orderkey WHEN 3 THEN '/p' ELSE '' END AS path,
            CASE WHEN o_orderkey % 5 = 2 THEN o_orderkey ELSE -1 END AS row_count,
            CAST(CASE WHEN o_orderkey % 5 = 2 THEN 3 ELSE 0 END AS BIGINT) AS file_count,
            CASE o_orderkey % 5 WHEN 2 THEN 'success' WHEN 3 THEN 'partial' ELSE 'failed' END AS status,
            CAST(CASE WHEN o_orderkey % 5 = 2 THEN 5 ELSE 0 END AS BIGINT) AS duration_ms,
            CAST(CASE WHEN o_orderkey % 5 = 3 THEN 2 ELSE 0 END AS BIGINT) AS n_errors,
            CASE WHEN o_orderkey % 5 = 3 THEN 'f' || o_custkey ELSE '' END AS first_file FROM orders""",
    "audit_result_rows": jobs(
        """SELECT task_name, interface_id, platform_id, partner_id, table_name, hdfs_path, period_type, batch_no,
            CAST(CAST(try_strptime(data_date, '%Y%m%d') AS DATE) AS VARCHAR) AS data_date, data_month, data_hour,
            count(*) OVER (PARTITION BY hdfs_path, format, delimiter) AS row_count, CAST(1 AS BIGINT) AS file_count,
            CAST(10 AS BIGINT) AS total_size_bytes,
            CASE length(hdfs_path) % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'partial' ELSE 'failed' END AS status,
            CASE WHEN length(hdfs_path) % 3 <> 0 THEN '[{"file":"f","error":"bad"}]' END AS error_msg,
            CAST(0 AS BIGINT) AS duration_ms, '2024-01-31 01:02:03' AS created_at """
        + RUNNABLE
    ),
    "audit_append": with_(
        "hist", "SELECT id, table_name, period_type, data_date, data_month, row_count FROM hist"
    ),
    "audit_read_since": with_(
        "hist",
        """SELECT id, table_name, day AS data_date, row_count FROM (
            SELECT *, CASE WHEN id % 11 <> 0 THEN data_date END AS day,
                CASE WHEN id % 7 <> 0 THEN data_month END AS mon FROM hist) h
        WHERE CASE WHEN day IS NOT NULL THEN day >= '2000-06-15' WHEN mon IS NOT NULL THEN mon >= '200006'
            ELSE CAST(created_at AS DATE) >= DATE '2000-06-15' END""",
    ),
    "run_table_results": with_(
        "hist files",
        """SELECT table_name, count(*) AS results,
            (SELECT count(*) FROM files WHERE error IS NOT NULL AND length(coalesce(file, '')) % 3 <> 1) AS errors,
            CAST(epoch_us(TIMESTAMP '2024-01-03') AS BIGINT) AS mark
        FROM hist WHERE id % 3 <> 1 AND data_date >= '1995-06-15' GROUP BY table_name""",
    ),
    "run_summary": with_(
        "hist",
        """SELECT data_date, count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success,
            count(*) FILTER (WHERE status = 'partial') AS partial, count(*) FILTER (WHERE status = 'failed') AS failed
        FROM hist GROUP BY data_date""",
    ),
    "full_audit": """
        WITH batches AS (
            SELECT event_type AS task_name, count(*) AS n,
                CASE event_type WHEN 'click' THEN 'hourly' WHEN 'purchase' THEN 'monthly' ELSE 'daily' END AS period_type,
                CASE event_type WHEN 'click' THEN strftime(ts, '%Y%m%d%H') WHEN 'purchase' THEN strftime(ts, '%Y%m')
                    ELSE strftime(ts, '%Y%m%d') END AS batch_no
            FROM events WHERE event_type <> 'error' GROUP BY ALL),
        jobs AS (
            SELECT *, 'ods.' || task_name AS table_name, CASE task_name
                WHEN 'click' THEN '/click/ymd=' || substr(batch_no, 1, 8) || '/hour=' || substr(batch_no, 9, 2)
                WHEN 'purchase' THEN '/purchase/ym=' || batch_no WHEN 'view' THEN '/view/ymd=' || batch_no
                ELSE '/signup' END AS path,
                CASE task_name WHEN 'click' THEN 2 * n WHEN 'signup' THEN -1 ELSE n END AS row_count,
                CASE WHEN task_name = 'signup' THEN 'Invalid format: csv. Supported formats: orc, parquet, textfile' END AS error
            FROM batches
            UNION ALL SELECT *, 'ods.copy', '/copy/ymd=' || substr(batch_no, 1, 8), -1,
                'Failed to access path: Path does not exist: /copy/ymd=' || substr(batch_no, 1, 8)
            FROM batches WHERE task_name = 'click')
        SELECT task_name, table_name, path, period_type, batch_no,
            CASE WHEN period_type <> 'monthly' THEN substr(batch_no, 1, 4) || '-' || substr(batch_no, 5, 2) || '-'
                || substr(batch_no, 7, 2) END AS data_date,
            substr(batch_no, 1, 6) AS data_month, CASE WHEN period_type = 'hourly' THEN substr(batch_no, 9, 2) END AS data_hour,
            row_count, CASE WHEN error IS NULL THEN 'success' ELSE 'failed' END AS status,
            '[{"file":"","error":"' || error || '"}]' AS error_msg FROM jobs""",
    "latest_per_table": latest("table_name, data_date"),
    "latest_per_table_day": latest("table_name, data_date", "data_date = '1998-04-15'"),
    "latest_per_table_platform": latest("table_name, platform_id, data_date"),
    "latest_result_date": lookup(
        "table_name = 't1' AND data_date = '1998-07-09' AND platform_id = '2'", NEWEST
    ),
    "latest_result_month": lookup(
        "table_name = 't0' AND data_month = '199506' AND platform_id = '3'", NEWEST
    ),
    "latest_result_any": lookup("table_name = 't7' AND platform_id = '1'", NEWEST),
    "latest_result_ci": lookup("table_name = 't7' AND platform_id = '1'", NEWEST),
    "results_by_partner": lookup("partner_id = '0' AND data_date = '1995-01-14'"),
    "results_by_partner_month": lookup("partner_id = '1' AND data_month = '199804'"),
    "results_by_interface": lookup("interface_id = '3' AND data_month = '199804'"),
    "results_by_interface_date": lookup("interface_id = '0' AND data_date = '1995-02-04'"),
    "results_by_batch": lookup("batch_no = '19980415'"),
    "results_by_period": lookup("period_type = 'monthly' AND data_month = '199504'"),
    "results_by_period_date": lookup("period_type = 'daily' AND data_date = '1998-04-15'"),
    "table_last_7_days": lookup("table_name = 't7' AND data_date >= '2001-07-13'"),
    "failed_results": lookup("status = 'failed'"),
    "results_by_platform": lookup("platform_id = '2'"),
    "recent_results": with_(
        "hist",
        """SELECT task_name, table_name, row_count, status, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
        FROM (SELECT * FROM hist ORDER BY created_at DESC, id DESC LIMIT 10) q""",
    ),
    "daily_rollup_maintained": daily(),
    "daily_rollup": daily(),
    "daily_rollup_7_days": daily("WHERE data_date >= '2001-07-13'"),
    "monthly_rollup": with_(
        "hist",
        """SELECT data_month, count(*) AS total_tasks, count(*) FILTER (WHERE status = 'success') AS success_count,
            CAST(sum(row_count) AS BIGINT) AS total_rows,
            CAST(coalesce(sum(row_count) FILTER (WHERE row_count >= 0), 0) AS BIGINT) AS total_rows_counted
        FROM hist WHERE period_type = 'monthly' GROUP BY data_month""",
    ),
    "incr_window": windows("ts", "600 seconds", "24 hours", "24 hours"),
    "incr_window_cold": windows(
        "CASE WHEN event_type <> 'error' THEN ts END", "600 seconds", "24 hours", "30 minutes"
    ),
    "incr_window_chunked": windows("ts", "0 seconds", "6 hours", "24 hours"),
    "incr_window_future": windows("ts + INTERVAL '15 days'", "600 seconds", None, "24 hours"),
    "state_latest": """
        SELECT user_id, strftime(last_end_time, '%Y-%m-%d %H:%M:%S') AS last_end_time FROM (
            SELECT user_id, CASE WHEN event_type <> 'error' THEN ts - INTERVAL '1 hour' END AS last_end_time,
                row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) q WHERE rn = 1""",
    "advance_decision": """
        SELECT day, CASE WHEN ((total > 0 AND (month = 6 OR (failed = 0 AND partial = 0))) OR (total = 0 AND fetched = 0))
                AND dom NOT IN (1, 2) THEN CAST(1 AS BIGINT) ELSE 0 END AS advance,
            CASE WHEN total = 0 AND fetched > 0 AND month = 12 THEN CAST(1 AS BIGINT) ELSE 0 END AS stalled
        FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, month(min(o_orderdate)) AS month, day(min(o_orderdate)) AS dom,
            count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS total,
            count(*) FILTER (WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P') AS failed,
            count(*) FILTER (WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'O') AS partial,
            count(*) FILTER (WHERE o_orderpriority IN ('2-HIGH', '5-LOW')) AS fetched
            FROM orders GROUP BY 1) q""",
    "template_range": """
        SELECT var, CAST(ord AS BIGINT) AS ord, CASE WHEN v < 0 THEN '-' || CASE WHEN length(t) < pad
                THEN lpad(substr(t, 2), CAST(pad - 1 AS INTEGER), '0') ELSE substr(t, 2) END
            WHEN length(t) < pad THEN lpad(t, CAST(pad AS INTEGER), '0') ELSE t END AS value
        FROM (SELECT var, pad, ord, lo + ord * step AS v, CAST(lo + ord * step AS VARCHAR) AS t
            FROM (SELECT *, unnest(range(0, CASE WHEN (hi - lo) * step >= 0 THEN (hi - lo) // step + 1 ELSE 0 END)) AS ord
                FROM (SELECT 'v' || p_partkey AS var, p_size AS lo, p_size + p_partkey % 20 - 5 AS hi, p_partkey % 4 AS pad,
                    CASE WHEN p_partkey % 4 = 0 THEN -2 ELSE p_partkey % 4 END AS step FROM part) a) b) c""",
    "template_enum": """
        SELECT s_name AS var, CAST(0 AS BIGINT) AS ord, CAST(s_nationkey AS VARCHAR) AS value FROM supplier
        UNION ALL SELECT s_name, 1, 'x' || s_suppkey FROM supplier""",
    "template_violations": """
        SELECT p_partkey AS ord, CASE p_partkey % 8 WHEN 1 THEN 'ghost' WHEN 2 THEN 'month' WHEN 3 THEN 'data_date'
                WHEN 4 THEN 'none' WHEN 5 THEN 'ghost' WHEN 6 THEN 'odd' END AS var,
            CASE p_partkey % 8 WHEN 1 THEN 'unknown' WHEN 2 THEN 'computed' WHEN 3 THEN 'runtime'
                WHEN 4 THEN 'empty_enum' WHEN 5 THEN 'unknown' WHEN 6 THEN 'unknown_type' END AS rule
        FROM part WHERE p_partkey % 8 NOT IN (0, 7)""",
    "expand_templates": with_(
        "templates region slot expanded",
        """SELECT ord, combo, 'P_' || r || '_S' || ord || '_' || s AS task_name, r AS platform_id, '/w/' || r AS hdfs_path,
            'ymd=${data_date}/slot=' || s AS partition_template FROM expanded""",
    ),
    "expansion_groups": with_(
        "templates region slot expanded groups", "SELECT ord, start_idx, count FROM groups"
    ),
    "expanded_schedules": with_(
        "templates region slot expanded groups",
        """SELECT g.start_idx + e.combo AS ord, 'P_' || e.r || '_S' || e.ord || '_' || e.s AS task_name
        FROM expanded e JOIN groups g ON g.ord = e.ord""",
    ),
}
