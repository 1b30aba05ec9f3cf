"""Run queries in Spark and their SQL in DuckDB and compare all rows.

    python -m checks.compare [--sf DIR] [name ...]
"""

import argparse
import sys
import time
from pathlib import Path

import duckdb


def normal(value):
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    """Rows with columns by name, sorted, values as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = path / "*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result; empty when equal."""
    spark_columns, spark_rows = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    sql_columns, sql_rows = rows_of(names, result.fetchall())
    if spark_columns != sql_columns:
        return [f"columns {spark_columns} against {sql_columns}"]
    if spark_rows == sql_rows:
        return []
    extra = sorted(set(spark_rows) - set(sql_rows))[:3]
    missing = sorted(set(sql_rows) - set(spark_rows))[:3]
    return [f"{len(spark_rows)} rows against {len(sql_rows)}", f"only Spark {extra}", f"only SQL {missing}"]


def main():
    from pyspark.sql import SparkSession

    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(args.sf), 0
    for name in args.names or QUERIES:
        began = time.monotonic()
        try:
            found = differences(QUERIES[name](spark, args.sf), con, ORACLE[name])
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.monotonic() - began:.2f}s", *found, sep="\n     ", flush=True)
    print(f"{bad} of {len(args.names or QUERIES)} differ")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
