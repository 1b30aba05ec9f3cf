"""Counting many small files and one large one.

    python -m checks.file_scale SCRATCH_DIR

Writes lineitem (BENCH_SF_DIR) as 100, 1,000 and 10,000 files and a text file
of 1 GiB under SCRATCH_DIR, then times the ways to count them.
"""

import os
import sys
import time

from pyspark.sql import functions as F

import bench
from laketally.operators.counting import count_files, path_totals
from laketally.sources import scan_row_counts


def timed(label, run):
    began = time.perf_counter()
    rows = run()
    print(f"{label:50s} {time.perf_counter() - began:8.2f} s  {rows} rows", flush=True)


def root(spark, path, format):
    return spark.range(1).select(
        F.lit(path).alias("hdfs_path"), F.lit(format).alias("format"), F.lit("\n").alias("delimiter")
    )


def audited(roots, **options):
    return path_totals(count_files(roots, **options)).agg(F.sum("row_count")).first()[0]


def main(scratch: str):
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = bench.session(os.environ.get("BENCH_CPUS", "8"))
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    n = items.count()
    audited(root(spark, sf_dir, "parquet"))

    for files in (100, 1_000, 10_000):
        path = f"{scratch}/files{files}"
        # A folder per hundredth, as if each were the partition of one job.
        spread = items.withColumn("part", F.pmod(F.hash("l_orderkey", "l_linenumber"), F.lit(100)))
        writer = spread.repartition(8, "part").write.option("maxRecordsPerFile", n // files + 1)
        writer.partitionBy("part").parquet(path)
        folders = spark.range(100).select(
            F.concat(F.lit(f"{path}/part="), F.col("id").cast("string")).alias("hdfs_path"),
            F.lit("parquet").alias("format"),
            F.lit(None).cast("string").alias("delimiter"),
        )
        timed(f"{files} files, 100 paths, one count", lambda: audited(folders))
        timed(f"{files} files, one path, one count", lambda: audited(root(spark, path, "parquet")))
        timed(
            f"{files} files, Spark's own scan",
            lambda: scan_row_counts(spark, [path], "parquet").agg(F.sum("row_count")).first()[0],
        )
        if files == 1_000:
            paths = [f"{path}/part={i}" for i in range(100)]
            timed(
                f"{files} files, one Spark job per path",
                lambda: sum(
                    scan_row_counts(spark, [p], "parquet").agg(F.sum("row_count")).first()[0]
                    for p in paths
                ),
            )

    text = f"{scratch}/text"
    lines = spark.range(1 << 24).select(F.lpad(F.col("id").cast("string"), 63, "x").alias("line"))
    lines.coalesce(1).write.text(text)
    timed("1 GiB text file, byte ranges", lambda: audited(root(spark, text, "textfile"), split_bytes=1 << 26))
    timed("1 GiB text file, one range", lambda: audited(root(spark, text, "textfile"), split_bytes=1 << 40))
    timed(
        "1 GiB text file, Spark's own scan",
        lambda: scan_row_counts(spark, [text], "textfile").agg(F.sum("row_count")).first()[0],
    )


if __name__ == "__main__":
    main(sys.argv[1])
