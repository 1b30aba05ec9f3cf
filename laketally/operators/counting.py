"""Counting rows, files and bytes under many paths in one distributed pass.

    roots -> listing -> one row per file, or per byte range of a text file
          -> counted in place -> per file -> per path

Only metadata rows are shuffled. Nothing is collected: the paths come from a
DataFrame and their files stay in one. Each file error is a row of its own, and
classes of like errors keep the result rows small.
"""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from laketally.functions.text import normalise_delimiter, overlaps_itself
from laketally.plans.scratch import stored
from laketally.sources.filesystems import default_parallelism, in_batches, session_opener
from laketally.sources.listing import list_files

PATH_KEYS = ["hdfs_path", "format", "delimiter"]

SPLIT_BYTES = 256 * 1024 * 1024
BLOCK_BYTES = 8 * 1024 * 1024
#: Ranges are not made shorter than this for the sake of balance.
LEAST_SPLIT = 8 * 1024 * 1024
#: What opening a file weighs against reading it, when work is dealt.
OPEN_BYTES = 64 * 1024

#: What tells a file counted before: the same name, size and time of change, read the same way.
FILE_KEYS = ["file", "format", "delimiter", "size", "modified"]
LEDGER = "file string, format string, delimiter string, size long, modified long, row_count long"


def parquet_rows(fs, path: str) -> int:
    """Rows a Parquet footer declares."""
    import pyarrow.parquet as pq

    with fs.open_input_file(path) as f:
        return pq.read_metadata(f).num_rows


def orc_rows(fs, path: str) -> int:
    """Rows an ORC footer declares."""
    import pyarrow.orc as orc

    with fs.open_input_file(path) as f:
        return orc.ORCFile(f).nrows


def count_occurrences(block: bytes, delimiter: bytes) -> int:
    """Positions of a block where the delimiter starts."""
    if not overlaps_itself(delimiter):
        return block.count(delimiter)
    found, at = 0, block.find(delimiter)
    while at >= 0:
        found, at = found + 1, block.find(delimiter, at + 1)
    return found


def text_range_rows(fs, path: str, size: int, start: int, length: int, delimiter: bytes) -> int:
    """Delimiters that start in one byte range of a text file.

    The range that holds the end of the file adds the last row when that row
    has no delimiter after it, so the ranges of a file add up to its rows.
    """
    if size == 0:
        return 0
    if not delimiter:
        raise ValueError("the delimiter must not be empty")
    extra = len(delimiter) - 1
    end = min(start + length, size)
    found, carry = 0, b""
    with fs.open_input_file(path) as f:
        f.seek(start)
        left = min(end + extra, size) - start
        while left > 0 and (block := f.read(min(BLOCK_BYTES, left))):
            left -= len(block)
            block = carry + block
            found += count_occurrences(block, delimiter)
            carry = block[max(0, len(block) - extra) :] if extra else b""
        if end == size:
            f.seek(max(0, size - len(delimiter)))
            found += f.read(len(delimiter)) != delimiter
    return found


# Format -> (file system, path -> rows), for files whose rows are counted as a
# whole. The extension point for further formats.
FILE_READERS = {"parquet": parquet_rows, "orc": orc_rows}


def count_files(
    roots: DataFrame,
    *,
    levels=1,
    tasks=None,
    split_bytes=SPLIT_BYTES,
    opener=None,
    ledger: str | None = None,
) -> DataFrame:
    """Row count, size and error of every visible file under the roots.

    `roots` has `hdfs_path, format, delimiter`; each distinct combination is
    counted once. The result adds `file, row_count, file_size, error,
    duration_ms`. A row without a file speaks for the path itself: with an
    error when the path cannot be listed or its format is unknown, else it only
    says that the path exists.

    Parquet and ORC cost one footer read per file. A text file is cut into
    byte ranges, so one huge file is shared by many tasks, and all pieces are
    dealt so that every task reads about as many bytes. The listing is stored
    when this is called.

    `ledger` names a table of files counted before. One whose size and time of
    change are still the same is not opened again; others are counted and noted.
    """
    spark = roots.sparkSession
    n = tasks or default_parallelism(spark)
    opener = opener or session_opener(spark)
    keys = roots.select(
        "hdfs_path",
        F.lower("format").alias("format"),
        normalise_delimiter("delimiter").alias("delimiter"),
    ).distinct()
    known = F.coalesce(F.col("format").isin("textfile", *FILE_READERS), F.lit(False))

    listed = list_files(keys.filter(known), levels=levels, tasks=n, opener=opener)
    # Numbered when stored: the task that listed a row, and its place there.
    listed = stored(listed.withColumn("row", F.monotonically_increasing_id()), "listing")
    seen = _seen_before(listed, ledger) if ledger else None
    if seen is not None:
        listed = listed.join(seen, FILE_KEYS, "left")
        seen = listed.filter("seen_rows IS NOT NULL")
        listed = listed.filter("seen_rows IS NULL").drop("seen_rows")

    pieces = deal_pieces(listed, n, split_bytes).drop("kind", "row")
    counted_schema = T.StructType(
        [f for f in pieces.schema.fields if f.name not in ("start", "length")]
        + [T.StructField("rows", T.LongType()), T.StructField("ms", T.LongType())]
    )
    counted = pieces.mapInArrow(_counter(to_arrow_schema(counted_schema), opener), counted_schema)
    per_file = counted.groupBy(*PATH_KEYS, "file").agg(
        F.sum("rows").alias("row_count"),
        F.max("size").alias("file_size"),
        F.min("error").alias("error"),
        F.sum("ms").alias("duration_ms"),
        F.max("modified").alias("modified"),
    )
    if ledger:
        per_file = stored(per_file, "newly-counted")
        _note(per_file, ledger)
    per_file = per_file.drop("modified")
    if seen is not None:
        per_file = per_file.unionByName(
            seen.select(
                *PATH_KEYS,
                "file",
                F.col("seen_rows").alias("row_count"),
                F.col("size").alias("file_size"),
                F.lit(None).cast("string").alias("error"),
                F.lit(0).cast("bigint").alias("duration_ms"),
            )
        )
    unknown = keys.filter(~known).select(
        *PATH_KEYS,
        F.lit(None).cast("string").alias("file"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(None).cast("bigint").alias("file_size"),
        invalid_format_error("format").alias("error"),
        F.lit(0).cast("bigint").alias("duration_ms"),
    )
    return per_file.unionByName(unknown)


def deal_pieces(listed: DataFrame, n: int, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Listed rows, text files in byte ranges, in `n` tasks of about equal bytes.

    A row's place on the line of all bytes is its place in its listing task plus
    what earlier ones hold: two levels of running sums, so no task sees all
    rows. The line is cut into n parts. Ranges are at most `split_bytes`, and
    about a task's share where that is less.
    """
    ranged = (F.col("kind") == "file") & (F.col("format") == "textfile") & (F.col("size") > 0)
    read = F.when(ranged, F.col("size")).otherwise(0)
    weight = F.when(F.col("kind") == "file", read + OPEN_BYTES).otherwise(0).cast("bigint")
    rows = listed.withColumns({"part": F.shiftright("row", 33), "weight": weight})
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("weight").alias("held")).select(  # one row per listing task
        "part",
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
        F.sum("held").over(Window.partitionBy()).alias("total"),
    )
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(parts, "part").withColumn(
        "before", F.col("before") + F.coalesce(F.sum("weight").over(within), F.lit(0))
    )
    split = F.least(F.lit(split_bytes), F.greatest(F.lit(LEAST_SPLIT), F.ceil(F.col("total") / n))).cast("bigint")
    zero = F.lit(0).cast("bigint")
    starts = F.when(ranged, F.sequence(zero, F.col("size") - 1, split)).otherwise(F.array(zero))
    pieces = placed.withColumns({"split": split, "start": F.explode(starts)})
    at = F.col("before") + F.col("start") + F.when(F.col("start") > 0, OPEN_BYTES).otherwise(0)
    task = F.least(F.lit(n - 1), F.floor(at / F.greatest("total", F.lit(1)) * n)).cast("int")
    length = F.when(ranged, F.least(F.col("split"), F.col("size") - F.col("start"))).otherwise(zero)
    dealt = pieces.withColumns({"task": task, "length": length}).repartitionById(n, "task")
    return dealt.select(*listed.columns, "start", "length")


def _seen_before(listed: DataFrame, ledger: str) -> DataFrame | None:
    """(file keys, seen_rows) of the listed files that the ledger knows as they are."""
    try:
        noted = listed.sparkSession.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    here = listed.filter("kind = 'file'").select(*FILE_KEYS).distinct()
    return noted.join(here, FILE_KEYS).groupBy(*FILE_KEYS).agg(F.max("row_count").alias("seen_rows"))


def _note(per_file: DataFrame, ledger: str) -> None:
    good = per_file.filter("file IS NOT NULL AND error IS NULL AND modified IS NOT NULL")
    good = good.withColumnRenamed("file_size", "size").select(*FILE_KEYS, "row_count")
    good.coalesce(default_parallelism(per_file.sparkSession)).write.mode("append").parquet(ledger)


def _counter(schema, opener):
    """The task side of the count: one piece in, one row out."""

    def rows_of(piece):
        fs, path, _ = opener(piece["file"])
        if piece["format"] in FILE_READERS:
            return FILE_READERS[piece["format"]](fs, path)
        delimiter = piece["delimiter"].encode()
        return text_range_rows(fs, path, piece["size"], piece["start"], piece["length"], delimiter)

    def count(piece):
        rows, error, began = 0, piece["error"], time.monotonic()
        if piece["file"] is not None:
            try:
                rows = rows_of(piece)
            except Exception as e:
                error = str(e) or type(e).__name__
        ms = int((time.monotonic() - began) * 1000)
        return {**piece, "rows": rows, "error": error, "ms": ms}

    def run(batches):
        pieces = (piece for batch in batches for piece in batch.to_pylist())
        yield from in_batches(map(count, pieces), schema, size=1_000)

    return run


def invalid_format_error(format):
    # Fixed value: the text an unknown format is reported with.
    return F.concat(
        F.lit("Invalid format: "),
        F.coalesce(F.col(format), F.lit("")),
        F.lit(". Supported formats: orc, parquet, textfile"),
    )


def is_file_error():
    return F.col("file").isNotNull() & F.col("error").isNotNull()


def path_totals(file_counts: DataFrame, keys=PATH_KEYS) -> DataFrame:
    """Rows and bytes of the readable files, and how many files there are."""
    readable = F.col("file").isNotNull() & F.col("error").isNull()
    return file_counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(readable, F.col("row_count"))), F.lit(0)).alias("row_count"),
        F.count("file").alias("file_count"),
        F.count_if(readable).alias("success_file_count"),
        F.coalesce(F.sum(F.when(readable, F.col("file_size"))), F.lit(0)).alias("total_size_bytes"),
        F.count_if(F.col("file").isNull() & F.col("error").isNotNull()).alias("path_errors"),
        F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("duration_ms"),
    )


def path_status(totals: DataFrame) -> DataFrame:
    """Add the status; a path with an error of its own counts as -1 rows.

    success: no error, also for an empty path. partial: some files are
    readable. failed: none is (0 rows), or the path itself is not (-1 rows).
    """
    broken = F.col("path_errors") > 0
    status = (
        F.when(broken, "failed")
        .when(F.col("success_file_count") == F.col("file_count"), "success")
        .when(F.col("success_file_count") > 0, "partial")
        .otherwise("failed")
    )
    return totals.withColumns(
        {
            "status": status,
            "row_count": F.when(broken, -1).otherwise(F.col("row_count")).cast("bigint"),
            **{
                c: F.when(broken, 0).otherwise(F.col(c)).cast("bigint")
                for c in ("file_count", "success_file_count", "total_size_bytes")
            },
        }
    ).drop("path_errors")


def path_errors(file_counts: DataFrame, keys=PATH_KEYS) -> DataFrame:
    """Every error, one row each; an error of the path itself has file ''."""
    return file_counts.filter(F.col("error").isNotNull()).select(
        *keys, F.coalesce("file", F.lit("")).alias("file"), "error"
    )


def error_text(error="error"):
    """An error without what differs from file to file: quoted text, paths, addresses and numbers."""
    c = F.regexp_replace(error, r"""'[^']*'|"[^"]*\"""", "?")
    c = F.regexp_replace(c, r"(?:[a-z][a-z0-9+.-]*:/)?/(?:[^\s:,;()\[\]]|:(?=\S))*", "<path>")
    c = F.regexp_replace(c, r"\b0x[0-9a-fA-F]+\b", "<n>")
    return F.regexp_replace(c, r"[0-9]+", "<n>")


def error_classes(file_counts: DataFrame, keys=PATH_KEYS) -> DataFrame:
    """One row per path and kind of error: its text, id, files, and one file with its own error.

    `class_id` links the rows of `classed_errors`, of which none is dropped. A
    path has as many rows as kinds of errors, however many files are broken.
    """
    return classed_errors(file_counts, keys).groupBy(*keys, "class_id", "error_class").agg(
        F.count(F.lit(1)).alias("files"), F.min(F.struct("file", "error")).alias("example")
    )


def classed_errors(file_counts: DataFrame, keys=PATH_KEYS) -> DataFrame:
    """Every error, as `path_errors` gives them, with the class it belongs to."""
    classed = path_errors(file_counts, keys).withColumn("error_class", error_text())
    return classed.withColumn("class_id", F.xxhash64("error_class"))


def inline_classes(file_counts: DataFrame, keys=PATH_KEYS) -> DataFrame:
    """The error classes of a path as one array: an example each, with how many files are like it."""
    told = F.concat(F.col("example.error"), F.when(F.col("files") > 1, F.concat(F.lit(" (and "), F.col("files") - 1, F.lit(" more like it)"))).otherwise(""))
    return error_classes(file_counts, keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("example.file").alias("file"), told.alias("error")))).alias("errors")
    )


def inline_errors(file_counts: DataFrame, keys=PATH_KEYS) -> DataFrame:
    """All errors of a path as one array, by file: its size is that of the path's own errors."""
    return path_errors(file_counts, keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("file", "error"))).alias("errors")
    )


def path_results(file_counts: DataFrame, *, by_class=False) -> DataFrame:
    """One count result per path, with its errors.

    `by_class` keeps an example of each kind of error in the result row, so that
    a path with millions of broken files stays a small row. Reads `file_counts` twice; pass a stored table, not the count itself.
    """
    results = path_status(path_totals(file_counts))
    # A path that cannot be listed is reported by the errors of the path itself.
    own = F.when(
        F.col("row_count") < 0, F.filter("errors", lambda e: e["file"] == "")
    ).otherwise(F.col("errors"))
    inline = inline_classes(file_counts) if by_class else inline_errors(file_counts)
    return results.join(inline, PATH_KEYS, "left").withColumn("errors", own)
