"""Row counts by Spark's own readers, for roots the caller names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_row_counts(
    spark: SparkSession, roots, format: str, delimiter: str = "\n"
) -> DataFrame:
    """Rows per file, (file, row_count), under a few roots in one scan.

    No column is read: the schema is empty, so Parquet and ORC open footers
    only and text is split at the delimiter without being decoded further.
    Files without rows do not appear, an unreadable file fails the query and
    compressed text is decompressed. Where each bad file has to be reported,
    and for paths that come from a DataFrame, use `operators.count_files`.
    """
    name = format.lower()
    if name not in ("orc", "parquet", "textfile"):
        raise ValueError(f"cannot count format {format!r}")
    reader = spark.read.option("recursiveFileLookup", "true")
    if name == "textfile":
        rows = reader.option("lineSep", delimiter).text(list(roots))
    else:
        rows = reader.schema(T.StructType([])).format(name).load(list(roots))
    return (
        rows.groupBy(F.col("_metadata.file_path").alias("uri"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(file_of_uri("uri").alias("file"), "row_count")
    )


def file_of_uri(uri: str):
    """A raw path from a percent-encoded one; local files without a scheme."""
    plain = F.url_decode(F.replace(F.col(uri), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "/")
