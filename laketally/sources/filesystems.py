"""Opening paths of any scheme inside a task, and what such tasks share."""

from itertools import islice

import pyarrow as pa
from pyspark.sql import SparkSession


class Opener:
    """Finds the file system of a URI; one of these serves one task.

    Calling it gives (file system, its own path, prefix that turns that path
    back into a URI). The path is taken raw, not percent-decoded, as Hadoop
    paths are. A path without a scheme lies in `default_fs`; its files are
    named with the scheme unless that is the local file system.
    """

    def __init__(self, default_fs: str = ""):
        self.default_fs = "" if default_fs.startswith("file:") else default_fs.rstrip("/")
        self.systems = {}

    def system(self, uri: str):
        from pyarrow.fs import FileSystem, LocalFileSystem

        if uri not in self.systems:
            self.systems[uri] = FileSystem.from_uri(uri)[0] if uri else LocalFileSystem()
        return self.systems[uri]

    def __call__(self, uri: str):
        if uri.startswith("/"):
            if not self.default_fs:
                return self.system(""), uri, ""
            uri = self.default_fs + uri
        scheme, found, rest = uri.partition("://")
        if not found and uri.startswith("file:"):
            return self.system(""), uri[len("file:") :], "file:"
        if scheme == "file":
            return self.system(""), rest, "file://"
        authority, _, path = rest.partition("/")
        if scheme in ("s3", "s3a", "s3n", "gs"):
            store = "gs" if scheme == "gs" else "s3"
            return self.system(f"{store}://{authority}"), f"{authority}/{path}", f"{scheme}://"
        return self.system(f"{scheme}://{authority}/"), "/" + path, f"{scheme}://{authority}"


def session_opener(spark: SparkSession) -> Opener:
    default_fs = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return Opener(default_fs or "")


def default_parallelism(spark: SparkSession) -> int:
    """Tasks for jobs whose cost is file opens, which Spark cannot estimate."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, spark.sparkContext.defaultParallelism)


def in_batches(rows, schema: pa.Schema, size: int = 10_000):
    """Arrow batches of a bounded size from any number of dict rows."""
    rows = iter(rows)
    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(part, schema=schema)
