"""Listing of many directories as a Spark job."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from laketally.sources.filesystems import default_parallelism, in_batches, session_opener

# Texts a failed path is reported with.
ACCESS_ERROR = "Failed to access path: "
MISSING_ERROR = "Path does not exist: "

LISTED = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.LongType()),  # nanoseconds; NULL where the store does not tell
        T.StructField("error", T.StringType()),
    ]
)


def list_files(
    roots: DataFrame, *, path_col="hdfs_path", levels=1, tasks=None, opener=None
) -> DataFrame:
    """All visible files under every root, with the roots' other columns kept.

    Adds `kind, file, size, modified, error`. Each readable root gives one `root` row, so
    that an empty directory is not lost; each file gives a `file` row; a root
    that is missing or cannot be listed gives an `error` row. Names that start
    with `_` or `.` are skipped, files and directories alike; the name of a
    root directory is not looked at, the name of a root file is.

    The first `levels` levels are listed one by one and spread over the cluster
    after each; what lies deeper is walked by the task that has its directory.
    So one root with most of the lake is listed by as many tasks as it has
    directories at that level.
    """
    n = tasks or default_parallelism(roots.sparkSession)
    opener = opener or session_opener(roots.sparkSession)
    schema = T.StructType(roots.schema.fields + LISTED.fields)
    found = roots
    for step in [_children, *[_entries] * (levels - 1), _below]:
        lister = _lister(to_arrow_schema(schema), path_col, step, opener)
        found = found.repartition(n).mapInArrow(lister, schema)
    return found


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def _children(uri, opener):
    """(kind, file, size, modified) of a root and of what lies directly in it."""
    from pyarrow.fs import FileType

    fs, path, prefix = opener(uri)
    info = fs.get_file_info(path)
    if info.type == FileType.NotFound:
        raise FileNotFoundError(MISSING_ERROR + uri)
    yield "root", None, None, None
    if info.type != FileType.File:
        yield from _entries(uri, opener)
    elif not _hidden(info.base_name):
        yield "file", prefix + info.path, info.size, info.mtime_ns


def _entries(uri, opener):
    """(kind, file, size, modified) of the visible entries of a directory."""
    from pyarrow.fs import FileSelector, FileType

    fs, path, prefix = opener(uri)
    for info in fs.get_file_info(FileSelector(path)):
        if not _hidden(info.base_name):
            kind = "dir" if info.type == FileType.Directory else "file"
            yield kind, prefix + info.path, info.size, info.mtime_ns


def _below(uri, opener):
    """(kind, file, size, modified) of every file at any depth under a directory."""
    folders = [uri]
    while folders:
        for entry in _entries(folders.pop(), opener):
            if entry[0] == "dir":
                folders.append(entry[1])
            else:
                yield entry


def _lister(schema: pa.Schema, path_col: str, step, opener):
    """The task side of one step: roots or directories in, their content out.
    Rows that are neither pass through."""

    def expand(source):
        kind = source.get("kind")
        if kind not in (None, "dir"):
            yield source
            return
        try:
            uri = source[path_col] if kind is None else source["file"]
            for kind, file, size, modified in step(uri, opener):
                yield {**source, "kind": kind, "file": file, "size": size, "modified": modified}
        except Exception as e:
            error = ACCESS_ERROR + str(e)
            yield {**source, "kind": "error", "file": None, "size": None, "modified": None, "error": error}

    def run(batches):
        sources = (source for batch in batches for source in batch.to_pylist())
        yield from in_batches((row for source in sources for row in expand(source)), schema)

    return run


def visible_files(listing: DataFrame) -> DataFrame:
    return listing.filter(F.col("kind") == "file").drop("kind", "error")
