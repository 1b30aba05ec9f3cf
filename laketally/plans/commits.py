"""Numbered commits: small files of which each number exists once.

What a job writes becomes visible when its commit does. A commit is created
exclusively by the file system, so of two jobs that want the same number one
fails. HDFS and local file systems guarantee this; an object store must.
"""

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Taken(Exception):
    """Another job has committed this number."""


def _folder(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _name(number: int) -> str:
    return f"{number:012d}.json"


def commit(spark: SparkSession, folder: str, number: int, content: dict) -> None:
    """Create a commit, or raise `Taken`."""
    path, fs = _folder(spark, folder)
    fs.mkdirs(path)
    text = json.dumps({"number": number, **content}, ensure_ascii=False)
    try:
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(path, _name(number)), False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()) or "already exists" in str(e.java_exception):
            raise Taken(f"{folder}: {number}") from e
        raise
    out.write(bytearray(text.encode()))
    out.close()


def _read(spark: SparkSession, fs, path) -> dict | None:
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def last_number(spark: SparkSession, folder: str) -> int:
    """The highest number taken; 0 without any."""
    path, fs = _folder(spark, folder)
    if not fs.exists(path):
        return 0
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return max((int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0] not in "._"), default=0)


def last_commit(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """(number, content) of the last commit; (0, {}) without any.

    One whose writer died within it has no content: the one before it holds,
    and its number stays taken.
    """
    path, fs = _folder(spark, folder)
    number = last = last_number(spark, folder)
    while last:
        file = spark._jvm.org.apache.hadoop.fs.Path(path, _name(last))
        content = _read(spark, fs, file) if fs.exists(file) else None
        if content is not None:
            return number, content
        last -= 1
    return number, {}
