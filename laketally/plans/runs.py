"""A run table: results, errors and mark of a run become visible at once.

Rows carry the run that wrote them. A run is committed by one numbered file that
also holds the mark, and readers keep the rows of committed runs only. A run
that breaks before its commit leaves nothing to be seen, and of two runs that
start from the same mark one cannot commit.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laketally.functions.dates import as_timestamp
from laketally.operators.results import append_errors, append_results, filtered_results
from laketally.plans.commits import Taken, commit, last_commit, last_number
from laketally.schemas import AUDIT_RESULT

RUN_COLUMN = T.StructField("run", T.StringType())
COMMIT = "number long, run string, mark long, finished long"
ERROR = "hdfs_path string, format string, delimiter string, file string, error string, created_at timestamp, run string"


class RunTable:
    """One run of the table at `path`, from the last commit on."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.run = spark, path.rstrip("/"), uuid.uuid4().hex
        self.number, content = last_commit(spark, self.folder("commits"))
        self._mark = content.get("mark")

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def mark(self):
        """The mark the run starts from, as wall-clock time of the session's zone; None without one."""
        if self._mark is None:
            return None
        at = F.timestamp_micros(F.lit(self._mark)).cast("timestamp_ntz")
        return self.spark.range(1).select(at).first()[0]

    def append(self, rows: DataFrame, errors: DataFrame, created_at) -> None:
        append_results(rows.withColumn("run", F.lit(self.run)), self.folder("results"), more=["run"])
        append_errors(errors.withColumn("run", F.lit(self.run)), self.folder("errors"), created_at)

    def _micros(self, at):
        if at is None:
            return None
        return self.spark.range(1).select(F.unix_micros(as_timestamp(at).cast("timestamp"))).first()[0]

    def finish(self, mark, finished_at) -> None:
        """Make the run visible with a new mark, or raise `Taken`."""
        content = {"run": self.run, "mark": self._micros(mark), "finished": self._micros(finished_at)}
        commit(self.spark, self.folder("commits"), self.number + 1, content)

    def finish_beside(self, finished_at) -> None:
        """Make a run visible that leaves the mark as it is, whoever else commits."""
        while True:
            number, content = last_commit(self.spark, self.folder("commits"))
            content = {"run": self.run, "mark": content.get("mark"), "finished": self._micros(finished_at)}
            try:
                return commit(self.spark, self.folder("commits"), number + 1, content)
            except Taken:
                continue


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """(number, run, mark, finished) of the committed runs, times in microseconds."""
    folder = f"{path.rstrip('/')}/commits"
    if not last_number(spark, folder):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(folder).filter("run IS NOT NULL")


def _visible(spark: SparkSession, path: str, name: str, schema) -> DataFrame:
    try:
        rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # no run has written any
    return rows.join(committed_runs(spark, path).select("run"), "run", "left_semi")


def read_run_results(spark: SparkSession, path: str, **which) -> DataFrame:
    """The results of committed runs; `which` as for `read_results`."""
    schema = T.StructType([*AUDIT_RESULT.fields, RUN_COLUMN])
    return filtered_results(_visible(spark, path, "results", schema), **which)


def read_run_errors(spark: SparkSession, path: str) -> DataFrame:
    """The errors of committed runs, one row each."""
    return _visible(spark, path, "errors", ERROR)
