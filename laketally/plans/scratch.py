"""Tables written on the way, in the folder the cluster names for them."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`.

    Unset, a local session gets a temporary folder of its own and a cluster
    an error, because its executors do not share one machine's disk.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="laketally-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *observed) -> DataFrame:
    """The same rows, read from a table written now.

    Cuts the lineage, is computed once however often it is read, and is still
    there when executors are lost. `observed` is an Observation and aggregates
    that it takes from the rows while they are written.
    """
    if observed:
        df = df.observe(*observed)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `stored` that nothing reads any more: all that was derived from them is written itself."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
