"""What work on whole columns of text holds at a time."""

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from laketally.llm import jaccard
from laketally.llm import text as T


def test_sets_of_a_long_batch_take_little_memory():
    """A worker keeps what it once took, and the stages of the pipeline share workers."""
    batch = pa.RecordBatch.from_arrays([pa.array([f"{i} " + "some words of a text " * 50 for i in range(4000)])], ["text"])
    T._powers.clear()
    tracemalloc.start()
    for part in T.slices(batch, most=T.SMALL_BYTES):
        assert batch.num_rows > part.num_rows
        jaccard._sets(part.column("text"), 5)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 64 * T.SMALL_BYTES
    assert sum(p.nbytes for p in T._powers.values()) <= 4 * 8 * T.SMALL_BYTES


def test_batches_of_long_rows_are_bounded_by_bytes(spark):
    """A batch of rows is held by the executor and by its worker at once."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    docs = spark.range(0, 120, 1, 1).select("id", F.repeat(F.lit("word "), 20000).alias("text"))
    before = spark.conf.get(T.BATCH_CONF, None)
    try:
        T.small_batches(spark)
        found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert len(found) > 1 and max(found) < 2 * T.BATCH_BYTES
        spark.conf.set(T.BATCH_CONF, "9999999")
        T.small_batches(spark)
        assert spark.conf.get(T.BATCH_CONF) == "9999999"
    finally:
        spark.conf.unset(T.BATCH_CONF) if before is None else spark.conf.set(T.BATCH_CONF, before)
