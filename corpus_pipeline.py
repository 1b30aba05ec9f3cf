"""The text side of a corpus: from raw documents to packed token windows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from laketally.llm import decontamination, jaccard, packing, quality, secrets
from laketally.plans.scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality.stage),
    ("near_duplicates", jaccard.stage),
    ("decontamination", decontamination.stage),
    ("secrets", secrets.stage),
    ("packing", packing.stage),
]

#: A trained classifier and a tokenizer have no SQL; `run`, quality and packing have no tests yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
