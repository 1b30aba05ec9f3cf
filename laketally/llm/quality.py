"""Quality classifier: logistic regression on hashed word n-grams.

Training follows the regularised leader (FTRL-proximal): per-weight sums of
gradients and of their squares give each weight in closed form, one update a
document. A score is one sparse dot product, squashed.

Tokens are runs of letters and digits (and all non-ASCII bytes) and runs of
punctuation, case kept. A word equal to the word before it becomes one fixed
token, so repetition is an n-gram like any other. Features are the tokens and
pairs of neighbouring tokens, hashed into `buckets` weights; the value of a
feature is its share of the text's n-grams.

Nulls and odd rows: a null or empty text has no features and gets the model's
base rate. A row without doc_id is scored like any other. Labels that are null
or have no document are not used; of several labels of a document the largest
counts. Repeated documents each get the same score. Without any labels every
score is 0.5.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketally.llm import text as T

SHARDS = 6
EPOCHS = 3
SCALE = 12.0

KIND = np.full(256, 2, np.uint8)
KIND[T.SPACES] = 0
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    KIND[ord(_a) : ord(_b) + 1] = 1
KIND[128:] = 1
SAME = np.uint64(0x5DEECE66D)


@dataclass(frozen=True)
class Model:
    """`weights` by bucket, and the logit of a text without features."""

    weights: np.ndarray
    base: float


def features(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each n-gram, and where each text's n-grams begin."""
    data, at = T.flat(column, b" ")
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    kind = KIND[data]
    edge = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(data)]))
    full = kind[edge[:-1]] > 0
    starts, ends = edge[:-1][full], edge[1:][full]
    h = T.run_hashes(data, starts, ends)
    begin = np.searchsorted(starts, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(begin))
    word = np.flatnonzero(kind[starts] == 1)
    same = (h[word[1:]] == h[word[:-1]]) & (doc[word[1:]] == doc[word[:-1]])
    h[word[1:][same]] = SAME
    pair = T.mixed(h[:-1] * T.WEIGHTS[0] + h[1:] * T.WEIGHTS[1])
    grams = np.zeros((len(h), 2), np.int64)
    grams[:, 0] = T.mixed(h) % np.uint64(buckets)
    grams[:-1, 1] = pair % np.uint64(buckets)
    keep = np.ones((len(h), 2), bool)
    keep[:, 1] = np.concatenate((doc[1:] == doc[:-1], [False]))[: len(h)]
    counts = np.zeros(len(at), np.int64)
    counts[1:] = np.cumsum(2 * np.diff(begin) - (np.diff(begin) > 0))
    return grams[keep], counts


def follow_leader(
    grams: np.ndarray, at: np.ndarray, labels: np.ndarray, buckets: int, rate: float = 2.0, l1: float = 0.02, l2: float = 1.0
) -> Model:
    """One model from documents in the order given, `EPOCHS` times over."""
    z, n, weights = np.zeros(buckets), np.zeros(buckets), np.zeros(buckets)
    rows = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        where, times = np.unique(grams[a:b], return_counts=True)
        rows.append((where, SCALE * times / max(1, b - a)))
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(share / (1 - share)))
    for _ in range(EPOCHS):
        for (where, x), label in zip(rows, labels.tolist(), strict=True):
            p = 1 / (1 + np.exp(-np.clip(base + weights[where] @ x, -30, 30)))
            g = (p - label) * x
            old = n[where]
            new = old + g * g
            z[where] += g - (np.sqrt(new) - np.sqrt(old)) / rate * weights[where]
            n[where] = new
            kept = z[where]
            weights[where] = np.where(np.abs(kept) <= l1, 0, -(kept - np.sign(kept) * l1) / ((1 + np.sqrt(new)) / rate + l2))
    return Model(weights, base)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, buckets: int = 1 << 18) -> Model:
    """Fit on the labelled documents, or on a hash sample of about `max_rows` of them.

    `labels` has (doc_id, label). The sample is dealt to `SHARDS` tasks, each
    trains on its share, and the mean of their weights is the model: the driver
    gets SHARDS rows of `buckets` weights, whatever the input.
    """
    labels = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    total = labels.count()
    if total > max_rows:
        share = int(max_rows / total * (1 << 30))
        labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    sampled = (
        docs.select("doc_id", "text")
        .join(F.broadcast(labels), "doc_id")  # about max_rows rows of two numbers
        .select("doc_id", "text", F.col("label").cast("double"), F.pmod(F.hash("doc_id"), F.lit(SHARDS)).alias("shard"))
    )

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[np.argsort(T.mixed(rows["doc_id"].to_numpy(np.uint64)), kind="stable")]
        batch = pa.RecordBatch.from_pandas(rows[["text"]], schema=pa.schema([("text", pa.string())]), preserve_index=False)
        grams, sizes = [], [0]
        for part in T.slices(batch, most=T.SMALL_BYTES):
            g, at = features(part.column("text"), buckets)
            grams.append(g)
            sizes += (sizes[-1] + at[1:]).tolist()
        model = follow_leader(np.concatenate(grams), np.array(sizes), rows["label"].to_numpy(), buckets)
        return pd.DataFrame({"n": [len(rows)], "base": [model.base], "weights": [model.weights.astype(np.float32).tobytes()]})

    found = sampled.groupBy("shard").applyInPandas(shard, "n long, base double, weights binary").collect()
    if not found:
        return Model(np.zeros(buckets, np.float32), 0.0)
    found.sort(key=lambda r: (r.n, r.base))
    weights = np.mean([np.frombuffer(r.weights, np.float32) for r in found], axis=0)
    return Model(weights.astype(np.float32), float(np.mean([r.base for r in found])))


def scores(column: pa.Array, weights: np.ndarray, base: float) -> np.ndarray:
    """The probability of label 1 of each text."""
    grams, at = features(column, len(weights))
    sums = np.concatenate(([0.0], np.cumsum(weights[grams], dtype=np.float64)))
    logit = base + SCALE * (sums[at[1:]] - sums[at[:-1]]) / np.maximum(1, np.diff(at))
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.base))  # one weight a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, most=T.SMALL_BYTES):
                found = pa.array(scores(part.column("text"), *shared.value))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows with a score of at least `least`, with all their columns."""
    T.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, most=T.SMALL_BYTES):
                yield part.filter(pa.array(scores(part.column("text"), *shared.value) >= least))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id="doc_id"):
    """Documents that labels are never learned from; one without id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


THRESHOLD = 0.3


def trained(spark, docs: DataFrame, sf_dir: str) -> Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return train(docs, labels.where(~held_out()))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: all documents with their score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = score(docs, trained(spark, docs, sf_dir))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not rejected; trained on the whole table of documents."""
    return keep_good(docs, trained(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir), THRESHOLD)
