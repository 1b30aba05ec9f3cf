"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its lower-cased words and one end. A token is coded as `CODE_BITS`
bits of its hash, its bucket, and then as itself among the tokens of that
bucket. Each bit is predicted by the buckets' own counts, and by two tables of
bit counts whose slots are hashes of the bits so far with one or with two tokens
before. The predictions are mixed as logits; the weights are those of a gate
(the place of the bit and how much the tables have seen), moved along the
gradient batch by batch. The result is refined by how often a bit was set where
the mixture said so before. Within a bucket a token has the share
(c + 0.1) / (C + 0.1 * (V + 1)) with the counts of that bucket, so that one
share is left for unknown tokens.

Every training text counts words. The bit counts come from nine of ten of the
training texts, and the weights and the refinement from the tenth, since counts
of a text's own bits would look too sure. Each task moves its own weights; their
mean, by bits seen, is used.

Word counts stay a table and grow with the corpus. Words that are one in
`COMMON` tokens or more, fewer than `COMMON` of them, are sent to every task;
the others of each text meet their counts in a join. The tables of bits have a
fixed size, a parameter of the model: more text makes them denser, and the
gates then trust them less. Words, and texts, are told apart by 64-bit hashes.

Nulls and odd rows: a null text is empty, which is one end. A row without
doc_id is never held out. Repeated rows each count and come back with the same
score. With no training texts all buckets are equally likely. An empty table
gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketally.llm import text as T
from laketally.plans.scratch import stored

CODE_BITS = 12
SLOT_BITS = 19
COMMON = 1 << 16
ADDED = 0.1
PARTS = 16
#: Tokens whose bits are predicted before the weights move.
BATCH = 4096
RATE = 0.5
CLIP = 8.0
GATES = CODE_BITS * 9
LEVELS = 33
END = np.uint64(0x1D8AF066E5A0C3B7)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every token, ends included, and where each text's tokens begin."""
    h, at = T.words(column)
    return np.insert(h, at[1:], END), at + np.arange(len(at))


def contexts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of one and of two tokens before each, none from the text before."""
    one = np.concatenate(([END], h[:-1]))[: len(h)]
    two = np.concatenate(([END], one[:-1]))[: len(h)]
    return T.mixed(one), T.mixed(one * T.WEIGHTS[0] + np.where(one == END, END, two) * T.WEIGHTS[1])


def codes(h: np.ndarray) -> np.ndarray:
    return (T.mixed(h ^ T.STEP) >> np.uint64(64 - CODE_BITS)).astype(np.int64)


def bits(h: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each place: (place, node, bit, slot by one token, slot by two)."""
    code = codes(h)
    one, two = contexts(h)
    for i in range(CODE_BITS):
        node = (code >> (CODE_BITS - i)) | (1 << i)
        spread = node.astype(np.uint64) * T.STEP
        slots = [(T.mixed(c ^ spread) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for c in (one, two)]
        yield i, node, (code >> (CODE_BITS - 1 - i)) & 1, slots[0], slots[1]


class Model:
    """Bucket counts, bit counts by slot, and the weights and refinement of the mixture."""

    def __init__(self, c: np.ndarray, v: np.ndarray, slots: np.ndarray):
        size = 1 << CODE_BITS
        self.mass = np.zeros(2 * size)
        self.mass[size:] = c + ADDED * (v + 1)
        for node in range(size - 1, 0, -1):
            self.mass[node] = self.mass[2 * node] + self.mass[2 * node + 1]
        self.within = np.log10(self.mass[size:])
        own = np.ones(size)
        own[1:] = self.mass[3::2] / self.mass[1:size]
        own[0] = 0.5
        self.own = np.clip(np.log(own / (1 - own)), -20, 20)
        seen = slots.sum(axis=2)
        self.logits = np.log((slots[:, :, 1] + 0.4) / (slots[:, :, 0] + 0.4)).astype(np.float32)
        self.trust = np.digitize(seen, [1, 8]).astype(np.int8)
        self.weights = np.zeros((GATES, 3))
        self.weights[:, 0] = 1.0
        self.met = np.zeros((CODE_BITS, LEVELS, 2))

    def inputs(self, i: int, node: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.stack([self.own[node], self.logits[0, one], self.logits[1, two]])
        return x, i * 9 + self.trust[0, one] * 3 + self.trust[1, two]

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip((self.weights[gate].T * x).sum(axis=0), -20, 20)

    @staticmethod
    def level(logit: np.ndarray) -> np.ndarray:
        return np.rint((np.clip(logit, -CLIP, CLIP) + CLIP) * ((LEVELS - 1) / (2 * CLIP))).astype(np.int64)

    def learn(self, h: np.ndarray) -> int:
        """Moves the weights along all bits of the tokens; the number of bits."""
        for a in range(0, len(h), BATCH):
            for i, node, bit, one, two in bits(h[a : a + BATCH]):
                x, gate = self.inputs(i, node, one, two)
                logit = self.mixed(x, gate)
                np.add.at(self.met, (i, self.level(logit), bit), 1)
                wrong = bit - 1 / (1 + np.exp(-logit))
                times = np.maximum(np.bincount(gate, minlength=GATES), 64)
                step = np.stack([np.bincount(gate, wrong * row / (1 + np.abs(row)), GATES) for row in x], axis=1)
                self.weights += RATE * step / times[:, None]
        return len(h) * CODE_BITS

    def log10(self, h: np.ndarray) -> np.ndarray:
        """Of each token: log10 of its bucket's probability, less log10 of the bucket's counts."""
        total = -self.within[codes(h)]
        share = (self.met[:, :, 1] + 0.5) / (self.met.sum(axis=2) + 1)
        held = np.linspace(-CLIP, CLIP, LEVELS)
        known = self.met.sum(axis=2) / (self.met.sum(axis=2) + 50)
        move = known * (np.log(share / (1 - share)) - held)  # how far the mixture was off
        for i, node, bit, one, two in bits(h):
            logit = self.mixed(*self.inputs(i, node, one, two))
            logit = logit + move[i][self.level(logit)] / 2
            total -= np.logaddexp(0, np.where(bit == 1, -logit, logit)) / np.log(10)
        return total


def _fold(n: int):
    """The remainder that splits documents; one without id is in fold 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(1))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, bucket) over all texts given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                found, times = np.unique(tokens(part.column("text"))[0], return_counts=True)
                columns = [pa.array(found.view(np.int64)), pa.array(times), pa.array(codes(found))]
                yield pa.RecordBatch.from_arrays(columns, ["word", "c", "bucket"])

    found = docs.select("text").mapInArrow(run, "word long, c long, bucket long")
    return found.groupBy("word", "bucket").agg(F.sum("c").alias("c"))


def slot_counts(docs: DataFrame) -> np.ndarray:
    """The bit counts of both tables over all texts given."""
    size = 4 << SLOT_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in T.slices(batch):
                for _, _, bit, one, two in bits(tokens(part.column("text"))[0]):
                    np.add.at(total, 2 * one + bit, 1)
                    np.add.at(total, 2 * two + bit + size // 2, 1)
        parts = [p.astype(np.int64).tobytes() for p in total.reshape(PARTS, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    dealt = docs.select("text").mapInArrow(count, schema).repartition(PARTS, "part")
    total = np.zeros((PARTS, size // PARTS), np.int64)
    for row in dealt.mapInArrow(add, schema).collect():  # the tables: a fixed size
        total[row.part] += np.frombuffer(row.counts, np.int64)
    return total.reshape(2, 1 << SLOT_BITS, 2)


def mix(docs: DataFrame, model: Model) -> Model:
    """The model with weights and refinement learned on the texts given."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n = shared.value, 0
        own.weights = np.zeros((GATES, 3))
        own.weights[:, 0], own.met = 1.0, np.zeros_like(own.met)
        for batch in batches:
            for part in T.slices(batch):
                n += own.learn(tokens(part.column("text"))[0])
        if n:
            columns = [pa.array([n], pa.int64()), pa.array([(own.weights * n).ravel()]), pa.array([own.met.ravel()])]
            yield pa.RecordBatch.from_arrays(columns, ["n", "weights", "met"])

    found = docs.select("text").mapInArrow(run, "n long, weights array<double>, met array<double>")
    cells = found.select("n", F.posexplode(F.concat("weights", "met")).alias("cell", "value"))
    sums = cells.groupBy("cell").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).collect()  # a fixed size
    flat = {r.cell: r.value / r.n if r.cell < GATES * 3 else r.value for r in sums}
    if flat:
        values = np.array([flat[cell] for cell in range(len(flat))])
        model.weights = values[: GATES * 3].reshape(GATES, 3)
        model.met = values[GATES * 3 :].reshape(model.met.shape)
    return model


def fit(training: DataFrame, counts: DataFrame) -> Model:
    """The model of the training texts, whose word counts are given."""
    size = 1 << CODE_BITS
    c, v = np.zeros(size), np.zeros(size)
    for row in counts.groupBy("bucket").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():  # one row a bucket
        c[row.bucket], v[row.bucket] = row.c, row.v
    tenth = F.xxhash64("doc_id") % 10 == 0
    return mix(training.where(tenth), Model(c, v, slot_counts(training.where(~tenth))))


def scored(docs: DataFrame, training) -> DataFrame:
    """Every row's doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score and score.

    `training` is the condition of the rows to learn from.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = stored(word_counts(docs.where(training)), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    rows = counts.where(F.col("c") * COMMON > n).orderBy(F.col("word")).collect()  # fewer than COMMON rows
    known = np.array([r.word for r in rows], np.int64), np.array([r.c for r in rows], np.float64)
    model = fit(docs.where(training), counts)
    shared = spark.sparkContext.broadcast((model, known))

    def common(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, c = shared.value[1]
        h = h.view(np.int64)
        at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
        found = words[at] == h if len(words) else np.zeros(len(h), bool)
        return found, np.log10(c[at[found]] + ADDED)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                h, at = tokens(part.column("text"))
                row = np.repeat(np.arange(len(at) - 1), np.diff(at))
                left = ~common(h)[0]
                h, row = h[left], row[left]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[: len(h)])
                times = np.diff(np.append(new, len(h)))
                columns = [part.column("name").take(pa.array(row[new])), pa.array(h[new].view(np.int64)), pa.array(times, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["name", "word", "times"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                h, at = tokens(part.column("text"))
                found, logs = common(h)
                own = np.zeros(len(h))
                own[found] = logs
                sums = [np.add.reduceat(x, at[:-1]) for x in (found.astype(np.int64), own, shared.value[0].log10(h))]
                sizes = np.diff(T.flat(part.column("text"))[1])
                columns = [part.column("doc_id"), part.column("name"), pa.array(sizes), pa.array(np.diff(at)), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "name", "n_bytes", "n_tokens", "n_common", "common", "bits"])

    named = docs.withColumn("name", F.xxhash64("text"))
    pairs = named.select("name", "text").mapInArrow(rare, "name long, word long, times long")
    pairs = pairs.repartition("word").groupBy("word", "name").agg(F.max("times").alias("times"))  # equal texts once, shuffled by what is joined next
    met = pairs.join(counts.select("word", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = met.groupBy("name").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_rare"),
        F.sum(F.col("times") * F.log10(F.col("c") + ADDED)).alias("rare"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, name long, n_bytes long, n_tokens long, n_common long, common double, bits double"
    told = named.select("doc_id", "name", "text").mapInArrow(predict, schema).join(sums, "name", "left")
    words = F.col("common") + F.coalesce("rare", F.lit(0.0))
    total = float(np.log10(n + ADDED * (v + 1)))
    return told.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * total).alias("base_score"),
        (words + F.col("bits")).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op7: all documents, learned from nine of ten, with total bits per byte."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scored(docs, _fold(10) != 0)
    per_byte = F.when(F.col("n_bytes") > 0, -F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes"))
    return found.select(
        "doc_id", (_fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", per_byte.alias("bits_per_byte")
    )
