"""Hard negatives by threshold joins of anchors with all vectors.

An anchor's positives are its nearest other vectors of the same label; a
positive's negatives are the nearest vectors of other labels whose score lies
between `LOW` and `HIGH` percent of the positive's. Both are found by joins with
a threshold that starts high and is lowered for those anchors whose windows are
not yet full, down to where nothing more can count.

A join scans all vectors against an inverted index of a block of anchors: by
group of dimensions, the anchors that have entries there. An anchor's last
dimensions are left out as long as the norms of what is left out, times the
largest such norm of all vectors, stay below its threshold: they cannot reach it
alone. Partial scores are accumulated over the index; a pair is dropped as soon
as its score and the product of the norms that remain are below the threshold.
Pairs that are left get their whole score in integers.

Every anchor meets all vectors, so the work is anchors times vectors, in blocks
of at most `BLOCK` anchors. A task keeps a window's best only, and full windows
raise the threshold within a task. The driver sees one block's windows at a time.

Nulls and odd rows: a row without id or label, with a null vector or a null or
non-finite component takes no part, nor does one whose scaled norm is 2 ** 31 or
more, since its scores need not fit a long. Vectors of different lengths are
compared as if the shorter ended in zeros. Equal rows are rows of their own: an
anchor leaves out itself, not its copies. Ties go to the smaller id. An empty
table has no negatives. Columns but vec_id, embedding and label are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laketally.plans.scratch import scratch_path, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
#: Anchors whose index is broadcast together.
BLOCK = 2048
#: Vectors that are scored together, and dimensions of one list of the index.
ROWS, LIST = 1024, 8
#: Thresholds, as shares of an anchor's own score and of a positive's.
FOR_POSITIVES = (0.7, 0.45, 0.25, 0.0)
FOR_NEGATIVES = (0.75, 0.6, 0.5)

PAIRS = "anchor int, slot int, vec_id long, score long"


def vectors(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, label, q): the rows that take part, numbered, with whole components."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x.cast("double") * SCALE).cast("double"), 2))
    kept = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return kept.where(norm < 2.0**62).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("long").alias("label"), whole.alias("q")
    )


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    at = np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(len(flat)) - at] = flat
    return out


def remaining_norms(m: np.ndarray) -> np.ndarray:
    """For each row and list of dimensions the norm of what stands from it on; the last is 0."""
    squares = np.cumsum((m.astype(float) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate((squares[:, ::LIST], np.zeros((len(m), 1))), axis=1))


@dataclass(frozen=True)
class Windows:
    """What a block of anchors still looks for: per anchor up to `POSITIVES` windows [low, high] of `keep` vectors each.

    `same` looks among the anchor's own label (never at its own row), else among
    all others. A window that is not open has low > high.
    """

    same: bool
    keep: int
    order: np.ndarray  # of dimensions, those that say most first
    largest: np.ndarray  # remaining norms that no vector exceeds
    row: np.ndarray
    label: np.ndarray
    q: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Index:
    """Inverted lists of the anchors of some windows."""

    def __init__(self, w: Windows, anchors: np.ndarray):
        self.anchors = anchors
        self.set_least(w.low, w.high)
        self.q = w.q[anchors][:, w.order]
        self.rest = remaining_norms(self.q)
        # The first list from which on the rest of no vector can reach the threshold.
        below = self.rest * w.largest * (1 + 1e-9) < self.least[:, None]
        self.ends = np.where(below.any(axis=1), below.argmax(axis=1), below.shape[1] - 1)
        self.by_length = np.argsort(-self.ends, kind="stable")
        self.lists = [  # by list: the anchors with entries, the longest first, and the entries
            self.q[self.by_length[: np.count_nonzero(self.ends > k)], k * LIST : (k + 1) * LIST].T.astype(float)
            for k in range(below.shape[1] - 1)
        ]

    def set_least(self, low: np.ndarray, high: np.ndarray) -> None:
        """The score a pair must reach to lie in any of its anchor's windows."""
        low, high = low[self.anchors], high[self.anchors]
        self.least = np.where(low <= high, low, np.iinfo(np.int64).max).min(axis=1)

    def pairs(self, x: np.ndarray, rest: np.ndarray, may: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, vector, score) of all pairs that reach the anchor's threshold; `may` says which pairs count."""
        score = np.zeros((len(x), len(self.anchors)))
        least = self.least[self.by_length].astype(float)
        mine = self.rest[self.by_length]
        alive = np.ones(score.shape, bool) if may is None else may[:, self.by_length].copy()
        lists = len(self.lists)
        for k, entries in enumerate(self.lists):
            n = entries.shape[1]
            score[:, :n] += x[:, k * LIST : (k + 1) * LIST] @ entries
            if k % 2 or k == lists - 1:
                # What an anchor lacks in the index begins where its lists end.
                begin = np.minimum(k + 1, self.ends[self.by_length])
                bound = score + rest[:, begin] * mine[np.arange(len(mine)), begin]
                alive &= bound * (1 + 1e-9) + 1e-6 >= least
                if k < lists - 1 and np.count_nonzero(alive) < alive.size / 16:
                    break
        v, a = np.nonzero(alive)
        a = self.by_length[a]
        found = [np.zeros(0, np.int64)]
        whole = x.astype(np.int64)
        for begin in range(0, len(v), 1 << 16):  # what is left is scored in integers
            part = slice(begin, begin + (1 << 16))
            found.append(np.einsum("ij,ij->i", whole[v[part]], self.q[a[part]]))
        exact = np.concatenate(found)
        reach = exact >= self.least[a]
        return self.anchors[a[reach]], v[reach], exact[reach]


def _best(anchor, slot, vec_id, score, keep):
    """The first `keep` of each window."""
    order = np.lexsort((vec_id, -score, slot, anchor))
    anchor, slot, vec_id, score = anchor[order], slot[order], vec_id[order], score[order]
    key = anchor * POSITIVES + slot
    first = np.flatnonzero(np.concatenate((key[:1] == key[:1], key[1:] != key[:-1])))
    place = np.arange(len(key)) - np.repeat(first, np.diff(np.concatenate((first, [len(key)]))))
    kept = place < keep
    return anchor[kept], slot[kept], vec_id[kept], score[kept]


def _joined(w: Windows, low: np.ndarray, batch: pa.RecordBatch, index: dict) -> tuple[np.ndarray, ...]:
    """All (anchor, slot, vec_id, score) of a batch that lie in a window."""
    q = matrix(batch.column("q"), w.q.shape[1])[:, w.order]
    label = batch.column("label").to_numpy()
    row = batch.column("row").to_numpy()
    vec_id = batch.column("vec_id").to_numpy()
    found = []
    if w.same:  # an anchor meets the vectors of its own label only
        groups = [(lists, np.flatnonzero(label == name)) for name, lists in index.items()]
    else:
        groups = [(lists, np.arange(len(q))) for lists in index.values()]
    for lists, rows in groups:
        for begin in range(0, len(rows), ROWS):
            part = rows[begin : begin + ROWS]
            x = q[part]
            may = None if w.same else label[part][:, None] != w.label[lists.anchors][None, :]
            a, v, score = lists.pairs(x.astype(float), remaining_norms(x), may)
            v = part[v]
            if w.same:
                other = row[v] != w.row[a]
                a, v, score = a[other], v[other], score[other]
            for slot in range(low.shape[1]):
                fits = (score >= low[a, slot]) & (score <= w.high[a, slot])
                found.append((a[fits], np.full(np.count_nonzero(fits), slot), vec_id[v[fits]], score[fits]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _indexes(w: Windows) -> dict:
    """One index for each label of anchors that still look for something, or one for all."""
    open_anchors = np.flatnonzero((w.low <= w.high).any(axis=1))
    if not w.same:
        return {None: Index(w, open_anchors)} if len(open_anchors) else {}
    return {int(name): Index(w, open_anchors[w.label[open_anchors] == name]) for name in np.unique(w.label[open_anchors])}


def threshold_join(rows: DataFrame, w: Windows) -> DataFrame:
    """(anchor, slot, vec_id, score, place): the best of each window, `anchor` by its place in the block."""
    shared = rows.sparkSession.sparkContext.broadcast(w)  # one block of anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        index, low = _indexes(w), w.low.copy()
        best = tuple(np.zeros(0, np.int64) for _ in range(4))
        for batch in batches:
            for begin in range(0, batch.num_rows, 4 * ROWS):
                new = _joined(w, low, batch.slice(begin, 4 * ROWS), index)
                if len(new[0]) == 0:
                    continue
                best = _best(*[np.concatenate(c) for c in zip(best, new, strict=True)], w.keep)
                # A full window is entered by nothing below its last entry.
                last = np.flatnonzero(np.diff(np.concatenate((best[0] * POSITIVES + best[1], [-1]))))
                first = np.concatenate(([-1], last[:-1]))
                full = last[last - first == w.keep]
                low[best[0][full], best[1][full]] = best[3][full]
                for lists in index.values():
                    lists.set_least(low, w.high)
        types = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
        names = ["anchor", "slot", "vec_id", "score"]
        for begin in range(0, len(best[0]), 50_000):
            cut = [pa.array(c[begin : begin + 50_000].astype(np.int64)).cast(t) for c, t in zip(best, types, strict=True)]
            yield pa.RecordBatch.from_arrays(cut, names)

    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    found = rows.mapInArrow(run, PAIRS).withColumn("place", F.row_number().over(order))
    return found.where(F.col("place") <= w.keep)


def largest_rests(rows: DataFrame, width: int, order: np.ndarray) -> np.ndarray:
    """Norms of the remaining dimensions that no vector exceeds, by list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(-(-width // LIST) + 1)
        for batch in batches:
            for begin in range(0, batch.num_rows, 4 * ROWS):
                part = matrix(batch.column("q").slice(begin, 4 * ROWS), width)[:, order]
                most = np.maximum(most, remaining_norms(part).max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(most)), pa.int32()), pa.array(most)], ["k", "norm"])

    found = rows.select("q").mapInArrow(run, "k int, norm double").groupBy("k").agg(F.max("norm").alias("norm"))
    return np.array([r.norm for r in found.orderBy("k").collect()])


def mine(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    `rows` and `anchors` are stored tables as `vectors` makes them.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    facts = rows.agg(F.max(F.size("q")).alias("width")).first()
    blocks = -(-anchors.count() // BLOCK)
    if blocks:
        width = max(1, facts.width)
        # Dimensions with much weight first, so that bounds close early; any order gives the same result.
        weights = rows.select(F.posexplode("q").alias("k", "x")).groupBy("k").agg(F.sum(F.pow(F.col("x").cast("double"), 2)).alias("w"))
        order = [r.k for r in weights.orderBy(F.desc("w"), "k").collect()]
        order = np.array([*order, *sorted(set(range(width)) - set(order))], np.int64)
        largest = largest_rests(rows, width, order)
        dealt = stored(anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "anchors")
        for block in range(blocks):
            table = dealt.where(F.col("block") == block).drop("block").toArrow().combine_chunks()
            for begin in range(0, table.num_rows, BLOCK):  # a block that the hash overfilled
                _mine_block(rows, table.slice(begin, BLOCK), width, order, largest, path)
    return spark.read.schema(schema).parquet(path)


def _mine_block(rows: DataFrame, table: pa.Table, width: int, order: np.ndarray, largest: np.ndarray, path: str) -> None:
    table = table.combine_chunks()
    n = table.num_rows
    q = matrix(table.column("q").combine_chunks(), width)
    ids, label, row = (table.column(c).to_numpy() for c in ("vec_id", "label", "row"))
    none = np.ones((n, POSITIVES), np.int64)
    fixed = {"order": order, "largest": largest, "row": row, "label": label, "q": q}

    # Positives: one window an anchor, open above; it is full with POSITIVES vectors.
    own = np.einsum("ij,ij->i", q, q)
    waiting, positives = np.ones(n, bool), {}
    for share in FOR_POSITIVES:
        low = np.where(waiting, np.ceil(own * share).astype(np.int64), 1)[:, None]
        high = np.where(waiting, np.iinfo(np.int64).max, 0)[:, None]
        found = threshold_join(rows, Windows(True, POSITIVES, low=low, high=high, **fixed)).collect()
        by_anchor: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r.anchor, r.place)):
            by_anchor.setdefault(r.anchor, []).append((r.vec_id, r.score))
        for a, got in by_anchor.items():
            if len(got) == POSITIVES or share == FOR_POSITIVES[-1]:
                positives[a] = got
                waiting[a] = False
        if not waiting.any():
            break

    # Negatives: one window a positive. A positive with a negative score has an empty one.
    score, positive_id, open_windows = np.zeros_like(none), np.zeros_like(none), np.zeros(none.shape, bool)
    for a, got in positives.items():
        for slot, (vec_id, s) in enumerate(got):
            positive_id[a, slot], score[a, slot], open_windows[a, slot] = vec_id, s, True
    spark = rows.sparkSession
    slots = spark.createDataFrame(
        pa.table({
            "anchor": pa.array(np.repeat(np.arange(n), POSITIVES), pa.int32()),
            "slot": pa.array(np.tile(np.arange(POSITIVES), n), pa.int32()),
            "anchor_id": pa.array(np.repeat(ids, POSITIVES)),
            "positive_id": pa.array(positive_id.ravel()),
            "positive_score": pa.array(score.ravel()),
        })
    )
    floor, cap = -(-score * LOW // 100), score * HIGH // 100
    for share in FOR_NEGATIVES:
        last = share == FOR_NEGATIVES[-1]
        low = np.where(open_windows, floor if last else np.maximum(floor, np.ceil(score * share).astype(np.int64)), 1)
        high = np.where(open_windows, cap, 0)
        if (low > high).all():
            continue
        found = stored(threshold_join(rows, Windows(False, NEGATIVES, low=low, high=high, **fixed)), "window")
        full = found.groupBy("anchor", "slot").agg(F.max("place").alias("n"))
        done = full if last else full.where(F.col("n") == NEGATIVES)
        taken = found.join(done.select("anchor", "slot"), ["anchor", "slot"]).join(slots, ["anchor", "slot"])
        taken.select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
        for r in done.collect():
            open_windows[r.anchor, r.slot] = False
        if not open_windows.any():
            break


def query(spark, sf_dir: str) -> DataFrame:
    """op12: negatives of every fiftieth vector, against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = stored(vectors(embeddings.select("vec_id", "embedding", label.alias("label"))), "vectors")
    return mine(rows, rows.where("vec_id % 50 = 0"))


SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 3"""
