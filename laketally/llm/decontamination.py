"""Benchmark decontamination: size-partitioned MinHash containment search.

Texts are sets of five-word shingles. Documents fall into partitions by set
size, and each partition has its own signature: the hash range is cut into
eight bins per shingle of its largest document, and a document keeps the least
hash of each bin (one-permutation MinHash). An item has one such signature per
partition. A document and an item that share a value are candidates; they are
verified by exact containment, the share of the item's shingles that the whole
document has.

A present shingle is hidden only by a smaller one in its own bin, about one in
sixteen, and an item is missed only where all of its shared shingles are. Items
of fewer than `SMALL` shingles, where that could happen, skip the bins.

Items are taken in blocks of at most `BLOCK` shingles, so what a task holds is
bounded; each block is one pass over the documents without a shuffle.

Nulls and odd rows: texts without words have no shingles and match nothing;
with fewer than five words the whole sequence is the one shingle. Items with
equal texts each match. Repeated documents each match. A null doc_id or item_id
is kept. Without items or documents the result is empty, and no row is dropped.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketally.llm import text as T
from laketally.llm.jaccard import SHINGLES

K = 5
LEAST = 0.8
BINS = 8
SMALL = 12
BLOCK = 1 << 20


def _partition(n: int) -> int:
    """The partition of a set's size; partition p has 2 ** p bins."""
    return max(1, (BINS * n - 1).bit_length())


def _signature(found: np.ndarray, bits: int) -> np.ndarray:
    """Which of the sorted hashes are the least of their bin."""
    bins = found >> np.uint64(64 - bits)
    return np.concatenate(([True], bins[1:] != bins[:-1])) if len(found) else np.zeros(0, bool)


class Items:
    """A block of items: sorted (hash, item) rows and the partitions in which a hash is in the signature."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        hashes = np.concatenate([*sets, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(sets)), self.sizes)
        last = np.zeros(len(hashes), np.uint64)  # bit p: in the signature of partition p
        at = 0
        for found in sets:
            for p in range(1, 64):
                signed = _signature(found, p) if len(found) >= SMALL else np.ones(len(found), bool)
                last[at : at + len(found)] |= signed.astype(np.uint64) << np.uint64(p)
            at += len(found)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.signed = hashes[order], item[order], last[order]
        self.known = np.unique(self.hashes)

    def search(self, found: np.ndarray, hit: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the candidates of one document; `hit` are the places of `found` in some item."""
        p = _partition(len(found))
        least = _signature(found, p)
        values = found[hit]
        low, high = np.searchsorted(self.hashes, values, "left"), np.searchsorted(self.hashes, values, "right")
        times = high - low
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
        item = self.item[rows]
        signed = (self.signed[rows] >> np.uint64(p) & np.uint64(1)).astype(bool)
        signed &= np.repeat(least[hit], times) | (self.sizes[item] < SMALL)
        shared = np.bincount(item, minlength=1)
        return [(i, int(shared[i])) for i in np.unique(item[signed]).tolist()]


def _blocks(items: DataFrame, block: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Items in blocks of bounded size, one partition of the table at a time."""
    ids, sets, size = [], [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        h, at = T.words(pa.array([row.text], pa.string()))
        found = T.shingles(h, at, K)[0]
        ids.append(row.item_id)
        sets.append(found)
        size += len(found)
        if size >= block:
            yield ids, sets
            ids, sets, size = [], [], 0
    if ids:
        yield ids, sets


def contained(docs: DataFrame, items: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, shared, containment) of all pairs with a containment of at least `least`."""
    found = [_searched(docs, items, ids, sets, least, False) for ids, sets in _blocks(items, block)]
    if not found:
        kinds = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], _schema(*kinds))
    all_found = found[0]
    for one in found[1:]:
        all_found = all_found.unionByName(one)
    return all_found


def clean(docs: DataFrame, items: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    for ids, sets in _blocks(items, block):
        docs = _searched(docs, items, ids, sets, least, True)
    return docs


def _schema(doc_id: str, item_id: str) -> str:
    return f"doc_id {doc_id}, item_id {item_id}, shared long, containment double"


def _searched(docs: DataFrame, items: DataFrame, ids: list, sets: list[np.ndarray], least: float, drop: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((ids, Items(sets)))  # at most BLOCK shingles and one item
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType
    arrow_item = pa.int64() if item_kind.simpleString() == "bigint" else pa.int32() if item_kind.simpleString() == "int" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, block = shared.value
        for batch in batches:
            for part in T.slices(batch, most=T.SMALL_BYTES):
                h, at = T.words(part.column("text"))
                where, which, sizes = [], [], []
                for d, found in enumerate(T.shingles(h, at, K)):
                    if not len(found) or not len(block.known):
                        continue
                    place = np.minimum(np.searchsorted(block.known, found), len(block.known) - 1)
                    hit = np.flatnonzero(block.known[place] == found)
                    if not len(hit):
                        continue
                    for item, n in block.search(found, hit):
                        if n >= least * block.sizes[item] - 1e-9:
                            where.append(d)
                            which.append(item)
                            sizes.append(n)
                if drop:
                    keep = np.ones(part.num_rows, bool)
                    keep[where] = False
                    yield part.filter(pa.array(keep))
                elif where:
                    columns = [
                        part.column("doc_id").take(pa.array(where, pa.int64())),
                        pa.array([names[i] for i in which], arrow_item),
                        pa.array(sizes, pa.int64()),
                        pa.array([n / int(block.sizes[i]) for n, i in zip(sizes, which, strict=True)], pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "shared", "containment"])

    if drop:
        return docs.mapInArrow(run, docs.schema)
    return docs.select("doc_id", "text").mapInArrow(run, _schema(kind, item_kind.simpleString()))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: all pairs of a document and a benchmark item that it contains."""
    return contained(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that contain no benchmark item."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = f"""
WITH doc_sets AS ({SHINGLES.format(k=K, id="doc_id", table="documents")}),
item_sets AS ({SHINGLES.format(k=K, id="item_id", table="benchmark")}),
sizes AS (SELECT id, count(*) AS n FROM item_sets GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared, count(*) / any_value(sizes.n) AS containment
FROM item_sets i JOIN doc_sets d ON d.s = i.s JOIN sizes ON sizes.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= {LEAST} * any_value(sizes.n) - 1e-9"""
