"""Removes the bytes of long strings that also start earlier, by bucket-pointer refinement.

Suffixes start in buckets of equal q-grams; a bucket is split by the bucket
identifiers of later offsets, and the identifiers of one round are the keys of
the next: 8, 16, 32, 64 and then `LENGTH` bytes. Buckets of one suffix leave.
Bytes are compared, not hashes, so a bucket holds equal strings only.

Within one document that runs over its bytes. Across documents a task sees only
the strings that can be equal: each window of LENGTH bytes belongs to the least
hash among its q-grams, its anchor, and equal windows have equal anchors.

    text -> anchors -> those of two texts or more       (shuffle: a hash and a name)
         -> the windows of these, as runs of bytes      (join by document)
         -> one of each equal run, its first document   (shuffle: partial)
         -> refinement of the runs of an anchor         (shuffle: a bounded number of runs a task)
         -> removed windows per document -> its text    (join by document)

Equal texts are named first; only the smallest doc_id of each goes through this
and every other one is removed as a whole. Runs that many documents share are
reduced to one before they are refined, so what meets in a task are the
different surroundings of an anchor.

Nulls and odd rows: a null text is empty; a text below LENGTH bytes is kept
whole. A null doc_id counts as later than all others. Rows with one doc_id are
not earlier than each other, so a repeated row comes back as often and with the
same result. An empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laketally.llm import text as T
from laketally.plans.scratch import discard, stored

LENGTH = 100
GRAM = 32
#: q-grams of one window.
WIDTH = LENGTH - GRAM + 1
#: Windows of one run; longer ones (a text that repeats itself) are cut, under the same anchor.
RUN = 512
#: A class of more than one in HOT documents is joined by broadcast: there are fewer than HOT of them.
HOT = 1000
LAST = 2**63 - 1


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the rows that share their key, in order of key and place, and their buckets."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = keys[order][1:] != keys[order][:-1]
    many = ~(new[:-1] & new[1:])
    return order[many], np.cumsum(new[:-1])[many]


def refine(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(starts, bucket) of those strings of `length` bytes that occur twice or more among `starts`.

    Ordered by bucket and then by start.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(data) < length or len(starts) == 0:
        return none
    n = len(data)
    wanted = np.zeros(n + 1, np.int32)  # places inside some string
    wanted[starts] += 1
    wanted[starts + length] -= 1
    inside = np.cumsum(wanted[:-1]) > 0
    words = np.zeros(n - 7, np.uint64)
    for i in range(8):
        words |= data[i : n - 7 + i].astype(np.uint64) << np.uint64(8 * i)
    at, size = np.flatnonzero(inside[: n - 7]), 8
    rows, ids = _split(words[at])
    at = at[rows]
    while size < length:
        bucket = np.zeros(n + length, np.int64)  # 0: alone
        bucket[at] = ids
        step = size if 2 * size <= length else length - size
        size += step
        at = np.sort(at) if size < length else starts
        at = at[(bucket[at] > 0) & (bucket[at + step] > 0)]
        rows, ids = _split((bucket[at].astype(np.uint64) << np.uint64(32)) | bucket[at + step].astype(np.uint64))
        at = at[rows]
    return at, ids


def _slide(h: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    n = len(h)
    blocks = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    blocks[:n] = h
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _windows(at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Start and row of every string of `length` bytes that lies in one text."""
    counts = np.maximum(np.diff(at) - length + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(rows)) - before[rows] + at[:-1][rows], rows


def _anchored(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, row, anchor) of every window, and the hash of every q-gram."""
    starts, rows = _windows(at)
    if len(starts) == 0:
        return starts, rows, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(T.BYTE_HASH[data] * T.powers(T.STEP, n), out=sums[1:])
    grams = T.mixed((sums[GRAM:] - sums[: n - GRAM + 1]) * T.powers(T.BACK, n + 1)[: n - GRAM + 1])
    return starts, rows, _slide(grams, WIDTH)[starts], grams


def _grouped(starts: np.ndarray, rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, windows, anchor) of the runs of windows with one anchor."""
    first = np.ones(len(starts), bool)
    first[1:] = (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])
    begins = np.flatnonzero(first)
    counts = np.diff(np.append(begins, len(starts)))
    return rows[begins], starts[begins], counts, anchors[begins]


def _runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return _grouped(*_anchored(data, at)[:3])


def _own(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Anchors told apart by text; two that meet by chance cost time only."""
    return anchors + rows.astype(np.uint64) * T.STEP


def _again(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The windows whose anchor occurs at two places of their text or more: all that can occur twice in it."""
    starts, rows, anchors, grams = _anchored(data, at)
    if len(starts) == 0:
        return starts
    least = np.zeros(len(grams) + WIDTH - 1, np.uint64)
    least[starts + WIDTH - 1] = anchors
    places = np.flatnonzero(grams == ~_slide(~least, WIDTH))  # the anchor of some window that holds it
    found, times = np.unique(_own(np.searchsorted(at, places, "right") - 1, grams[places]), return_counts=True)
    row, _, count, anchor = _grouped(starts, rows, anchors)
    return starts[np.repeat(np.isin(_own(row, anchor), found[times > 1]), count)]


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, place, name): the place in the order of documents, and a name of the text."""
    text = F.coalesce("text", F.lit(""))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select("doc_id", text.alias("text"), place.alias("place"), F.xxhash64(text).alias("name"))


def anchors(texts: DataFrame) -> DataFrame:
    """(name, shared): the anchors of each text that another text has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                rows, _, _, found = _runs(*T.flat(part.column("text")))
                columns = [part.column("name").take(pa.array(rows)), pa.array(found.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["name", "anchor"])

    found = texts.select("name", "text").mapInArrow(run, "name long, anchor long")
    same = Window.partitionBy("anchor")  # and the only shuffle of all anchors
    many = found.withColumn("low", F.min("name").over(same)).withColumn("high", F.max("name").over(same)).where("low <> high")
    pairs = many.select("name", "anchor").distinct()
    return pairs.groupBy("name").agg(F.collect_list("anchor").alias("shared"))


def runs(texts: DataFrame) -> DataFrame:
    """The runs of windows under the anchors of the column `shared`, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                data, at = T.flat(part.column("text"))
                row, start, count, anchor = _runs(data, at)
                lists = part.column("shared")
                known = _own(pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy().view(np.uint64))
                keep = np.isin(_own(row, anchor), known)
                rows = []
                for r, s, c, a in zip(row[keep].tolist(), start[keep].tolist(), count[keep].tolist(), anchor[keep].view(np.int64).tolist(), strict=True):
                    for skip in range(0, c, RUN):
                        size = min(RUN, c - skip)
                        piece = data[s + skip : s + skip + size + LENGTH - 1].tobytes()
                        rows.append((r, s + skip - int(at[r]), a, hashlib.blake2b(piece, digest_size=16).digest(), piece))
                if rows:
                    r, s, a, i, p = zip(*rows, strict=True)
                    own = [part.column(c).take(pa.array(r)) for c in ("place", "name")]
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array(s, pa.int64()), pa.array(a, pa.int64()), pa.array(i, pa.binary()), pa.array(p, pa.binary())],
                        ["place", "name", "start", "anchor", "run_id", "bytes"],
                    )

    schema = "place long, name long, start long, anchor long, run_id binary, bytes binary"
    return texts.select("place", "name", "text", "shared").mapInArrow(run, schema)


def earlier(classes: DataFrame) -> DataFrame:
    """(run_id, hits): the windows of each class of runs that a run of an earlier document has."""

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        same = np.diff(batch.column("anchor").to_numpy()) == 0
        batch = batch.filter(pa.array(np.append(same, False) | np.append(False, same)))  # an anchor's only run leaves
        data, at = T.flat(batch.column("bytes"))
        starts, rows = _windows(at)
        place = batch.column("first").to_numpy()
        owner = np.zeros(len(data), np.int64)
        owner[starts] = rows
        where, bucket = refine(data, starts)
        row = owner[where]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        least = np.minimum.reduceat(place[row], edges) if len(edges) else place[:0]
        later = place[row] > np.repeat(least, np.diff(np.append(edges, len(row))))
        where, row = where[later], row[later]
        order = np.argsort(where)
        where, row = where[order], row[order]
        ids, begin = np.unique(row, return_index=True)
        hits = pa.ListArray.from_arrays(pa.array(np.append(begin, len(row)), pa.int32()), pa.array(where - at[:-1][row], pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column("run_id").take(pa.array(ids)), hits], ["run_id", "hits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            anchor = batch.column("anchor").to_numpy()
            cut = np.searchsorted(anchor, anchor[-1])  # its last anchor may go on
            if size > T.SLICE_BYTES and (cut or held[-1].column("anchor")[-1].as_py() != anchor[0]):
                whole = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()
                yield from (found(b) for b in whole)
                held, size = [], 0
                batch = batch.slice(cut)
            held.append(batch)
            size += batch.nbytes
        if held:
            yield from (found(b) for b in pa.Table.from_batches(held).combine_chunks().to_batches())

    dealt = classes.select("anchor", "run_id", "first", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "run_id binary, hits array<long>")


def copies(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(place, name) of the rows whose text an earlier row has."""
    total = classes.agg(F.sum("rows")).first()[0] or 0
    many = classes.where("rows > 1")
    rows = texts.select("place", "name", _digest().alias("digest"))
    hot = F.broadcast(many.where(F.col("rows") * HOT > total).select("digest", "first"))  # fewer than HOT rows
    cold = many.where(F.col("rows") * HOT <= total).select("digest", "first")
    rest = rows.join(hot, "digest", "left_anti").join(cold, "digest")
    both = rows.join(hot, "digest").select("place", "name", "first").unionByName(rest.select("place", "name", "first"))
    return both.where("place > first").select("place", "name").distinct()


def _digest():
    return F.unhex(F.sha2("text", 256))


def marks(docs: DataFrame) -> DataFrame:
    """(place, name, copy, removed): for each text that is a copy or has windows that start earlier, those."""
    texts = _texts(docs)
    classes = stored(
        texts.select("place", "name", _digest().alias("digest"))
        .groupBy("digest")
        .agg(F.min("place").alias("first"), F.first("name").alias("name"), F.count("*").alias("rows")),
        "classes",
    )
    lists = anchors(texts)
    firsts = classes.select(F.col("first").alias("place"), "name").join(lists, "name")
    found = stored(runs(texts.join(firsts, ["place", "name"])), "runs")
    alike = found.groupBy("run_id").agg(F.min("place").alias("first"), F.first("anchor").alias("anchor"), F.first("bytes").alias("bytes"))
    alike = stored(alike, "alike")
    told = alike.select("run_id", "first").join(earlier(alike), "run_id", "left")
    placed = found.select("place", "name", "start", F.expr(f"octet_length(bytes) - {LENGTH - 1}").cast("long").alias("count"), "run_id").join(told, "run_id")
    spans = placed.where("place > first OR hits IS NOT NULL").select(
        "place",
        "name",
        F.when(F.col("place") > F.col("first"), F.array(F.struct("start", "count")))
        .otherwise(F.transform("hits", lambda h: F.struct((F.col("start") + h).alias("start"), F.lit(1).cast("long").alias("count"))))
        .alias("spans"),
    )
    own = spans.groupBy("place", "name").agg(F.flatten(F.collect_list("spans")).alias("removed"))
    own = own.withColumn("copy", F.lit(False))
    whole = copies(texts, classes).withColumn("copy", F.lit(True))
    found_marks = stored(own.unionByName(whole, allowMissingColumns=True), "marks")
    discard(classes, found, alike)
    return found_marks


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                data, at = T.flat(part.column("text"))
                n = len(data)
                where, bucket = refine(data, _again(data, at))
                owner = np.searchsorted(at, where, "right")
                again = (np.diff(bucket, prepend=-1) == 0) & (np.diff(owner, prepend=-1) == 0)
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, where[again], 1)
                np.add.at(change, where[again] + LENGTH, -1)
                lists = part.column("removed")
                base = at[pc.list_parent_indices(lists).to_numpy()]
                spans = lists.flatten()
                begin = base + spans.field("start").to_numpy()
                np.add.at(change, begin, 1)
                np.add.at(change, begin + spans.field("count").to_numpy() + LENGTH - 1, -1)
                gone = np.cumsum(change[:n]) > 0
                size = np.diff(at)
                for row in np.flatnonzero(part.column("copy").to_numpy(zero_copy_only=False) & (size >= LENGTH)):
                    gone[at[row] : at[row + 1]] = True
                kept, n_removed, n_spans = [], [], []
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = gone[a:b]
                    n_removed.append(int(own.sum()))
                    n_spans.append(int((own[1:] & ~own[:-1]).sum()) + int(b > a and own[0]))
                    kept.append(data[a:b][~own].tobytes())
                counts = [pa.array(x, pa.int64()) for x in (size, n_removed, n_spans)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
                )

    empty = F.expr("cast(array() as array<struct<start: long, count: long>>)")
    known = _texts(docs).join(marks(docs), ["place", "name"], "left")
    known = known.select("doc_id", "text", F.coalesce("removed", empty).alias("removed"), F.coalesce("copy", F.lit(False)).alias("copy"))
    return known.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: what is removed of every document, and a digest of what is left."""
    found = deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
