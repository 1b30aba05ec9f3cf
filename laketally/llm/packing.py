"""Hierarchical packing: documents of several lengths into token windows without padding.

A document is its token ids and one end id. Its full windows of the longest
tier are cut off first; the rest goes to the smallest tier that holds it. Each
tier, the longest first, opens a window for its longest piece and fills the gap
with the largest pieces that fit, from its own and the shorter tiers; where
nothing fits, a piece is cut. What is left when all pieces are used up becomes
windows whose sizes are powers of two, so no window holds padding. Windows are
dealt to step groups, the costliest first to the group with the least cost so
far, cost being the sum of squared piece lengths.

Each task packs what it reads, a bounded number of tokens at a time, so there
is no shuffle and a repeated task gives the same windows. Window ids hold the
task's number in the upper bits.

Nulls and odd rows: a null or empty text is its end id alone. Repeated rows are
packed each on its own; a null doc_id is kept. An empty table gives no pieces.
"""

import heapq
import os
import re
import sys
from collections.abc import Iterable, Iterator
from itertools import islice
from struct import pack as pack_ids
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketally.llm import text as T

TIERS = (1024, 512, 256, 128)
#: Tokens packed together, and tokens of a step group.
PACK_TOKENS = 1 << 21
STEP_TOKENS = 64 * 1024
#: Distinct pieces of text whose ids a worker keeps; of words those that half as many new ones have not used leave.
CACHE = 600_000
#: The same in a pipeline, whose workers keep them next to what other stages need.
SMALL_CACHE = CACHE // 6
TOKENIZER = "byte_bpe_50k.json"

#: A blank between two other characters always begins a new pre-token.
SINGLE = re.compile(r"(?<=\S) (?=\S)")
#: Between pieces that go through the tokenizer together: white space that is one token of its own before a blank.
MARK = "\x0c"


def tokenizer(name: str):
    """The tokenizer of a path, or of a public vocabulary's name."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if not os.path.isabs(name):
        import public_tokenizers

        name = str(public_tokenizers.path(name))
    return Tokenizer.from_file(name)


class Encoder:
    """Ids of texts as little-endian 32-bit bytes.

    Texts are cut at blanks and each distinct piece goes through the tokenizer
    once while it is among the pieces kept. Where every blank is single, no
    token crosses a cut; other texts are cut at their single blanks only.
    """

    def __init__(self, name: str, cache: int | None = None):
        self.tokenizer = tokenizer(name)
        self.cache = CACHE if cache is None else cache
        self.first: dict[str, bytes] = {}  # the piece a text begins with
        self.known: dict[str, bytes] = {}  # any other, by what follows its blank; no bytes: it is next to more space
        self.older: dict[str, bytes] = {}  # what was known before, and comes back when it is used
        self.wide: dict[str, bytes] = {}  # the same of texts with more space than single blanks
        self.mark = self._ids([MARK])[0]
        one, two, both = self._ids([" a", " b", f" a{MARK} b"])
        self.marked = len(self.mark) == 1 and both == one + self.mark + two

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        at = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
        words = lists.flatten().dictionary_encode()
        codes, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self._words(distinct)
        first, number = np.unique(codes[at[:-1]], return_inverse=True)
        first = [distinct[c] for c in first.tolist()]
        self._learn(self.first, first, "")
        ids += map(self.first.__getitem__, first)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        wide = np.flatnonzero(np.logical_or.reduceat(sizes[codes] == 0, at[:-1])).tolist()
        codes = codes.astype(np.int64)
        codes[at[:-1]] = len(distinct) + number
        begin, size = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        ends = np.cumsum(size)
        whole = np.frombuffer(b"".join(ids), np.uint32)[np.repeat(begin - (ends - size), size) + np.arange(ends[-1])].tobytes()
        edges = (4 * np.append(0, ends)[at]).tolist()
        found = [whole[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        for row, text in zip(wide, self._wide([texts[row] for row in wide]), strict=True):
            found[row] = text
        for kept in (self.first, self.wide):
            if len(kept) > self.cache:
                kept.clear()
        if len(self.known) > self.cache // 2:
            self.known, self.older = {}, self.known
        return found

    def _wide(self, texts: list[str]) -> list[bytes]:
        cut = [SINGLE.split(text) for text in texts]
        self._learn(self.first, {parts[0] for parts in cut}, "")
        self._learn(self.wide, set().union(*[islice(parts, 1, None) for parts in cut]), " ")
        first, wide = self.first, self.wide.__getitem__
        return [first[parts[0]] + b"".join(map(wide, islice(parts, 1, None))) for parts in cut]

    def _words(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces without blanks; no bytes for one next to more space."""
        ids = list(map(self.known.get, pieces))
        new = [at for at, found in enumerate(ids) if found is None]
        todo = []
        for piece in map(pieces.__getitem__, new):
            found = self.older.get(piece)
            if found is None and piece and piece.strip() == piece:
                todo.append(piece)
            else:
                self.known[piece] = found or b""
        if self.marked:
            self._learn_marked([piece for piece in todo if MARK not in piece])
        self._learn(self.known, todo, " ")
        for at in new:
            ids[at] = self.known[pieces[at]]
        return ids

    def _learn_marked(self, pieces: list[str]) -> None:
        """Learns pieces that neither begin nor end with space, many in one text; those it can't tell apart stay unknown."""
        some = [pieces[begin : begin + 256] for begin in range(0, len(pieces), 256)]
        for part, found in zip(some, self._ids([" " + f"{MARK} ".join(part) for part in some]), strict=True):
            ids = np.array(found, "<u4")
            marks = np.flatnonzero(ids == self.mark[0])
            if len(marks) == len(part) - 1:
                data = ids.tobytes()
                begins, ends = [0, *(4 * marks + 4).tolist()], [*(4 * marks).tolist(), len(data)]
                self.known.update(zip(part, map(data.__getitem__, map(slice, begins, ends)), strict=True))

    def _learn(self, kept: dict[str, bytes], pieces: Iterable[str], before: str) -> None:
        todo = [piece for piece in pieces if piece not in kept]
        for begin in range(0, len(todo), 10_000):
            some = todo[begin : begin + 10_000]
            for piece, ids in zip(some, self._ids([before + piece for piece in some] if before else some), strict=True):
                kept[piece] = pack_ids(f"<{len(ids)}I", *ids)


def encoder(name: str, cache: int | None = None) -> Encoder:
    """The encoder of this Python worker, which later tasks use again."""
    kept = sys.modules.setdefault("laketally_kept", ModuleType("laketally_kept")).__dict__
    if (name, cache) not in kept:
        kept[name, cache] = Encoder(name, cache)
    return kept[name, cache]


def windows(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) that hold every token of every document once."""
    longest, full = tiers[0], []
    stacks: dict[int, list[tuple[int, int]]] = {n: [] for n in range(1, longest + 1)}
    filled = 0  # bit n: there is a piece of n tokens

    def put(doc: int, start: int, n: int) -> None:
        nonlocal filled
        stacks[n].append((doc, start))
        filled |= 1 << n

    def take(n: int) -> tuple[int, int, int]:
        nonlocal filled
        doc, start = stacks[n].pop()
        if not stacks[n]:
            filled &= ~(1 << n)
        return doc, start, n

    for doc, n in enumerate(lengths):
        whole = n // longest
        full += [[(doc, i * longest, longest)] for i in range(whole)]
        if n % longest:
            put(doc, whole * longest, n % longest)
    for tier in tiers:
        below = (1 << (tier + 1)) - 1
        shorter = max((t for t in tiers if t < tier), default=0)
        while (filled & below) >> (shorter + 1):
            window, gap = [], tier
            while gap and filled:
                if fits := filled & ((1 << (gap + 1)) - 1):
                    window.append(take(fits.bit_length() - 1))
                else:
                    n = (filled & -filled).bit_length() - 1
                    doc, start, _ = take(n)
                    window.append((doc, start, gap))
                    put(doc, start + gap, n - gap)
                gap -= window[-1][2]
            full += [window] if not gap else _powers_of_two(window)
    return full


def _powers_of_two(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A window that is not full, cut into windows of the powers of two in its size."""
    total, found = sum(n for _, _, n in window), []
    pieces = window[::-1]
    for size in (1 << b for b in reversed(range(total.bit_length())) if total >> b & 1):
        part, room = [], size
        while room:
            doc, start, n = pieces.pop()
            part.append((doc, start, min(n, room)))
            if n > room:
                pieces.append((doc, start + room, n - room))
            room -= part[-1][2]
        found.append(part)
    return found


def step_groups(packed: list[list[tuple[int, int, int]]]) -> list[int]:
    """The step group of each window."""
    total = sum(n for w in packed for _, _, n in w)
    loads = [(0, g) for g in range(max(1, round(total / STEP_TOKENS)))]
    cost = [sum(n * n for _, _, n in w) for w in packed]
    groups = [0] * len(packed)
    for w in sorted(range(len(packed)), key=lambda w: -cost[w]):
        load, g = heapq.heappop(loads)
        groups[w] = g
        heapq.heappush(loads, (load + cost[w], g))
    return groups


def pack(docs: DataFrame, tokenizer_name: str = TOKENIZER, end_id: int = 0, tiers: tuple[int, ...] = TIERS, cache: int | None = None) -> DataFrame:
    """One row per piece: its document, place, ids (little-endian 32-bit) and window.

    Columns: doc_id, start, length, ids, doc_tokens, sequence_id, offset,
    sequence_tokens, step_group. Other columns of `docs` are not read.
    """
    kind = docs.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long, step_group long"
    names = [part.split()[0] for part in schema.split(", ")]
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer_name, cache).encode
        sequence = group = TaskContext.get().partitionId() << 36
        held: list[tuple[pa.Array, list[bytes]]] = []

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group
            doc_ids = pa.concat_arrays([a for a, _ in held])
            ids = [i for _, some in held for i in some]
            found = windows([len(i) // 4 for i in ids], tiers)
            steps = step_groups(found)
            for begin in range(0, len(found), 512):
                rows, where = [], []
                for w in range(begin, min(begin + 512, len(found))):
                    at, size = 0, sum(n for _, _, n in found[w])
                    for doc, start, n in found[w]:
                        where.append(doc)
                        rows.append((start, n, ids[doc][4 * start : 4 * (start + n)], len(ids[doc]) // 4, sequence + w, at, size, group + steps[w]))
                        at += n
                columns = [doc_ids.take(pa.array(where, pa.int64())), *(pa.array(c, pa.binary() if k == 2 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True)))]
                yield pa.RecordBatch.from_arrays(columns, names)
            sequence, group = sequence + len(found), group + max(steps, default=-1) + 1
            held.clear()

        tokens = 0
        for batch in batches:
            for part in T.slices(batch):
                ids = [i + end for i in ids_of([t or "" for t in part.column("text").to_pylist()])]
                held.append((part.column("doc_id"), ids))
                tokens += sum(map(len, ids)) // 4
                if tokens >= PACK_TOKENS:
                    yield from packed()
                    tokens = 0
        if held:
            yield from packed()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


#: What the query returns first, in this order.
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the pieces of all documents."""
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    more = [c for c in pieces.columns if c not in (*COLUMNS, "ids")]
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(*COLUMNS, *more)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, cache=SMALL_CACHE)
