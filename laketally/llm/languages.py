"""Language identification by rank-order profiles of character n-grams.

A profile is the `SIZE` most frequent n-grams of 1 to `LONGEST` characters of a
language, in order. A document is ranked in the same way, and the language with
the least out-of-place distance is its own: the sum, over the document's
n-grams, of how far each stands from its place in the profile, or `SIZE` where
the profile lacks it. Words are runs of letters and their marks, lower-cased,
with one blank on either side; n-grams do not reach over a blank.

Profiles are counted on all documents of a language, or on a hash sample of
about `per_language` of them. Everything else covers whole texts of all rows.

Nulls and odd rows: a text that is null or has no letter is `und`, with score
0, as is every text when no language was learned. Rows without a language are
not learned from. Ties of frequency go by the n-gram's hash, ties of distance to
the language that is first by name. Repeated rows each count. A text of any
length is counted in steps of `STEP` characters. Columns but doc_id, text and
lang are not read, so their names do not matter.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laketally.llm import text as T
from laketally.llm.quality import held_out
from laketally.plans.scratch import stored

SIZE = 300
LONGEST = 5
#: Characters that are counted together; work arrays take some 150 bytes for each.
STEP = 1 << 19
#: Profiles that are broadcast together, at most some 4 MB; more take further passes over the documents.
BLOCK = 1024
UNKNOWN = "und"

OWNER_BITS = 24
GRAM_BITS = np.uint64(64 - OWNER_BITS)
TIMES = np.uint64(0x9E3779B97F4A7C15)


@cache
def characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter or mark, 0 for anything else; and a hash of that."""
    lower = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if category(chr(c))[0] in "LM":
            low = chr(c).lower()
            lower[c] = ord(low) if len(low) == 1 else c
    return lower, T.mixed(lower.astype(np.uint64) + np.uint64(1))


@cache
def letters() -> np.ndarray:
    """By code point: is it a letter?"""
    return np.array([category(chr(c))[0] == "L" for c in range(0x110000)])


@dataclass(frozen=True)
class Profiles:
    """Languages by name, and for each n-gram its rank in each of them (`SIZE`: not there)."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray


def _stream(texts: list[str], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts with single blanks between, each one's owner, and whether each text has a letter."""
    raw = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    ends = np.cumsum(sizes)
    sums = np.concatenate(([0], np.cumsum(letters()[raw])))
    has_letter = sums[ends] > sums[ends - sizes]
    c = characters()[0][raw]
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] > 0) | (c[:-1] > 0)
    owner = np.concatenate((np.repeat(owners, sizes), owners[-1:]))[keep]
    c = c[keep]
    blank = np.flatnonzero(c[:-1] == 0)
    owner[blank] = owner[blank + 1]  # a blank begins what stands behind it
    return c, owner, has_letter


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def gram_counts(texts: list[str], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram, count) of all n-grams, by owner and n-gram; and whether each text has a letter."""
    c, owner, has_letter = _stream(texts, owners)
    values = characters()[1][c]
    n = len(c)
    blanks = np.flatnonzero(c == 0)
    found = []
    for begin in range(0, n, STEP):
        end = min(n, begin + STEP)
        here = np.arange(begin, end)
        following = np.searchsorted(blanks, here, "right")
        room = np.where(following < len(blanks), blanks[np.minimum(following, len(blanks) - 1)], -1) - here
        high = owner[begin:end].astype(np.uint64) << GRAM_BITS
        h, keys = np.zeros(end - begin, np.uint64), []
        for k in range(LONGEST):
            size = min(end, n - k) - begin
            if size <= 0:
                break
            h = h[:size] * TIMES + values[begin + k : begin + k + size]
            fits = room[:size] >= k if k else c[begin:end] > 0
            keys.append((high[:size] | (h >> np.uint64(OWNER_BITS)))[fits])
        keys = np.concatenate(keys)
        keys.sort()
        first = np.flatnonzero(np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1])))
        found.append((keys[first], np.diff(np.concatenate((first, [len(keys)])))))
    keys, counts = found[0]
    if len(found) > 1:
        keys, counts = _merged(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))
    return (keys >> GRAM_BITS).astype(np.int64), (keys & np.uint64((1 << int(GRAM_BITS)) - 1)).astype(np.int64), counts, has_letter


def ranked(owner: np.ndarray, counts: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Which entries are among the `SIZE` most frequent of their owner, by owner and rank, and these ranks."""
    left = np.arange(len(owner))
    for least in (2, 4, 8, 16):  # where enough are frequent, the rare ones need not be sorted
        often = counts[left] >= least
        enough = np.bincount(owner[left][often], minlength=owners) >= SIZE
        left = left[often | ~enough[owner[left]]]
    rare = np.uint64(2**32 - 1) - np.minimum(counts[left], 2**32 - 1).astype(np.uint64)
    left = left[np.argsort((owner[left].astype(np.uint64) << np.uint64(32)) | rare, kind="stable")]
    starts = np.concatenate(([0], np.cumsum(np.bincount(owner[left], minlength=owners))))
    rank = np.arange(len(left)) - starts[owner[left]]
    return left[rank < SIZE], rank[rank < SIZE]


def distances(texts: list[str], profiles: Profiles) -> tuple[np.ndarray, np.ndarray]:
    """For each text and language the distance as a share of the largest possible; and which texts have a letter."""
    owner, gram, counts, has_letter = gram_counts(texts, np.arange(len(texts)))
    top, rank = ranked(owner, counts, len(texts))
    owner, gram = owner[top], gram[top]
    n = np.bincount(owner, minlength=len(texts))
    total = np.repeat(n[:, None] * float(SIZE), len(profiles.languages), axis=1)
    at = np.minimum(np.searchsorted(profiles.grams, gram), len(profiles.grams) - 1)
    hit = np.flatnonzero(profiles.grams[at] == gram)
    step = max(1, (1 << 21) // len(profiles.languages))
    for begin in range(0, len(hit), step):
        part = hit[begin : begin + step]
        places = profiles.ranks[at[part]]
        apart = np.where(places < SIZE, np.abs(places - rank[part, None]), SIZE) - SIZE
        first = np.flatnonzero(np.concatenate(([True], owner[part][1:] != owner[part][:-1])))
        total[owner[part][first]] += np.add.reduceat(apart, first, axis=0)
    return total / np.maximum(1, n * SIZE)[:, None], has_letter


def train(docs: DataFrame, per_language: int = 1000) -> list[Profiles]:
    """Profiles of all languages of `docs` (doc_id, text, lang), `BLOCK` languages each.

    A language with more than `per_language` documents is learned from a hash
    sample of about that many. The driver gets `SIZE` n-grams a language.
    """
    labelled = docs.where("lang IS NOT NULL")
    parts = 1 << 30
    share = F.least(F.lit(parts), (F.lit(float(per_language)) / F.count(F.lit(1)) * parts).cast("long"))
    # Stored, so that Spark knows how small it is and moves no text to join it.
    shares = stored(labelled.groupBy("lang").agg(share.alias("share")), "shares")
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(parts))
    sampled = labelled.select("lang", "text", picked.alias("picked")).join(shares, "lang").where("picked < share")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = {}, None
        for batch in batches:
            for part in T.slices(batch):
                owners = np.array([names.setdefault(name, len(names)) for name in part.column("lang").to_pylist()])
                owner, gram, n, _ = gram_counts(["" if t is None else t for t in part.column("text").to_pylist()], owners)
                keys = (owner.astype(np.uint64) << GRAM_BITS) | gram.astype(np.uint64)
                held = (keys, n) if held is None else _merged(np.concatenate((held[0], keys)), np.concatenate((held[1], n)))
        if held is not None and len(held[0]):
            owner, gram = held[0] >> GRAM_BITS, held[0] & np.uint64((1 << int(GRAM_BITS)) - 1)
            lang = pa.array(list(names)).take(pa.array(owner.astype(np.int64)))
            whole = pa.RecordBatch.from_arrays([lang, pa.array(gram.astype(np.int64)), pa.array(held[1].astype(np.int64))], ["lang", "gram", "n"])
            yield from (whole.slice(begin, 50_000) for begin in range(0, whole.num_rows, 50_000))

    counted = sampled.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = totals.select("lang", "gram", (F.row_number().over(order) - 1).alias("rank")).where(f"rank < {SIZE}")
    rows = top.toPandas()
    languages = sorted(set(rows["lang"]))
    found = []
    for begin in range(0, len(languages), BLOCK):
        block = languages[begin : begin + BLOCK]
        here = rows[rows["lang"].isin(block)]
        grams, at = np.unique(here["gram"].to_numpy(np.int64), return_inverse=True)
        ranks = np.full((len(grams), len(block)), SIZE, np.int32)
        ranks[at, np.searchsorted(np.array(block, object), here["lang"].to_numpy(object))] = here["rank"]
        found.append(Profiles(block, grams, ranks))
    return found


def predict(docs: DataFrame, blocks: list[Profiles]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; score is 1 less the distance's share of the largest."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        rows = rows.mapInArrow(
            _nearest(docs.sparkSession.sparkContext.broadcast(block), last),
            f"doc_id {kind}, {'' if last else 'text string, '}lang_pred string, score double",
        )
    return rows.select("doc_id", "lang_pred", "score")


def _nearest(shared, last: bool):
    """Keep the better of what a row has and its nearest language of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for part in T.slices(batch):
                share, has_letter = distances(["" if t is None else t for t in part.column("text").to_pylist()], block)
                nearest = share.argmin(axis=1)
                score = 1 - share[np.arange(len(share)), nearest]
                known, names = part.column("score").to_numpy(), part.column("lang_pred").to_pylist()
                better = has_letter & ((score > known) | np.array([name == UNKNOWN for name in names]))
                told = [block.languages[k] if b else name for k, b, name in zip(nearest.tolist(), better.tolist(), names, strict=True)]
                columns = {
                    "doc_id": part.column("doc_id"),
                    **({} if last else {"text": part.column("text")}),
                    "lang_pred": pa.array(told, pa.string()),
                    "score": pa.array(np.where(better, score, known)),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def query(spark, sf_dir: str) -> DataFrame:
    """op11: all documents with their language, learned from four in five of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs, train(docs.select("doc_id", "text", "lang").where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
