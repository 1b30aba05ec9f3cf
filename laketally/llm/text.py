"""Words, shingles and hashes of whole Arrow columns of text, without a loop per word.

A text is its UTF-8 bytes, and a null text is empty. Words are runs of bytes
between ASCII white space. All hashes are unsigned 64-bit and the same in every
task and every session.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text that are looked at together. Work arrays take about 40 bytes
#: for each; one text longer than this is looked at alone.
SLICE_BYTES = 2 << 20
#: The same where a worker should stay small: work arrays then are freed to the system or used again.
SMALL_BYTES = SLICE_BYTES // 4

#: Bytes of rows that Spark hands a worker at a time, where the session names no number of its own.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.Generator(np.random.PCG64(20))
BYTE_HASH = _random.integers(1, 2**64, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 2**64))
WEIGHTS = _random.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)


class Cache(dict):
    """Kept while a task runs, and empty again wherever it is sent."""

    def __reduce__(self):
        return (Cache, ())


_powers = Cache()


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), wrapping."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(1 << max(n, 1).bit_length(), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[int(base)] = known
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def small_batches(spark: SparkSession) -> None:
    """From now on batches of BATCH_BYTES in this session: a batch is held by the executor and by its worker at once."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most `most` bytes of text, or one row."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, begin = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > begin and total + size > most:
            yield batch.slice(begin, row - begin)
            total, begin = 0, row
        total += size
    yield batch.slice(begin)


def flat(column: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, `end` after each text, and where each text begins (one more than texts)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if end:  # as the separator between the text and an empty one
        column = pc.binary_join_element_wise(column, pa.scalar(b"", pa.large_binary()), pa.scalar(end, pa.large_binary()))
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where each text's words begin (one more than texts)."""
    data, at = flat(column, b" ")
    starts, ends = _runs(SPACES[data])
    return run_hashes(LOWER[data] if lower else data, starts, ends), np.searchsorted(starts, at)


def _runs(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(gap) and not gap[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial of the bytes of each run, from differences of running sums."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_HASH[data] * powers(STEP, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(BACK, n + 1)[starts]
    return mixed(h + (ends - starts).astype(np.uint64))


def shingles(h: np.ndarray, at: np.ndarray, k: int, short: bool = True) -> list[np.ndarray]:
    """The sorted distinct hashes of the k-word shingles of each text.

    With fewer than k words, the whole sequence is the one shingle (none if not
    `short`); without words there are none.
    """
    n = len(h) - k + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for i in range(k if n > 0 else 0):
        rolled += h[i : i + n] * WEIGHTS[i]
    rolled = mixed(rolled)
    found = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            found.append(np.unique(rolled[a : b - k + 1]))
        elif b > a and short:
            whole = (h[a:b] * WEIGHTS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            found.append(mixed(np.array([whole], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found
