"""The base score against plain Python; the mixed score against held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from laketally.llm import mixing


def made(seed, n=1200):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeXé", k=rng.randint(1, 8))) for _ in range(200)]
    after = {w: rng.choices(words, k=3) for w in words}
    rows = [(None, "alone here"), (n, None), (n + 1, ""), (n + 2, " \t\n")]
    for d in range(n):
        text = [rng.choice(words)]
        for _ in range(rng.randint(5, 60)):
            text.append(rng.choice(after.get(text[-1], words)) if rng.random() < 0.8 else rng.choice([*words, f"new{rng.random()}"]))
        rows.append((d, " ".join(text)))
    return [*rows, rows[-1], (n + 3, rows[-1][1])]


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def test_counts_and_base(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COMMON", 300)  # so that rare words are joined
    rows = made(1)
    train = [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10]
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, word int")
    got = mixing.scored(docs, mixing._fold(10) != 0).collect()
    assert len(got) == len(rows)
    want = sorted(
        (str(d), len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6))
        for d, t in rows
        for w in [tokens(t)]
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    held = [r for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.85  # log10 sums are negative


def test_bits_are_a_distribution():
    rng = np.random.default_rng(3)
    h = rng.integers(1, 2**63, 500).astype(np.uint64)
    size = 1 << mixing.CODE_BITS
    c, v = rng.integers(0, 9, size).astype(float), rng.integers(0, 3, size).astype(float)
    model = mixing.Model(c, v, rng.integers(0, 20, (2, 1 << mixing.SLOT_BITS, 2)))
    model.learn(h)
    # all tokens after one context: bucket probabilities sum to 1
    last, seen = np.uint64(77), {}
    for word in rng.integers(1, 2**63, 80_000).astype(np.uint64):
        seen.setdefault(int(mixing.codes(np.array([word]))[0]), word)
    pairs = np.array([x for w in seen.values() for x in (mixing.END, last, w)], np.uint64)
    logs = model.log10(pairs)[2::3]
    mass = model.within[np.fromiter(seen, int)]
    assert len(seen) == size
    assert np.sum(10 ** (logs + mass)) == pytest.approx(1, abs=1e-6)


def test_empty_and_untrained(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert mixing.scored(docs, F.lit(True)).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = mixing.scored(docs, F.lit(False)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known) for r in got} == {(1, 3, 0), (2, 1, 0)}
    assert all(math.isfinite(r.score) for r in got)


def test_words_of_texts_are_shuffled_once(spark, capsys):
    """By the word alone, which both the grouping and the join with the counts take."""
    docs = spark.createDataFrame(made(2, 50), "doc_id long, text string")
    mixing.scored(docs, F.lit(True)).explain()
    plan = capsys.readouterr().out
    assert not re.search(r"hashpartitioning\((word#\d+L?, name|name#\d+L?, word)", plan)
    assert re.search(r"hashpartitioning\(word#\d+L?, \d+\)", plan)
