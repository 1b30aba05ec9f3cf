"""Rank-order profiles against plain Python, and held-out accuracy."""

import random
from collections import Counter
from unicodedata import category

import numpy as np
import pytest
from pyspark.sql import functions as F

from laketally.llm import languages as L
from laketally.llm.quality import held_out

M64 = (1 << 64) - 1


def plain_mixed(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & M64
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & M64
    return h ^ (h >> 31)


def plain_hash(gram):
    h = 0
    for c in gram:
        h = (h * 0x9E3779B97F4A7C15 + plain_mixed((0 if c == " " else ord(c)) + 1)) & M64
    return h >> 24


def plain_grams(text):
    def low(c):
        return c.lower() if len(c.lower()) == 1 else c

    words = "".join(low(c) if category(c)[0] in "LM" else " " for c in text or "").split()
    found = Counter()
    for word in words:
        padded = f" {word} "
        found.update(g for n in range(1, 6) for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " ")
    return found


def plain_ranks(counts):
    hashed = {plain_hash(g): n for g, n in counts.items()}
    order = sorted(hashed, key=lambda h: (-hashed[h], h))[: L.SIZE]
    return {h: i for i, h in enumerate(order)}


def plain_predict(text, profiles):
    if not any(category(c)[0] == "L" for c in text or "") or not profiles:
        return "und", 0.0
    mine = plain_ranks(plain_grams(text))
    far = {
        lang: sum(abs(rank - p[h]) if h in p else L.SIZE for h, rank in mine.items()) for lang, p in sorted(profiles.items())
    }
    best = min(far, key=far.get)
    return best, 1 - far[best] / (L.SIZE * len(mine))


def random_text(rng):
    kind = rng.randrange(8)
    if kind == 0:
        return rng.choice([None, "", " \n", "123 !!", "́"])
    alphabet = ["abcdeé", "xyzçÀ", "абвгд", "中文字", "aİß'", "\U00010400\U00010428 x"][rng.randrange(6)]
    return "".join(rng.choice(alphabet + "   \n1.") for _ in range(rng.randint(1, 600)))


@pytest.mark.parametrize("step", [7, 1 << 19])
def test_counts_equal_plain(step, monkeypatch):
    monkeypatch.setattr(L, "STEP", step)
    rng = random.Random(step)
    texts = [random_text(rng) or "" for _ in range(60)]
    owner, gram, n, letter = L.gram_counts(texts, np.arange(60))
    got = [{} for _ in texts]
    for o, g, c in zip(owner.tolist(), gram.tolist(), n.tolist(), strict=True):
        got[o][g] = c
    for text, found, has in zip(texts, got, letter.tolist(), strict=True):
        assert found == {plain_hash(g): c for g, c in plain_grams(text).items()}
        assert has == any(category(c)[0] == "L" for c in text)


def test_no_texts():
    owner, _, _, letter = L.gram_counts([""], np.arange(1))
    assert len(owner) == 0 and letter.tolist() == [False]


@pytest.mark.parametrize("block", [1, 1024])
def test_predictions_equal_plain(spark, block, monkeypatch):
    """Ties, repeated rows, nulls, a language without letters, clashing columns; one and several blocks of languages."""
    monkeypatch.setattr(L, "BLOCK", block)
    rng = random.Random(3)
    rows = [(i, random_text(rng), rng.choice(["a", "b", "c", None, ""]), 1, "x") for i in range(150)]
    rows += [rows[5], rows[5], (None, "abc abc", "b", 1, "x"), (900, "12 34", "digits", 1, "x"), (901, "word " * 30_000, None, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, gram int, lang_pred string")
    totals = {}
    for _, text, lang, *_ in rows:
        if lang is not None:
            totals.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {lang: plain_ranks(c) for lang, c in totals.items() if c}
    found = L.predict(docs, L.train(docs)).collect()
    expected = [(r[0], *plain_predict(r[1], profiles)) for r in rows]
    key = lambda r: (str(r[0]), r[1], round(r[2], 9))
    assert sorted(map(key, found)) == sorted(map(key, expected))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.predict(none, L.train(none)).collect() == []
    some = spark.createDataFrame([(1, "abc", "a")], none.schema)
    assert [tuple(r) for r in L.predict(some, L.train(none)).collect()] == [(1, "und", 0.0)]


def test_sample_is_bounded(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.when(F.col("id") < 4990, "big").otherwise("small").alias("lang"))
    (profiles,) = L.train(docs, per_language=100)
    assert profiles.languages == ["big", "small"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").where(held_out()).select("doc_id", "lang")
    found = L.query(spark, sf).where("held_out").join(truth, "doc_id").where("lang IS NOT NULL")
    right, n = found.agg(F.count_if(F.col("lang_pred") == F.col("lang")), F.count("*")).first()
    assert right / n >= 0.97
