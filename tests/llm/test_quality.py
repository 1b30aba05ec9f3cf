"""The quality classifier against a plain loop, and on held-out labels."""

import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from laketally.llm import quality

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x09-\x0d\x20]+")


def plain_grams(text):
    """Tokens and neighbouring pairs, a word equal to the one before it as one fixed token."""
    words = TOKEN.findall((text or "").encode())
    kept, last = [], None
    for w in words:
        is_word = w[:1].isalnum() or w[0] >= 128
        kept.append("SAME" if is_word and w == last else w)
        if is_word:
            last = w
    return len(kept) + max(0, len(kept) - 1), [*kept, *zip(kept, kept[1:], strict=False)]


def test_features_equal_plain():
    """As many n-grams as plain Python has, equal ones in equal buckets."""
    rng = random.Random(1)
    texts = [None, "", "a a a b", "x, y", "é é", "the the. the"] + [" ".join(rng.choice("aab,.é1 ") for _ in range(rng.randint(0, 40))) for _ in range(40)]
    grams, at = quality.features(pa.array(texts, pa.string()), 1 << 40)
    seen = {}
    for k, text in enumerate(texts):
        n, plain = plain_grams(text)
        mine = grams[at[k] : at[k + 1]].tolist()
        assert len(mine) == n
        singles = [g for g in plain if not isinstance(g, tuple)]
        pairs = [g for g in plain if isinstance(g, tuple)]
        ordered = [g for s, p in zip(singles, [*pairs, None], strict=False) for g in (s, p) if g is not None]
        for bucket, gram in zip(mine, ordered, strict=True):
            assert seen.setdefault(gram, bucket) == bucket
    assert len(set(seen.values())) == len(seen)


def plain_ftrl(rows, labels, buckets, rate=2.0, l1=0.02, l2=1.0):
    z, n, w = [0.0] * buckets, [0.0] * buckets, [0.0] * buckets
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    base = math.log(share / (1 - share))
    for _ in range(quality.EPOCHS):
        for row, label in zip(rows, labels, strict=True):
            x = {g: quality.SCALE * row.count(g) / len(row) for g in set(row)}
            p = 1 / (1 + math.exp(-max(-30, min(30, base + sum(w[g] * v for g, v in x.items())))))
            for g, v in x.items():
                step = (p - label) * v
                sigma = (math.sqrt(n[g] + step * step) - math.sqrt(n[g])) / rate
                z[g] += step - sigma * w[g]
                n[g] += step * step
                w[g] = 0 if abs(z[g]) <= l1 else -(z[g] - math.copysign(l1, z[g])) / ((1 + math.sqrt(n[g])) / rate + l2)
    return w, base


def test_updates_equal_plain():
    rng = random.Random(2)
    rows = [[rng.randrange(12) for _ in range(rng.randint(1, 30))] for _ in range(40)]
    labels = [float(sum(r) / len(r) > 5.5) for r in rows]
    at = np.cumsum([0, *map(len, rows)])
    model = quality.follow_leader(np.array(sum(rows, [])), at, np.array(labels), 12)
    weights, base = plain_ftrl(rows, labels, 12)
    assert np.allclose(model.weights, weights) and math.isclose(model.base, base)


def test_odd_rows(spark):
    """Nulls, empty texts, labels without documents, repeated and clashing columns, no labels, no rows."""
    rows = [(1, "good text here", 0.5), (2, "bad !! bad !!", 0.5), (2, "bad !! bad !!", 0.5), (3, None, 0.5), (None, "", 0.5), (4, "word " * 50_000, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (77, 1), (None, 1)], "doc_id long, label int")
    model = quality.train(docs, labels, buckets=64)
    found = quality.score(docs, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[1] > by_id[2] and math.isclose(by_id[3], by_id[None])
    assert math.isclose(by_id[3], 1 / (1 + math.exp(-model.base)), rel_tol=1e-6)
    none = quality.train(docs, labels.limit(0), buckets=64)
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.keep_good(docs, model, 2.0).count() == 0


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    found = quality.query(spark, sf).where("held_out").join(labels, "doc_id").where("quality IS NOT NULL")
    right, n = found.agg(F.count_if(F.col("predicted") == F.col("quality")), F.count("*")).first()
    assert n > 200 and right / n >= 0.97
