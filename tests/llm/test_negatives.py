"""Hard negatives against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest

from laketally.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, row string, q int"


def usable(v, label):
    return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain(rows, every):
    """The contract over (vec_id, vector, label), by all pairs."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if i is not None and usable(v, lab)]
    out = []
    for k, (anchor, a, label) in enumerate(kept):
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, q)), i, lab) for j, (i, q, lab) in enumerate(kept) if j != k]  # noqa: B905
        scored.sort()
        for ps, pid, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 50 * -ps <= 100 * -s[0] <= 95 * -ps][:3]
            out += [(anchor, pid, r, nid, -ps, -ns) for r, (ns, nid, _) in enumerate(fits, 1)]
    return sorted(out)


def random_rows(rng, n, dims, labels=3):
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        c = rng.randrange(labels)
        v = [x + rng.gauss(0, 0.15) for x in centres[c]]
        rows.append((i, v, rng.choice([c, c, c, rng.randrange(labels)])))
    return rows


def found(spark, rows, every):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    table = N.stored(N.vectors(df), "vectors")
    return sorted(tuple(r) for r in N.mine(table, table.where(f"vec_id % {every} = 0")).collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed, monkeypatch):
    """Several blocks of anchors, sizes of vectors, ties, copies, and rows that take no part."""
    if seed == 1:
        monkeypatch.setattr(N, "BLOCK", 7)
        monkeypatch.setattr(N, "ROWS", 16)
    rng = random.Random(seed)
    rows = random_rows(rng, 160, rng.choice([3, 16, 21]))
    rows += [rows[0], rows[0], (0, rows[1][1], 1), (500, [0.0] * 4, 1), (505, [], 2), (510, [0.1], 0), (515, rows[7][1] * 2, 1)]
    rows += [(520, None, 1), (525, [1.0, None], 1), (530, [float("nan")], 1), (535, [float("inf")], 1), (540, [1.0], None), (None, [1.0] * 3, 1)]
    rows += [(545, [1e30], 1), (546, [-x for x in rows[0][1]], rows[0][2])]
    assert found(spark, rows, 5) == plain([r for r in rows if r[0] != 545], 5)


def test_few_rows(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [0.9], 1), (2, [0.7], 2)], [(0, [], 1), (1, [], 1), (2, [], 2)]):
        assert found(spark, rows, 5) == plain(rows, 5)


def test_hot_label_and_equal_scores(spark):
    rows = [(i, [0.5, 0.25], 1 if i % 3 else 2) for i in range(90)] + [(100 + i, [0.4, 0.2], 2) for i in range(20)]
    assert found(spark, rows, 10) == plain(rows, 10)


def test_index_omits_and_prunes():
    """Lists stop where the rest cannot reach the threshold; no pair above it is lost."""
    rng = np.random.default_rng(1)
    q = np.rint(rng.normal(0, 40, (30, 32)) * np.linspace(1, 0.01, 32)).astype(np.int64)
    x = np.rint(rng.normal(0, 40, (200, 32)) * np.linspace(1, 0.01, 32)).astype(np.int64)
    rest = N.remaining_norms(x)
    low = np.full((30, 1), int(np.quantile(x @ q.T, 0.95)))
    w = N.Windows(False, 3, np.arange(32), rest.max(axis=0), np.arange(30), np.zeros(30, int), q, low, low + 10**9)
    index = N.Index(w, np.arange(30))
    assert max(index.ends) < 4 and min(index.ends) >= 1
    a, v, score = index.pairs(x.astype(float), rest, None)
    true = x @ q.T
    assert sorted(zip(v.tolist(), a.tolist(), strict=True)) == [tuple(p) for p in np.argwhere(true >= low[0, 0]).tolist()]
    assert (score == true[v, a]).all()
