"""Removal of repeated strings against plain Python."""

import random
from pathlib import Path

from laketally.llm import suffixes


def plain(rows, length=100):
    order = sorted({(2**63 if d is None else d, (t or "").encode()) for d, t in rows})
    first = {}
    for d, b in order:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w not in first or (d, i) < first[w]:
                first[w] = (d, i)
    out = []
    for d, t in rows:
        b, place = (t or "").encode(), 2**63 if d is None else d
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]][0] < place or first[b[i : i + length]] < (place, i):
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 9))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passages = [text(n) for n in (8, 14, 20, 45)]
    long = text(300)
    rows = [(None, long), (90, None), (91, ""), (92, "a" * 99), (93, "a" * 100), (94, "a" * 101), (95, "ab" * 900), (96, "ba" * 300)]
    for d in range(60):
        kind = rng.random()
        if kind < 0.3:
            made = long.split(" ")
            for _ in range(rng.randint(1, 8)):
                made[rng.randrange(len(made))] = rng.choice(words)
            rows.append((d, " ".join(made)))
        elif kind < 0.4:
            rows.append((d, long))
        else:
            rows.append((d, " ".join(x for _ in range(4) for x in (text(rng.randint(0, 30)), rng.choice(passages)))))
    return [*rows, rows[-1], rows[3]]


def test_equals_plain_removal(spark):
    for seed in range(2):
        rows = made(seed)
        docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, place int, name string")
        got = sorted((tuple(r[:4]) + (bytes(r[4]),) for r in suffixes.deduplicated(docs).collect()), key=str)
        assert got == plain(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.deduplicated(docs).collect() == []


def test_only_the_marks_are_left_on_disk(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    suffixes.marks(spark.createDataFrame(made(1), "doc_id long, text string"))
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["marks"]


def test_anchors_are_shuffled_once(spark, capsys):
    docs = spark.createDataFrame(made(1), "doc_id long, text string")
    suffixes.anchors(suffixes._texts(docs)).explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning(anchor") == 1
