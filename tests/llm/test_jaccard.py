"""Components of the join against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from laketally.llm import jaccard


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, part, whole):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * whole >= part * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    group = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            group[find(i)] = min(d, group.get(find(i), d))
    return sorted(((d, len(sets[i]), group.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefg", k=3))
    texts = [None, "", "  \n", "one", "One", "one two three", "ONE two three"]
    passage = [word() for _ in range(20)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.choice([1, 2, 30])):
            some = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                some[rng.randrange(len(some))] = word()
            if rng.random() < 0.2:
                some = some + passage
            texts.append(" ".join(some).title() if rng.random() < 0.2 else " ".join(some))
    chain = [word() for _ in range(160)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 60, 3)]
    rng.shuffle(texts)
    out = list(enumerate(texts)) + [(3, texts[3]), (None, texts[9]), (None, "all alone here and there")]
    rng.shuffle(out)
    return out


def test_components_match_all_pairs(spark, rows):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, set_id int")
    got = sorted(map(tuple, jaccard.joined(docs, 4, 85, 100).collect()), key=str)
    assert got == brute(rows, 4, 85, 100)


def test_adaptive_join_alone_finds_all(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "STARS", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard.joined(docs, 5, 8, 10).collect()), key=str)
    assert got == brute(rows, 5, 8, 10)


def test_stage_keeps_one_of_each_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = {(c if c is not None else None) for d, _, c in brute(rows, 5, 8, 10) if d is not None}
    kept = [r.doc_id for r in jaccard.one_of_each(docs, 5, 8, 10).collect()]
    assert sorted(d for d in kept if d is not None) == sorted(groups)
    assert kept.count(None) == 2
    assert jaccard.joined(docs.limit(0), 4, 85, 100).count() == 0


def test_rows_that_share_an_id_are_kept_by_their_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b), (4, c), (4, c), (5, ""), (5, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, set_id int")
    kept = jaccard.one_of_each(docs, 5, 8, 10)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (1, b), (4, c), (5, ""), (5, None)], key=str)


def test_lists_of_two_that_cannot_link_are_dropped(spark):
    def entry(name, n, first, shingle):
        return (name, n, 1, first, 0, 0, 0, shingle, 1)

    far, near = (1 << 40) - 1, 7  # 40 and 3 bits from zero
    rows = [entry(b"a", 100, 0, 1), entry(b"b", 100, far, 1)]  # two that cannot link
    rows += [entry(b"a", 100, 0, 2), entry(b"c", 100, near, 2)]  # two that can
    rows += [entry(b"a", 100, 0, 3), entry(b"b", 100, far, 3), entry(b"c", 100, near, 3)]  # more than two
    rows += [entry(b"d", 100, 0, 4), entry(b"e", 100, 0, 4)]  # one component
    columns = ", ".join(f"{m} long" for m in jaccard.MAP)
    entries = spark.createDataFrame(rows, f"set_id binary, n long, own long, {columns}, shingle long, level long")
    links = spark.createDataFrame([(bytearray(b"d"), bytearray(b"e"))], "a binary, b binary")
    kept = jaccard._rooted(entries, links, 85, 100)
    assert {r.shingle for r in kept.collect()} == {2, 3}


def candidates(monkeypatch, docs, k):
    """How many pairs each star and the last join have verified, and the result."""
    counts, stored = [], jaccard.stored

    def counting(df, name, *observed):
        table = stored(df, name, *observed)
        if name == "pairs":
            counts.append(table.count())
        return table

    monkeypatch.setattr(jaccard, "stored", counting)
    return counts, jaccard.joined(docs, k, 85, 100).collect()


def test_the_set_that_shares_most_is_the_first_centre(spark, monkeypatch):
    """Copies that link with their original alone are not met with each other."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for d in range(1, 41):
        changed = set(rng.sample(range(200), 14))
        rows.append((d, " ".join(f"d{d}n{i}" if i in changed else w for i, w in enumerate(base))))
    counts, got = candidates(monkeypatch, spark.createDataFrame(rows, "doc_id long, text string"), 1)
    assert sorted(map(tuple, got), key=str) == brute(rows, 1, 85, 100)
    assert counts[0] == 40 and not any(counts[1:])
    assert len(counts) == 3  # two stars, as the second finds nothing, and the last join


def test_sets_that_share_too_late_for_their_sizes_are_no_candidates(spark, monkeypatch):
    common = [f"c{i}" for i in range(200)]
    shared = [f"s{i}" for i in range(5)]  # with 12 words before them two sets of 100 may link only if these are alike in 92
    rows = [(d, " ".join([*(f"d{d}n{i}" for i in range(12)), *shared, *common[83 * d : 83 * d + 83]])) for d in range(2)]
    rows += [(d, " ".join(common[:190] + [f"e{d}n{i}" for i in range(600)])) for d in range(2, 12)]  # these words are common
    monkeypatch.setattr(jaccard, "_alike", lambda *a: F.lit(True))
    counts, got = candidates(monkeypatch, spark.createDataFrame(rows, "doc_id long, text string"), 1)
    assert sorted(map(tuple, got), key=str) == brute(rows, 1, 85, 100)
    assert sum(counts) == 0
