"""Fingerprints: neighbours and edits exactly, likeness by what it should tell apart."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from laketally.llm import fingerprints


def test_edits_and_likeness(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeéf漢", k=rng.randint(2, 7)))
    texts = [" ".join(word() for _ in range(rng.choice([30, 300, 3000]))) for _ in range(40)]
    texts[3], texts[4], texts[5], texts[6] = None, "", "x", "a" * 20000
    texts[8] = texts[7]
    ids = rng.sample(range(1000), len(texts))
    docs = spark.createDataFrame([(*r, 1) for r in zip(ids, texts, strict=True)], "doc_id long, text string, next_id int").repartition(5)
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    by_id, order = dict(zip(ids, texts, strict=True)), sorted(ids, reverse=True)
    for i, d in enumerate(order):
        text, other = by_id[d] or "", by_id[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        assert got[d].n_chars == len(text)
        assert got[d].edited_sha256 == hashlib.sha256((text[: len(text) - half] + other[:half]).encode()).hexdigest()
        assert got[d].next_id == order[(i + 1) % len(order)]
    assert got[ids[7]].bins == got[ids[8]].bins
    scored = fingerprints.fingerprints(docs).select("n_chars", fingerprints.alike("bins", "edited_bins").alias("e"), fingerprints.alike("bins", "next_bins").alias("n")).where("n_chars > 1000 AND n_chars < 20000").collect()
    assert sum(r.e for r in scored) > 2 * sum(r.n for r in scored)


def test_order_of_the_text_matters(spark):
    rng = random.Random(4)
    blocks = ["".join(rng.choices("abcdefgh", k=40)) for _ in range(30)]
    moved = blocks[15:] + blocks[:15]
    docs = spark.createDataFrame([(1, "".join(blocks)), (2, "".join(moved))], "doc_id long, text string")
    rows = fingerprints.fingerprints(docs).select(fingerprints.alike("bins", "next_bins").alias("n")).collect()
    assert all(0 < r.n < 1 for r in rows)


def test_repeated_null_and_empty(spark):
    docs = spark.createDataFrame([(1, "abc"), (1, "abc"), (None, "null id")], "doc_id long, text string")
    rows = fingerprints.fingerprints(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]
    assert {r.next_id for r in rows if r.doc_id} == {1}
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0


def test_near_copies_around_powers_of_two(spark):
    rng = random.Random(8)
    rows = []
    for i, size in enumerate([128, 256, 1024, 4096, 16384]):
        text = "".join(rng.choices("abcdefghijklmnop qrst", k=size))
        rows.append((i, text, text[:-1], text + "z"))
    docs = spark.createDataFrame(rows, "i int, a string, b string, c string")
    for column in "abc":
        docs = fingerprints.sketched(docs, column, f"{column}_bins")
    for r in docs.select("i", fingerprints.alike("a_bins", "b_bins").alias("less"), fingerprints.alike("a_bins", "c_bins").alias("more")).collect():
        assert min(r.less, r.more) > 0.8, r


def plain_bins(spark, text):
    """The bins' (hash, place) from all numbered k-mers, hashed by Spark, chosen by Python."""
    k = fingerprints.K
    kmers = [text[i : i + k] for i in range(len(text) - k + 1)] if len(text) >= k else [text] * bool(text)
    seen, numbered = {}, []
    for i, kmer in enumerate(kmers):
        numbered.append((i, kmer, seen.get(kmer, 0)))
        seen[kmer] = seen.get(kmer, 0) + 1
    rows = spark.createDataFrame(numbered, "i int, kmer string, nth int").select("i", F.xxhash64(F.xxhash64("kmer"), "nth").alias("g")).collect() if numbered else []
    bins = [sorted((r.g, r.i) for r in rows if r.g % fingerprints.BINS == j)[: fingerprints.TUPLE] for j in range(fingerprints.BINS)]
    return [[g for g, _ in sorted(some, key=lambda x: x[1])] for some in bins]


@pytest.mark.parametrize("few", [40, 448])
def test_bins_match_plain_python(spark, monkeypatch, few):
    monkeypatch.setattr(fingerprints, "FEW", few)
    rng = random.Random(9)
    texts = ["", "é", "abcdefgh", "ab" * 900, "a" * 3000, "".join(rng.choices("abé漢\n", k=5000)), "one passage again. " * 70 + "x"]
    texts += ["\U0001f600abcdefghij", "".join(rng.choices("ab\U0001f600\U00010400漢", k=800))]  # code points of two UTF-16 units
    docs = spark.createDataFrame([*enumerate(texts)], "i int, text string")
    for r in fingerprints.sketched(docs, "text", "bins").collect():
        expected = plain_bins(spark, texts[r.i])
        filled = spark.createDataFrame([(j, some) for j, some in enumerate(expected)], "j int, some array<bigint>").select("j", F.when(F.size("some") > 0, F.xxhash64("some")).alias("h"))
        assert r.bins == [x.h for x in sorted(filled.collect())]


def test_texts_are_shuffled_once(spark):
    rows = [(i, f"text {i} " * 20) for i in range(50)] + [(None, "null id"), (7, "another text of 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = fingerprints.edited(docs)
        got = sorted(((r.doc_id, r.text, r.next_id, r.edited) for r in found.collect()), key=str)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ReusedExchange" in plan
    least = {d: min(t for e, t in rows if e == d) for d, _ in rows}
    expected = []
    for d, t in rows:
        other = None if d is None else (d - 1) % 50
        half = len(t) // 2
        expected.append((d, t, other, t[: len(t) - half] + (least[other][:half] if d is not None else "")))
    assert got == sorted(expected, key=str)


@pytest.mark.parametrize(("place", "rank"), [(20, 3), (4, 12)])
def test_long_texts_and_many_candidates(spark, monkeypatch, place, rank):
    """Keys with 31 bits of place, and candidates without ranks, give the same bins."""
    text = random.Random(7).choices("abcé漢", k=900)
    docs = spark.createDataFrame([("".join(text) * 2,)], "text string")
    expected = fingerprints.sketched(docs, "text", "bins").first().bins
    monkeypatch.setattr(fingerprints, "PLACE_BITS", place)
    monkeypatch.setattr(fingerprints, "RANK_BITS", rank)
    assert fingerprints.sketched(docs, "text", "bins").first().bins == expected


def test_no_pattern_is_matched_at_every_place(spark):
    docs = spark.createDataFrame([("some text of eight and more",)], "text string")
    plan = fingerprints.sketched(docs, "text", "bins")._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan.lower() and "rlike" not in plan.lower()
