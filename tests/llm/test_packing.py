"""Packing against the plain tokenizer: every id once, windows without gaps or padding."""

import random
import struct
import zlib

import pytest

from laketally.llm import packing

SCHEMA = "doc_id long, text string, ids int, start string"


def texts(rng):
    words = ["the", "a", "naïve", "Ünder", "中文", "x" * 40, "12,5", "don't", "", " ", "\n", "\t\n", "\U0001f600", "</s>"]
    out = [None, "", " ", "  a", "a  ", "a \n b", "\n\n", "word " * 6000, "z" * 5000]
    return out + ["".join(rng.choice(words) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randint(0, 300))) for _ in range(60)]


@pytest.fixture(scope="module")
def plain():
    tokenizer = packing.tokenizer(packing.TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("cache", [5, 600_000])
def test_encoder_equals_tokenizer(plain, cache, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", cache)
    encoder = packing.Encoder(packing.TOKENIZER)
    for seed in range(3):
        some = [t or "" for t in texts(random.Random(seed))]
        got = [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in encoder.encode(some)]
        assert got == [plain(t)[:-1] for t in some]


def test_pieces(spark, tmp_path, plain):
    """Nulls, empty and long texts, repeated rows and clashing columns; the query's columns in order."""
    rows = [(i, t, 1, "x") for i, t in enumerate(texts(random.Random(9)))] + [(900, "again and again", 1, "x")] * 2 + [(None, "no id", 1, "x")]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    df = packing.query(spark, str(tmp_path))
    assert tuple(df.columns[:7]) == packing.COLUMNS
    pieces = df.collect()
    sequences, found = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        found.setdefault(p.doc_id, []).append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1024 and at & (at - 1) == 0
    want = {}
    for doc, text, *_ in rows:
        want.setdefault(doc, []).append(plain(text))
    assert found.keys() == want.keys()
    for doc, lists in want.items():
        ids = lists[0]
        copies = sorted(found[doc])
        assert sum(n for _, n, _, _ in copies) == len(ids) * len(lists)
        for start, n, crc, total in copies:
            assert crc == zlib.crc32(struct.pack(f"<{n}I", *ids[start : start + n])) and total == len(ids)
        if len(lists) == 1:
            assert [s for s, *_ in copies] == [sum(n for _, n, _, _ in copies[:k]) for k in range(len(copies))]


def test_windows_keep_every_token():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.choice([1, 5, 130, 500, 1023, 1024, 1025, 5000]) + rng.randrange(40) for _ in range(rng.randint(0, 60))]
        found = packing.windows(lengths)
        held = sorted((doc, start, n) for window in found for doc, start, n in window)
        for doc, total in enumerate(lengths):
            at = 0
            for _, start, n in (h for h in held if h[0] == doc):
                assert start == at
                at += n
            assert at == total
        assert all((size := sum(n for _, _, n in w)) <= 1024 and size & (size - 1) == 0 for w in found)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_new_words_go_through_the_tokenizer_together(plain):
    encoder = packing.Encoder(packing.TOKENIZER)
    encoder.tokenizer = Counting(encoder.tokenizer)
    text = " ".join(f"w{i}" for i in range(5000))
    assert list(struct.unpack("<%dI" % (len(encoder.encode([text])[0]) // 4), encoder.encode([text])[0])) == plain(text)[:-1]
    assert encoder.tokenizer.texts < 50


@pytest.mark.parametrize("marked", [True, False])
def test_words_that_hold_the_mark_or_other_space(plain, marked):
    encoder = packing.Encoder(packing.TOKENIZER)
    assert encoder.marked
    encoder.marked = marked
    odd = ["a\x0cb", "\x0c", "c\x0c", "\x0cd", "<|endoftext|>", "x<|endoftext|>", "don't", "'s", "l\nm", "n ", " o", "p\x1cq", "r\x1c", "é", "_", "1,5"]
    rng = random.Random(4)
    some = [" ".join(rng.choice(odd) for _ in range(rng.randint(1, 12))) for _ in range(400)] + odd
    got = [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in encoder.encode(some)]
    assert got == [plain(t)[:-1] for t in some]


def test_words_in_use_outlive_the_cache(plain, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 40)
    encoder = packing.Encoder(packing.TOKENIZER)
    words = []
    learn = encoder._learn_marked
    encoder._learn_marked = lambda pieces: (words.extend(pieces), learn(pieces))[1]
    for i in range(30):
        text = "start often used " + " ".join(f"w{i}n{j}" for j in range(15))
        assert encoder.encode([text]) == [struct.pack(f"<{len(plain(text)) - 1}I", *plain(text)[:-1])]
    assert words.count("often") == 1 and len(encoder.known) + len(encoder.older) <= 80
