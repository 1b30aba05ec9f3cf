"""Secrets, decontamination and chat windows against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from laketally.llm import chat, decontamination, packing, secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return ",".join(f"{secrets.BASE[k]}:{a}:{b}" for a, k, b in sorted(found))


@pytest.fixture(scope="module")
def secret_texts():
    rng = random.Random(5)
    parts = ["password", "Secret", "token", "API_KEY", "apikey", "=", ":", '"', "'", " ", "  ", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "\n", "x", "zz9+/", "eyJ", "漢"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "a" * 5000, "token=" * 900, "0" * 3000 + " é password = 'abcdef'", "password" + " " * 3000 + "=" + " " * 3000 + "abcdefgh"]
    return texts


def test_secrets_match_patterns(spark, secret_texts):
    rows = list(enumerate(secret_texts)) + [(None, "token=abcdefg")]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r.spans for r in secrets.find(docs).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        found = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in got[i] if s.kind in secrets.BASE)
        assert found == base_spans(text or ""), text


def test_redacted_texts_have_no_secret(spark):
    docs = spark.createDataFrame([(1, "é token=abcdefgh end", 20), (2, "plain", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(docs).collect()}
    assert got == {1: ("é [SECRET] end", 14), 2: ("plain", 5), 3: (None, None)}


def test_contained_items_match_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    items = [[word() for _ in range(rng.choice([3, 5, 9, 30, 80]))] for _ in range(30)] + [[]]
    docs = []
    for i in range(200):
        words = [word() for _ in range(rng.choice([0, 4, 60, 900]))]
        if i % 2:
            some = list(rng.choice(items))
            if some and i % 4 == 1:
                some[rng.randrange(len(some))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = some
        docs.append((i, " ".join(words).upper() if i % 3 else "\n".join(words), 7))
    docs += [(500, None, 1), (501, "", 1), (502, " ".join(items[0]), 1), (502, " ".join(items[0]), 1), (None, " ".join(items[5]), 1)]

    def grams(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    expected = []
    for d, text, _ in docs:
        for k, item in enumerate(items):
            need = grams(" ".join(item))
            if need and 10 * len(need & grams(text)) >= 8 * len(need):
                expected.append((d, k))
    table = spark.createDataFrame(docs, "doc_id long, text string, containment int")
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    key = lambda p: (p[0] is None, p)
    for block in (1 << 20, 50):
        found = [(r.doc_id, r.item_id) for r in decontamination.contained(table, bench, block=block).collect()]
        assert sorted(found, key=key) == sorted(expected, key=key)
        kept = decontamination.clean(table, bench, block=block)
        assert kept.columns == table.columns
        bad = {d for d, _ in expected}
        assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _, _ in docs if d not in bad)
    assert decontamination.contained(table, bench.limit(0)).count() == 0
    assert decontamination.contained(table.limit(0), bench).count() == 0


def plain_digests(turns):
    said = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
    loss = "".join(text or "" for role, text in turns if role == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark):
    rng = random.Random(9)
    texts = ["</s>[INST] ok [/INST]", "", None, "&lt;é&amp;", "<user>\n<=x>", "漢字 " * 50, "word " * 400, "y" * 9000, ">a=b>", "\\&#91;"]
    rows, expected = [], {}
    for c in (*range(12), -1):
        n = 700 if c == 3 else rng.randint(1, 30)
        turns = [("system" if t == 0 and c % 2 else rng.choice(["user", "assistant"]), rng.choice(texts)) for t in range(n)]
        expected[c] = plain_digests(turns)
        rows += [(c, t, *turn, "x") for t, turn in enumerate(turns)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    wins = chat.windows(turns)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(wins).collect()}
    assert got == expected
    assert wins.where("conv_id = 3").count() > 5
    assert wins.where((F.col("conv_id") == 3) & ~F.col("formatted").startswith("<=system>") & (F.col("window") > 0)).count() == 0
    assert chat.read_back(chat.windows(turns.limit(0))).count() == 0


def test_null_and_repeated_turns(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "a"), (None, 1, "assistant", "a"), (5, 0, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.windows(turns)).collect()}
    assert got == {None: plain_digests([("", ""), ("assistant", "a"), ("assistant", "a")]), 5: plain_digests([("assistant", "")])}


def test_secret_query(spark, tmp_path, secret_texts):
    spark.createDataFrame(list(enumerate(secret_texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in secrets.query(spark, str(tmp_path)).collect():
        spans = base_spans(secret_texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [spans.count(k + ":") for k in secrets.BASE]


def test_chat_windows_keep_their_budget(spark):
    count = lambda text: len(packing.encoder(packing.TOKENIZER).encode([text])[0]) // 4
    rng = random.Random(11)
    texts = ["<<<===&&&" * 40, "漢字かな" * 90, "word " * 300, "ok", "if x[0] >= y: z\n" * 60, "y" * 9000, "é" * 5000, "[" * 700]
    rows, expected = [], {}
    for c in range(8):
        turns = [("system" if t == 0 and c % 2 else rng.choice(["user", "assistant"]), rng.choice(texts)) for t in range(rng.choice([1, 20, 150]))]
        turns += [("assistant", "漢[" * 3000)] * 2
        expected[c] = plain_digests(turns)
        rows += [(c, min(t, len(turns) - 2), *turn) for t, turn in enumerate(turns)]
    wins = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    assert {r.conv_id: tuple(r)[1:5] for r in chat.read_back(wins).collect()} == expected
    some = wins.collect()
    for r in some:
        pieces = [re.fullmatch("(<[^>]*>)([^<]*)", t).groups() for t in r.formatted.split("</s>")[:-1]]
        assert sum(count(head) + count(body) + count("</s>") for head, body in pieces) <= r.tokens <= chat.BUDGET
        assert any(not head.startswith("<=") for head, _ in pieces)
    assert any("<=user>" in r.formatted for r in some) and any("<[" in r.formatted for r in some)


def test_chat_long_roles_and_equal_turn_numbers(spark):
    """A role longer than a window, null and repeated turn numbers over several blocks: all turns come back."""
    rows = [(1, 0, "system", "s"), (1, 1, "r" * 9000, "said"), (1, 2, "assistant", "ok"), (None, None, None, None)]
    rows += [(2, None if i % 2 else 7, "user", f"t{i:05d}") for i in range(chat.BLOCK + 50)]
    wins = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    told = {r.conv_id: r for r in chat.read_back(wins).collect()}
    said = "".join(f"{role}\n{text}\n" for _, _, role, text in rows[:3])
    assert told[1].n_turns == 3 and told[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    order = sorted(rows[4:], key=lambda r: (r[1] is not None, r[3]))
    said = "".join(f"user\n{r[3]}\n" for r in order)
    assert told[2].n_turns == chat.BLOCK + 50 and told[2].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert told[None].n_turns == 1
