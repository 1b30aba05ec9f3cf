"""Licence recognition against plain Python."""

import random
import re

from laketally.llm import licenses
from laketally.llm.queries import QUERIES

BREAK = re.compile(r"""[.!?:;)]["'”’)]*(?=\s|$)|\n""")
WORD = re.compile(r"[^\W_]+")


def plain_sentences(text):
    """Every known sentence as a pattern, tried at every break."""
    words = list(WORD.finditer(text))
    gap = lambda a, b: bool(BREAK.search(text[a : b + 1]) and any(a <= m.start() < b for m in BREAK.finditer(text)))
    starts = [k == 0 or gap(words[k - 1].end(), w.start()) for k, w in enumerate(words)]
    ends = [*starts[1:], True]
    pats = [(name, re.compile(" ".join(r"\w+(?: \w+){0,%d}" % (licenses.WILD - 1) if w == "*" else w for w in re.findall(r"[^\W_]+|\*", s.lower())))) for name, s in licenses.SENTENCES]
    low = [w.group().lower() for w in words]
    found, at, begun = [], 0, 0
    while at < len(words):
        best = None
        if starts[at]:
            for end in range(len(words), at, -1):
                if ends[end - 1] and end - at < 140:
                    best = next((name for name, p in pats if p.fullmatch(" ".join(low[at:end]))), None)
                    if best:
                        break
        if best:
            found.append((best, words[at].start(), words[end - 1].end()))
            at = begun = end
            continue
        if ends[at]:
            if licenses.TELLING & set(low[begun : at + 1]):
                found.append(("?", words[begun].start(), words[at].end()))
            begun = at + 1
        at += 1
    return found


def plain_licenses(found):
    ids, out, at = [f[0] for f in found], [], 0
    while at < len(ids):
        fits = [r for r in licenses.RULES if tuple(ids[at : at + len(r[1])]) == r[1]]
        best = max(fits, key=lambda r: len(r[1]), default=None)
        if best:
            out.append((best[0], found[at][1], found[at + len(best[1]) - 1][2]))
        at += len(best[1]) if best else 1
    return out


def in_lines(rng, sentence):
    """A sentence of several lines with comment marks, in another case."""
    sentence = sentence.replace("*", rng.choice(["Foo", "the University of X and others"]))
    for _ in range(rng.randint(0, 3)):
        sentence = sentence.replace(" ", "~", 1) if rng.random() < 0.5 else sentence[::-1].replace(" ", "~", 1)[::-1]
    return rng.choice([str.upper, str.lower, str])(sentence.replace("~", "\n * "))


def test_licenses_match_brute_force(spark):
    rng = random.Random(6)
    by_id = {}
    for name, s in licenses.SENTENCES:
        by_id.setdefault(name, []).append(s)
    noise = ["Plain words here", "é 漢字 x", "This license is another", "Licensed under", "1", "no warranty", "version 2", "neither the name of", "İstanbul"]
    texts = []
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(0, 5)):
            ids = rng.choice(licenses.RULES)[1]
            if rng.random() < 0.3:
                ids = ids[: rng.randint(1, len(ids))]
            for k in ids:
                parts.append(in_lines(rng, rng.choice(by_id[k])))
                if rng.random() < 0.15:
                    parts.append(rng.choice(noise))
            parts.append(rng.choice(noise))
        texts.append("".join(p + rng.choice([". ", "\n", ".\n", ": ", "; ", " ", '." ']) for p in parts))
    texts += [None, "", "Licensed under the Apache License, Version 2.0.1", "x" * 5000, "neither the name of " * 500]
    docs = spark.createDataFrame([*enumerate(texts), (None, "Released under the MIT License."), (None, "Released under the MIT License.")], "doc_id long, text string").repartition(3)
    rows = licenses.find(docs).collect()
    assert len(rows) == len(texts) + 2
    told = set()
    for r in rows:
        found = plain_sentences((texts[r.doc_id] if r.doc_id is not None else "Released under the MIT License.") or "")
        assert [tuple(s) for s in r.sentences] == found, r.doc_id
        assert [tuple(s) for s in r.licenses] == plain_licenses(found)
        told |= {s[0] for s in r.licenses}
    assert told == {name for name, _ in licenses.RULES}
    assert licenses.find(docs.limit(0)).count() == 0


def test_query_finds_a_licence_at_the_end_of_a_long_text(spark, tmp_path):
    rows = [(1, "Plain words. " * 40000 + "\nLicensed under CC BY-NC 4.0.\n"), (2, "Under a license of our own. Released under\n# the MIT License."), (3, "BSD"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.licenses, r.n_unknown) for r in QUERIES["op6_licenses"](spark, str(tmp_path)).collect()}
    assert got == {1: ("CC-BY-NC-4.0", 0), 2: ("MIT", 1), 3: ("", 0), 4: ("", 0)}
