"""Merkle manifests against a plain rebuild of every level."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from laketally.llm import merkle


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, pos):
    """(left, right) of each level."""
    found = []
    for level in tree[:-1]:
        run = pos // 3 * 3
        found.append(("".join(level[run:pos]), "".join(level[pos + 1 : run + 3])))
        pos //= 3
    return found


def plain(rows):
    """The contract, row by row."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: b"" if s is None else b"=" + s.encode())
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: ((r[0] is not None, r[0] or 0), bytes.fromhex(H(*map(field, r)))))
        trees[name] = levels([H(*map(field, r)) for r in groups[name]])
    top = levels([trees[n][-1][0] for n in names]) if names else []
    out = []
    for i, name in enumerate(names):
        for pos, r in enumerate(groups[name]):
            path = siblings(trees[name], pos) + siblings(top, i)
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = H(*map(field, (*r[:4], text)))
            for left, right in path:
                h = H(left, h, right)
            proof = H("".join(a + b for a, b in path))
            out.append((r[0], H(*map(field, r)), trees[name][-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "extra int, doc_id long, source string, lang string, n_chars long, text string, leaf string"


def write(spark, folder, rows):
    df = spark.createDataFrame([(1, *r, "x") for r in rows], SCHEMA)
    df.write.parquet(f"{folder}/documents.parquet")


def found(spark, folder):
    return sorted((tuple(r) for r in merkle.query(spark, str(folder)).collect()), key=str)


@pytest.mark.parametrize("depth", [1, 2])
def test_manifest_equals_plain(spark, tmp_path, depth, monkeypatch):
    """Several rounds of blocks, a hot group, nulls, repeated rows and ids, empty and long texts."""
    rng = random.Random(depth)
    rows = []
    for i in range(60):
        source = "hot" if i % 3 else rng.choice([None, "", "b", "é", "z\n", "\U0001f600"])
        text = rng.choice([None, "", "a\nb", "x" * 20_000, f"line {i}\n", "ä\U0001f600\n"])
        rows.append((i, source, rng.choice([None, "de"]), rng.choice([None, i]), text))
    rows += [(None, "hot", "en", 1, "no id\n"), (7, "hot", "en", 1, "same id"), rows[4], rows[4]]
    write(spark, tmp_path, rows)
    monkeypatch.setattr(merkle.trees, "__kwdefaults__", {"arity": 3, "depth": depth})
    monkeypatch.setattr(merkle.manifest, "__kwdefaults__", {"arity": 3, "depth": depth})
    assert found(spark, tmp_path) == plain(rows)


def test_production_depth(spark, tmp_path):
    rows = [(i, f"s{i % 4}", "en", 1, f"t\n{i}") for i in range(60)]
    write(spark, tmp_path, rows)
    assert found(spark, tmp_path) == plain(rows)


def test_single_row_and_empty_table(spark, tmp_path):
    rows = [(4, None, None, None, None)]
    write(spark, tmp_path / "one", rows)
    assert found(spark, tmp_path / "one") == plain(rows)
    write(spark, tmp_path / "none", [])
    assert found(spark, tmp_path / "none") == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 80])
def test_appended_tree(n):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    tree = merkle.Tree(3)
    for d in digests:
        tree.append(d)
    plain_levels = levels([d.hex() for d in digests])
    assert tree.finish(None).hex() == plain_levels[-1][0]
    for pos, witness in enumerate(tree.witnesses().to_pylist()):
        assert [(w["left"].hex(), w["right"].hex()) for w in witness] == siblings(plain_levels, pos)


def test_positions_are_spread_and_gapless(spark):
    df = spark.range(5000).select(F.lit("one").alias("g"), F.col("id").alias("k"))
    rows = merkle.numbered(df.repartition(7), "g", ["k"]).collect()
    assert all(r.pos == r.k and r.total == 5000 for r in rows)
