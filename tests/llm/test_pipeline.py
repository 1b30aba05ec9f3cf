"""The corpus pipeline on a small fixture, stage by stage."""

import random

import pyarrow as pa
import pytest

import corpus_pipeline
from laketally.llm import decontamination, packing, quality
from laketally.llm import text as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _set string, _row int"


def prose(rng, n=120):
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Unlike prose, junk, copies, near copies, a leaked benchmark item, a secret, and odd rows."""
    rng = random.Random(7)
    path = tmp_path_factory.mktemp("corpus")
    good = [prose(rng) for _ in range(30)]
    junk = ["BUY NOW!!! " * 40 + f"{i} $$$ {i}" for i in range(20)]
    item = prose(rng, 40)
    near = good[0].split()
    near[60] = "changed"
    texts = {i: t for i, t in enumerate(good)} | {100 + i: t for i, t in enumerate(junk)}
    texts |= {200: good[1], 201: " ".join(near), 202: f"{good[2][:200]} {item} {prose(rng)}", 203: f"{prose(rng)} password = hunter2secret {prose(rng)}"}
    rows = [(i, t, "en", "s", len(t), "x", 1) for i, t in texts.items()]
    rows += [(300, None, None, None, None, None, None), (301, "", "en", "s", 0, "x", 1), rows[5]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
    scores = {r.doc_id: r.score for r in quality.score(spark.read.parquet(f"{folder}/documents.parquet"), quality.trained(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)).collect()}
    after = ids(kept["quality"])
    assert set(after) == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    assert not set(after) & set(range(100, 120)) and set(range(30)) <= set(after)
    alone = ids(kept["near_duplicates"])
    assert len(alone) == len(set(alone))
    assert len({1, 200} & set(alone)) == 1 and len({0, 201} & set(alone)) == 1
    assert set(range(2, 30)) <= set(alone) | {5} and 5 in alone
    clean = ids(kept["decontamination"])
    assert 202 not in clean and set(alone) - set(clean) == {202}
    masked = {r.doc_id: r.text for r in kept["secrets"].collect()}
    assert sorted(masked, key=str) == clean and "hunter2secret" not in masked[203]
    assert masked[7] == {r.doc_id: r.text for r in kept["decontamination"].collect()}[7]
    assert sorted(set(ids(kept["packing"])), key=str) == clean


def test_run_on_no_row_and_on_one(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, rows in (("none", docs.limit(0)), ("one", docs.where("doc_id = 3"))):
        path = tmp_path / name
        rows.write.parquet(f"{path}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{path}/{table}.parquet")
        assert sorted(set(ids(corpus_pipeline.run(spark, str(path))))) == ([] if name == "none" else [3])


def test_workers_keep_little_between_stages(spark):
    """What a stage leaves in a worker that later ones use again: tables of powers for small slices, few words."""

    class Taken:
        """Keeps the function that `clean` hands to mapInArrow."""

        def __init__(self, docs):
            self.schema, self.sparkSession = docs.schema, spark

        def mapInArrow(self, run, schema):
            self.run = run
            return self

    text = " ".join(f"word{i}" for i in range(20_000))
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "an item of more than five words")], "item_id long, text string")
    taken = decontamination.clean(Taken(docs), items)
    T._powers.clear()
    batch = pa.RecordBatch.from_arrays([pa.array(range(20), pa.int64()), pa.array([text] * 20)], ["doc_id", "text"])
    assert sum(part.num_rows for part in taken.run(iter([batch]))) == 20
    assert max(map(len, T._powers.values())) <= 2 * T.SMALL_BYTES
    assert packing.Encoder(packing.TOKENIZER, packing.SMALL_CACHE).cache < packing.Encoder(packing.TOKENIZER).cache
