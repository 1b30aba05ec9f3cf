import gzip
import random

import pyarrow as pa
import pyarrow.orc as orc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from laketally.operators import counting
from laketally.plans.scratch import stored
from laketally.sources import list_files, scan_row_counts
from laketally.sources.listing import visible_files
from tests.rules import text_rows


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(data, bytes):
        path.write_bytes(data)
    elif path.suffix == ".orc":
        orc.write_table(pa.table({"x": range(data)}), path)
    else:
        pq.write_table(pa.table({"x": list(range(data))}), path)
    return str(path)


def roots_of(spark, *roots):
    rows = [(str(p), f, d) for p, f, d in roots]
    return spark.createDataFrame(rows, "hdfs_path string, format string, delimiter string")


def results(spark, *roots, **options):
    counts = stored(counting.count_files(roots_of(spark, *roots), **options), "counts")
    return {r["hdfs_path"]: r for r in counting.path_results(counts).collect()}


@pytest.fixture
def lake(tmp_path):
    t = tmp_path / "t"
    put(t / "a.parquet", 3)
    put(t / "dt=1" / "b b.parquet", 4)
    put(t / "dt=1" / "deep" / "er" / "c", 5)
    put(t / "_SUCCESS", b"")
    put(t / ".hidden.crc", b"x")
    put(t / "_k=1" / "d.parquet", 100)
    put(t / "dt=1" / ".stage" / "e.parquet", 100)
    return t


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_listing(spark, lake, levels):
    roots = spark.createDataFrame([(str(lake), 7), (str(lake / "dt=1"), 8)], "hdfs_path string, tag int")
    found = visible_files(list_files(roots, levels=levels, tasks=3)).collect()
    assert sorted((r["tag"], r["file"][len(str(lake)) :]) for r in found) == [
        (7, "/a.parquet"), (7, "/dt=1/b b.parquet"), (7, "/dt=1/deep/er/c"),
        (8, "/dt=1/b b.parquet"), (8, "/dt=1/deep/er/c"),
    ]
    assert all(r["size"] > 0 for r in found)


def test_counts_and_status(spark, lake, tmp_path):
    (tmp_path / "empty").mkdir()
    put(tmp_path / "mixed" / "good.orc", 6)
    put(tmp_path / "mixed" / "bad.orc", b"not an orc file")
    put(tmp_path / "mixed" / "zero.orc", b"")
    put(tmp_path / "broken" / "other.parquet", 9)
    put(tmp_path / "none" / "n.parquet", 0)
    put(tmp_path / "_root" / "r.parquet", 2)
    put(tmp_path / "_file.parquet", 2)
    r = results(
        spark,
        (lake, "PARQUET", None),
        (lake / "dt=1", "parquet", None),
        (tmp_path / "empty", "orc", None),
        (tmp_path / "mixed", "Orc", None),
        (tmp_path / "broken", "orc", None),
        (tmp_path / "none", "parquet", None),
        (tmp_path / "missing", "textfile", None),
        (tmp_path / "_root", "parquet", None),
        (tmp_path / "_file.parquet", "parquet", None),
        (tmp_path / "csv", "CSV", None),
        (lake / "a.parquet", "parquet", None),
    )
    got = {
        p[len(str(tmp_path)) :]: (x["row_count"], x["file_count"], x["success_file_count"], x["status"])
        for p, x in r.items()
    }
    assert got == {
        "/t": (12, 3, 3, "success"),
        "/t/dt=1": (9, 2, 2, "success"),
        "/empty": (0, 0, 0, "success"),
        "/mixed": (6, 3, 1, "partial"),
        "/broken": (0, 1, 0, "failed"),
        "/none": (0, 1, 1, "success"),
        "/missing": (-1, 0, 0, "failed"),
        "/_root": (2, 1, 1, "success"),
        "/_file.parquet": (0, 0, 0, "success"),
        "/csv": (-1, 0, 0, "failed"),
        "/t/a.parquet": (3, 1, 1, "success"),
    }
    mixed = r[str(tmp_path / "mixed")]
    assert mixed["total_size_bytes"] == (tmp_path / "mixed" / "good.orc").stat().st_size
    assert [e["file"].rsplit("/", 1)[1] for e in mixed["errors"]] == ["bad.orc", "zero.orc"]
    missing = r[str(tmp_path / "missing")]["errors"]
    assert [tuple(e) for e in missing] == [
        ("", f"Failed to access path: Path does not exist: {tmp_path}/missing")
    ]
    assert r[str(tmp_path / "csv")]["errors"][0]["error"] == (
        "Invalid format: csv. Supported formats: orc, parquet, textfile"
    )
    assert r[str(lake)]["errors"] is None


def test_unreadable_child_fails_the_path(spark, lake):
    put(lake / "bad.parquet", b"x")

    def opener(uri):
        from pyarrow.fs import LocalFileSystem

        if uri.endswith("dt=1"):
            raise PermissionError("denied")
        return LocalFileSystem(), uri, ""

    r = results(spark, (lake, "parquet", None), opener=opener)[str(lake)]
    assert (r["row_count"], r["file_count"], r["status"]) == (-1, 0, "failed")
    assert [tuple(e) for e in r["errors"]] == [("", "Failed to access path: denied")]


GOLDEN = [
    (b"", "\n", 0),
    (b"a\nb", "\n", 2),
    (b"a\nb\n", "\n", 2),
    (b"\n", "\n", 1),
    (b"a\n\n\nb", "\n", 4),
    (b"a\r\nb\r\n", "\n", 2),
    (b"a\rb", "\n", 1),
    (b"a\x01b", "\x01", 2),
    (b"a||b||c", "||", 3),
    (b"a||b||", "||", 2),
    (b"x", "||", 1),
    (b"aaa", "aa", 2),
    (b"aaaa", "aa", 3),
]


@pytest.mark.parametrize("split_bytes", [1, 2, 3, 1 << 20])
def test_text_golden(spark, tmp_path, split_bytes):
    roots = []
    for i, (data, delimiter, _) in enumerate(GOLDEN):
        put(tmp_path / str(i) / "f", data)
        roots.append((tmp_path / str(i), "textfile", delimiter))
    r = results(spark, *roots, split_bytes=split_bytes)
    got = [r[str(tmp_path / str(i))]["row_count"] for i in range(len(GOLDEN))]
    assert got == [rows for _, _, rows in GOLDEN]
    assert all(x["status"] == "success" for x in r.values())


@pytest.mark.parametrize("delimiter", ["\n", "ab", "aba", "é"])
def test_text_random_ranges(spark, tmp_path, monkeypatch, delimiter):
    rng = random.Random(11)
    d = delimiter.encode()
    want = {}
    for i in range(40):
        data = bytes(rng.choice(b"abx" + d) for _ in range(rng.randrange(60)))
        want[put(tmp_path / "t" / f"f{i}", data)] = text_rows(data, d)
    for split in (1, 5, 7, 64):
        counts = counting.count_files(
            roots_of(spark, (tmp_path / "t", "textfile", delimiter)), split_bytes=split
        ).filter("file is not null")
        assert {r["file"]: r["row_count"] for r in counts.collect()} == want


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_blocks_within_a_range(tmp_path, monkeypatch, block):
    from pyarrow.fs import LocalFileSystem

    monkeypatch.setattr(counting, "BLOCK_BYTES", block)
    data = b"aabaababaaab" * 3
    path = put(tmp_path / "f", data)
    for d in (b"a", b"aa", b"aba", b"baab"):
        rows = sum(
            counting.text_range_rows(LocalFileSystem(), path, len(data), at, 7, d)
            for at in range(0, len(data), 7)
        )
        assert rows == text_rows(data, d)


def test_empty_delimiter_is_a_file_error(spark, tmp_path):
    put(tmp_path / "t" / "f", b"abc")
    put(tmp_path / "t" / "none", b"")
    r = results(spark, (tmp_path / "t", "textfile", ""))[str(tmp_path / "t")]
    assert (r["status"], r["row_count"], r["success_file_count"]) == ("partial", 0, 1)


def test_compressed_text_counts_raw_bytes(spark, tmp_path):
    data = gzip.compress(b"a\nb\nc\n", mtime=0)
    put(tmp_path / "t" / "f.gz", data)
    r = results(spark, (tmp_path / "t", "textfile", None))[str(tmp_path / "t")]
    assert r["row_count"] == text_rows(data, b"\n")
    scanned = scan_row_counts(spark, [str(tmp_path / "t")], "textfile").collect()
    assert [x["row_count"] for x in scanned] == [3]


def test_scan_agrees_with_footers(spark, lake, tmp_path):
    put(tmp_path / "t.txt" / "one two.txt", b"a\nb\nc")
    for root, format in ((lake, "parquet"), (tmp_path / "t.txt", "textfile")):
        visible = {
            r["file"]: r["row_count"]
            for r in counting.count_files(roots_of(spark, (root, format, None))).collect()
            if r["file"]
        }
        scanned = {r["file"]: r["row_count"] for r in scan_row_counts(spark, [str(root)], format).collect()}
        # Spark's listing keeps directories named `_k=1`; the audit skips them.
        assert {f: n for f, n in scanned.items() if "/_k=1/" not in f} == visible


def test_same_path_once_per_format(spark, tmp_path):
    put(tmp_path / "t" / "f", b"a|b\nc")
    path = tmp_path / "t"
    counts = counting.count_files(
        roots_of(spark, (path, "textfile", "|"), (path, "TEXTFILE", "|"), (path, "textfile", "\\n"))
    )
    rows = counting.path_totals(counts).collect()
    assert {r["delimiter"]: r["row_count"] for r in rows} == {"|": 2, "\n": 2}


def test_many_errors_stay_whole(spark):
    files = spark.range(2500).select(
        F.lit("/p").alias("hdfs_path"), F.lit("orc").alias("format"), F.lit("\n").alias("delimiter"),
        F.format_string("f%05d", "id").alias("file"), F.lit(0).cast("bigint").alias("row_count"),
        F.lit(1).cast("bigint").alias("file_size"), F.lit("bad").alias("error"),
        F.lit(0).cast("bigint").alias("duration_ms"),
    )
    r = counting.path_results(files).first()
    assert (r["status"], r["file_count"]) == ("failed", 2500)
    assert [e["file"] for e in r["errors"]] == [f"f{i:05d}" for i in range(2500)]
    assert counting.path_errors(files).count() == 2500


def test_further_format(spark, tmp_path, monkeypatch):
    def fixed_width(fs, path):
        return fs.get_file_info(path).size // 4

    monkeypatch.setitem(counting.FILE_READERS, "fixed4", fixed_width)
    put(tmp_path / "t" / "f", b"aaaabbbbcccc")
    r = results(spark, (tmp_path / "t", "Fixed4", None))[str(tmp_path / "t")]
    assert (r["row_count"], r["status"]) == (3, "success")


@pytest.mark.parametrize("tasks", [3, 7])
def test_pieces_are_dealt_by_bytes(spark, tmp_path, monkeypatch, tasks):
    """Sizes 1 : 10^6: no task has more than twice the mean bytes, and every byte is in one piece."""
    monkeypatch.setattr(counting, "OPEN_BYTES", 0)
    sizes = {put(tmp_path / "t" / f"s{i}", b"x"): 1 for i in range(60)}
    sizes |= {put(tmp_path / "t" / f"big{i}", b"y" * (10**6 - i)): 10**6 - i for i in range(2)}
    listed = list_files(roots_of(spark, (tmp_path / "t", "textfile", "n")), tasks=4)
    listed = stored(listed.withColumn("row", F.monotonically_increasing_id()), "listing")
    pieces = counting.deal_pieces(listed, tasks, split_bytes=64 * 1024).select("file", "start", "length", F.spark_partition_id().alias("task")).collect()
    by_task, by_file = {}, {}
    for p in pieces:
        by_task[p.task] = by_task.get(p.task, 0) + p.length
        if p.file:
            by_file[p.file] = by_file.get(p.file, 0) + p.length
    assert by_file == sizes
    assert max(by_task.values()) <= 2 * sum(sizes.values()) / tasks and len(by_task) == tasks


class Opened:
    """Counts, over all tasks, which files are read; listing opens directories only."""

    def __init__(self, log):
        self.log = log

    def __call__(self, uri):
        from pyarrow.fs import LocalFileSystem

        if not uri.rsplit("/", 1)[1].startswith("t"):
            with open(self.log, "a") as f:
                f.write(uri + "\n")
        return LocalFileSystem(), uri, ""

    def files(self):
        import os

        found = sorted(open(self.log).read().split()) if os.path.exists(self.log) else []
        if found:
            os.truncate(self.log, 0)
        return [f.rsplit("/", 1)[1] for f in found]


def test_ledger_opens_changed_files_only(spark, tmp_path):
    t, ledger, opened = tmp_path / "t", str(tmp_path / "ledger"), Opened(str(tmp_path / "opened"))
    for i in range(4):
        put(t / f"f{i}.parquet", i + 1)
    put(t / "bad.parquet", b"x")

    def count():
        return results(spark, (t, "parquet", None), opener=opened, ledger=ledger)[str(t)]

    first = count()
    assert opened.files() == ["bad.parquet", "f0.parquet", "f1.parquet", "f2.parquet", "f3.parquet"]
    second = count()
    assert opened.files() == ["bad.parquet"]  # what could not be read is tried again
    drop = ("duration_ms",)
    assert {k: v for k, v in first.asDict().items() if k not in drop} == {k: v for k, v in second.asDict().items() if k not in drop}
    put(t / "f1.parquet", 50)
    (t / "f2.parquet").unlink()
    put(t / "f9.parquet", 7)
    put(t / "bad.parquet", 2)
    third = count()
    assert opened.files() == ["bad.parquet", "f1.parquet", "f9.parquet"]
    assert (third["row_count"], third["file_count"], third["status"]) == (1 + 50 + 4 + 7 + 2, 5, "success")
    # The same files as text are another count.
    put(tmp_path / "u" / "f", b"a|b\nc")
    rows = [results(spark, (tmp_path / "u", "textfile", d), ledger=ledger)[str(tmp_path / "u")]["row_count"] for d in ("|", "\n", "|")]
    assert rows == [2, 2, 2]


def test_error_classes(spark):
    texts = [
        ("f1", "Could not open '/a/b c/f1' at 17: bad magic 0xAF"), ("f2", 'Could not open "/x/f2" at 9: bad magic 0x1'),
        ("f3", "denied: hdfs://h:8020/a/f3, block 7"), ("f4", "denied: /a/f4, block 12"), ("f5", "denied: /a/f5"), ("f6", None),
    ]
    rows = [("/p", "orc", "n", f, 0, 1, e, 0) for f, e in texts] + [("/q", "orc", "n", None, 0, None, "gone", 0)]
    counts = spark.createDataFrame(rows, "hdfs_path string, format string, delimiter string, file string, row_count long, file_size long, error string, duration_ms long")
    classes = {(r.hdfs_path, r.error_class): (r.files, r.example.file, r.class_id) for r in counting.error_classes(counts).collect()}
    assert {k: v[:2] for k, v in classes.items()} == {
        ("/p", "Could not open ? at <n>: bad magic <n>"): (2, "f1"), ("/p", "denied: <path>, block <n>"): (2, "f3"),
        ("/p", "denied: <path>"): (1, "f5"), ("/q", "gone"): (1, ""),
    }
    linked = counting.classed_errors(counts).collect()
    assert len(linked) == counting.path_errors(counts).count() == sum(v[0] for v in classes.values())
    assert {r.class_id for r in linked} == {v[2] for v in classes.values()}
    told = {r.hdfs_path: [tuple(e) for e in r.errors] for r in counting.path_results(counts, by_class=True).collect()}
    assert told["/p"][0] == ("f1", "Could not open '/a/b c/f1' at 17: bad magic 0xAF (and 1 more like it)")
    assert len(told["/p"]) == 3 and told["/q"] == [("", "gone")]
