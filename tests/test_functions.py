import random

import pytest
from pyspark.sql import functions as F

from laketally import functions as lf
from laketally.functions.text import overlaps_itself
from tests.rules import batch_parts, text_rows


def parsed(spark, cases):
    rows = [(i, b, p) for i, (b, p) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, batch_no string, period_type string")
    out = lf.parse_batch_no(df).orderBy("i").collect()
    return [(r["data_date"], r["data_month"], r["data_hour"]) for r in out]


def test_batch_decision_table(spark):
    table = {
        ("2026010516", "hourly"): ("20260105", "202601", "16"),
        ("20260105", "daily"): ("20260105", "202601", None),
        ("202601", "monthly"): (None, "202601", None),
        ("2026010516", "daily"): ("20260105", "202601", None),
        ("20260105", "monthly"): (None, "202601", None),
        ("20260105", "hourly"): ("20260105", "202601", None),
        ("202601", "daily"): (None, "202601", None),
        ("2026010516", "minutely"): ("20260105", "202601", "16"),
        ("202601051630", "hourly"): ("20260105", "202601", "16"),
        ("2026-01-05", "daily"): ("20260105", "202601", None),
        ("2026010", "daily"): (None, None, None),
        ("202601051", "hourly"): (None, None, None),
        ("202601051", "daily"): ("20260105", "202601", None),
        ("20260", "monthly"): (None, None, None),
        ("99999999", "daily"): ("99999999", "999999", None),
        ("", "daily"): (None, None, None),
        (None, "daily"): (None, None, None),
        ("abc", "daily"): (None, None, None),
        ("20260105", None): ("20260105", "202601", None),
    }
    assert parsed(spark, table) == list(table.values())


def test_batch_random(spark):
    rng = random.Random(7)
    cases = [
        ("".join(rng.choice("0123456789-x ") for _ in range(rng.randrange(15))), period)
        for _ in range(400)
        for period in ["hourly", "daily", "monthly", "minutely", None]
    ]
    assert parsed(spark, cases) == [batch_parts(b, p) for b, p in cases]


def test_period_default(spark):
    rows = [(p,) for p in ["hourly", "minutely", "monthly", "daily", "weekly", None]]
    df = spark.createDataFrame(rows, "p string")
    got = [r[0] for r in df.select(lf.period_default_date("p", "2026-03-01")).collect()]
    assert got == ["20260301", "20260301", "20260228", "20260228", "20260228", "20260228"]


@pytest.mark.parametrize(
    "period, explicit, parts, expected",
    [
        ("monthly", "20260115", ("20260101", "202601", "05"), (None, "202601", None)),
        ("hourly", "20260115", ("20260101", "202601", "05"), ("20260115", "202601", None)),
        ("monthly", None, ("20260105", "202601", "07"), (None, "202601", "07")),
        ("monthly", None, (None, None, None), (None, "202602", None)),
        ("daily", None, ("20260105", "202601", None), ("20260105", "202601", None)),
        ("hourly", None, ("20260105", "202601", "07"), ("20260105", "202601", "07")),
        # The month of the default replaces a parsed month.
        ("daily", None, (None, "202512", None), ("20260309", "202603", None)),
        ("hourly", None, (None, None, None), ("20260310", "202603", None)),
    ],
)
def test_resolve_dates(spark, period, explicit, parts, expected):
    df = spark.createDataFrame(
        [(period, explicit, *parts)], "p string, e string, d string, m string, h string"
    )
    d = lf.resolve_dates("p", "2026-03-10", explicit="e", data_date="d", data_month="m", data_hour="h")
    assert tuple(df.select(d.alias("d")).select("d.*").first()) == expected


def test_named_dates(spark):
    names = ["${yesterday}", "${today}", None, "20240229", "20230229", "2024-01-01", "2024011"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = df.select(lf.resolve_named_date("n", "2024-03-01").alias("d")).select("d.*").collect()
    days = ["20240229", "20240301", "20240229", "20240229", None, None, None]
    assert [r["data_date"] for r in out] == days
    assert [r["error"] is None for r in out] == [d is not None for d in days]
    assert out[5]["error"] == "not a yyyyMMdd date: 2024-01-01"


@pytest.mark.parametrize(
    "base, template, expected",
    [
        ("/a/", "/x=${data_date}", "/a/x=20260105"),
        ("/a", "x=${data_month}/h=${data_hour}/", "/a/x=202601/h=07/"),
        ("/a//", "//x", "/a/x"),
        ("/a/", None, "/a/"),
        ("/a/", "", "/a/"),
        ("", "/x", "/x"),
        ("/a", "x=${other}", "/a/x=${other}"),
    ],
)
def test_render_path(spark, base, template, expected):
    df = spark.createDataFrame(
        [(base, template, "20260105", "202601", "07")],
        "b string, t string, d string, m string, h string",
    )
    assert df.select(lf.render_path("b", "t", "d", "m", "h")).first()[0] == expected


def test_unset_values_stay(spark):
    df = spark.createDataFrame(
        [("20260105", None, ""), (None, None, None), (None, "202512", None)],
        "d string, m string, h string",
    )
    template = F.lit("${data_date}/${data_month}/${data_hour}")
    got = [r[0] for r in df.select(lf.render_partition(template, "d", "m", "h")).collect()]
    assert got == [
        "20260105/202601/${data_hour}",
        "${data_date}/${data_month}/${data_hour}",
        "${data_date}/202512/${data_hour}",
    ]


def test_join_path_empty_sides(spark):
    df = spark.createDataFrame([("/a", ""), ("/a", None), (None, "b"), ("", "/b")], "b string, s string")
    assert [r[0] for r in df.select(lf.join_path("b", "s")).collect()] == ["/a", "/a", "b", "/b"]


@pytest.mark.parametrize("delimiter", ["\n", "|", "||", "aa", "aba", ".", "\x01"])
def test_text_rows_random(spark, delimiter):
    rng = random.Random(3)
    letters = delimiter + "xa"
    texts = ["", delimiter, delimiter * 4, "aaaa", "a\rb", "a\r\nb\r\n"] + [
        "".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(200)
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in df.select("i", lf.text_row_count("t", delimiter)).orderBy("i").collect()]
    assert got == [text_rows(t.encode(), delimiter.encode()) for t in texts]


def test_self_overlap():
    assert [overlaps_itself(d) for d in ["|", "||", "ab", "aba", "abab", "abc"]] == [
        False, True, False, True, True, False,
    ]
    assert overlaps_itself(b"aa") and not overlaps_itself(b"ab")


def test_delimiter(spark):
    df = spark.createDataFrame([("\\n",), (None,), ("\\t",), ("|",)], "d string")
    got = [r[0] for r in df.select(lf.normalise_delimiter("d")).collect()]
    assert got == ["\n", "\n", "\\t", "|"]
