import itertools

import pytest
from pyspark.sql import functions as F

from laketally import sources
from laketally.operators import templates
from laketally.schemas import TEMPLATE_VAR
from laketally.sources import schedules_from_dicts

PROV = ("prov", "range", "10100", "13100", "100", None, None)
HOUR = ("hour", "range", "0", "23", "1", 2, None)


def variables(spark, *rows):
    return spark.createDataFrame(list(rows), TEMPLATE_VAR)


def table(**fields):
    return {"name": "ods.t", "hdfs_path": "/lake/t", "format": "orc", **fields}


def shipped(spark):
    """Two daily templates, one monthly without a loop, one hourly."""
    daily = table(partition_template="ymd=${data_date}/prov=${prov}")
    hourly = table(partition_template="ymdh=${data_date}${hour}/prov=${prov}/")
    return schedules_from_dicts(
        spark,
        [
            {"task_name": "D1_${prov}", "platform_id": "${prov}", "loop_var": "prov", "tables": [daily]},
            {"task_name": "M1", "period_type": "monthly", "tables": [table()]},
            {"task_name": "${prov}_D2", "platform_id": "${prov}", "loop_var": "prov", "tables": [daily]},
            {
                "task_name": "${prov}_H_${data_date}${hour}",
                "platform_id": "${prov}",
                "loop_var": "prov&hour",
                "tables": [hourly],
            },
        ],
    )


def test_807(spark):
    t, v = shipped(spark), variables(spark, PROV, HOUR)
    groups = templates.expansion_groups(t, v).orderBy("ord")
    assert [(r["start_idx"], r["count"]) for r in groups.collect()] == [
        (0, 31), (31, 1), (32, 31), (63, 744),
    ]
    rows = templates.as_schedules(templates.expand_templates(t, v), groups).orderBy("ord").collect()
    assert [r["ord"] for r in rows] == list(range(807))
    first_last = [rows[i]["task_name"] for i in (0, 30, 31, 32, 62, 63, 64, 806)]
    assert first_last == [
        "D1_10100", "D1_13100", "M1", "10100_D2", "13100_D2",
        "10100_H_${data_date}00", "10100_H_${data_date}01", "13100_H_${data_date}23",
    ]
    assert rows[806]["platform_id"] == "13100"
    assert rows[806]["tables"][0]["partition_template"] == "ymdh=${data_date}23/prov=13100/"
    assert rows[31]["tables"][0]["partition_template"] is None


@pytest.mark.parametrize("suffix", ["yml", "json"])
def test_template_file(spark, tmp_path, suffix):
    if suffix == "yml":
        pytest.importorskip("yaml")
    f = tmp_path / f"template.{suffix}"
    # JSON is YAML as well.
    f.write_text(
        """{"template_vars": {
              "prov": {"type": "range", "start": 10100, "end": 13100, "step": 100, "description": "x"},
              "hour": {"type": "range", "start": "0", "end": "23", "step": 1, "pad": 2},
              "name": {"type": "enum", "values": ["a", 7]},
              "month": {"type": "computed", "rule": "month"}},
            "schedules": [
              {"task_name": "${prov}_${hour}_${name}", "loop_var": "prov&hour&name", "tables": []},
              {"task_name": "m", "loop_var": "month", "tables": []}]}"""
    )
    t, v = sources.read_templates(spark, str(f))
    rows = templates.expand_templates(t, v).orderBy("combo").collect()
    assert len(rows) == 31 * 24 * 2
    assert [rows[i]["task_name"] for i in (0, 1, 2, -1)] == [
        "10100_00_a", "10100_00_7", "10100_01_a", "13100_23_7",
    ]
    assert [r["rule"] for r in templates.template_violations(t, v).collect()] == ["computed"]


def test_last_variable_varies_fastest(spark):
    v = variables(
        spark,
        ("a", "enum", None, None, None, None, ["x", "y"]),
        ("b", "range", "1", "3", None, None, None),
        ("c", None, "8", "9", None, 3, None),
    )
    t = schedules_from_dicts(
        spark, [{"task_name": "${a}-${b}-${c}", "loop_var": " a&b & c", "tables": [table()]}]
    )
    rows = templates.expand_templates(t, v).orderBy("combo").collect()
    want = ["-".join(p) for p in itertools.product("xy", "123", ["008", "009"])]
    assert [r["task_name"] for r in rows] == want
    assert [r["combo"] for r in rows] == list(range(12))


def test_group_blocks_do_not_matter(spark):
    t, v = shipped(spark), variables(spark, PROV, HOUR)
    want = templates.expansion_groups(t, v).orderBy("ord").collect()
    for block in (1, 2, 3):
        assert templates.expansion_groups(t, v, block=block).orderBy("ord").collect() == want


@pytest.mark.parametrize(
    "start, end, step, pad, want",
    [
        ("0", "3", "1", 0, ["0", "1", "2", "3"]),
        ("8", "11", "1", 2, ["08", "09", "10", "11"]),
        ("98", "101", None, 2, ["98", "99", "100", "101"]),
        ("5", "1", "-1", 0, ["5", "4", "3", "2", "1"]),
        ("5", "1", "1", 0, []),
        ("1", "5", "-1", 0, []),
        ("1", "10", "4", 0, ["1", "5", "9"]),
        ("-2", "1", "1", 3, ["-02", "-01", "000", "001"]),
        (None, None, None, None, ["0"]),
    ],
)
def test_ranges(spark, start, end, step, pad, want):
    v = variables(spark, ("v", "range", start, end, step, pad, None))
    rows = templates.range_values(v).orderBy("ord").collect()
    assert [r["value"] for r in rows] == want


def test_violations(spark):
    v = variables(
        spark,
        PROV,
        ("month", "computed", None, None, None, None, None),
        ("none", "enum", None, None, None, None, []),
        ("odd", "list", None, None, None, None, None),
        ("still", "range", "0", "5", "0", None, None),
        ("data_date", "enum", None, None, None, None, ["x"]),
    )
    loops = ["prov", "ghost", "month&prov", "none", "odd", "still", "data_date", "", None]
    t = spark.createDataFrame(list(enumerate(loops)), "ord long, loop_var string")
    found = templates.template_violations(t, v).collect()
    assert sorted((r["ord"], r["var"], r["rule"]) for r in found) == [
        (1, "ghost", "unknown"),
        (2, "month", "computed"),
        (3, "none", "empty_enum"),
        (4, "odd", "unknown_type"),
        (5, "still", "zero_step"),
        (6, "data_date", "runtime"),
    ]


def test_one_large_template_is_spread(spark):
    """A million combinations of one template, in equal shares over all tasks, each from its number."""
    v = variables(spark, ("a", "range", "0", "99", "1", 2, None), ("b", "range", "0", "99", "1", 2, None), ("c", "enum", None, None, None, None, [f"x{i}" for i in range(100)]))
    t = schedules_from_dicts(spark, [{"task_name": "${a}_${b}_${c}", "loop_var": "a & b & c", "tables": [table()]}])
    rows = templates.expand_templates(t, v).select("combo", "task_name", F.spark_partition_id().alias("task"))
    shares = [r["count"] for r in rows.groupBy("task").count().collect()]
    assert sum(shares) == 10**6 and len(shares) >= 6 and max(shares) < 10**6 / 3
    wrong = rows.where(
        "task_name <> concat_ws('_', lpad(combo div 10000, 2, '0'), lpad(combo div 100 % 100, 2, '0'), concat('x', combo % 100))"
    )
    assert wrong.count() == 0 and rows.select("combo").distinct().count() == 10**6


@pytest.mark.parametrize("block", [1, 3, 10_000])
def test_any_block_gives_the_product(spark, block):
    v = variables(spark, ("a", "range", "1", "3", "1", None, None), ("b", "enum", None, None, None, None, ["p", "q"]), ("e", "range", "1", "0", "1", None, None))
    t = schedules_from_dicts(spark, [
        {"task_name": "n", "tables": [table()]}, {"task_name": "${b}${a}${b}", "loop_var": "b&a", "tables": [table()]},
        {"task_name": "${a}${e}", "loop_var": "a&e", "tables": [table()]}, {"task_name": "${a}", "loop_var": "a&ghost", "tables": [table()]},
    ])
    rows = templates.expand_templates(t, v, block=block).orderBy("ord", "combo").collect()
    assert [(r.ord, r.combo, r.task_name) for r in rows] == [(0, 0, "n")] + [
        (1, i, f"{b}{a}{b}") for i, (b, a) in enumerate(itertools.product("pq", "123"))
    ]
