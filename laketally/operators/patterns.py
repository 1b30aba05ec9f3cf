"""Log names matched with configured names that carry date placeholders.

`P_${data_date}14` names the task `P_2026011914` of the log. A name's layout is
where its placeholders stand. Names of the log find layouts by equality of their
digit skeleton, every digit as `#` and a placeholder as that many of them; a
layout then rewrites the log's name into the configured one, so that schedules
are joined by equality again. A log name has one candidate per layout of its
skeleton, however many names share that layout.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketally.functions._cols import is_set
from laketally.functions.dates import storage_date

# The placeholders a name may carry, and their digits.
WIDTHS = {"data_date": 8, "data_month": 6, "data_hour": 2}

#: One character per digit of a placeholder while names are cut; control characters no task name has.
MARKS = {var: chr(i + 1) for i, var in enumerate(WIDTHS)}
_ANY_MARK = "".join(MARKS.values())


def _marked(name: Column) -> Column:
    for var, width in WIDTHS.items():
        name = F.replace(name, F.lit("${%s}" % var), F.lit(MARKS[var] * width))
    return name


def digit_skeleton(name) -> Column:
    """A name with every digit, and every digit a placeholder stands for, as `#`."""
    return F.regexp_replace(_marked(name if isinstance(name, Column) else F.col(name)), f"[0-9{_ANY_MARK}]", "#")


def name_layouts(schedules: DataFrame) -> DataFrame:
    """(skeleton, layouts) of the configured names with placeholders.

    A layout is an array of (start, length, var), var '' for fixed text. Equal
    layouts of a skeleton are one. Names with any other placeholder match no log
    name and have no layout.
    """
    marked = _marked(F.col("task_name"))
    runs = "|".join([*[f"{MARKS[v]}{{{w}}}" for v, w in WIDTHS.items()], f"[^{_ANY_MARK}]+"])
    var = F.lit("")
    for v, mark in MARKS.items():
        var = F.when(F.col("first") == mark, v).otherwise(var)
    names = schedules.select("task_name").distinct().where(F.rlike(marked, F.lit(f"[{_ANY_MARK}]")) & ~F.contains(marked, F.lit("${")))
    cut = names.select(
        digit_skeleton("task_name").alias("skeleton"), F.regexp_extract_all(marked, F.lit(f"(?s){runs}"), F.lit(0)).alias("runs")
    )
    # Only where placeholders stand tells layouts apart, not the text between.
    shapes = cut.select(
        "skeleton",
        F.transform("runs", lambda r: F.struct(F.char_length(r).alias("length"), F.when(F.rlike(r, F.lit(f"[{_ANY_MARK}]")), F.left(r, F.lit(1))).otherwise("").alias("mark"))).alias("runs"),
    ).distinct()
    kind = lambda m: F.coalesce(*[F.when(m == mark, v) for v, mark in MARKS.items()], F.lit(""))
    placed = F.transform(
        "runs",
        lambda r, i: F.struct(
            F.aggregate(F.slice("runs", F.lit(1), i), F.lit(1), lambda n, x: n + x["length"]).alias("start"),
            r["length"].alias("length"),
            kind(r["mark"]).alias("var"),
        ),
    )
    return shapes.select("skeleton", placed.alias("layout")).groupBy("skeleton").agg(F.array_sort(F.collect_list("layout")).alias("layouts"))


def _candidate(name: Column, layout: Column) -> Column:
    """(task_name, data_date, data_month, data_hour) a layout reads from a name; null unless its values are one date."""
    cut = lambda p: F.substring(name, p["start"], p["length"])
    text = F.array_join(
        F.transform(layout, lambda p: F.when(p["var"] == "", cut(p)).otherwise(F.concat(F.lit("${"), p["var"], F.lit("}")))), ""
    )

    def values(var):
        return F.array_distinct(F.transform(F.filter(layout, lambda p: p["var"] == var), cut))

    found = {v: values(v) for v in WIDTHS}
    one = {v: F.get(c, F.lit(0)) for v, c in found.items()}
    day, month, hour = (one[v] for v in WIDTHS)
    day_given, month_given, hour_given = (F.size(found[v]) > 0 for v in WIDTHS)
    fits = (
        (F.size(found["data_date"]) <= 1)
        & (F.size(found["data_month"]) <= 1)
        & (F.size(found["data_hour"]) <= 1)
        & (~day_given | storage_date(day).isNotNull())
        & (~month_given | storage_date(F.concat(month, F.lit("01"))).isNotNull())
        & (~hour_given | F.rlike(hour, F.lit("^([01][0-9]|2[0-3])$")))
        & (~day_given | ~month_given | (F.left(day, F.lit(6)) == month))
    )
    month = F.coalesce(month, F.left(day, F.lit(6)))
    parts = F.struct(text.alias("task_name"), day.alias("data_date"), month.alias("data_month"), hour.alias("data_hour"))
    return F.when(fits, parts)


def name_candidates(tasks: DataFrame, schedules: DataFrame) -> DataFrame:
    """The completed tasks under every configured name theirs can stand for.

    Each task keeps its row under its own name; a name with placeholders that
    fits adds one, and a name that fits two adds two. `log_name` is the name in
    the log. Date parts the batch lacks are filled from the name: its hour and
    month only when they belong to the task's own day and month. Names that no schedule has
    find no partner in the join that follows.
    """
    # By key, as schedules are joined: names of different text give as many layouts.
    layouts = name_layouts(schedules).hint("merge")
    keyed = tasks.withColumn("skeleton", digit_skeleton("task_name")).join(layouts, "skeleton", "left")
    no_part = F.lit(None).cast("string")
    own = F.struct("task_name", *[no_part.alias(v) for v in WIDTHS])
    fitting = F.filter(F.transform("layouts", lambda layout: _candidate(F.col("task_name"), layout)), lambda c: c.isNotNull())
    candidates = F.concat(F.array(own), F.coalesce(fitting, F.array().cast("array<struct<task_name:string,data_date:string,data_month:string,data_hour:string>>")))
    rows = keyed.select("*", F.explode(candidates).alias("c"))
    month = F.when(is_set(F.col("data_month")), F.col("data_month"))
    day = F.when(is_set(F.col("data_date")), F.col("data_date"))
    same_month = month.isNull() | (month == F.col("c.data_month"))
    new_day = F.coalesce(day, F.when(same_month, F.col("c.data_date")))
    same_day = F.col("c.data_date").isNull() | (new_day == F.col("c.data_date"))
    filled = {
        "data_date": new_day,
        "data_month": F.coalesce(month, F.col("c.data_month")),
        "data_hour": F.coalesce("data_hour", F.when(same_month & same_day, F.col("c.data_hour"))),
    }
    return rows.select(
        *[F.col("c.task_name").alias(c) if c == "task_name" else filled[c].alias(c) if c in filled else F.col(c) for c in tasks.columns],
        F.col("task_name").alias("log_name"),
    )
