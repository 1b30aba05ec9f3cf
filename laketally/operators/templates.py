"""Template expansion: one schedule per combination of loop variables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laketally.sources.filesystems import default_parallelism

# Placeholders that are filled when a job is built.
RUNTIME_VARS = ("data_date", "data_month")

STRING_FIELDS = ("task_name", "interface_id", "platform_id", "partner_id", "period_type")


def zero_filled(value: Column, width: Column) -> Column:
    """Zero-fill to a width without cutting longer values; keeps a sign first."""
    digits = F.ltrim(value, F.lit("-"))
    sign = F.when(value.startswith("-"), "-").otherwise("")
    short = F.length(value) < width
    return F.when(
        short, F.concat(sign, F.lpad(digits, width - F.length(sign), F.lit("0")))
    ).otherwise(value)


def variable_values(variables: DataFrame) -> DataFrame:
    """The values of every variable as (var, type, values ARRAY<STRING>).

    A range includes its end and may be given as strings; a missing bound is 0
    and a missing step 1. A range that its step leads away from is empty.
    """
    start, end = (F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in ("start", "end"))
    step = F.coalesce(F.col("step").cast("bigint"), F.lit(1))
    pad = F.coalesce("pad", F.lit(0))
    kind = F.coalesce("type", F.lit("range"))
    reaches = ((step > 0) & (start <= end)) | ((step < 0) & (start >= end))
    numbers = F.when(reaches, F.sequence(start, end, F.when(reaches, step))).otherwise(
        F.array().cast("array<bigint>")
    )
    texts = F.transform(numbers, lambda v: zero_filled(v.cast("string"), pad))
    return variables.select(
        "var",
        kind.alias("type"),
        F.when(kind == "range", texts).when(kind == "enum", F.col("values")).alias("values"),
    )


def range_values(variables: DataFrame) -> DataFrame:
    """(var, ord, value) of the range variables."""
    return _exploded(variable_values(variables).filter("type = 'range'"))


def enum_values(variables: DataFrame) -> DataFrame:
    """(var, ord, value) of the enum variables."""
    return _exploded(variable_values(variables).filter("type = 'enum'"))


def _exploded(values: DataFrame) -> DataFrame:
    return values.select("var", F.posexplode("values").alias("ord", "value")).select(
        "var", F.col("ord").cast("bigint").alias("ord"), "value"
    )


def loop_vars(loop_var) -> Column:
    """The variables of a loop, `a & b`, trimmed; an empty array without one."""
    c = F.col(loop_var) if isinstance(loop_var, str) else loop_var
    names = F.transform(F.split(c, "&"), lambda v: F.trim(v))
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(names)


def template_violations(templates: DataFrame, variables: DataFrame) -> DataFrame:
    """Loop variables that cannot be expanded, as (ord, var, rule)."""
    used = templates.select("ord", F.explode(loop_vars("loop_var")).alias("var"))
    defined = variables.select(
        "var", F.coalesce("type", F.lit("range")).alias("type"), "step", "values"
    )
    checked = used.join(defined, "var", "left")
    rule = (
        F.when(F.col("var").isin(*RUNTIME_VARS), "runtime")
        .when(F.col("type").isNull(), "unknown")
        .when(F.col("type") == "computed", "computed")
        .when(~F.col("type").isin("range", "enum"), "unknown_type")
        .when(
            (F.col("type") == "enum") & (F.coalesce(F.size("values"), F.lit(0)) <= 0), "empty_enum"
        )
        .when((F.col("type") == "range") & (F.col("step").cast("bigint") == 0), "zero_step")
    )
    return checked.select("ord", "var", rule.alias("rule")).filter("rule IS NOT NULL")


def _value_lists(templates: DataFrame, variables: DataFrame) -> DataFrame:
    """(ord, lists): the values of a template's variables in loop order; none of
    a template that loops over an undefined variable."""
    looped = templates.select("ord", F.posexplode(loop_vars("loop_var")).alias("pos", "var"))
    values = variable_values(variables).select("var", "values").filter("values IS NOT NULL")
    return looped.join(values, "var").groupBy("ord").agg(
        F.array_sort(F.collect_list(F.struct("pos", "var", "values"))).alias("lists")
    )


def _combinations(templates: DataFrame, variables: DataFrame, block: int) -> DataFrame:
    """Templates with `combo` (number within the template) and `bound`.

    `bound` holds the (var, value) pairs of one combination, which follow from
    its number: a number in mixed radix, the last variable varying fastest.
    Ranges of `block` numbers are dealt to all tasks, so a template of any size
    is spread.
    """
    tasks = default_parallelism(templates.sparkSession)
    no_list = F.array().cast("array<struct<pos:int,var:string,values:array<string>>>")
    rows = templates.join(_value_lists(templates, variables), "ord", "left")
    rows = rows.withColumn("lists", F.coalesce("lists", no_list)).filter(
        F.size("lists") == F.size(loop_vars("loop_var"))
    )
    one = F.lit(1).cast("bigint")
    # How many combinations lie between two values of a variable, and all of them.
    strides = F.transform(
        "lists",
        lambda _, i: F.aggregate(
            F.slice("lists", i + 2, F.size("lists")), one, lambda n, x: n * F.size(x["values"])
        ),
    )
    total = F.aggregate("lists", one, lambda n, x: n * F.size(x["values"]))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("total") - 1, F.lit(block).cast("bigint"))
    blocks = (
        rows.withColumns({"strides": strides, "total": total})
        .filter("total > 0")
        .withColumn("start", F.explode(starts))
        .repartition(tasks, "ord", "start")
    )
    last = F.least(F.col("start") + block, F.col("total")) - 1
    combos = blocks.withColumn("combo", F.explode(F.sequence("start", last)))
    bound = F.zip_with(
        "lists",
        "strides",
        lambda x, stride: F.struct(
            x["var"].alias("var"),
            F.get(x["values"], F.floor(F.col("combo") / stride) % F.size(x["values"])).alias("value"),
        ),
    )
    return combos.withColumn("bound", bound)


def _substituted(text: Column) -> Column:
    """A string with every bound variable filled in; other placeholders stay."""
    return F.aggregate(
        "bound",
        text,
        lambda acc, b: F.replace(acc, F.concat(F.lit("${"), b["var"], F.lit("}")), b["value"]),
    )


def expand_templates(
    templates: DataFrame, variables: DataFrame, *, block=10_000
) -> DataFrame:
    """Schedules of all templates, with `ord` (of the template) and `combo`.

    Every string of a schedule and of its tables is filled in. A template
    without a loop gives one schedule. Check `template_violations` first: a
    loop over an undefined variable gives no rows here.
    """
    rows = _combinations(templates, variables, block)

    def filled(t):
        fields = templates.schema["tables"].dataType.elementType.fieldNames()
        return F.struct(*[_substituted(t[f]).alias(f) for f in fields])

    return rows.select(
        "ord",
        "combo",
        *[_substituted(F.col(c)).alias(c) for c in STRING_FIELDS],
        F.transform("tables", filled).alias("tables"),
    )


def as_schedules(expanded: DataFrame, groups: DataFrame) -> DataFrame:
    """Expanded templates with one running `ord`, ready to be joined."""
    starts = groups.select(F.col("ord"), "start_idx")
    return expanded.join(starts, "ord").select(
        (F.col("start_idx") + F.col("combo")).alias("ord"),
        *STRING_FIELDS,
        F.lit(None).cast("string").alias("loop_var"),
        "tables",
    )


def expansion_groups(templates: DataFrame, variables: DataFrame, *, block=10_000) -> DataFrame:
    """How many schedules each template gives and where they start.

    The running sum has two levels, blocks of templates and templates within a
    block, so no task sees all of them. `ord` is the template's position.
    """
    sizes = variable_values(variables).select("var", F.size("values").cast("bigint").alias("n"))
    # A template without a loop keeps one row without a variable; a variable
    # that is not defined has no values.
    factors = templates.select(
        "ord", "task_name", "loop_var", F.explode_outer(loop_vars("loop_var")).alias("var")
    ).join(sizes, "var", "left")
    factor = F.when(F.col("var").isNotNull(), F.coalesce("n", F.lit(0)))
    counts = (
        factors.groupBy("ord")
        .agg(
            F.first("task_name").alias("task_name"),
            F.first("loop_var").alias("loop_var"),
            F.collect_list(factor).alias("ns"),
        )
        .select(
            "ord",
            "task_name",
            "loop_var",
            F.aggregate("ns", F.lit(1).cast("bigint"), lambda a, n: a * n).alias("count"),
            F.floor(F.col("ord") / block).alias("block"),
        )
    )
    before = (
        counts.groupBy("block")
        .agg(F.sum("count").alias("total"))
        .withColumn("before", F.sum("total").over(Window.orderBy("block")) - F.col("total"))
    )
    within = Window.partitionBy("block").orderBy("ord")
    return counts.join(before, "block").select(
        "ord",
        "task_name",
        "loop_var",
        (F.col("before") + F.sum("count").over(within) - F.col("count")).alias("start_idx"),
        "count",
    )
