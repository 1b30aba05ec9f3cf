"""Schedules: which tables a task writes and where."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from laketally.schemas import SCHEDULE, TEMPLATE_VAR
from laketally.sources.filesystems import in_batches


def _typed(rows: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Typed columns of JSON bodies; absent fields are NULL, numbers strings."""
    parsed = rows.select(key, F.from_json("body", schema).alias("s"))
    return parsed.select(key, *[f"s.{f.name}" for f in schema.fields if f.name != key])


def schedules_from_dicts(spark: SparkSession, schedules) -> DataFrame:
    """Schedules given as the nested dicts of a configuration."""
    rows = [(i, json.dumps(s, ensure_ascii=False)) for i, s in enumerate(schedules)]
    return _typed(spark.createDataFrame(rows, "ord bigint, body string"), SCHEDULE, "ord")


def variables_from_dicts(spark: SparkSession, variables) -> DataFrame:
    """Template variables given as the {name: definition} of a configuration."""
    rows = [(name, json.dumps(v, ensure_ascii=False)) for name, v in variables.items()]
    return _typed(spark.createDataFrame(rows, "var string, body string"), TEMPLATE_VAR, "var")


CONFIG_ROW = T.StructType(
    [
        T.StructField("section", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("var", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


def _config_rows(spark: SparkSession, path: str) -> DataFrame:
    """The schedules and variables of a YAML or JSON file, a row each.

    The file is parsed in the task that reads it; YAML needs PyYAML there.
    """
    is_yaml, schema = path.endswith((".yml", ".yaml")), to_arrow_schema(CONFIG_ROW)

    def parse(text):
        if not is_yaml:
            return json.loads(text)
        import yaml

        return yaml.safe_load(text) or {}

    def rows(text):
        config = parse(text)
        if "schedules" not in config:
            raise ValueError(f"{path} has no schedules")
        for i, schedule in enumerate(config["schedules"]):
            body = json.dumps(schedule, ensure_ascii=False)
            yield {"section": "schedule", "ord": i, "body": body}
        for var, definition in (config.get("template_vars") or {}).items():
            body = json.dumps(definition, ensure_ascii=False)
            yield {"section": "variable", "var": var, "body": body}

    def run(batches):
        texts = (text for batch in batches for text in batch.column(0).to_pylist())
        yield from in_batches((row for text in texts for row in rows(text)), schema)

    return spark.read.text(path, wholetext=True).mapInArrow(run, CONFIG_ROW)


def read_schedules(spark: SparkSession, path: str) -> DataFrame:
    """Schedules from one YAML file or from any number of JSON lines, which
    carry an `ord` field."""
    if path.endswith((".yml", ".yaml")):
        return read_templates(spark, path)[0]
    return spark.read.schema(SCHEDULE).json(path)


def read_templates(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(templates, variables) of one YAML or JSON template file."""
    rows = _config_rows(spark, path)
    return (
        _typed(rows.filter("section = 'schedule'"), SCHEDULE, "ord"),
        _typed(rows.filter("section = 'variable'"), TEMPLATE_VAR, "var"),
    )


def schedule_tables(schedules: DataFrame) -> DataFrame:
    """One row per schedule and table; ids default to '' and period to daily."""
    flat = schedules.select(
        "ord",
        "task_name",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("interface_id", "platform_id", "partner_id")],
        F.coalesce("period_type", F.lit("daily")).alias("period_type"),
        F.posexplode("tables").alias("table_ord", "t"),
    )
    return flat.select(
        "ord",
        F.col("table_ord").cast("bigint").alias("table_ord"),
        "task_name",
        "interface_id",
        "platform_id",
        "partner_id",
        "period_type",
        F.col("t.name").alias("table_name"),
        F.col("t.hdfs_path").alias("base_path"),
        F.lower("t.format").alias("format"),
        F.col("t.partition_template").alias("partition_template"),
        F.coalesce("t.delimiter", F.lit("\\n")).alias("delimiter"),
    )


def config_violations(schedules: DataFrame) -> DataFrame:
    """Every missing required field as (rule, ord, task_name, table_ord, field)."""
    no_table = F.lit(None).cast("bigint")

    def missing(rule, field):
        return schedules.filter(F.col(field).isNull()).select(
            F.lit(rule).alias("rule"),
            "ord",
            "task_name",
            no_table.alias("table_ord"),
            F.lit(field).alias("field"),
        )

    entries = schedules.select("ord", "task_name", F.posexplode("tables").alias("table_ord", "t"))
    required = F.array(
        *[F.when(F.col(f"t.{f}").isNull(), F.lit(f)) for f in ("name", "hdfs_path", "format")]
    )
    in_tables = entries.select(
        F.lit("table_field").alias("rule"),
        "ord",
        "task_name",
        F.col("table_ord").cast("bigint").alias("table_ord"),
        F.explode(F.array_compact(required)).alias("field"),
    )
    return (
        missing("schedule_task_name", "task_name")
        .unionByName(missing("schedule_tables", "tables"))
        .unionByName(in_tables)
    )


def validate(schedules: DataFrame) -> None:
    """Raise ValueError when a required field is missing."""
    found = config_violations(schedules).limit(5).collect()
    if found:
        texts = [f"schedule {r['ord']} ({r['task_name']}): {r['field']}" for r in found]
        raise ValueError("required fields are missing: " + "; ".join(texts))


def all_task_names(schedules: DataFrame) -> DataFrame:
    """Configured task names in configuration order, duplicates kept."""
    return schedules.select("ord", "task_name").orderBy("ord")


def schedule_by_task(schedules: DataFrame, task_name: str) -> DataFrame:
    """The first schedule of that name, or no row."""
    return schedules.filter(F.col("task_name") == task_name).orderBy("ord").limit(1)
