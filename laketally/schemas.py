"""Schemas shared by the sources, operators and sinks."""

from pyspark.sql import types as T

TABLE_ENTRY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("hdfs_path", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("partition_template", T.StringType()),
        T.StructField("delimiter", T.StringType()),
    ]
)

# `ord` is the position in the configuration: a DataFrame has no row order.
SCHEDULE = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("interface_id", T.StringType()),
        T.StructField("platform_id", T.StringType()),
        T.StructField("partner_id", T.StringType()),
        T.StructField("period_type", T.StringType()),
        T.StructField("loop_var", T.StringType()),
        T.StructField("tables", T.ArrayType(TABLE_ENTRY)),
    ]
)

TEMPLATE_VAR = T.StructType(
    [
        T.StructField("var", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("end", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("pad", T.IntegerType()),
        T.StructField("values", T.ArrayType(T.StringType())),
    ]
)

TASK_LOG = T.StructType(
    [
        T.StructField("task_name", T.StringType()),
        T.StructField("period_type", T.StringType()),
        T.StructField("batch_no", T.StringType()),
        T.StructField("state", T.IntegerType()),
        T.StructField("complete_dt", T.TimestampType()),
    ]
)

FILE_ERROR = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("error", T.StringType())]
)

COUNT_RESULT = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("file_count", T.LongType()),
        T.StructField("success_file_count", T.LongType()),
        T.StructField("total_size_bytes", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("errors", T.ArrayType(FILE_ERROR)),
    ]
)

AUDIT_RESULT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("interface_id", T.StringType()),
        T.StructField("platform_id", T.StringType()),
        T.StructField("partner_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("hdfs_path", T.StringType()),
        T.StructField("period_type", T.StringType()),
        T.StructField("batch_no", T.StringType()),
        T.StructField("data_date", T.DateType()),
        T.StructField("data_month", T.StringType()),
        T.StructField("data_hour", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("file_count", T.LongType()),
        T.StructField("total_size_bytes", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("last_end_time", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)
