"""Business date parts of a scheduler batch number."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketally.functions._cols import col


def digits_used(digits, period_type) -> Column:
    """How many leading digits of a batch number say when it is for.

    10: day and hour, 8: day, 6: month, 0: none. The period decides; when it
    does not fit the number of digits, that number alone decides.
    """
    n, period = F.length(col(digits)), col(period_type)
    return (
        F.when((period == "hourly") & (n >= 10), 10)
        .when((period == "daily") & (n >= 8), 8)
        .when((period == "monthly") & (n >= 6), 6)
        .when(n >= 10, 10)
        .when(n.isin(8, 6), n)
        .otherwise(0)
    )


def date_parts(digits, used) -> list[Column]:
    """The columns data_date, data_month and data_hour of a batch's digits."""
    digits, used = col(digits), col(used)
    return [
        F.when(used >= 8, F.substring(digits, 1, 8)).alias("data_date"),
        F.when(used >= 6, F.substring(digits, 1, 6)).alias("data_month"),
        F.when(used >= 10, F.substring(digits, 9, 2)).alias("data_hour"),
    ]


def parse_batch_no(tasks: DataFrame, *, batch_no="batch_no", period_type="period_type"):
    """Add data_date, data_month and data_hour, read from a batch number.

    Only its digits count, and they are not checked to be a calendar date. In
    three steps, so that the digits are taken out once per row.
    """
    kept = tasks.columns
    digits = tasks.withColumn("digits", F.regexp_replace(batch_no, r"\D", ""))
    used = digits.withColumn("used", digits_used("digits", period_type))
    return used.select(*kept, *date_parts("digits", "used"))
