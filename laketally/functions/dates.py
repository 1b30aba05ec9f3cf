"""Business-date rules. The run date is an argument, never the clock."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from laketally.functions._cols import col, is_set

DAY_FORMAT = "yyyyMMdd"


def as_date(run_date) -> Column:
    """A date column from a date, an ISO date string, a datetime or a column.
    The date of an instant is that of the session's zone."""
    if isinstance(run_date, (Column, dt.datetime)):
        return as_timestamp(run_date).cast("date")
    return F.lit(str(run_date)).cast("date")


def as_timestamp(value) -> Column:
    """A timestamp column, whole seconds, from a datetime or a column.

    A datetime with a zone is an instant (TIMESTAMP). One without is wall-clock
    time of the session's zone (TIMESTAMP_NTZ), never of the machine's.
    """
    if isinstance(value, Column):
        return value
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    type = "timestamp_ntz" if value.tzinfo is None else "timestamp"
    return F.lit(value.replace(microsecond=0).isoformat(sep=" ")).cast(type)


def storage_date(day) -> Column:
    """DATE of a yyyyMMdd string; NULL unless it is eight digits and a date."""
    c = col(day)
    return F.when(c.rlike(r"\A[0-9]{8}\z"), F.try_to_date(c, DAY_FORMAT))


def month_of_date(day) -> Column:
    """yyyyMM of a yyyyMMdd string; NULL when it is not a date."""
    return F.date_format(storage_date(day), "yyyyMM")


def period_default_date(period_type, run_date) -> Column:
    """The yyyyMMdd a period audits when nothing else names a date.

    hourly and minutely: the run date; monthly: the last day of the month
    before; daily and anything else: the day before.
    """
    period, today = col(period_type), as_date(run_date)
    # Formatted one by one, so that a literal run date folds to constants.
    return (
        F.when(period.isin("hourly", "minutely"), F.date_format(today, DAY_FORMAT))
        .when(period == "monthly", F.date_format(F.last_day(F.add_months(today, -1)), DAY_FORMAT))
        .otherwise(F.date_format(F.date_sub(today, 1), DAY_FORMAT))
    )


def resolve_named_date(name, run_date) -> Column:
    """Struct (data_date, error) of `${yesterday}`, `${today}` or a yyyyMMdd.

    NULL means `${yesterday}`. Anything that is not a date gives a NULL date
    and an error text, so one bad row does not fail the job.
    """
    c, today = F.coalesce(col(name), F.lit("${yesterday}")), as_date(run_date)
    day = (
        F.when(c == "${yesterday}", F.date_format(F.date_sub(today, 1), DAY_FORMAT))
        .when(c == "${today}", F.date_format(today, DAY_FORMAT))
        .when(storage_date(c).isNotNull(), c)
    )
    error = F.when(
        day.isNull(),
        F.concat(F.lit("not a yyyyMMdd date: "), c),
    )
    return F.struct(day.alias("data_date"), error.alias("error"))


def resolve_dates(
    period_type, run_date, *, explicit=None, data_date=None, data_month=None, data_hour=None
) -> Column:
    """Struct (data_date, data_month, data_hour) a job is audited for.

    An explicit date wins, then the parts parsed from the batch number, then
    the period default. Monthly jobs never carry a day. An explicit date
    carries no hour. When the day comes from the period default its month
    replaces a parsed one.
    """
    null = F.lit(None).cast("string")
    monthly = col(period_type) == "monthly"
    explicit = null if explicit is None else col(explicit)
    day = null if data_date is None else col(data_date)
    month = null if data_month is None else col(data_month)
    hour = null if data_hour is None else col(data_hour)

    default = period_default_date(period_type, run_date)
    default_month = F.substring(default, 1, 6)
    given, parsed = explicit.isNotNull(), is_set(day)

    return F.struct(
        F.when(monthly, null)
        .when(given, explicit)
        .when(parsed, day)
        .otherwise(default)
        .alias("data_date"),
        F.when(given, F.when(F.length(explicit) >= 6, F.substring(explicit, 1, 6)))
        .when(monthly, F.when(is_set(month), month).otherwise(default_month))
        .when(parsed, month)
        .otherwise(default_month)
        .alias("data_month"),
        F.when(~given, hour).alias("data_hour"),
    )
