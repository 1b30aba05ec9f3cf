"""Storage paths rendered from a base path and a partition template."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from laketally.functions._cols import col, is_set


def _fill(text: Column, name: str, value: Column) -> Column:
    """Replace `${name}` by a value, or by itself when the value is not set."""
    placeholder = F.lit("${%s}" % name)
    return F.replace(text, placeholder, F.coalesce(F.nullif(value, F.lit("")), placeholder))


def render_partition(template, data_date, data_month, data_hour) -> Column:
    """Fill `${data_date}`, `${data_month}` and `${data_hour}` in a template.

    Without a month the first six digits of the date serve. A placeholder
    without a value stays, so that the job can be reported.
    """
    day, month, hour = col(data_date), col(data_month), col(data_hour)
    of_day = F.when(F.length(day) >= 6, F.substring(day, 1, 6))
    month = F.coalesce(F.nullif(month, F.lit("")), of_day)
    text = _fill(col(template), "data_date", day)
    text = _fill(text, "data_month", month)
    return _fill(text, "data_hour", hour)


def join_path(base, suffix) -> Column:
    """Join two path parts with one slash; an empty side gives the other."""
    b, s = col(base), F.coalesce(col(suffix), F.lit(""))
    return F.when(s == "", b).otherwise(_joined(b, s))


def _joined(base: Column, suffix: Column) -> Column:
    """The join for a suffix that is not empty; mentions the suffix once, as
    Spark repeats whatever stands behind it."""
    has_base = is_set(base)
    head = F.when(has_base, F.concat(F.rtrim(base, F.lit("/")), F.lit("/"))).otherwise("")
    return F.concat(head, F.ltrim(suffix, F.when(has_base, "/").otherwise("")))


def render_path(base, template, data_date, data_month, data_hour) -> Column:
    """The path of one table partition; without a template the base as it is."""
    partition = render_partition(template, data_date, data_month, data_hour)
    return F.when(is_set(col(template)), _joined(col(base), partition)).otherwise(col(base))


def has_placeholder(path) -> Column:
    return F.contains(col(path), F.lit("${"))
