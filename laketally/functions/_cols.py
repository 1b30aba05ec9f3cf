"""Small helpers shared by the column functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """A column from a column or a column name."""
    return F.col(c) if isinstance(c, str) else c


def is_set(c: Column) -> Column:
    """True when a string is neither NULL nor empty; never NULL."""
    return c.isNotNull() & (c != "")


def or_default(c, default: str) -> Column:
    """The string itself, or `default` when it is NULL or empty."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default))
