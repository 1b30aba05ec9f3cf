"""Row counts of delimited text."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from laketally.functions._cols import col


def normalise_delimiter(delimiter) -> Column:
    r"""The two characters `\n` become a newline; NULL means newline."""
    c = col(delimiter)
    return F.when(c.isNull() | (c == "\\n"), F.lit("\n")).otherwise(c)


def overlaps_itself(delimiter: str) -> bool:
    """True when a copy of the delimiter can start inside another one."""
    return any(delimiter[i:] == delimiter[:-i] for i in range(1, len(delimiter)))


def text_row_count(text, delimiter: str = "\n") -> Column:
    """Rows of a text: delimiters, plus one when it does not end with one.

    Every position where the delimiter starts counts, so `aa` occurs three
    times in `aaaa`. The empty text has no rows.
    """
    if not delimiter:
        raise ValueError("the delimiter must not be empty")
    c, d = col(text), F.lit(delimiter)
    if overlaps_itself(delimiter):
        found = F.regexp_count(c, F.lit(f"(?={re.escape(delimiter)})"))
    else:
        without = F.length(F.replace(c, d, F.lit("")))
        found = ((F.length(c) - without) / len(delimiter)).cast("bigint")
    open_end = F.when(F.endswith(c, d), 0).otherwise(1)
    return F.when(c == "", 0).otherwise(found + open_end).cast("bigint")
