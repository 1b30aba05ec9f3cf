"""Functions on columns: none of them triggers a job or uses a UDF."""

from laketally.functions.batches import parse_batch_no
from laketally.functions.dates import (
    month_of_date,
    period_default_date,
    resolve_dates,
    resolve_named_date,
    storage_date,
)
from laketally.functions.paths import (
    has_placeholder,
    join_path,
    render_partition,
    render_path,
)
from laketally.functions.text import normalise_delimiter, text_row_count

__all__ = [
    "has_placeholder",
    "join_path",
    "month_of_date",
    "normalise_delimiter",
    "parse_batch_no",
    "period_default_date",
    "render_partition",
    "render_path",
    "resolve_dates",
    "resolve_named_date",
    "storage_date",
    "text_row_count",
]
