"""Date text normalization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_short_date(text: Column) -> Column:
    """``M/D/YY`` text to a date; null when it is not one."""
    return F.try_to_date(text, "M/d/yy")
