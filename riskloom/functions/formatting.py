"""Display formatting done as Column expressions (report/KPI tables)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(col: str | Column, decimals: int = 1) -> Column:
    """0.8645 → '86.5%' (value × 100, fixed decimals)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%.{decimals}f%%", c.cast("double") * F.lit(100.0))


def thousands_text(col: str | Column) -> Column:
    """253680 → '253,680'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_number(c.cast("bigint"), 0)
