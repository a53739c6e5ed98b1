"""Calendar parts and instants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_date_parts(df: DataFrame, date_col: str, *, year="YEAR", month="MONTH",
                    weekday="DAY_OF_WEEK") -> DataFrame:
    """Append year, month and day of week (Sunday = 1) of ``date_col``."""
    return df.withColumns({
        year: F.year(date_col),
        month: F.month(date_col),
        weekday: F.dayofweek(date_col),
    })


def utc_instant(col: str | Column) -> Column:
    """Read a zone-less timestamp as UTC, whatever the session zone is."""
    col = F.col(col) if isinstance(col, str) else col
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), col)
    return local.cast("timestamp")


def utc_text(col: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Format an instant in UTC, whatever the session zone is."""
    col = F.col(col) if isinstance(col, str) else col
    wall = F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz"))
    return F.date_format(wall, fmt)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Difference in minutes, both ends truncated to whole seconds."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)
