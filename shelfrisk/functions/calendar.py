"""Calendar (date dimension) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_parts(d) -> list:
    """year, month, day, weekday name and weekend test of a DATE column."""
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    ]


def date_rows(spans: DataFrame, start_col: str, end_col: str, raw: bool = False) -> DataFrame:
    """One row per day of each [start, end] span (inclusive).

    ``raw=True`` gives the landing layout (``date`` as ISO text); otherwise the
    staged layout (``date_day`` DATE).
    """
    days = spans.select(F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias("d"))
    d = F.col("d")
    first = F.date_format(d, "yyyy-MM-dd").alias("date") if raw else d.alias("date_day")
    return days.select(first, *date_parts(d))
