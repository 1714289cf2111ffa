"""Numeric helpers shared by every money and score column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


BELOW_HALF = math.nextafter(0.5, 0)


def round_half_away(col: Column | str, scale: int) -> Column:
    """Round a double to ``scale`` decimals, ties away from zero.

    ``round(x, k)`` on a double rounds the shortest decimal text of ``x``;
    scaling to an integer first and dividing back gives the same result as a
    warehouse engine that rounds the binary value, which keeps the scores and
    flags stable across engines.

    ``floor`` and ``ceil`` are used, as ``round`` would print and parse every value as a decimal. With the largest double
    below a half instead of a half, exact halves still reach the next whole number and nothing below them does. From 2^52
    on a double has no fraction; NaN and infinities stay as they are. ``col`` is used several times: name it in a
    projection of its own if it is costly.
    """
    factor = 10 ** scale
    c = F.col(col) if isinstance(col, str) else col
    x, half = c.cast("double") * F.lit(factor), F.lit(BELOW_HALF)
    whole = F.when(x < 0, F.ceil(x - half)).otherwise(F.floor(x + half)).cast("double")
    return F.when(F.abs(x) < float(1 << 52), whole).otherwise(x) / F.lit(factor)


def exact_sum(col: Column | str, scale: int = 5) -> Column:
    """Order-independent sum of a double money column, returned as double.

    Summing doubles depends on the order rows meet in partial aggregates;
    summing a decimal does not. ``scale`` must cover the decimals of the inputs
    (money columns here are products of 2- and 3-decimal values: 5 suffice).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double")


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true, as BIGINT."""
    return F.count_if(cond).cast("bigint")
