"""Dense daily spine and trailing sell-through.

Partitioning: stored facts are bucketed by product_id and cross no network at all; others
are hash-partitioned once on ``partition_col`` (product_id by default). With ``spark.sql.requireAllClusterKeysForCoPartition``
off (see ``session.configure``) the left join on (store, product, date) and the
window over (store, product) both reuse that partitioning, so the dense
spine crosses the network once. A product's rows are bounded by
stores x days, so no partition outgrows a task even for the busiest product.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from shelfrisk.sources.schemas import SELL_THROUGH_WINDOW_DAYS

KEYS = ("product_id", "store_id")


def densify(df: DataFrame, keys: Sequence[str], date_col: str, fill: dict[str, object],
            start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Give every key series one row per day, filling missing days with ``fill``.

    With ``start``/``end`` every key spans that calendar; without them each key
    spans its own first .. last day (gaps inside a series are filled, nothing is
    invented outside it). The spine is built per key with ``sequence`` and
    joined back on (keys, date): no cross join, no driver round trip.
    """
    keys = list(keys)
    if start is not None and end is not None:
        spans = df.select(*keys).distinct().select(
            *keys, F.lit(start).alias("_d0"), F.lit(end).alias("_d1"))
    else:
        spans = df.groupBy(*keys).agg(F.min(date_col).alias("_d0"), F.max(date_col).alias("_d1"))
    spine = spans.select(*keys, F.explode(F.sequence("_d0", "_d1")).alias(date_col))
    filled = spine.join(df, keys + [date_col], "left")
    value_cols = [c for c in df.columns if c not in keys and c != date_col]
    return filled.select(
        *keys, date_col,
        *[(F.coalesce(F.col(c), F.lit(fill[c])) if c in fill else F.col(c)).alias(c)
          for c in value_cols],
    )


def dense_sales(inventory: DataFrame, sales: DataFrame, keys: Sequence[str] = KEYS,
                date_col: str = "snapshot_date", sale_date_col: str = "sale_date",
                units_col: str = "units_sold", partition_col: str | None = "product_id") -> DataFrame:
    """Left-join daily units onto the dense inventory spine; no sale -> 0.

    ``partition_col=None`` is for facts that are stored bucketed by a key: they are merged as they lie, and the
    merge's order by (keys, day) is the one that a window over the series needs.
    """
    keys = list(keys)
    s = sales.select(*keys, F.col(sale_date_col).alias(date_col), F.col(units_col).alias("_units"))
    inv = inventory
    if partition_col:
        inv, s = inv.repartition(partition_col), s.repartition(partition_col)
    else:
        s = s.hint("merge")
    joined = inv.join(s, keys + [date_col], "left")
    return joined.select(
        *[F.col(c) for c in inventory.columns],
        F.coalesce(F.col("_units"), F.lit(0)).alias(units_col),
    )


def sell_through(inventory: DataFrame, sales: DataFrame,
                 window_days: int = SELL_THROUGH_WINDOW_DAYS, keys: Sequence[str] = KEYS,
                 date_col: str = "snapshot_date", sale_date_col: str = "sale_date",
                 units_col: str = "units_sold", partition_col: str | None = "product_id",
                 out_col: str = "trailing_avg_daily_sell_through") -> DataFrame:
    """Trailing mean of daily units over the last ``window_days`` rows of a series.

    A ROWS frame means "days" only on a dense spine, which is why sales are
    joined onto the inventory snapshot rather than averaged on their own.

    A sliding frame adds up all its rows anew for every row. Whole units are therefore totalled from the series' start,
    up to the row and up to the one that left the frame: two sums that grow by one row each, whose difference is exact.
    """
    if window_days < 1:
        raise ValueError("window_days must be >= 1")
    dense = dense_sales(inventory, sales, keys, date_col, sale_date_col, units_col, partition_col)
    series = Window.partitionBy(*keys).orderBy(date_col)
    if not isinstance(dense.schema[units_col].dataType, IntegerType):
        return dense.withColumn(out_col, F.avg(units_col).over(series.rowsBetween(-(window_days - 1), 0)))
    left = F.sum(units_col).over(series.rowsBetween(Window.unboundedPreceding, -window_days))
    total = F.sum(units_col).over(series.rowsBetween(Window.unboundedPreceding, 0)) - F.coalesce(left, F.lit(0))
    days = F.least(F.row_number().over(series), F.lit(window_days))
    return dense.withColumn(out_col, total.cast("double") / days)
