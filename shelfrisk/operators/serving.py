"""Serving: enriched risk rows, KPIs, pivots, trends and ranked action lists.

Everything through the top-k stays in the Spark plan; only the final, small
result would be collected by a front end. Aggregates are single passes with
map-side combining (a hot category or region collapses before its shuffle);
top-k uses ``orderBy(...).limit(n)`` which plans as a per-partition
``TakeOrderedAndProject`` rather than a global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrisk.functions.numeric import count_where, exact_sum
from shelfrisk.sources.schemas import PIVOT_DIMENSIONS, RISK_COLUMNS, RISK_FLAGS

ACTION_COLUMNS = (
    "store_id", "store_name", "region", "product_id", "product_name", "category",
    "on_hand_qty", "days_remaining_shelf_life", "trailing_7d_sell_through",
    "spoilage_risk_score", "stockout_risk_score",
)
FLAG_METRIC = {
    "STOCKOUT": "stockout_lost_revenue_per_day",
    "SPOILAGE": "spoilage_cost_at_risk",
}


def newest_day(gold: DataFrame, date_col: str = "snapshot_date"):
    """The newest date as a Python value (one scalar; this reads the date
    column of every partition). Filtering with it as a literal
    lets the scan prune to that day's folder."""
    return gold.agg(F.max(date_col)).first()[0]


def stockout_lost_revenue(flag: Column, sell_through: Column, unit_price: Column) -> Column:
    return F.when(flag == "STOCKOUT", sell_through * unit_price).otherwise(F.lit(0.0))


def spoilage_cost_at_risk(flag: Column, score: Column, on_hand: Column, unit_cost: Column) -> Column:
    return F.when(flag == "SPOILAGE", score * on_hand * unit_cost).otherwise(F.lit(0.0))


def enriched_rows(gold: DataFrame, products: DataFrame, stores: DataFrame,
                  snapshot_date: str | None = None, ordered: bool = True) -> DataFrame:
    """Gold rows with product / store attributes and money at stake.

    ``snapshot_date`` keeps one day (all days when None). Left joins keep gold rows whose dims are missing.
    """
    g = gold
    if snapshot_date is not None:
        g = g.where(F.col("snapshot_date") == F.to_date(F.lit(str(snapshot_date))))
    p = products.select("product_id", "product_name", "category", "unit_price", "unit_cost")
    s = stores.select("store_id", "store_name", "region")
    rows = g.join(p, "product_id", "left").join(s, "store_id", "left")
    flag = F.col("risk_flag")
    rows = rows.withColumns({
        "stockout_lost_revenue_per_day": stockout_lost_revenue(
            flag, F.col("trailing_7d_sell_through"), F.col("unit_price")),
        "spoilage_cost_at_risk": spoilage_cost_at_risk(
            flag, F.col("spoilage_risk_score"), F.col("on_hand_qty"), F.col("unit_cost")),
    }).select(*RISK_COLUMNS)
    if ordered:
        rows = rows.orderBy(F.col("snapshot_date").desc(), F.col("risk_flag").desc(),
                            "store_id", "product_id")
    return rows


def slice_rows(rows: DataFrame, regions: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Keep rows in the selected regions and categories."""
    return rows.where(F.col("region").isin(list(regions)) & F.col("category").isin(list(categories)))


def kpis(rows: DataFrame) -> DataFrame:
    """One-row KPI summary; 0 % healthy and zero money on empty input."""
    total = F.count(F.lit(1))
    ok = count_where(F.col("risk_flag") == "OK")
    return rows.agg(
        total.alias("sku_days"),
        F.when(total > 0, ok / total * 100).otherwise(F.lit(0.0)).alias("ok_pct"),
        count_where(F.col("risk_flag") == "STOCKOUT").alias("stockout_count"),
        count_where(F.col("risk_flag") == "SPOILAGE").alias("spoilage_count"),
        F.coalesce(exact_sum("stockout_lost_revenue_per_day"), F.lit(0.0))
        .alias("stockout_lost_revenue_per_day"),
        F.coalesce(exact_sum("spoilage_cost_at_risk"), F.lit(0.0)).alias("spoilage_cost_at_risk"),
    )


def flags_by_dimension(rows: DataFrame, dimension: str) -> DataFrame:
    """Flag counts per value of a dashboard dimension, missing flags as 0."""
    if dimension not in PIVOT_DIMENSIONS:
        raise ValueError(f"flags can be counted by {', '.join(PIVOT_DIMENSIONS)}, not by {dimension!r}")
    counts = (
        rows.where(F.col(dimension).isNotNull())
        .groupBy(dimension).pivot("risk_flag", list(RISK_FLAGS)).agg(F.count("product_id"))
        .na.fill(0, list(RISK_FLAGS))
    )
    return counts.select(dimension, *[F.col(f).cast("bigint").alias(f) for f in RISK_FLAGS])


def flags_by_dimension_from_gold(gold: DataFrame, dim_table: DataFrame, key: str,
                                 dimension: str) -> DataFrame:
    """``flags_by_dimension`` over all gold rows, aggregating before the join.

    Flag counts are taken per dimension key first (map-side combined), so only
    (key, flag) rows meet the dimension table instead of every gold row.
    """
    if dimension not in PIVOT_DIMENSIONS:
        raise ValueError(f"flags can be counted by {', '.join(PIVOT_DIMENSIONS)}, not by {dimension!r}")
    per_key = gold.groupBy(key, "risk_flag").agg(F.count("product_id").alias("n"))
    labelled = per_key.join(dim_table.select(key, dimension), key, "left")
    counts = (
        labelled.where(F.col(dimension).isNotNull())
        .groupBy(dimension).pivot("risk_flag", list(RISK_FLAGS)).agg(F.sum("n"))
        .na.fill(0, list(RISK_FLAGS))
    )
    return counts.select(dimension, *[F.col(f).cast("bigint").alias(f) for f in RISK_FLAGS])


def kpis_from_gold(gold: DataFrame, products: DataFrame, scale: int = 5) -> DataFrame:
    """``kpis`` over all gold rows, aggregating per product before the join.

    Money at stake is price x sell-through (STOCKOUT) and cost x score x
    on-hand (SPOILAGE); summed as DECIMAL, the per-product factor comes out of
    the sum exactly, so one row per product meets the price list instead of
    every gold row. Same result as ``kpis(enriched_rows(...))``.
    """
    dec = f"decimal(38,{scale})"
    flag = F.col("risk_flag")
    per_product = gold.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(flag == "OK").alias("ok"),
        count_where(flag == "STOCKOUT").alias("stockout"),
        count_where(flag == "SPOILAGE").alias("spoilage"),
        F.sum(F.when(flag == "STOCKOUT", F.col("trailing_7d_sell_through")).cast(dec)).alias("st"),
        F.sum(F.when(flag == "SPOILAGE", F.col("spoilage_risk_score") * F.col("on_hand_qty"))
              .cast(dec)).alias("exposure"),
    )
    priced = per_product.join(products.select("product_id", "unit_price", "unit_cost"),
                              "product_id", "left")
    total = F.sum("rows")
    ok = F.sum("ok")
    lost = F.sum(F.col("st") * F.col("unit_price").cast(dec))
    spoil = F.sum(F.col("exposure") * F.col("unit_cost").cast(dec))
    return priced.agg(
        F.coalesce(total, F.lit(0)).cast("bigint").alias("sku_days"),
        F.when(total > 0, ok / total * 100).otherwise(F.lit(0.0)).alias("ok_pct"),
        F.coalesce(F.sum("stockout"), F.lit(0)).cast("bigint").alias("stockout_count"),
        F.coalesce(F.sum("spoilage"), F.lit(0)).cast("bigint").alias("spoilage_count"),
        F.coalesce(lost.cast(dec).cast("double"), F.lit(0.0)).alias("stockout_lost_revenue_per_day"),
        F.coalesce(spoil.cast(dec).cast("double"), F.lit(0.0)).alias("spoilage_cost_at_risk"),
    )


def top_risks(rows: DataFrame, flag: str, n: int = 25) -> DataFrame:
    """Prioritised action list: the n rows with the most money at stake."""
    if flag not in FLAG_METRIC:
        raise ValueError(f"only {' and '.join(FLAG_METRIC)} rows are ranked, not {flag!r}")
    metric = FLAG_METRIC[flag]
    return (
        rows.where(F.col("risk_flag") == flag)
        .orderBy(F.col(metric).desc(), "store_id", "product_id", F.col("snapshot_date").desc())
        .limit(n)
        .select(*ACTION_COLUMNS, metric)
    )


def daily_trend(gold: DataFrame) -> DataFrame:
    """Flag counts per day (dates as ISO text), ordered by day and flag."""
    return (
        gold.groupBy("snapshot_date", "risk_flag").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("snapshot_date", F.col("snapshot_date").cast("string"))  # of one row per day and flag
        .orderBy("snapshot_date", "risk_flag")
    )


def trend_pivot(trend: DataFrame, flags: Sequence[str] = ("STOCKOUT", "SPOILAGE")) -> DataFrame:
    """Days as rows, flags as columns, absent counts as 0."""
    return (
        trend.groupBy("snapshot_date").pivot("risk_flag", list(flags)).agg(F.first("n"))
        .na.fill(0, list(flags)).orderBy("snapshot_date")
    )


def available_dates(gold: DataFrame) -> DataFrame:
    """Distinct snapshot dates as ISO text, newest first."""
    return (gold.select(F.col("snapshot_date").cast("string").alias("snapshot_date"))
            .distinct().orderBy(F.col("snapshot_date").desc()))


def filter_values(rows: DataFrame, dimensions: Sequence[str] = ("region", "category")) -> DataFrame:
    """Sorted distinct values per filter dimension, as (dimension, value) rows."""
    parts = [rows.select(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
             .where(F.col("value").isNotNull()).distinct() for d in dimensions]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("dimension", "value")


def flag_distribution(gold: DataFrame) -> DataFrame:
    return gold.groupBy("risk_flag").agg(F.count(F.lit(1)).alias("n"))
