"""Inventory insights: signal summary, ageing stock, spoilage by category."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.functions.numeric import count_where, exact_sum


def signal_summary(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """One row: window bounds and the failure-mode signals of the snapshot.

    Both inputs are reduced to one row each before they meet.
    """
    inv = inventory.agg(
        F.min("snapshot_date").alias("window_start"),
        F.max("snapshot_date").alias("window_end"),
        count_where(F.col("on_hand_qty") == 0).alias("zero_on_hand_rows"),
        count_where(F.col("unmet_demand") > 0).alias("unmet_demand_rows"),
        count_where(F.col("spoiled_qty") > 0).alias("spoilage_rows"),
        F.coalesce(F.sum("spoiled_qty"), F.lit(0)).cast("bigint").alias("spoiled_units"),
    )
    rev = sales.agg(F.coalesce(exact_sum("revenue"), F.lit(0.0)).alias("total_revenue"))
    # Both sides are single rows; they meet on a constant key (a bounded broadcast).
    one = F.lit(1).alias("_one")
    both = inv.select(one, "*").join(F.broadcast(rev.select(one, "*")), "_one", "left").drop("_one")
    return both.withColumn(
        "both_failure_modes",
        (F.col("zero_on_hand_rows") > 0) & (F.col("spoilage_rows") > 0))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table, stacked into one (table_name, row_count) frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def aging_stock(inventory: DataFrame, min_age: int = 3, n: int = 5) -> DataFrame:
    """The n oldest batches still on the shelf (ties broken by key and date)."""
    return (
        inventory.where((F.col("on_hand_qty") > 0) & (F.col("oldest_batch_age_days") >= min_age))
        .orderBy(F.col("oldest_batch_age_days").desc(), "store_id", "product_id",
                 F.col("snapshot_date").desc())
        .limit(n)
        .select("store_id", "product_id", "snapshot_date", "on_hand_qty", "oldest_batch_age_days")
    )


def spoilage_by_category(inventory: DataFrame, products: DataFrame,
                         shelf_life: DataFrame) -> DataFrame:
    """Spoiled vs received units and mean current shelf life per category.

    rate = spoiled / max(received, 1); shelf is the mean over snapshot rows
    (products without a current shelf life are left out, as in an inner
    join). The snapshot is summed per product before it meets the product
    attributes, so one row per product is joined instead of every snapshot
    row; the row-weighted mean is recovered exactly from integer sums.
    """
    current = shelf_life.where("is_current").select("product_id", "shelf_life_days")
    attrs = products.select("product_id", "category").join(current, "product_id")
    per_product = inventory.groupBy("product_id").agg(
        F.sum("spoiled_qty").cast("bigint").alias("spoiled"),
        F.sum("received_qty").cast("bigint").alias("received"),
        F.count(F.lit(1)).alias("rows"),
    )
    by_cat = (
        per_product.join(attrs, "product_id")
        .groupBy("category")
        .agg(F.sum("spoiled").cast("bigint").alias("spoiled"),
             F.sum("received").cast("bigint").alias("received"),
             (F.sum(F.col("rows") * F.col("shelf_life_days")).cast("double")
              / F.sum("rows")).alias("shelf"))
    )
    return by_cat.withColumn("rate", F.col("spoiled") / F.greatest(F.col("received"), F.lit(1)))


def spoilage_extremes(by_category: DataFrame) -> DataFrame:
    """Categories with the shortest and longest mean shelf life, and whether
    the shortest spoils at the higher rate (first category wins ties)."""
    shortest = F.struct("shelf", "category")
    longest = F.struct((-F.col("shelf")).alias("neg"), "category")
    row = F.struct("category", "shelf", "rate")
    picked = by_category.agg(F.min_by(row, shortest).alias("lo"), F.min_by(row, longest).alias("hi"))
    return picked.select(
        F.col("lo.category").alias("shortest_category"),
        F.col("lo.shelf").alias("shortest_shelf_life"),
        F.col("lo.rate").alias("shortest_rate"),
        F.col("hi.category").alias("longest_category"),
        F.col("hi.shelf").alias("longest_shelf_life"),
        F.col("hi.rate").alias("longest_rate"),
        (F.col("lo.rate") > F.col("hi.rate")).alias("shortest_spoils_more"),
    )
