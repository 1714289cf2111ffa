"""Gold risk table: one scored, flagged row per store x product x day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.functions.numeric import round_half_away
from shelfrisk.functions.scores import (
    days_remaining_shelf_life,
    risk_flag,
    spoilage_risk_score,
    stockout_risk_score,
)
from shelfrisk.sources.schemas import SPOILAGE_FLAG_THRESHOLD

GOLD_COLUMNS = (
    "store_id", "product_id", "snapshot_date", "on_hand_qty", "days_remaining_shelf_life",
    "trailing_7d_sell_through", "projected_demand_before_expiry", "replenishment_lead_days",
    "spoilage_risk_score", "stockout_risk_score", "risk_flag",
)


def product_attributes(products: DataFrame, suppliers: DataFrame,
                       shelf_life: DataFrame) -> DataFrame:
    """Product grain: supplier lead time and the *current* shelf life.

    Inner joins, as in the gold model: a product without a supplier row or
    without a current shelf-life row is dropped, and two current rows fan out
    (guarded by the quality checks). The product grain is joined before it
    meets the fact, so the fact joins once on product_id.
    """
    current = shelf_life.where(F.col("is_current")).select("product_id", "shelf_life_days")
    return (
        products.select("product_id", "supplier_id")
        .join(suppliers.select("supplier_id", "lead_time_days"), "supplier_id")
        .join(current, "product_id")
        .select("product_id", "lead_time_days", "shelf_life_days")
    )


def risk(velocity: DataFrame, products: DataFrame, suppliers: DataFrame, shelf_life: DataFrame,
         threshold: float = SPOILAGE_FLAG_THRESHOLD,
         sell_through_col: str = "trailing_avg_daily_sell_through", by_day: bool = False) -> DataFrame:
    """Score spoilage and stockout risk and raise one flag per row.

    Scores are rounded to 3 decimals *before* flagging so the flag never
    disagrees with the score shown. The STOCKOUT test uses the unrounded
    sell-through (with a 7-day window the smallest positive mean is 1/7, so it
    agrees with the rounded column).

    ``by_day`` puts each partition's rows in order of their day, before they are scored: a row is half as long then.
    """
    attrs = product_attributes(products, suppliers, shelf_life)
    st = F.col("_st")
    enriched = velocity.select(
        "store_id", "product_id", "snapshot_date", "on_hand_qty", "oldest_batch_age_days",
        F.col(sell_through_col).alias("_st"),
    ).join(attrs.hint("merge" if by_day else "shuffle_hash"), "product_id").withColumn(  # the latter keeps the facts' order
        "days_remaining_shelf_life",
        days_remaining_shelf_life("shelf_life_days", "oldest_batch_age_days"),
    )
    if by_day:
        enriched = enriched.drop("shelf_life_days", "oldest_batch_age_days").sortWithinPartitions("snapshot_date")
    raw = enriched.withColumns({
        "_spoil": spoilage_risk_score("on_hand_qty", st, "days_remaining_shelf_life"),
        "_stock": stockout_risk_score("on_hand_qty", st, "lead_time_days"),
        "_demand": st * F.col("days_remaining_shelf_life"),
    })
    scored = raw.withColumns({"spoilage_risk_score": round_half_away("_spoil", 3), "stockout_risk_score": round_half_away("_stock", 3)})
    return scored.select(
        "store_id", "product_id", "snapshot_date", "on_hand_qty", "days_remaining_shelf_life",
        round_half_away(st, 2).alias("trailing_7d_sell_through"),
        round_half_away("_demand", 1).alias("projected_demand_before_expiry"),
        F.col("lead_time_days").alias("replenishment_lead_days"),
        "spoilage_risk_score", "stockout_risk_score",
        risk_flag("on_hand_qty", st, "spoilage_risk_score", threshold).alias("risk_flag"),
    )


def with_computed_at(gold: DataFrame) -> DataFrame:
    """Stamp the build time (kept out of deterministic query results)."""
    return gold.withColumn("computed_at", F.current_timestamp())
