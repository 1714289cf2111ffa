"""Risk score columns: spoilage, stockout, shelf-life runway and the flag.

These are plain ``Column -> Column`` functions (the macro surface of the
warehouse), evaluated JVM-side inside whole-stage codegen. ``register_sql``
also exposes the two scores as SQL functions for ``spark.sql`` users.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shelfrisk.sources.schemas import SPOILAGE_FLAG_THRESHOLD


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def spoilage_risk_score(on_hand: Column | str, sell_through: Column | str,
                        days_remaining: Column | str) -> Column:
    """Share of on-hand stock not expected to sell before it expires, in [0, 1]."""
    on_hand, st, days = _c(on_hand), _c(sell_through), _c(days_remaining)
    expected_sold = F.coalesce(st, F.lit(0)) * F.greatest(days, F.lit(0))
    raw = (on_hand - expected_sold) / F.nullif(on_hand, F.lit(0))
    return F.when(on_hand <= 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)))


def stockout_risk_score(on_hand: Column | str, sell_through: Column | str,
                        lead_days: Column | str) -> Column:
    """How far days of cover fall short of the replenishment lead time, in [0, 1]."""
    on_hand, st, lead = _c(on_hand), _c(sell_through), _c(lead_days)
    cover_days = on_hand / F.nullif(st, F.lit(0))
    raw = (lead - cover_days) / lead
    return (
        F.when(F.coalesce(st, F.lit(0)) <= 0, F.lit(0.0))
        .when(lead <= 0, F.lit(0.0))
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)))
    )


def days_remaining_shelf_life(shelf_life_days: Column | str,
                              oldest_batch_age_days: Column | str) -> Column:
    """Freshness runway of the oldest stock on the shelf, never negative."""
    return F.greatest(_c(shelf_life_days) - _c(oldest_batch_age_days), F.lit(0))


def risk_flag(on_hand: Column | str, sell_through: Column | str,
              spoilage_score: Column | str,
              threshold: float = SPOILAGE_FLAG_THRESHOLD) -> Column:
    """First match wins: empty shelf with live demand, then projected write-off."""
    on_hand, st, spoil = _c(on_hand), _c(sell_through), _c(spoilage_score)
    return (
        F.when((on_hand == 0) & (st > 0), F.lit("STOCKOUT"))
        .when(spoil >= F.lit(threshold), F.lit("SPOILAGE"))
        .otherwise(F.lit("OK"))
    )


def register_sql(spark: SparkSession) -> None:
    """Expose the scores as SQL functions (session-scoped, inlined by the optimizer)."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION spoilage_risk_score(
            on_hand DOUBLE, sell_through DOUBLE, days_remaining DOUBLE)
        RETURNS DOUBLE
        RETURN CASE WHEN on_hand <= 0 THEN 0.0
                    ELSE least(1.0, greatest(0.0,
                         (on_hand - coalesce(sell_through, 0) * greatest(days_remaining, 0))
                         / nullif(on_hand, 0))) END
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION stockout_risk_score(
            on_hand DOUBLE, sell_through DOUBLE, lead_days DOUBLE)
        RETURNS DOUBLE
        RETURN CASE WHEN coalesce(sell_through, 0) <= 0 THEN 0.0
                    WHEN lead_days <= 0 THEN 0.0
                    ELSE least(1.0, greatest(0.0,
                         (lead_days - on_hand / nullif(sell_through, 0)) / lead_days)) END
    """)
