"""Staging: impose the warehouse types on raw landing tables.

Raw tables carry ISO-text dates and wide integers; each stager casts to the
typed layout of ``sources.schemas`` and projects exactly the warehouse
columns (so column pruning reaches the scan below).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cast(df: DataFrame, spec: list[tuple[str, str | None, str | None]]) -> DataFrame:
    """spec: (output name, source column or None for same name, type or None)."""
    cols = []
    for name, src, dtype in spec:
        c = F.col(src or name)
        cols.append((c.cast(dtype) if dtype else c).alias(name))
    return df.select(*cols)


def stage_stores(raw: DataFrame) -> DataFrame:
    return _cast(raw, [
        ("store_id", None, None), ("store_name", None, None), ("store_format", None, None),
        ("city", None, None), ("state", None, None), ("region", None, None),
        ("size_factor", None, "double"), ("open_date", None, "date"),
    ])


def stage_products(raw: DataFrame) -> DataFrame:
    return _cast(raw, [
        ("product_id", None, None), ("product_name", None, None), ("category", None, None),
        ("supplier_id", None, None), ("unit_price", None, "double"),
        ("unit_cost", None, "double"), ("popularity", None, "double"),
    ])


def stage_suppliers(raw: DataFrame) -> DataFrame:
    return _cast(raw, [
        ("supplier_id", None, None), ("supplier_name", None, None),
        ("lead_time_days", None, "int"), ("reliability", None, "double"),
    ])


def stage_shelf_life(raw: DataFrame) -> DataFrame:
    return _cast(raw, [
        ("product_id", None, None), ("shelf_life_days", None, "int"),
        ("effective_from", None, "date"), ("effective_to", None, "date"),
        ("is_current", None, "boolean"),
    ])


def stage_date(raw: DataFrame) -> DataFrame:
    return _cast(raw, [
        ("date_day", "date", "date"), ("year", None, None), ("month", None, None),
        ("day", None, None), ("day_of_week", None, None), ("is_weekend", None, "boolean"),
    ])


def stage_sales(raw: DataFrame) -> DataFrame:
    return _cast(raw, [
        ("store_id", None, None), ("product_id", None, None), ("sale_date", None, "date"),
        ("units_sold", None, "int"), ("unit_price", None, "double"), ("revenue", None, "double"),
    ])


def stage_inventory_snapshot(raw: DataFrame) -> DataFrame:
    return _cast(raw, [
        ("store_id", None, None), ("product_id", None, None), ("snapshot_date", None, "date"),
        ("on_hand_qty", None, "int"), ("received_qty", None, "int"),
        ("oldest_batch_age_days", None, "int"), ("spoiled_qty", None, "int"),
        ("unmet_demand", None, "int"),
    ])
