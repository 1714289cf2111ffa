"""Table schemas and fixed contract values.

The typed schemas are the staged (warehouse) layout; raw layouts keep dates
as ISO strings the way the landing files carry them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


DIM_STORE = _schema(
    ("store_id", StringType()), ("store_name", StringType()), ("store_format", StringType()),
    ("city", StringType()), ("state", StringType()), ("region", StringType()),
    ("size_factor", DoubleType()), ("open_date", DateType()),
)
DIM_PRODUCT = _schema(
    ("product_id", StringType()), ("product_name", StringType()), ("category", StringType()),
    ("supplier_id", StringType()), ("unit_price", DoubleType()), ("unit_cost", DoubleType()),
    ("popularity", DoubleType()),
)
DIM_SUPPLIER = _schema(
    ("supplier_id", StringType()), ("supplier_name", StringType()),
    ("lead_time_days", IntegerType()), ("reliability", DoubleType()),
)
DIM_SHELF_LIFE = _schema(
    ("product_id", StringType()), ("shelf_life_days", IntegerType()),
    ("effective_from", DateType()), ("effective_to", DateType()), ("is_current", BooleanType()),
)
DIM_DATE = _schema(
    ("date_day", DateType()), ("year", IntegerType()), ("month", IntegerType()),
    ("day", IntegerType()), ("day_of_week", StringType()), ("is_weekend", BooleanType()),
)
FACT_SALES = _schema(
    ("store_id", StringType()), ("product_id", StringType()), ("sale_date", DateType()),
    ("units_sold", IntegerType()), ("unit_price", DoubleType()), ("revenue", DoubleType()),
)
FACT_INVENTORY_SNAPSHOT = _schema(
    ("store_id", StringType()), ("product_id", StringType()), ("snapshot_date", DateType()),
    ("on_hand_qty", IntegerType()), ("received_qty", IntegerType()),
    ("oldest_batch_age_days", IntegerType()), ("spoiled_qty", IntegerType()),
    ("unmet_demand", IntegerType()),
)
PERISHABLES_RISK = _schema(
    ("store_id", StringType()), ("product_id", StringType()), ("snapshot_date", DateType()),
    ("on_hand_qty", IntegerType()), ("days_remaining_shelf_life", IntegerType()),
    ("trailing_7d_sell_through", DoubleType()), ("projected_demand_before_expiry", DoubleType()),
    ("replenishment_lead_days", IntegerType()), ("spoilage_risk_score", DoubleType()),
    ("stockout_risk_score", DoubleType()), ("risk_flag", StringType()),
    ("computed_at", TimestampType()),
)

# Raw extracts arrive as headered CSV; every column is read as a string.
RAW_SUPPLIER_EXTRACT = _schema(
    ("supplier_id", StringType()), ("supplier_name", StringType()),
    ("lead_time_days", StringType()), ("reliability", StringType()), ("extract_ts", StringType()),
)
RAW_SHELF_LIFE_EXTRACT = _schema(
    ("product_id", StringType()), ("shelf_life_days", StringType()), ("effective_from", StringType()),
)

# --- Fixed values (must equal the source platform's contracts) --------------
# Batch id patterns.
SUPPLIER_ID_PATTERN = r"^SUP[0-9]+$"
BATCH_PRODUCT_ID_PATTERN = r"^P[0-9]+$"
# Stream id patterns: a store is S + 3 digits, a product is P + 5 digits.
STREAM_STORE_ID_PATTERN = r"^S[0-9]{3}$"
STREAM_PRODUCT_ID_PATTERN = r"^P[0-9]{5}$"
# Event types and their required fields, in declared order.
EVENT_TYPES = ("pos_sale", "inventory_update")
COMMON_EVENT_FIELDS = ("event_type", "event_id", "event_ts", "store_id", "product_id")
TYPE_EVENT_FIELDS = {
    "pos_sale": ("units", "unit_price"),
    "inventory_update": ("on_hand_qty", "received_qty"),
}
# Risk flags, and the model parameters with their defaults.
RISK_FLAGS = ("OK", "STOCKOUT", "SPOILAGE")
SELL_THROUGH_WINDOW_DAYS = 7
SPOILAGE_FLAG_THRESHOLD = 0.70
# Serving row layout (column order of the enriched risk rows).
RISK_COLUMNS = (
    "snapshot_date", "store_id", "store_name", "region", "product_id", "product_name",
    "category", "risk_flag", "on_hand_qty", "days_remaining_shelf_life",
    "trailing_7d_sell_through", "projected_demand_before_expiry", "replenishment_lead_days",
    "spoilage_risk_score", "stockout_risk_score", "unit_price", "unit_cost",
    "stockout_lost_revenue_per_day", "spoilage_cost_at_risk",
)
# Dimensions the flag pivot may be grouped by.
PIVOT_DIMENSIONS = ("region", "category", "store_name", "product_name")
# Grain of the snapshot and gold tables.
GRAIN = ("store_id", "product_id", "snapshot_date")
# Required columns of an inventory snapshot.
INVENTORY_COLUMNS = (
    "store_id", "product_id", "snapshot_date", "on_hand_qty", "received_qty",
    "oldest_batch_age_days", "spoiled_qty", "unmet_demand",
)
