"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables under ``sf_dir`` (through
``Warehouse``) and returns a lazy DataFrame; the caller triggers it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime as dt

from shelfrisk.functions import calendar, scores
from shelfrisk.operators import conform, fifo, insights, quality, risk, serving, velocity
from shelfrisk.plans.warehouse import Warehouse
from shelfrisk.session import configure, scratch_path
from shelfrisk.sources import domain, files, lake, schemas
from shelfrisk.sources import events as event_source
from shelfrisk.sources.tables import read_table
from shelfrisk.streaming import events, job

LAST_SEASON_DAY = (domain.SEASON_START + dt.timedelta(days=domain.SEASON_DAYS - 1)).isoformat()

# Dashboard slice used by the slice queries (regions and categories present in
# the driver tables).
SLICE_REGIONS = ("AMERICA", "EUROPE")
SLICE_CATEGORIES = ("LARGE", "MEDIUM", "SMALL")

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


@query("risk_gold")
def risk_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold risk rows, default parameters (7-day window, threshold 0.70)."""
    return Warehouse.of(spark, sf_dir).gold()


@query("risk_gold_params")
def risk_gold_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold risk rows with a 14-day window and a 0.5 spoilage threshold."""
    return Warehouse.of(spark, sf_dir).gold(window_days=14, threshold=0.5)


# --------------------------------------------------------------------------- #
# Staging and marts
# --------------------------------------------------------------------------- #
@query("stg_stores")
def stg_stores(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).stores


@query("stg_products")
def stg_products(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).products


@query("stg_suppliers")
def stg_suppliers(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).suppliers


@query("stg_shelf_life")
def stg_shelf_life(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).shelf_life


@query("stg_date")
def stg_date(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).dates


@query("stg_sales")
def stg_sales(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).sales


@query("stg_inventory")
def stg_inventory(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).inventory


@query("dim_product")
def dim_product(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).dim_product


@query("sell_through")
def sell_through_q(spark, sf_dir):
    """Dense spine with sales joined and the 7-row trailing mean."""
    return Warehouse.of(spark, sf_dir).velocity()


@query("sell_through_dense")
def sell_through_dense(spark, sf_dir):
    """Dense spine with zero-filled daily units (no window)."""
    w = Warehouse.of(spark, sf_dir)
    return velocity.dense_sales(w.inventory, w.sales, partition_col=None)


@query("densify_spine")
def densify_spine(spark, sf_dir):
    """Sales series gap-filled between each pair's first and last sale day."""
    w = Warehouse.of(spark, sf_dir)
    s = w.sales.select("store_id", "product_id", "sale_date", "units_sold")
    return velocity.densify(s, ["store_id", "product_id"], "sale_date", {"units_sold": 0})


@query("price_lookup")
def price_lookup(spark, sf_dir):
    """Sales priced from the product catalogue (distinct id -> price lookup)."""
    w = Warehouse.of(spark, sf_dir)
    prices = w.products.select("product_id", F.col("unit_price").alias("catalog_price")).distinct()
    s = w.sales.join(prices, "product_id", "left")
    return s.select("store_id", "product_id", "sale_date", "units_sold", "catalog_price",
                    (F.col("units_sold") * F.col("catalog_price")).alias("catalog_value"),
                    (F.col("unit_price") == F.col("catalog_price")).alias("price_matches"))


@query("spoilage_score")
def spoilage_score_q(spark, sf_dir):
    """Raw (unrounded) spoilage score on every velocity row."""
    w = Warehouse.of(spark, sf_dir)
    attrs = risk.product_attributes(w.products, w.suppliers, w.shelf_life)
    v = w.velocity().join(attrs, "product_id")
    days = scores.days_remaining_shelf_life("shelf_life_days", "oldest_batch_age_days")
    return v.select("store_id", "product_id", "snapshot_date",
                    scores.spoilage_risk_score("on_hand_qty", "trailing_avg_daily_sell_through",
                                               days).alias("spoilage_risk_raw"))


@query("stockout_score")
def stockout_score_q(spark, sf_dir):
    """Raw (unrounded) stockout score on every velocity row."""
    w = Warehouse.of(spark, sf_dir)
    attrs = risk.product_attributes(w.products, w.suppliers, w.shelf_life)
    v = w.velocity().join(attrs, "product_id")
    return v.select("store_id", "product_id", "snapshot_date",
                    scores.stockout_risk_score("on_hand_qty", "trailing_avg_daily_sell_through",
                                               "lead_time_days").alias("stockout_risk_raw"))


# --------------------------------------------------------------------------- #
# Serving
# --------------------------------------------------------------------------- #
def _enriched(spark, sf_dir, newest_only=False, ordered=False):
    w = Warehouse.of(spark, sf_dir)
    gold = w.gold_table().drop("computed_at")
    day = w.gold_mart().newest() if newest_only else None  # from the manifest, as a dashboard picks it
    return serving.enriched_rows(gold, w.products, w.stores, snapshot_date=day, ordered=ordered)


@query("serve_enriched_day")
def serve_enriched_day(spark, sf_dir):
    """Enriched risk rows of the newest day, in dashboard order."""
    return _enriched(spark, sf_dir, newest_only=True, ordered=True)


@query("serve_slice")
def serve_slice(spark, sf_dir):
    """Newest day sliced to two regions and three categories."""
    return serving.slice_rows(_enriched(spark, sf_dir, newest_only=True),
                              SLICE_REGIONS, SLICE_CATEGORIES)


@query("kpis")
def kpis_q(spark, sf_dir):
    """KPI row over every risk row (aggregated per product before pricing)."""
    w = Warehouse.of(spark, sf_dir)
    return serving.kpis_from_gold(w.gold_table(), w.products)


@query("kpis_day_slice")
def kpis_day_slice(spark, sf_dir):
    """KPI row for the dashboard's default view: newest day, sliced."""
    return serving.kpis(serving.slice_rows(_enriched(spark, sf_dir, newest_only=True),
                                           SLICE_REGIONS, SLICE_CATEGORIES))


@query("flags_by_region")
def flags_by_region(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return serving.flags_by_dimension_from_gold(w.gold_table(), w.stores, "store_id", "region")


@query("flags_by_category")
def flags_by_category(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return serving.flags_by_dimension_from_gold(w.gold_table(), w.products, "product_id",
                                                "category")


@query("flags_by_store")
def flags_by_store(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return serving.flags_by_dimension_from_gold(w.gold_table(), w.stores, "store_id",
                                                "store_name")


@query("top_stockouts")
def top_stockouts(spark, sf_dir):
    """Newest day's 25 stockouts losing the most revenue per day."""
    return serving.top_risks(_enriched(spark, sf_dir, newest_only=True), "STOCKOUT", 25)


@query("top_spoilage")
def top_spoilage(spark, sf_dir):
    """Newest day's 25 spoilage risks with the largest write-off at stake."""
    return serving.top_risks(_enriched(spark, sf_dir, newest_only=True), "SPOILAGE", 25)


@query("daily_trend")
def daily_trend(spark, sf_dir):
    return serving.daily_trend(Warehouse.of(spark, sf_dir).gold_table())


@query("trend_pivot")
def trend_pivot(spark, sf_dir):
    return serving.trend_pivot(serving.daily_trend(Warehouse.of(spark, sf_dir).gold_table()))


@query("available_dates")
def available_dates(spark, sf_dir):
    """Published days, newest first, from the mart's manifest: no data file is opened."""
    days = Warehouse.of(spark, sf_dir).gold_mart().values()
    return spark.createDataFrame([(d,) for d in reversed(days)], "snapshot_date string")


@query("filter_values")
def filter_values(spark, sf_dir):
    return serving.filter_values(_enriched(spark, sf_dir, newest_only=True))


@query("flag_distribution")
def flag_distribution(spark, sf_dir):
    return serving.flag_distribution(Warehouse.of(spark, sf_dir).gold_table())


# --------------------------------------------------------------------------- #
# Inventory insights
# --------------------------------------------------------------------------- #
@query("signal_summary")
def signal_summary(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return insights.signal_summary(w.inventory, w.sales)


@query("table_counts")
def table_counts(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return insights.table_counts({
        "dim_store": w.stores, "dim_product": w.products, "dim_supplier": w.suppliers,
        "dim_shelf_life": w.shelf_life, "dim_date": w.dates, "fact_sales": w.sales,
        "fact_inventory_snapshot": w.inventory,
    })


@query("aging_stock")
def aging_stock(spark, sf_dir):
    return insights.aging_stock(Warehouse.of(spark, sf_dir).inventory)


@query("spoilage_by_category")
def spoilage_by_category(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return insights.spoilage_by_category(w.inventory, w.products, w.shelf_life)


@query("spoilage_extremes")
def spoilage_extremes(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return insights.spoilage_extremes(
        insights.spoilage_by_category(w.inventory, w.products, w.shelf_life))


# --------------------------------------------------------------------------- #
# Conform, SCD2 and the lake
# --------------------------------------------------------------------------- #
CONFORM_COLUMNS = ("supplier_id", "supplier_name", "lead_time_days", "reliability",
                   "extract_ts", "load_date")
LOAD_DATE = "2026-07-05"


@query("supplier_conform")
def supplier_conform(spark, sf_dir):
    """Dirty supplier extract -> clean, valid, latest row per supplier."""
    w = Warehouse.of(spark, sf_dir)
    return conform.conform_suppliers(w.raw_supplier_extract, LOAD_DATE).select(*CONFORM_COLUMNS)


@query("supplier_quarantine")
def supplier_quarantine(spark, sf_dir):
    """The extract rows that are not loaded, as they came, with the first rule that each breaks."""
    return conform.quarantined_suppliers(Warehouse.of(spark, sf_dir).raw_supplier_extract)


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """The extract written as headered CSV, read back as strings, conformed."""
    w = Warehouse.of(spark, sf_dir)
    path = scratch_path(spark, "supplier-extract-csv")
    lake.write_extract_csv(w.raw_supplier_extract, path)
    raw = lake.read_extract(spark, path, schemas.RAW_SUPPLIER_EXTRACT)
    out = conform.conform_suppliers(raw, LOAD_DATE)
    return out.select(*CONFORM_COLUMNS,
                      F.col("source_file").endswith(".csv").alias("source_file_captured"))


@query("partition_reload")
def partition_reload(spark, sf_dir):
    """Two daily loads, then a reload of the first: both days must survive."""
    w = Warehouse.of(spark, sf_dir)
    path = scratch_path(spark, "bronze-suppliers")
    for day in (LOAD_DATE, "2026-07-06", LOAD_DATE):
        lake.write_partitioned(conform.conform_suppliers(w.raw_supplier_extract, day)
                               .select(*CONFORM_COLUMNS), path, ["load_date"])
    # Partition values come back type-inferred (a DATE here); restore the declared text.
    back = lake.read_partitions(spark, path)
    return back.withColumn("load_date", F.col("load_date").cast("string")).select(*CONFORM_COLUMNS)


@query("partition_prune")
def partition_prune(spark, sf_dir):
    """Snapshot written partitioned by day; one day read back (folder pruning)."""
    w = Warehouse.of(spark, sf_dir)
    path = scratch_path(spark, "bronze-inventory")
    snap = w.snapshot.sortWithinPartitions("snapshot_date").withColumn("dt", F.col("snapshot_date").cast("string"))
    lake.write_partitioned(snap, path, ["dt"], in_order=True)  # each bucket's rows of a day in order of their series
    day = F.col("dt") == F.lit(LAST_SEASON_DAY)
    return lake.read_partitions(spark, path, day).select(*schemas.INVENTORY_COLUMNS)


@query("scd2_build")
def scd2_build(spark, sf_dir):
    """Type-2 shelf-life history from the dirty revision extract."""
    w = Warehouse.of(spark, sf_dir)
    return conform.build_scd2(w.raw_shelf_life_extract).orderBy("product_id", "effective_from")


@query("scd2_current")
def scd2_current(spark, sf_dir):
    """Shelf life in force today (one row per product)."""
    return (Warehouse.of(spark, sf_dir).shelf_life.where(F.col("is_current"))
            .select("product_id", "shelf_life_days", "effective_from"))


# --------------------------------------------------------------------------- #
# Data quality
# --------------------------------------------------------------------------- #
@query("dq_not_null")
def dq_not_null(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    nn = lambda *cols: {f"not_null({c})": quality.is_null(c) for c in cols}
    return quality.union_all([
        quality.row_checks(w.gold_table(), "perishables_risk",
                           nn("store_id", "product_id", "snapshot_date", "risk_flag",
                              "spoilage_risk_score", "stockout_risk_score")),
        quality.row_checks(w.stores, "dim_store", nn("store_id", "region")),
        quality.row_checks(w.products, "dim_product", nn("product_id", "category")),
        quality.row_checks(w.suppliers, "dim_supplier", nn("supplier_id", "lead_time_days")),
        quality.row_checks(w.shelf_life, "dim_shelf_life", nn("product_id", "shelf_life_days")),
        quality.row_checks(w.dates, "dim_date", nn("date_day")),
    ])


@query("dq_unique")
def dq_unique(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return quality.union_all([
        quality.unique(w.stores, "dim_store", ["store_id"]),
        quality.unique(w.products, "dim_product", ["product_id"]),
        quality.unique(w.suppliers, "dim_supplier", ["supplier_id"]),
        quality.unique(w.dates, "dim_date", ["date_day"]),
        quality.unique(conform.clean_suppliers(w.raw_supplier_extract), "raw_supplier_extract",
                       ["supplier_id"]),
    ])


@query("dq_unique_grain")
def dq_unique_grain(spark, sf_dir):
    """Gold rows sharing a (store, product, day) grain: none in the mart; in a copy where rows with one piece
    on hand stand twice, exactly these."""
    gold = Warehouse.of(spark, sf_dir).gold_table()
    twice = gold.unionByName(gold.where(F.col("on_hand_qty") == 1))
    return quality.union_all([quality.violating_duplicates(df, schemas.GRAIN).select(F.lit(target).alias("target"), "*")
                              for target, df in (("perishables_risk", gold), ("perishables_risk[seeded]", twice))])


def _linked(target: str, df: DataFrame, parents: dict[str, str]):
    """A child with its foreign keys, each also with seeded orphans: keys ending in 7 changed to unknown ones. It is counted by
    one key column at a time: a fact has far more pairs of keys than keys."""
    children = []
    for col, parent in parents.items():
        seeded = F.when(F.col(col).endswith("7"), F.concat(F.lit("?"), F.col(col))).otherwise(F.col(col))
        children.append((df, [col], [quality.ForeignKey(target, col, F.col(col), parent), quality.ForeignKey(f"{target}[seeded]", col, seeded, parent)]))
    return children


@query("dq_relationships")
def dq_relationships(spark, sf_dir):
    """Every foreign key of the warehouse in one aggregate, and the same keys with seeded orphans."""
    w = Warehouse.of(spark, sf_dir)
    both = {"store_id": "dim_store", "product_id": "dim_product"}
    return quality.relationships([
        *_linked("dim_product", w.products, {"supplier_id": "dim_supplier"}),
        *_linked("dim_shelf_life", w.shelf_life, {"product_id": "dim_product"}),
        *_linked("fact_sales", w.sales, both),
        *_linked("fact_inventory_snapshot", w.snapshot, both),
        *_linked("perishables_risk", w.gold_table(), both),
        *_linked("raw_supplier_extract", conform.clean_suppliers(w.raw_supplier_extract), {"supplier_id": "dim_supplier"}),
    ], {"dim_store": w.stores.select("store_id"), "dim_product": w.products.select("product_id"),
        "dim_supplier": w.suppliers.select("supplier_id")})


SERIES = ("store_id", "product_id")


def _bitmaps(spark, sf_dir) -> dict[str, DataFrame]:
    w = Warehouse.of(spark, sf_dir)
    return {"fact_inventory_snapshot": quality.day_bitmaps(w.inventory, SERIES, "snapshot_date", domain.SEASON_START, domain.SEASON_DAYS),
            "fact_sales": quality.day_bitmaps(w.sales, SERIES, "sale_date", domain.SEASON_START, domain.SEASON_DAYS)}


@query("dq_density")
def dq_density(spark, sf_dir):
    """Dense snapshot passes; the sparse sales fact, checked the same way, does not."""
    return quality.union_all([quality.density_detail(b, domain.SEASON_DAYS).select(F.lit(target).alias("target"), "*")
                              for target, b in _bitmaps(spark, sf_dir).items()])


@query("dq_density_gaps")
def dq_density_gaps(spark, sf_dir):
    """Series that lack days, with the days named: none in the snapshot, the days without sales in the sales fact."""
    return quality.union_all([quality.density_gaps(b, SERIES, domain.SEASON_START, domain.SEASON_DAYS).select(F.lit(target).alias("target"), "*")
                              for target, b in _bitmaps(spark, sf_dir).items()])


@query("dq_accepted_values")
def dq_accepted_values(spark, sf_dir):
    return quality.row_checks(Warehouse.of(spark, sf_dir).gold_table(), "perishables_risk",
                              {"in_set(risk_flag)": quality.not_in("risk_flag", schemas.RISK_FLAGS)})


@query("dq_score_range")
def dq_score_range(spark, sf_dir):
    return quality.row_checks(Warehouse.of(spark, sf_dir).gold_table(), "perishables_risk", {
        "between(spoilage_risk_score, 0, 1)": quality.outside("spoilage_risk_score", 0, 1),
        "between(stockout_risk_score, 0, 1)": quality.outside("stockout_risk_score", 0, 1),
    })


@query("dq_min_nonneg")
def dq_min_nonneg(spark, sf_dir):
    return quality.column_minimums(Warehouse.of(spark, sf_dir).inventory, [
        "on_hand_qty", "received_qty", "spoiled_qty", "unmet_demand", "oldest_batch_age_days"])


@query("dq_flag_consistent")
def dq_flag_consistent(spark, sf_dir):
    """Flags re-derived from scores at 0.70: the default build agrees, a build
    made with threshold 0.5 is caught."""
    w = Warehouse.of(spark, sf_dir)
    check = {"flag_matches_scores": quality.flag_disagrees(0.70)}
    return quality.union_all([
        quality.row_checks(w.gold_table(), "perishables_risk", check),
        quality.row_checks(w.gold_table(threshold=0.5), "perishables_risk[threshold=0.5]", check),
    ])


@query("dq_outlives")
def dq_outlives(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return quality.violating_outlived_stock(w.inventory, w.shelf_life)


@query("dq_sales_positive")
def dq_sales_positive(spark, sf_dir):
    return quality.row_checks(Warehouse.of(spark, sf_dir).sales, "fact_sales",
                              {"units_sold > 0": F.col("units_sold") <= 0})


@query("dq_revenue")
def dq_revenue(spark, sf_dir):
    return quality.row_checks(Warehouse.of(spark, sf_dir).sales, "fact_sales",
                              {"revenue = round(units_sold * unit_price, 2)":
                               quality.revenue_mismatch(0.01)})


@query("dq_scd2_current")
def dq_scd2_current(spark, sf_dir):
    return quality.one_current_version(Warehouse.of(spark, sf_dir).shelf_life, "dim_shelf_life")


@query("dq_suite_inventory")
def dq_suite_inventory(spark, sf_dir):
    """The suite over the snapshot, and over a copy with seeded faults: rows on the first day without one,
    rows with one piece on hand below zero, and spoiled rows twice. ``quality.inventory_suite``, run as an audit is."""
    inv = Warehouse.of(spark, sf_dir).snapshot
    faulty = inv.withColumns({
        "snapshot_date": F.when((F.col("received_qty") == 5) & (F.col("snapshot_date") == F.lit(domain.SEASON_START)), None).otherwise(F.col("snapshot_date")),
        "on_hand_qty": F.when(F.col("on_hand_qty") == 1, F.lit(-1)).otherwise(F.col("on_hand_qty"))})
    faulty = faulty.unionByName(faulty.where(F.col("spoiled_qty") == 7))
    return quality.union_all([quality.inventory_audit(inv), quality.inventory_audit(faulty, "fact_inventory_snapshot[seeded]")])


@query("dq_suite_risk")
def dq_suite_risk(spark, sf_dir):
    """``quality.risk_suite`` over the published mart, run as its audit is."""
    return quality.risk_audit(Warehouse.of(spark, sf_dir).gold_table())


# --------------------------------------------------------------------------- #
# Events: contract checks and the stream
# --------------------------------------------------------------------------- #
@query("decode_payload")
def decode_payload(spark, sf_dir):
    """base64 envelopes decoded and parsed; bad payloads come back NULL."""
    configure(spark)
    recs = event_source.enveloped_records(event_source.event_records(spark, sf_dir))
    v = events.decode_base64_json(F.col("data"))
    return recs.select("record_id", v.isNotNull().alias("payload_is_json"),
                       F.try_variant_get(v, "$.event_type", "string").alias("event_type"))


@query("event_validate")
def event_validate(spark, sf_dir):
    """Every record with its first failing rule (NULL reason = valid)."""
    configure(spark)
    return events.with_reason(event_source.event_records(spark, sf_dir)).select(
        "record_id", "reason")


@query("event_enrich")
def event_enrich(spark, sf_dir):
    """Valid records, typed and enriched with event_date and revenue."""
    configure(spark)
    return events.validate_and_enrich(event_source.event_records(spark, sf_dir))


_STREAM_LAKES: dict[tuple[str, str, str], job.Lake] = {}


def stream_lake(spark, sf_dir) -> job.Lake:
    """Run the event stream over the enveloped records (as files) once per session and state of the
    input; return its lake."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, files.fingerprint(spark, [f"{sf_dir.rstrip('/')}/events.parquet"]))
    if key not in _STREAM_LAKES:
        source = scratch_path(spark, "stream-source")
        event_source.envelope_lines(event_source.event_records(spark, sf_dir)).select("value").write.mode("overwrite").text(source)
        lake = job.Lake(scratch_path(spark, "lake"))
        q = job.start(spark, source, lake, scratch_path(spark, "stream-checkpoint"), enveloped=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        _STREAM_LAKES[key] = lake
    return _STREAM_LAKES[key]


@query("stream_good")
def stream_good(spark, sf_dir):
    """Enriched events as delivered to the bronze lake by the stream."""
    return job.read_good(spark, stream_lake(spark, sf_dir)).select(*events.ENRICHED_COLUMNS)


@query("stream_rejects")
def stream_rejects(spark, sf_dir):
    """Rejected records by reason and payload as received, read back from the quarantine."""
    return (job.read_rejects(spark, stream_lake(spark, sf_dir))
            .groupBy("reason", "raw").agg(F.count(F.lit(1)).alias("n")))


@query("stream_summary")
def stream_summary(spark, sf_dir):
    """Totals of the per-batch delivery summaries."""
    return job.read_summary(spark, stream_lake(spark, sf_dir)).agg(
        F.sum("received").cast("bigint").alias("received"),
        F.sum("delivered").cast("bigint").alias("delivered"),
        F.sum("rejected").cast("bigint").alias("rejected"),
    )


SEQUENCE_BATCHES = 3


@query("stream_sequence")
def stream_sequence(spark, sf_dir):
    """The order of each store's events across batches: a stream of three batches, in which one store has a
    third of all events, numbered per store and packed on the way."""
    configure(spark)
    records = event_source.event_records(spark, sf_dir)
    busy = F.when(F.col("record_id") % 3 == 0, F.regexp_replace("value", '"store_id":"S[0-9]{3}"', '"store_id":"S000"')).otherwise(F.col("value"))
    source, lake = scratch_path(spark, "sequence-source"), job.Lake(scratch_path(spark, "sequence-lake"))
    for part in range(SEQUENCE_BATCHES):  # a folder of files per batch; the stream takes the oldest first
        (records.where(F.floor(F.col("record_id") / 7) % SEQUENCE_BATCHES == part).select(busy.alias("value"))
         .coalesce(1).write.mode("append").text(source))
    q = job.start(spark, source, lake, scratch_path(spark, "sequence-checkpoint"), max_bytes_per_trigger=1, numbered=True, pack_every=2)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return job.read_good(spark, lake).select("store_id", "store_seq", "event_id")


# --------------------------------------------------------------------------- #
# FIFO ageing and calendar
# --------------------------------------------------------------------------- #
@query("fifo_aging")
def fifo_aging(spark, sf_dir):
    """FIFO lot ageing of every (store, product) ledger: receipts from the snapshot, demand from sales, shelf life =
    the current version. Opening stock is what stood on the shelf before the first day's receipt: that day's
    end stock with its sales and write-offs put back and its receipt taken away, as old as its oldest lot
    (a day at least, its shelf life at most)."""
    w = Warehouse.of(spark, sf_dir)
    keys = ["product_id", "store_id"]  # as the facts are sorted
    current = w.shelf_life.where(F.col("is_current")).select("product_id", "shelf_life_days").hint("shuffle_hash")  # keeps their order
    opening = F.col("on_hand_qty") + F.col("spoiled_qty") + F.col("units_sold") - F.col("received_qty")
    ledger = velocity.dense_sales(w.inventory, w.sales, partition_col=None).join(current, "product_id").select(
        *keys, F.datediff("snapshot_date", F.lit(domain.SEASON_START)).alias("day"),
        "received_qty", "units_sold", "shelf_life_days", F.greatest(opening, F.lit(0)).alias("opening"),
        F.least(F.greatest("oldest_batch_age_days", F.lit(1)), "shelf_life_days").alias("opening_age"))
    out = fifo.fifo_age(ledger, keys, "day", "received_qty", "units_sold", "shelf_life_days",
                        "opening", "opening_age")
    return out.select("store_id", "product_id", F.date_add(F.lit(domain.SEASON_START), F.col("day"))
                      .alias("snapshot_date"), *fifo.OUT_FIELDS)


@query("date_dim")
def date_dim(spark, sf_dir):
    """Calendar rows spanning every ship date of the line items."""
    configure(spark)
    li = read_table(spark, sf_dir, "lineitem", "l_shipdate")
    span = li.agg(F.min("l_shipdate").cast("date").alias("d0"),
                  F.max("l_shipdate").cast("date").alias("d1"))
    return calendar.date_rows(span, "d0", "d1")


@query("sql_scores")
def sql_scores(spark, sf_dir):
    """The two scores called as SQL functions over the enriched velocity rows."""
    w = Warehouse.of(spark, sf_dir)
    scores.register_sql(spark)
    attrs = risk.product_attributes(w.products, w.suppliers, w.shelf_life)
    v = w.velocity().join(attrs, "product_id").withColumn(
        "days_remaining_shelf_life",
        scores.days_remaining_shelf_life("shelf_life_days", "oldest_batch_age_days"))
    return v.selectExpr(
        "store_id", "product_id", "snapshot_date",
        "round(spoilage_risk_score(on_hand_qty, trailing_avg_daily_sell_through, "
        "days_remaining_shelf_life) * 1000, 0) / 1000 AS spoilage_risk_score",
        "round(stockout_risk_score(on_hand_qty, trailing_avg_daily_sell_through, "
        "lead_time_days) * 1000, 0) / 1000 AS stockout_risk_score")


# Sales that the incremental query lets arrive late: of these season days, for stores of odd number.
LATE_DAYS = (3, 4, 17, 28)


@query("risk_gold_incremental")
def risk_gold_incremental(spark, sf_dir):
    """A mart published before some sales came in, brought up to date by their change set: late rows of
    several days, some of whose windows overlap or reach beyond the season. The whole mart is read back."""
    w = Warehouse.of(spark, sf_dir)
    day = F.datediff("sale_date", F.lit(domain.SEASON_START))
    late = day.isin(*LATE_DAYS) & F.col("store_id").rlike("[13579]$")
    mart = w.new_gold_mart("mart-incremental")
    w.publish_gold(mart, w.gold_from(w.sales.where(~late)))
    w.refresh_gold(mart, w.sales, w.sales.where(late))
    return mart.read().select(*risk.GOLD_COLUMNS)


def broken(gold: DataFrame) -> DataFrame:
    """Gold rows with seeded faults: unknown flags, scores above 1, and repeated rows."""
    wrong = gold.withColumns({
        "risk_flag": F.when(F.col("on_hand_qty") == 1, F.lit("MAYBE")).otherwise(F.col("risk_flag")),
        "spoilage_risk_score": F.when(F.col("on_hand_qty") == 2, F.col("spoilage_risk_score") + 1.5).otherwise(F.col("spoilage_risk_score")),
    })
    return wrong.unionByName(wrong.where(F.col("on_hand_qty") == 3))


@query("dq_gate")
def dq_gate(spark, sf_dir):
    """Two publishes of one mart: a good build, then one with seeded faults. Per check its violations,
    whether the build was published, and the rows that readers see afterwards."""
    w = Warehouse.of(spark, sf_dir)
    mart = w.new_gold_mart("mart-gate")
    rows = []
    # The good build comes from the gold plan as any mart's does; the broken one from what was published.
    for name, build in (("good", lambda: risk.with_computed_at(w.gold())), ("broken", lambda: broken(mart.read()))):
        outcome = mart.publish(build(), quality.risk_audit, in_order=name == "good")
        seen = sum(p.rows for p in mart.partitions())
        rows += [(name, c["check"], c["violations"], c["passed"], outcome.version is not None, seen) for c in outcome.checks]
    return spark.createDataFrame(rows, "build string, check string, violations long, passed boolean, published boolean, visible_rows long")
