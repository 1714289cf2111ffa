"""Retail domain tables derived from the driver's TPC-H-style tables.

The driver ships orders and line items, not stores and shelves, so every
domain table is a deterministic function of the driver tables (integer
arithmetic only, so any SQL engine reproduces it exactly):

* store    <- nation x region (one store per nation, region from the region table)
* supplier <- supplier (lead time and reliability from the key)
* product  <- part (price from the part, cost 65 % of price, supplier = part div 20,
              which maps the 20 parts per supplier of the TPC-H ratios onto suppliers)
* sales    <- every line item, joined to its order and customer: the customer's
              nation is the store, the part is the product, and the ship date is
              replayed onto a SEASON_DAYS-long season (days since SHIP_EPOCH, modulo
              the season length), so all shipments count and none is filtered out
* inventory snapshot <- every (store, product) pair that sold, times every day of
              the season (dense spine), with end-of-day quantities from formulas
* raw supplier / shelf-life extracts <- supplier / part as all-string rows with
              padding, lower case, bad ids, out-of-range values and duplicates

Raw dimension extracts keep dates as ISO strings, as landing files do, and
``staging`` casts them; the large facts land with DATE columns (formatting and
re-parsing dates on every fact row costs more than the rest of the scan). Work grows with the inputs: nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrisk.functions.numeric import round_half_away
from shelfrisk.sources.tables import read_table

# Fixed derivation parameters.
SEASON_START = dt.date(2026, 7, 1)
SEASON_DAYS = 30
SHIP_EPOCH = dt.date(1995, 1, 1)
PARTS_PER_SUPPLIER = 20
SHELF_LIFE_REVISION_DATE = dt.date(2026, 6, 1)
SHELF_LIFE_FIRST_DATE = dt.date(2026, 1, 1)


def padded_id(prefix: str, key: Column, width: int) -> Column:
    """prefix + key zero-padded to ``width`` digits (wider keys keep all digits).

    ``lpad`` alone would cut a wider key; ``format_string`` is exact but parses
    its pattern on every row (3x slower on the dense spine).
    """
    digits = key.cast("string")
    return F.concat(F.lit(prefix),
                    F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits))


def store_id(key: Column) -> Column:
    return padded_id("S", key, 3)


def product_id(key: Column) -> Column:
    return padded_id("P", key, 5)


def supplier_id(key: Column) -> Column:
    return padded_id("SUP", key, 4)


def _iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def season_day(ts: Column) -> Column:
    """Day of the season a shipment is replayed on, 0 .. SEASON_DAYS-1."""
    days = F.datediff(ts.cast("date"), F.lit(SHIP_EPOCH))
    return ((days % SEASON_DAYS) + SEASON_DAYS) % SEASON_DAYS


# --------------------------------------------------------------------------- #
# Dimensions
# --------------------------------------------------------------------------- #
def raw_dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    k = F.col("n_nationkey")
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(
            store_id(k).alias("store_id"),
            F.col("n_name").alias("store_name"),
            F.when(k % 3 == 0, "Supercenter").when(k % 3 == 1, "Neighborhood")
            .otherwise("Express").alias("store_format"),
            F.col("n_name").alias("city"),
            F.format_string("ST%02d", k).alias("state"),
            F.col("r_name").alias("region"),
            ((k % 11) + 5).cast("double").__truediv__(F.lit(10)).alias("size_factor"),
            _iso(F.date_add(F.lit(dt.date(2015, 1, 1)), (k * 91).cast("int"))).alias("open_date"),
        )
    )


def raw_dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    k = F.col("s_suppkey")
    return s.select(
        supplier_id(k).alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        (k % 5 + 1).alias("lead_time_days"),
        ((k % 15) + 85).cast("double").__truediv__(F.lit(100)).alias("reliability"),
    )


def raw_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size",
                   "p_retailprice")
    k = F.col("p_partkey")
    return p.select(
        product_id(k).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        supplier_id(F.floor(k / PARTS_PER_SUPPLIER)).alias("supplier_id"),
        F.col("p_retailprice").alias("unit_price"),
        round_half_away(F.col("p_retailprice") * F.lit(0.65), 2).alias("unit_cost"),
        F.col("p_size").cast("double").__truediv__(F.lit(50)).alias("popularity"),
    )


def current_shelf_life_days(p_size: Column) -> Column:
    return (p_size % 10 + 1).cast("int")


def raw_shelf_life_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacked shelf-life revisions as an all-string extract, with dirty rows.

    Per part k (life L = 1 + p_size % 10):
      * the current revision (from 2026-06-01 when k % 10 == 0, else 2026-01-01);
        its id is padded lower case when k % 7 == 3
      * k % 10 == 0: an earlier revision with life L + 1 from 2026-01-01
      * k % 10 == 5: a same-day duplicate with life L - 1 (the larger life wins)
      * k % 10 == 7: junk: a bad id, a zero life, an unparsable life and an
        unparsable date (all rejected)
    One pass over ``part``: the rows of a part are an array exploded in place.
    """
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    k, life = F.col("p_partkey"), current_shelf_life_days(F.col("p_size"))
    pid = product_id(k)
    messy_id = F.when(k % 7 == 3, F.concat(F.lit(" "), F.lower(pid), F.lit(" "))).otherwise(pid)
    first, revised = F.lit(SHELF_LIFE_FIRST_DATE.isoformat()), F.lit(SHELF_LIFE_REVISION_DATE.isoformat())

    def row(cond: Column | None, pid_text: Column, life_text: Column, from_text: Column) -> Column:
        s = F.struct(pid_text.alias("product_id"), life_text.alias("shelf_life_days"),
                     from_text.alias("effective_from"))
        return s if cond is None else F.when(cond, s)

    rows = F.array(
        row(None, messy_id, life.cast("string"), F.when(k % 10 == 0, revised).otherwise(first)),
        row(k % 10 == 0, pid, (life + 1).cast("string"), first),
        row(k % 10 == 5, pid, (life - 1).cast("string"), first),
        row(k % 10 == 7, F.concat(F.lit("bad-"), k.cast("string")), F.lit("3"), first),
        row(k % 10 == 7, pid, F.lit("0"), F.lit("2026-03-01")),
        row(k % 10 == 7, pid, F.lit("x"), F.lit("2026-03-02")),
        row(k % 10 == 7, pid, F.lit("4"), F.lit("not-a-date")),
    )
    return (
        p.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
        .select("r.product_id", "r.shelf_life_days", "r.effective_from")
    )


def raw_supplier_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier extract as all-string rows, with corrections and junk.

    Per supplier k (lead 1 + k % 5, reliability 0.85 .. 0.99):
      * the base row stamped 2026-07-01T08:00:00; id padded lower case when k % 6 == 1
      * k % 4 == 0: a later correction (name + ' (rev)', lead + 1) that must win
      * k % 6 == 2: a stale copy without a timestamp that must lose
      * k % 10 == 3: a bad id; k % 10 == 5: reliability 1.50; k % 10 == 7: lead -1;
        k % 10 == 9: lead 'n/a' -- all stamped later, all rejected before dedupe
    """
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    k = F.col("s_suppkey")
    sid = supplier_id(k)
    lead = (k % 5 + 1)
    rel = F.concat(F.lit("0."), (k % 15 + 85).cast("string"))
    messy_id = F.when(k % 6 == 1, F.concat(F.lit(" "), F.lower(sid), F.lit(" "))).otherwise(sid)
    name = F.col("s_name")
    t0, t1, t2 = (F.lit("2026-07-01T08:00:00"), F.lit("2026-07-02T08:00:00"),
                  F.lit("2026-07-03T08:00:00"))

    def row(cond, id_text, name_text, lead_text, rel_text, ts_text) -> Column:
        s_ = F.struct(id_text.alias("supplier_id"), name_text.alias("supplier_name"),
                      lead_text.alias("lead_time_days"), rel_text.alias("reliability"),
                      ts_text.alias("extract_ts"))
        return s_ if cond is None else F.when(cond, s_)

    rows = F.array(
        row(None, messy_id, F.concat(F.lit("  "), name, F.lit(" ")), lead.cast("string"), rel, t0),
        row(k % 4 == 0, sid, F.concat(name, F.lit(" (rev)")), (lead + 1).cast("string"), rel, t1),
        row(k % 6 == 2, sid, F.concat(name, F.lit(" (stale)")), F.lit("9"), F.lit("0.50"),
            F.lit(None).cast("string")),
        row(k % 10 == 3, F.concat(F.lit("bad-"), k.cast("string")), name, F.lit("2"), F.lit("0.90"), t2),
        row(k % 10 == 5, sid, name, F.lit("1"), F.lit("1.50"), t2),
        row(k % 10 == 7, sid, name, F.lit("-1"), F.lit("0.80"), t2),
        row(k % 10 == 9, sid, name, F.lit("n/a"), F.lit("0.80"), t2),
    )
    return (
        s.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
        .select("r.supplier_id", "r.supplier_name", "r.lead_time_days", "r.reliability",
                "r.extract_ts")
    )


# --------------------------------------------------------------------------- #
# Facts
# --------------------------------------------------------------------------- #
def sales_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units shipped per (nation, part, season day) over all line items.

    Orders meet customers first (the smaller join), then line items; the
    aggregate combines map-side before its shuffle, so a hot part or nation
    reaches the exchange already collapsed to one row per key and task.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity",
                    "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    order_nation = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "c_nationkey")
    return (
        li.where(F.col("l_partkey").isNotNull())  # a line item without a part sells no product
        .join(order_nation, li.l_orderkey == order_nation.o_orderkey)
        .groupBy(F.col("c_nationkey").alias("store_key"), F.col("l_partkey").alias("product_key"),
                 season_day(F.col("l_shipdate")).alias("day"))
        .agg(F.sum("l_quantity").alias("qty"))
    )


def raw_fact_sales(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """``keys``: the result of ``sales_by_key`` if it is stored already."""
    agg = sales_by_key(spark, sf_dir) if keys is None else keys
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    units = F.col("qty").cast("bigint")
    return (
        agg.join(part, agg.product_key == part.p_partkey)
        .select(
            store_id(F.col("store_key")).alias("store_id"),
            product_id(F.col("product_key")).alias("product_id"),
            F.date_add(F.lit(SEASON_START), F.col("day")).alias("sale_date"),
            units.alias("units_sold"),
            F.col("p_retailprice").alias("unit_price"),
            round_half_away(units * F.col("p_retailprice"), 2).alias("revenue"),
        )
    )


def inventory_quantities(s: Column, p: Column, t: Column) -> dict[str, Column]:
    """End-of-day quantities of store s, product p on season day t."""
    on_hand = F.greatest((p * 7 + s * 13 + t * 5) % 40 - 4, F.lit(0))
    return {
        "on_hand_qty": on_hand,
        "received_qty": F.when((p + s + t) % 3 == 0, p % 20 + 5).otherwise(F.lit(0)),
        "oldest_batch_age_days": F.when(on_hand == 0, F.lit(0)).otherwise((p + t) % 6),
        "spoiled_qty": F.when((on_hand > 0) & ((p * 3 + s + t) % 11 == 0), (p + s) % 7 + 1)
        .otherwise(F.lit(0)),
        "unmet_demand": F.when(on_hand == 0, (p + s + t) % 4).otherwise(F.lit(0)),
    }


def selling_pairs(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """Every (store, product) pair that sold, with its keys and ids. ``keys`` as in ``raw_fact_sales``."""
    keys = sales_by_key(spark, sf_dir) if keys is None else keys
    return keys.select("store_key", "product_key").distinct().select(
        "*", store_id(F.col("store_key")).alias("store_id"), product_id(F.col("product_key")).alias("product_id"))


def raw_fact_inventory_snapshot(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None,
                                pairs: DataFrame | None = None) -> DataFrame:
    """Dense snapshot: every selling (store, product) pair on every season day.

    ``keys`` as in ``raw_fact_sales``, ``pairs`` the result of ``selling_pairs`` if it is stored already; a partition's rows keep the
    order of its pairs.
    """
    pairs = selling_pairs(spark, sf_dir, keys) if pairs is None else pairs
    spine = pairs.select("store_key", "product_key", "store_id", "product_id",
                         F.explode(F.sequence(F.lit(0), F.lit(SEASON_DAYS - 1))).alias("day"))
    s, p, t = F.col("store_key"), F.col("product_key"), F.col("day")
    q = inventory_quantities(s, p, t)
    return spine.select(
        "store_id",
        "product_id",
        F.date_add(F.lit(SEASON_START), t).alias("snapshot_date"),
        *[c.cast("bigint").alias(name) for name, c in q.items()],
    )


def raw_dim_date(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """Calendar rows for every day between the first and last sale day."""
    from shelfrisk.functions.calendar import date_rows

    span = (sales_by_key(spark, sf_dir) if keys is None else keys).agg(
        F.date_add(F.lit(SEASON_START), F.min("day")).alias("start"),
        F.date_add(F.lit(SEASON_START), F.max("day")).alias("end"),
    )
    return date_rows(span, "start", "end", raw=True)
