"""The warehouse: staged dims, landed facts, velocity, and the published gold mart.

``Warehouse(spark, sf_dir)`` derives the raw domain tables from the driver's Parquet files, stages them, and
exposes the intermediate and gold models. Facts are landed once (``sources.landing``) when first asked for, the gold mart is
published once (``plans.mart``); everything else stays a lazy plan that Catalyst optimises end to end.
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrisk.functions.numeric import round_half_away
from shelfrisk.operators import quality, risk, staging, velocity
from shelfrisk.plans.mart import Mart
from shelfrisk.session import configure, scratch_path
from shelfrisk.sources import domain, files, landing, schemas
from shelfrisk.sources.landing import as_declared
from shelfrisk.sources.schemas import SELL_THROUGH_WINDOW_DAYS, SPOILAGE_FLAG_THRESHOLD

SOURCE_TABLES = ("nation", "region", "supplier", "part", "customer", "orders", "lineitem")


class Warehouse:
    _instances: dict[tuple, "Warehouse"] = {}
    _lock = threading.Lock()

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self._marts: dict[tuple, Mart] = {}
        self._mart_lock = threading.Lock()
        self._land_lock = threading.Lock()
        self._landed: landing.Landed | None = None

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        """One warehouse per session and state of the input files.

        Queries of one session share the landed facts and published marts; when a source file changes, the next
        query gets a new warehouse.
        """
        source = files.fingerprint(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES])
        key = (spark.sparkContext.applicationId, id(spark._jsparkSession), sf_dir, source)
        with cls._lock:
            if key not in cls._instances:
                cls._instances[key] = cls(spark, sf_dir)
            return cls._instances[key]

    @property
    def landed(self) -> landing.Landed:
        with self._land_lock:
            if self._landed is None:
                self._landed = landing.land(self.spark, self.sf_dir)
            return self._landed

    # -- raw landing tables ------------------------------------------------
    @cached_property
    def raw_supplier_extract(self) -> DataFrame:
        return domain.raw_supplier_extract(self.spark, self.sf_dir)

    @cached_property
    def raw_shelf_life_extract(self) -> DataFrame:
        return domain.raw_shelf_life_extract(self.spark, self.sf_dir)

    # -- staged dimensions ---------------------------------------------------
    @cached_property
    def stores(self) -> DataFrame:
        return as_declared(staging.stage_stores(domain.raw_dim_store(self.spark, self.sf_dir)), schemas.DIM_STORE)

    @cached_property
    def suppliers(self) -> DataFrame:
        return as_declared(staging.stage_suppliers(domain.raw_dim_supplier(self.spark, self.sf_dir)), schemas.DIM_SUPPLIER)

    @cached_property
    def products(self) -> DataFrame:
        return as_declared(staging.stage_products(domain.raw_dim_product(self.spark, self.sf_dir)), schemas.DIM_PRODUCT)

    @cached_property
    def shelf_life(self) -> DataFrame:
        """SCD2 shelf-life history, landed from the dirty revision extract."""
        return self.landed.shelf_life

    @cached_property
    def dates(self) -> DataFrame:
        return as_declared(staging.stage_date(domain.raw_dim_date(self.spark, self.sf_dir, self.landed.sales_keys)), schemas.DIM_DATE)

    # -- landed facts --------------------------------------------------------
    @property
    def sales(self) -> DataFrame:
        return self.landed.sales

    @property
    def inventory(self) -> DataFrame:
        return self.landed.inventory

    @property
    def snapshot(self) -> DataFrame:
        """The rows of ``inventory``, for one pass over them: not stored."""
        return self.landed.snapshot

    # -- marts -----------------------------------------------------------------
    @cached_property
    def dim_product(self) -> DataFrame:
        """Products with supplier name and unit margin (left join: keep orphans)."""
        s = self.suppliers.select("supplier_id", "supplier_name")
        return self.products.join(s, "supplier_id", "left").select(
            "product_id", "product_name", "category", "supplier_id", "supplier_name",
            "unit_price", "unit_cost",
            round_half_away(F.col("unit_price") - F.col("unit_cost"), 2).alias("unit_margin"),
            "popularity",
        )

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose staging and marts as session temp views for ``spark.sql``
        users (views stay lazy plans; only the gold mart is stored)."""
        views = {
            "dim_store": self.stores, "dim_product": self.dim_product,
            "dim_supplier": self.suppliers, "dim_shelf_life": self.shelf_life,
            "dim_date": self.dates, "fact_sales": self.sales,
            "fact_inventory_snapshot": self.inventory,
            "int_inventory_sell_through": self.velocity(),
            "perishables_risk": self.gold_table(),
        }
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + n for n in views]

    def velocity(self, window_days: int = SELL_THROUGH_WINDOW_DAYS) -> DataFrame:
        return velocity.sell_through(self.inventory, self.sales, window_days, partition_col=None)

    def gold(self, window_days: int = SELL_THROUGH_WINDOW_DAYS,
             threshold: float = SPOILAGE_FLAG_THRESHOLD) -> DataFrame:
        """The gold plan over the sales as landed and the snapshot as it is made."""
        return self.gold_from(self.sales, window_days, threshold)

    def gold_from(self, sales: DataFrame, window_days: int = SELL_THROUGH_WINDOW_DAYS,
                  threshold: float = SPOILAGE_FLAG_THRESHOLD) -> DataFrame:
        """The gold plan with another sales fact. Its rows come by day inside a bucket, as the mart is written."""
        v = velocity.sell_through(self.snapshot, sales, window_days, partition_col=None)
        return risk.risk(v, self.products, self.suppliers, self.shelf_life, threshold, by_day=True)

    def gold_for_day(self, day, window_days: int = SELL_THROUGH_WINDOW_DAYS,
                     threshold: float = SPOILAGE_FLAG_THRESHOLD) -> DataFrame:
        """Gold rows of one day from only the facts it depends on.

        A day's trailing mean needs the previous ``window_days - 1`` days, so
        the facts are cut to [day - (window_days - 1), day] before the spine
        is built; on stored facts these date filters reach the Parquet scan.
        The result equals the full build's rows for that day.
        """
        d = F.to_date(F.lit(str(day)))
        lo = F.date_sub(d, window_days - 1)
        inv = self.inventory.where(F.col("snapshot_date").between(lo, d))
        sales = self.sales.where(F.col("sale_date").between(lo, d))
        v = velocity.sell_through(inv, sales, window_days, partition_col=None)
        gold = risk.risk(v, self.products, self.suppliers, self.shelf_life, threshold)
        return gold.where(F.col("snapshot_date") == d)

    # -- the published gold mart -------------------------------------------------
    def new_gold_mart(self, name: str) -> Mart:
        """An empty published table with the gold layout."""
        return Mart(self.spark, scratch_path(self.spark, name), schemas.PERISHABLES_RISK, "snapshot_date",
                    ("product_id", "store_id"), ("product_id", "spoilage_risk_score", "stockout_risk_score"), (landing.BUCKET_KEY, self.landed.buckets))

    def publish_gold(self, mart: Mart, gold: DataFrame) -> None:
        """The whole mart anew from rows in the order of ``gold``; raises ``Refused`` if its suite fails."""
        mart.publish_or_raise(risk.with_computed_at(gold), quality.risk_audit, in_order=True)

    def refresh_gold_day(self, mart: Mart, day, window_days: int = SELL_THROUGH_WINDOW_DAYS,
                         threshold: float = SPOILAGE_FLAG_THRESHOLD) -> None:
        """Recompute one day of a published mart; the other days keep their files."""
        rows = risk.with_computed_at(self.gold_for_day(day, window_days, threshold))
        mart.publish_or_raise(rows, quality.risk_audit, replace=[str(day)])

    def refresh_gold(self, mart: Mart, sales: DataFrame, changed: DataFrame, window_days: int = SELL_THROUGH_WINDOW_DAYS,
                     threshold: float = SPOILAGE_FLAG_THRESHOLD) -> list[str]:
        """Bring a published mart up to date after changes of the sales fact; returns the touched days.

        ``sales`` is the fact as it is now, ``changed`` the (store_id, product_id, sale_date) that came late, were
        mended or went. A change reaches its own day and the ``window_days - 1`` days after it, so these cells are scored
        again, from the changed series' days in reach only; the touched days' other rows are carried over
        from the mart, and days that no change reaches keep their files.
        """
        keys = ["store_id", "product_id"]
        cells = (changed.select(*keys, F.explode(F.sequence(F.col("sale_date"), F.date_add("sale_date", window_days - 1))).alias("snapshot_date"))
                 .distinct().join(self.snapshot.select(*keys, "snapshot_date"), [*keys, "snapshot_date"], "left_semi"))
        cells = _stored(cells, self.spark, "changed-cells")
        published = set(mart.values())
        touched = sorted(str(r[0]) for r in cells.select("snapshot_date").distinct().collect())  # days, not rows
        if not touched:
            return []
        series = cells.select(*keys).distinct()
        lo, hi = F.date_sub(F.to_date(F.lit(touched[0])), window_days - 1), F.to_date(F.lit(touched[-1]))
        inv = self.snapshot.where(F.col("snapshot_date").between(lo, hi)).join(series, keys, "left_semi")
        sold = sales.where(F.col("sale_date").between(lo, hi)).join(series, keys, "left_semi")
        v = velocity.sell_through(inv, sold, window_days, partition_col=None)
        scored = risk.risk(v, self.products, self.suppliers, self.shelf_life, threshold)
        fresh = risk.with_computed_at(scored.join(cells, [*keys, "snapshot_date"], "left_semi"))
        carried = mart.read().where(F.col("snapshot_date").isin([F.to_date(F.lit(d)) for d in touched if d in published] or [None]))
        rows = fresh.unionByName(carried.join(cells, [*keys, "snapshot_date"], "left_anti"))
        mart.publish_or_raise(rows, quality.risk_audit, replace=touched)
        return touched

    def gold_mart(self, window_days: int = SELL_THROUGH_WINDOW_DAYS,
                  threshold: float = SPOILAGE_FLAG_THRESHOLD) -> Mart:
        """The gold mart of these parameters, built and published once per warehouse.

        It lies under the shared checkpoint root, partitioned by day: serving queries prune to the days they ask
        for, later queries skip the build, and the lineage is cut (a lost executor re-reads files).
        """
        key = (window_days, threshold)
        with self._mart_lock:
            if key not in self._marts:
                mart = self.new_gold_mart(f"mart-perishables-risk-w{window_days}")
                self.publish_gold(mart, self.gold(window_days, threshold))
                self._marts[key] = mart
            return self._marts[key]

    def gold_table(self, window_days: int = SELL_THROUGH_WINDOW_DAYS,
                   threshold: float = SPOILAGE_FLAG_THRESHOLD) -> DataFrame:
        """The published rows, resolved through the manifest."""
        return self.gold_mart(window_days, threshold).read()


def _stored(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
