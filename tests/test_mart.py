"""Landed facts, the published mart, its manifest, and upkeep by change sets."""
from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from conftest import SMOKE_DIR
from shelfrisk.operators import quality, risk
from shelfrisk.plans import catalog
from shelfrisk.plans.mart import Conflict, Mart, Refused
from shelfrisk.plans.warehouse import Warehouse
from shelfrisk.session import scratch_path
from shelfrisk.sources import domain, files, landing, schemas

LAYOUT = StructType([StructField("k", StringType()), StructField("n", IntegerType()), StructField("day", DateType())])
D0 = dt.date(2031, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse.of(spark, SMOKE_DIR)


# -- landed facts ----------------------------------------------------------------
def test_one_read_of_the_line_items_lands_both_facts(spark, monkeypatch):
    reads = []
    real = domain.read_table
    monkeypatch.setattr(domain, "read_table", lambda s, d, name, *c: reads.append(name) or real(s, d, name, *c))
    landed = landing.land(spark, SMOKE_DIR, buckets=3)
    assert reads.count("lineitem") == 1
    assert landed.sales.schema == schemas.FACT_SALES and landed.inventory.schema == schemas.FACT_INVENTORY_SNAPSHOT
    assert landed.shelf_life.schema == schemas.DIM_SHELF_LIFE
    assert len(landed.sales.inputFiles()) <= 3 and len(landed.inventory.inputFiles()) <= 3  # a file per bucket
    pairs = landed.inventory.groupBy("store_id", "product_id").count()
    assert pairs.where(F.col("count") != domain.SEASON_DAYS).count() == 0
    assert landed.sales.join(landed.inventory, ["store_id", "product_id"], "left_anti").count() == 0


def test_gold_reads_no_line_item_and_moves_no_fact(warehouse, spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (old, "-1"):  # with -1 as at scale: the product attributes are shuffled, the facts still are not
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            gold, units = plan_of(warehouse.gold()), plan_of(warehouse.velocity())
            attributes = plan_of(risk.product_attributes(warehouse.products, warehouse.suppliers, warehouse.shelf_life))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert "lineitem" not in gold and "Exchange" not in units and "SortMergeJoin" in units
        assert gold.count("Exchange") <= attributes.count("Exchange") + 1  # the product attributes go to the facts


def test_a_table_that_does_not_match_its_schema_is_refused(spark):
    df = spark.createDataFrame([("a", "1", "2031-01-01")], "k string, n string, day string")
    assert landing.as_declared(df.select("day", "n", "k"), LAYOUT).first() == ("a", 1, D0)
    with pytest.raises(ValueError, match="missing .'n'."):
        landing.as_declared(df.drop("n"), LAYOUT)
    with pytest.raises(ValueError, match="undeclared .'extra'."):
        landing.as_declared(df.withColumn("extra", F.lit(1)), LAYOUT)


def test_changed_input_gets_a_new_warehouse(spark, tmp_path):
    for t in catalog.Warehouse.of(spark, SMOKE_DIR) and ("nation", "region", "supplier", "part", "customer", "orders", "lineitem"):
        spark.read.parquet(f"{SMOKE_DIR}/{t}.parquet").coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
    first = Warehouse.of(spark, str(tmp_path))
    assert Warehouse.of(spark, str(tmp_path)) is first
    spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet").limit(50).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert Warehouse.of(spark, str(tmp_path)) is not first


# -- write, audit, publish -----------------------------------------------------------
def new_mart(spark, **options):
    return Mart(spark, scratch_path(spark, "test-mart"), LAYOUT, "day", ("k",), ("n",), **options)


def rows(spark, *given):
    return spark.createDataFrame([(k, n, D0 + dt.timedelta(days=d)) for k, n, d in given], LAYOUT)


def suite(df):
    return quality.grain_and_row_checks(df, "t", ["k", "day"], {"n >= 0": quality.below("n", 0)})


def content(mart):
    return sorted((r.k, r.n, (r.day - D0).days) for r in mart.read().collect())


def test_publish_refuse_and_replace(spark):
    mart = new_mart(spark)
    assert mart.manifest() is None and mart.newest() is None and content(mart) == []
    assert mart.publish(rows(spark, ("a", 1, 0), ("b", 5, 0), ("a", 2, 1), ("a", 9, 3)), suite).version == 1
    first = {p.value: p for p in mart.partitions()}
    assert [(p.value, p.rows, p.bounds["n"]) for p in mart.partitions()] == [("2031-01-01", 2, (1, 5)), ("2031-01-02", 1, (2, 2)), ("2031-01-04", 1, (9, 9))]

    for bad in (rows(spark, ("a", -1, 0)), rows(spark, ("a", 1, 0), ("a", 2, 0))):
        outcome = mart.publish(bad, suite)
        assert outcome.version is None and any(not c["passed"] for c in outcome.checks)
        with pytest.raises(Refused):
            mart.publish_or_raise(bad, suite, replace=["2031-01-01"])
    assert mart.publish(rows(spark, ("a", 1, 0)), lambda df: suite(df).limit(0)).version is None  # no check, no publish
    assert mart.manifest().version == 1 and len(content(mart)) == 4

    assert mart.publish(rows(spark, ("c", 7, 1)), suite, replace=["2031-01-02", "2031-01-04"]).version == 2
    assert content(mart) == [("a", 1, 0), ("b", 5, 0), ("c", 7, 1)]  # the 4th got no rows and is gone
    assert {p.value: p for p in mart.partitions()}["2031-01-01"] == first["2031-01-01"]
    with pytest.raises(ValueError, match="2031-01-01"):
        mart.publish(rows(spark, ("c", 7, 0)), suite, replace=["2031-01-02"])
    assert mart.manifest().version == 2


def test_readers_keep_their_version_and_a_second_writer_is_told(spark):
    mart = new_mart(spark)
    mart.publish_or_raise(rows(spark, ("a", 1, 0)), suite)
    reader = mart.read()

    def audit_while_another_publishes(staged):
        other = Mart(spark, mart.root, LAYOUT, "day", ("k",), ("n",))
        other.publish_or_raise(rows(spark, ("other", 2, 0)), suite)
        return suite(staged)

    with pytest.raises(Conflict):
        mart.publish(rows(spark, ("mine", 3, 0)), audit_while_another_publishes)
    assert content(mart) == [("other", 2, 0)] and [r.k for r in reader.collect()] == ["a"]


def test_days_come_from_the_manifest_alone(spark, warehouse):
    mart = warehouse.gold_mart()
    df = catalog.QUERIES["available_dates"](spark, SMOKE_DIR)
    assert "Scan parquet" not in plan_of(df) and "FileScan" not in plan_of(df)
    days = [r[0] for r in df.collect()]
    stored = [str(r[0]) for r in mart.read().select("snapshot_date").distinct().orderBy(F.desc("snapshot_date")).collect()]
    assert days == stored and mart.newest() == stored[0]
    one = mart.read().where(F.col("snapshot_date") == F.to_date(F.lit(mart.newest())))
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().toString()
    assert sum(p.rows for p in mart.partitions() if p.value == mart.newest()) == one.count()
    assert files.listed(spark, f"{mart.root}/nothing") == []


def test_build_stamps_are_stored_as_numbers(spark, warehouse):
    mart = warehouse.gold_mart()
    folder = f"{mart.root}/{mart.partitions()[0].folder}"
    stored = next(f for f, _, _ in files.listed(spark, folder) if f.endswith(".parquet"))
    assert str(pq.read_schema(stored.removeprefix("file:")).field("computed_at").type) == "timestamp[us, tz=UTC]"  # [ns] if of 96 bits
    assert mart.read().where("computed_at IS NULL OR computed_at > current_timestamp()").count() == 0


# -- upkeep ---------------------------------------------------------------------------
def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_day_equals_full_build(spark, warehouse):
    day = "2026-07-20"
    full = warehouse.gold().where(F.col("snapshot_date") == F.to_date(F.lit(day)))
    assert full.count() > 0 and same(full, warehouse.gold_for_day(day))
    mart = warehouse.new_gold_mart("test-day")
    warehouse.publish_gold(mart, warehouse.gold())
    before = {p.value: p.folder for p in mart.partitions()}
    warehouse.refresh_gold_day(mart, day)
    after = {p.value: p.folder for p in mart.partitions()}
    assert {d for d in before if before[d] != after[d]} == {day}
    assert same(mart.read().select(*risk.GOLD_COLUMNS), warehouse.gold())


def test_late_sales_rebuild_exactly_the_days_in_reach(spark, warehouse):
    day = F.datediff("sale_date", F.lit(domain.SEASON_START))
    late = day.isin(5, 7, 27) & F.col("store_id").isin("S003", "S011")
    mart = warehouse.new_gold_mart("test-late")
    warehouse.publish_gold(mart, warehouse.gold_from(warehouse.sales.where(~late)))
    assert not same(mart.read().select(*risk.GOLD_COLUMNS), warehouse.gold())
    before = {p.value: p.folder for p in mart.partitions()}
    touched = warehouse.refresh_gold(mart, warehouse.sales, warehouse.sales.where(late))
    reach = {str(domain.SEASON_START + dt.timedelta(days=d)) for d in (*range(5, 14), 27, 28, 29)}
    assert set(touched) == reach
    after = {p.value: p.folder for p in mart.partitions()}
    assert {d for d in before if before[d] != after[d]} == reach  # the others keep their files
    assert same(mart.read().select(*risk.GOLD_COLUMNS), warehouse.gold())
    assert warehouse.refresh_gold(mart, warehouse.sales, warehouse.sales.limit(0)) == [] and mart.manifest().version == 2


def test_sales_that_went_are_taken_back(spark, warehouse):
    gone = (F.col("sale_date") == F.lit(dt.date(2026, 7, 10))) & F.col("product_id").endswith("3")
    mart = warehouse.new_gold_mart("test-gone")
    warehouse.publish_gold(mart, warehouse.gold())
    warehouse.refresh_gold(mart, warehouse.sales.where(~gone), warehouse.sales.where(gone))
    assert same(mart.read().select(*risk.GOLD_COLUMNS), warehouse.gold_from(warehouse.sales.where(~gone)))


# -- facts and mart lie where they are used -----------------------------------------------
def test_a_fact_lands_when_it_is_first_read(spark):
    landed = landing.land(spark, SMOKE_DIR, buckets=3)
    written = []
    landed._makers = {name: lambda name=name, make=make: written.append(name) or make() for name, make in landed._makers.items()}
    assert landed.sales_keys.count() > 0 and landed.sales.count() > 0 and landed.sales.count() > 0
    assert written == ["sales"]  # queries of the sales don't wait for the snapshot
    assert landed.inventory.count() > 0 and landed.shelf_life.count() > 0 and written == ["sales", "inventory", "shelf_life"]


def test_series_are_merged_and_windowed_as_they_lie(warehouse):
    assert "Sort [" not in plan_of(warehouse.velocity())


def test_buckets_follow_the_rows(spark):
    shuffled, cores = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    assert landing.bucket_count(spark, 0) == min(shuffled, 2 * cores)
    assert landing.bucket_count(spark, 50 * landing.MOST) == 50 and landing.bucket_count(spark, 50 * landing.MOST + 1) == 51


def test_the_mart_is_written_audited_and_read_where_the_facts_lie(spark, warehouse):
    mart = warehouse.new_gold_mart("test-buckets")
    staged = []

    def audit(df):
        staged.append(plan_of(quality.risk_suite(df)))
        return quality.risk_suite(df)

    mart.publish_or_raise(risk.with_computed_at(warehouse.gold()), audit)
    assert "hashpartitioning" not in staged[0] and "Bucketed: true" in staged[0]
    gold = mart.read()
    twice = gold.unionByName(gold.where(F.col("on_hand_qty") == 1))
    for df in (quality.risk_suite(gold), quality.violating_duplicates(gold, schemas.GRAIN), quality.violating_duplicates(twice, schemas.GRAIN)):
        assert "hashpartitioning" not in plan_of(df)
    assert quality.violating_duplicates(twice, schemas.GRAIN).count() == gold.where(F.col("on_hand_qty") == 1).count() > 0
    generation = mart.partitions()[0].folder.rsplit("/", 1)[0]
    assert all(f"/{generation}/snapshot_date=" in f for f in gold.inputFiles())
    # One that knows the folders only reads the same rows, and so does a part of a generation.
    other = Mart(spark, mart.root, mart.schema, mart.partition_col, mart.sort_cols, mart.bound_cols)
    assert same(other.read(), gold)
    some = mart.partitions()[3:5]
    assert same(mart._rows(some), gold.where(F.col("snapshot_date").cast("string").isin([p.value for p in some])))


def test_bounds_are_found_without_sorting_every_row(spark, warehouse):
    for p in warehouse.gold_mart().partitions()[:2]:
        day = warehouse.gold().where(F.col("snapshot_date").cast("string") == p.value)
        assert (p.rows, p.bounds["product_id"]) == (day.count(), tuple(day.agg(F.min("product_id"), F.max("product_id")).first()))
        assert p.bounds["stockout_risk_score"] == tuple(day.agg(F.min("stockout_risk_score"), F.max("stockout_risk_score")).first())


def test_the_snapshot_lies_in_the_order_that_its_table_declares(spark):
    landed = landing.land(spark, SMOKE_DIR, buckets=3)
    for df, day in ((landed.inventory, "snapshot_date"), (landed.sales, "sale_date")):
        for file in df.inputFiles():
            held = [tuple(r) for r in spark.read.parquet(file).coalesce(1).select("product_id", "store_id", day).collect()]
            assert held == sorted(held)
    held = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    assert held in (None, "0")  # only while the snapshot is written


def test_scores_are_rounded_without_decimal_texts(warehouse):
    assert " round(" not in plan_of(warehouse.gold())


def test_an_audit_that_passes_groups_no_row_by_its_day(spark, warehouse, monkeypatch):
    gold = risk.with_computed_at(warehouse.gold())
    exact = [tuple(r) for r in quality.risk_suite(gold).collect()]
    monkeypatch.setattr(quality, "grain_and_row_checks", None)  # not needed
    assert [tuple(r) for r in quality.risk_audit(gold).collect()] == exact and all(r[3] for r in exact)


@pytest.mark.parametrize("bad", [
    [("a", 1, 0), ("a", 1, 0)], [("a", 1, 0), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0), ("b", 1, 0)], [("a", -1, 0), ("b", 1, 0)],
    [("a", 1, -40_000), ("a", 1, -40_000)], [(None, 1, 0), (None, 1, 0)], [("a", -1, 0), (None, -1, 0)]])
def test_the_audit_counts_what_the_suite_counts(spark, bad):
    good = [("a", 1, d) for d in (*range(1, 200), -40_001, -39_999)]
    df = rows(spark, *good, *bad).unionByName(spark.createDataFrame([("a", 1, None), ("a", 1, None)], LAYOUT))
    checks = {"n >= 0": quality.below("n", 0)}
    got, exact = quality.grain_holds(df, "t", ["k"], "day", checks), quality.grain_and_row_checks(df, "t", ["k", "day"], checks)
    assert got.dtypes == exact.dtypes and [tuple(r) for r in got.collect()] == [tuple(r) for r in exact.collect()]
    assert all(r["passed"] for r in exact.collect()) == (bad[0][0] is None)


# -- a mart without the stored snapshot, sorted before it is scored, described by its audit ----------
def test_the_mart_needs_no_stored_snapshot(spark, monkeypatch):
    w = Warehouse(spark, SMOKE_DIR)
    monkeypatch.setattr(Mart, "_described", None)  # the audit's scans tell what the manifest says
    mart = w.gold_mart()
    assert "inventory" not in w.landed._made and "sales" in w.landed._made
    assert same(w.snapshot, w.inventory) and w.snapshot.dtypes == w.inventory.dtypes
    v = w.velocity()  # over the stored snapshot
    stored = risk.risk(v, w.products, w.suppliers, w.shelf_life)
    assert same(mart.read().select(*risk.GOLD_COLUMNS), stored)


def test_rows_are_put_in_order_of_their_day_before_they_are_scored(spark):
    w = Warehouse(spark, SMOKE_DIR)
    plan = w.gold()._jdf.queryExecution().optimizedPlan().toString()
    by_day = plan.index("Sort [snapshot_date")
    assert plan.index("spoilage_risk_score") < by_day < plan.index("Window") and "Sort [snapshot_date" not in plan[by_day + 1:]
    held = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    mart = w.gold_mart()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == held
    for p in mart.partitions()[:2]:  # a file per bucket and day, its rows in order of the series
        files_of_day = [f for f, _, _ in files.listed(spark, f"{mart.root}/{p.folder}") if f.endswith(".parquet")]
        assert 0 < len(files_of_day) <= w.landed.buckets
        assert sum(spark.read.parquet(f).count() for f in files_of_day) == p.rows


def test_partitions_written_out_of_order_are_whole(spark):
    given = [(f"k{i // 70}", i, i * 11 % 70) for i in range(700)]  # more partitions than files kept open, each back and forth
    mart = new_mart(spark, bucket=("k", 3))
    mart.publish_or_raise(rows(spark, *given), suite, in_order=True)
    assert content(mart) == sorted(given) and len(mart.partitions()) == 70


@pytest.mark.parametrize("extra", [[], [("a", 1, 0)], [("a", 1, 0), ("a", 2, 0), ("b", -3, 5)], [(None, 4, 2), (None, 4, 2)]])
def test_the_audit_describes_partitions_as_a_scan_of_its_own_does(spark, extra):
    df = rows(spark, *[("abc"[i % 3], i, d) for i, d in enumerate((*range(0, 90), *range(-200, -100)))], *[(k, 5, d) for k in ("a0", "b", "zz") for d in (0, 70, 500)], *extra)
    checks = {"n >= 0": quality.below("n", 0)}
    found, profile = quality.grain_profile(df, "t", ["k"], "day", checks, ("k", "n"))
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in quality.grain_and_row_checks(df, "t", ["k", "day"], checks).collect()]
    described = {p.value: (p.rows, p.bounds) for p in new_mart(spark)._described(df, "g")}
    described_k = {p.value: (p.rows, p.bounds) for p in Mart(spark, "r", LAYOUT, "day", ("k",), ("k", "n"))._described(df, "g")}
    assert {str(d): (n, {"n": b["n"]}) for d, (n, b) in profile.items()} == described
    assert {str(d): v for d, v in profile.items()} == described_k


def test_a_snapshot_is_partitioned_by_day_where_it_lies(spark, monkeypatch):
    from shelfrisk.sources import lake
    plans, real = [], lake._overwrite_partitions
    monkeypatch.setattr(lake, "_overwrite_partitions", lambda df, *a: plans.append(plan_of(df)) or real(df, *a))
    monkeypatch.setattr(Warehouse, "_instances", {})
    one_day = catalog.QUERIES["partition_prune"](spark, SMOKE_DIR)
    w = Warehouse.of(spark, SMOKE_DIR)
    assert "inventory" not in w.landed._made and len(plans) == 1 and "Exchange" not in plans[0] and "rebalance" not in plans[0].lower()
    assert same(one_day, w.inventory.where(F.col("snapshot_date") == F.to_date(F.lit(catalog.LAST_SEASON_DAY))))


def test_partitions_written_in_order_replace_only_their_own(spark):
    from shelfrisk.sources import lake
    path = scratch_path(spark, "test-in-order")
    first = rows(spark, *[(f"k{i}", i, d) for d in range(90) for i in range(3)])  # more partitions than files kept open
    lake.write_partitioned(first.coalesce(1), path, ["day"], in_order=True)
    lake.write_partitioned(rows(spark, ("z", 1, 5), ("z", 2, 7)), path, ["day"], in_order=True)
    got = sorted((r.k, r.n, (r.day - D0).days) for r in lake.read_partitions(spark, path).collect())
    assert got == sorted([(f"k{i}", i, d) for d in range(90) if d not in (5, 7) for i in range(3)] + [("z", 1, 5), ("z", 2, 7)])


def test_the_suite_over_the_mart_groups_no_row_by_its_day(spark, warehouse, monkeypatch):
    exact = [tuple(r) for r in quality.risk_suite(warehouse.gold_table()).collect()]
    monkeypatch.setattr(quality, "grain_and_row_checks", None)  # not needed
    assert [tuple(r) for r in catalog.QUERIES["dq_suite_risk"](spark, SMOKE_DIR).collect()] == exact


def test_foreign_keys_of_facts_are_counted_by_one_key_at_a_time(spark, monkeypatch):
    given, real = [], quality.relationships
    monkeypatch.setattr(quality, "relationships", lambda children, parents: given.extend(children) or real(children, parents))
    monkeypatch.setattr(Warehouse, "_instances", {})
    got = {(r["target"], r["check"]): r["violations"] for r in catalog.QUERIES["dq_relationships"](spark, SMOKE_DIR).collect()}
    w = Warehouse.of(spark, SMOKE_DIR)
    assert "inventory" not in w.landed._made and all(len(columns) == 1 for _, columns, _ in given) and len(given) == 9
    for col in ("store_id", "product_id"):
        orphans = w.inventory.where(F.col(col).endswith("7")).count()
        assert got["fact_inventory_snapshot[seeded]", f"relationship({col})"] == orphans > 0 == got["fact_inventory_snapshot", f"relationship({col})"]


def test_the_gate_publishes_its_own_good_build(spark, monkeypatch):
    monkeypatch.setattr(quality, "grain_and_row_checks", None)  # not needed
    monkeypatch.setattr(Warehouse, "_instances", {})
    got = catalog.QUERIES["dq_gate"](spark, SMOKE_DIR).collect()
    w = Warehouse.of(spark, SMOKE_DIR)
    assert not w._marts  # no third copy of the gold rows
    monkeypatch.undo()
    faulty = {r["check"]: r["violations"] for r in quality.risk_suite(catalog.broken(risk.with_computed_at(w.gold()))).collect()}
    assert {r["check"]: r["violations"] for r in got if r["build"] == "broken"} == faulty and sum(faulty.values()) > 0
    assert {(r["build"], r["published"]) for r in got} == {("good", True), ("broken", False)} and {r["visible_rows"] for r in got} == {w.gold().count()}


def test_upkeep_needs_no_stored_snapshot(spark, monkeypatch):
    monkeypatch.setattr(Warehouse, "_instances", {})
    got = catalog.QUERIES["risk_gold_incremental"](spark, SMOKE_DIR)
    w = Warehouse.of(spark, SMOKE_DIR)
    assert "inventory" not in w.landed._made and same(got, w.gold())
