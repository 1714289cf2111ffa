"""Dense spine, trailing sell-through and the co-partitioned plan."""
from __future__ import annotations

import datetime as dt

import pytest

from shelfrisk.operators.velocity import densify, sell_through

D0 = dt.date(2026, 7, 1)


def _day(i):
    return D0 + dt.timedelta(days=i)


def test_trailing_mean_uses_zero_days(spark):
    inv = spark.createDataFrame([("S1", "P1", _day(i), 5, 0, 0, 0, 0) for i in range(9)],
                                "store_id string, product_id string, snapshot_date date, "
                                "on_hand_qty int, received_qty int, oldest_batch_age_days int, "
                                "spoiled_qty int, unmet_demand int")
    sales = spark.createDataFrame([("S1", "P1", _day(0), 7), ("S1", "P1", _day(8), 14)],
                                  "store_id string, product_id string, sale_date date, units_sold int")
    got = [r["trailing_avg_daily_sell_through"] for r in
           sell_through(inv, sales, 7).orderBy("snapshot_date").collect()]
    assert got[0] == 7.0 and got[1] == pytest.approx(3.5)   # partial window at series start
    assert got[6] == pytest.approx(1.0) and got[7] == 0.0   # day 0 left the window
    assert got[8] == pytest.approx(2.0)


def test_a_row_costs_the_same_whatever_the_window(spark):
    """Two growing sums instead of a frame that is added up anew for every row; same means, also of other number types."""
    days = [(f"S{s}", "P1", _day(i), 5) for s in range(3) for i in range(40) if (i * 7 + s) % 5]  # rows, not days, are counted
    inv = spark.createDataFrame(days, "store_id string, product_id string, snapshot_date date, on_hand_qty int")
    sold = [(s, p, d, (d.day * 13 + len(s)) % 9) for s, p, d, _ in days if d.day % 3]
    for kind in ("int", "double"):
        sales = spark.createDataFrame(sold, "store_id string, product_id string, sale_date date, units_sold int").selectExpr(
            "store_id", "product_id", "sale_date", f"CAST(units_sold AS {kind}) AS units_sold")
        units = {r[:3]: r[3] for r in sold}
        for window in (1, 7, 50):
            df = sell_through(inv, sales, window)
            got = {(r.store_id, r.snapshot_date): r.trailing_avg_daily_sell_through for r in df.collect()}
            for store in ("S0", "S1", "S2"):
                own = [d for s, _, d, _ in days if s == store]
                for i, day in enumerate(own):
                    frame = [units.get((store, "P1", d), 0) for d in own[max(0, i - window + 1):i + 1]]
                    assert got[store, day] == sum(frame) / len(frame)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert kind == "double" or f"specifiedwindowframe(RowFrame, -{window - 1}, " not in plan


def test_densify_fills_gaps_inside_each_series(spark):
    df = spark.createDataFrame([("S1", "P1", _day(0), 3), ("S1", "P1", _day(3), 4),
                                ("S2", "P1", _day(5), 1)],
                               "store_id string, product_id string, sale_date date, units int")
    got = densify(df, ["store_id", "product_id"], "sale_date", {"units": 0}).orderBy(
        "store_id", "sale_date").collect()
    assert [(r["store_id"], r["units"]) for r in got] == [
        ("S1", 3), ("S1", 0), ("S1", 0), ("S1", 4), ("S2", 1)]
    full = densify(df, ["store_id", "product_id"], "sale_date", {"units": 0},
                   start=_day(0), end=_day(5))
    assert full.count() == 12


def test_facts_that_are_not_bucketed_are_shuffled_once(spark):
    """inventory and sales each cross one exchange; join and window reuse it."""
    inv = spark.createDataFrame([("S1", "P1", _day(0), 5)], "store_id string, product_id string, snapshot_date date, on_hand_qty int")
    sales = spark.createDataFrame([("S1", "P1", _day(0), 7)], "store_id string, product_id string, sale_date date, units_sold int")
    plan = sell_through(inv, sales)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 2
    assert "Window" in plan


def test_bucketed_facts_need_no_shuffle(spark, tmp_path):
    from shelfrisk.plans.warehouse import Warehouse
    from shelfrisk.sources import lake

    w = Warehouse(spark, "/root/testdata/sf0.001")
    lake.write_bucketed_table(w.inventory, "t_inventory_bucketed", 4, ["product_id"],
                              ["product_id", "store_id", "snapshot_date"], str(tmp_path / "inv"))
    lake.write_bucketed_table(w.sales, "t_sales_bucketed", 4, ["product_id"],
                              ["product_id", "store_id", "sale_date"], str(tmp_path / "sales"))
    inv, sales = spark.table("t_inventory_bucketed"), spark.table("t_sales_bucketed")
    v = sell_through(inv, sales, 7, partition_col=None)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the at-scale join strategy
    try:
        plan = v._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert v.count() == w.inventory.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
