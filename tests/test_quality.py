"""Quality checks catch seeded violations; suites and the promotion gate."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfrisk.operators import quality


def _result(df):
    return {(r["target"], r["check"]): r["violations"] for r in df.collect()}


def test_row_checks_single_pass(spark):
    df = spark.createDataFrame([(1, None, 0.5, "OK"), (2, "a", 1.5, "BAD"), (3, "b", -0.1, "OK")],
                               "k int, s string, score double, flag string")
    got = _result(quality.row_checks(df, "t", {
        "not_null(s)": quality.is_null("s"),
        "between(score)": quality.outside("score", 0, 1),
        "in_set(flag)": quality.not_in("flag", ["OK", "STOCKOUT", "SPOILAGE"]),
    }))
    assert got == {("t", "not_null(s)"): 1, ("t", "between(score)"): 2, ("t", "in_set(flag)"): 1}


def test_unique_relationship_density(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert _result(quality.unique(child, "c", ["k"]))[("c", "unique(k)")] == 1
    fk = quality.ForeignKey("c", "k", F.col("k"), "p")
    assert _result(quality.relationships([(child, ["k"], [fk])], {"p": parent}))[("c", "relationship(k)")] == 1


def test_foreign_keys_of_several_children_in_one_pass(spark):
    a = spark.createDataFrame([("x", "1")] * 5 + [("y", None), (None, "3"), ("q", "1")], "s string, n string")
    b = spark.createDataFrame([("1",), ("4",), ("4",)], "n string")
    keys = [quality.ForeignKey("a", "s", F.col("s"), "store"), quality.ForeignKey("a", "n", F.col("n"), "number")]
    got = _result(quality.relationships([(a, ["s", "n"], keys), (b, ["n"], [quality.ForeignKey("b", "n", F.col("n"), "number")])],
                                        {"store": spark.createDataFrame([("x",), ("y",), ("x",)], "s string"), "number": b.where("n = '1'")}))
    assert got == {("a", "relationship(s)"): 1, ("a", "relationship(n)"): 1, ("b", "relationship(n)"): 2}
    empty = _result(quality.relationships([(a.limit(0), ["s", "n"], keys)], {"store": a.select("s").limit(0), "number": b}))
    assert empty == {("a", "relationship(s)"): 0, ("a", "relationship(n)"): 0}


def test_density_over_a_calendar_of_several_words(spark):
    start = dt.date(2030, 12, 1)
    day = lambda i: start + dt.timedelta(days=i)
    rows = [("s", "p", day(i)) for i in range(150)] + [("s", "q", day(i)) for i in range(150) if i not in (0, 63, 64, 127, 149)]
    rows += [("s", "q", day(70)), ("s", "p", day(-1)), ("s", "p", None)]
    grid = spark.createDataFrame(rows, "store_id string, product_id string, d date")
    bitmaps = quality.day_bitmaps(grid, ["store_id", "product_id"], "d", start, 160)
    r = quality.density_detail(bitmaps, 160).first()
    assert (r["rows"], r["series"], r["days"], r["missing_cells"], r["duplicate_rows"], r["passed"]) == (298, 2, 150, 5, 1, False)
    gaps = quality.density_gaps(bitmaps, ["store_id", "product_id"], start, 160).collect()
    assert [tuple(g) for g in gaps] == [("s", "q", 5, ",".join(str(day(i)) for i in (0, 63, 64, 127, 149)))]
    assert "Expand" not in bitmaps._jdf.queryExecution().executedPlan().toString()
    dense = quality.density_detail(quality.day_bitmaps(grid.where("product_id = 'p' AND d >= '2030-12-01'"), ["product_id"], "d", start, 160), 160).first()
    assert dense["passed"] and dense["days"] == 150


def test_flag_consistency(spark):
    gold = spark.createDataFrame(
        [(0, 1.0, 0.0, "STOCKOUT"), (5, 0.0, 0.5, "SPOILAGE"), (5, 0.0, 0.7, "SPOILAGE"), (5, 0.0, 0.7, "OK"), (0, 0.0, 0.0, "OK"),
         (0, 0.0, 0.0, "STOCKOUT"), (0, 2.0, 0.9, "OK")],
        "on_hand_qty int, trailing_7d_sell_through double, spoilage_risk_score double, risk_flag string")
    checks = quality.row_checks(gold, "g", {"flag": quality.flag_disagrees(0.7)})
    assert _result(checks)[("g", "flag")] == 4


def test_fused_suite_equals_separate_checks(spark):
    df = spark.createDataFrame([("a", 1, -1), ("a", 1, 2), ("b", 2, 3), (None, 3, None), (None, 3, 1)],
                               "k string, d int, q int")
    checks = {"q >= 0": quality.below("q", 0), "not_null(q)": quality.is_null("q")}
    fused = _result(quality.grain_and_row_checks(df, "t", ["k", "d"], checks))
    apart = _result(quality.union_all([quality.unique(df, "t", ["k", "d"]),
                                       quality.row_checks(df, "t", checks)]))
    assert fused == apart == {("t", "unique(k, d)"): 1, ("t", "q >= 0"): 1, ("t", "not_null(q)"): 1}


def test_the_inventory_suites_land_no_snapshot_and_group_no_row_by_its_day(spark, monkeypatch):
    from conftest import SMOKE_DIR
    from shelfrisk.plans import catalog
    from shelfrisk.plans.warehouse import Warehouse

    exact, frames = quality.inventory_suite, []
    real = quality._duplicate_groups
    monkeypatch.setattr(quality, "grain_and_row_checks", None)  # not needed
    monkeypatch.setattr(quality, "_duplicate_groups", lambda df, *a: frames.append(df) or real(df, *a))
    monkeypatch.setattr(Warehouse, "_instances", {})
    got = [tuple(r) for r in catalog.QUERIES["dq_suite_inventory"](spark, SMOKE_DIR).collect()]
    w = Warehouse.of(spark, SMOKE_DIR)
    assert "inventory" not in w.landed._made and len(frames) == 1  # only the copy with rows twice
    monkeypatch.undo()
    expected = [tuple(r) for t, df in (("fact_inventory_snapshot", w.inventory), ("fact_inventory_snapshot[seeded]", frames[0])) for r in exact(df, t).collect()]
    assert got == expected and not all(r[3] for r in got)
    keys = ["store_id", "product_id"]
    spans = quality._day_spans(frames[0], keys, "snapshot_date")
    assert "hashpartitioning" not in spans._jdf.queryExecution().executedPlan().toString()  # series are counted where they lie
