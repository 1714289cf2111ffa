"""Serving: figures worked out by plain Python over a small random mart."""
from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest

from shelfrisk.operators import serving

FLAGS = ("OK", "SPOILAGE", "STOCKOUT")
DAYS = [dt.date(2031, 1, d) for d in (4, 5, 6)]


@pytest.fixture(scope="module")
def plain():
    rng = random.Random(42)
    products = {f"P{90 + i}": (f"item {i}", rng.choice("xyz"), rng.randint(100, 900) / 100, rng.randint(10, 99) / 100) for i in range(7)}
    stores = {f"S{40 + i}": (f"shop {i}", "north" if i % 2 else "south") for i in range(4)}
    gold = [(s, p, d, rng.randint(0, 60), rng.randint(0, 9), rng.randint(0, 40) / 4, 0.0, 2, rng.randint(0, 100) / 100, 0.5, rng.choice(FLAGS))
            for s in stores for p in products for d in DAYS]
    return products, stores, gold


@pytest.fixture(scope="module")
def frames(spark, plain):
    products, stores, gold = plain
    return (spark.createDataFrame(gold, "store_id string, product_id string, snapshot_date date, on_hand_qty int, days_remaining_shelf_life int, "
                                  "trailing_7d_sell_through double, projected_demand_before_expiry double, replenishment_lead_days int, "
                                  "spoilage_risk_score double, stockout_risk_score double, risk_flag string"),
            spark.createDataFrame([(k, *v) for k, v in products.items()], "product_id string, product_name string, category string, unit_price double, unit_cost double"),
            spark.createDataFrame([(k, *v) for k, v in stores.items()], "store_id string, store_name string, region string"))


@pytest.fixture(scope="module")
def served(frames):
    return serving.enriched_rows(*frames)


def lost(plain, g):
    return g[5] * plain[0][g[1]][2] if g[10] == "STOCKOUT" else 0.0


def risked(plain, g):
    return g[8] * g[3] * plain[0][g[1]][3] if g[10] == "SPOILAGE" else 0.0


def test_money_of_each_row(served, plain):
    got = {(r.store_id, r.product_id, r.snapshot_date): r for r in served.collect()}
    assert len(got) == len(plain[2])
    for g in plain[2]:
        r = got[g[:3]]
        assert r.stockout_lost_revenue_per_day == pytest.approx(lost(plain, g)) and r.spoilage_cost_at_risk == pytest.approx(risked(plain, g))
        assert (r.store_name, r.region) == plain[1][g[0]] and r.category == plain[0][g[1]][1]


def test_totals_either_way(served, frames, plain):
    flags = Counter(g[10] for g in plain[2])
    gold, products, _ = frames
    for k in (serving.kpis(served).first(), serving.kpis_from_gold(gold, products).first()):
        assert (k.sku_days, k.stockout_count, k.spoilage_count) == (len(plain[2]), flags["STOCKOUT"], flags["SPOILAGE"])
        assert k.ok_pct == pytest.approx(100 * flags["OK"] / len(plain[2]), abs=0.06)
        assert k.stockout_lost_revenue_per_day == pytest.approx(sum(lost(plain, g) for g in plain[2]), abs=0.01)
        assert k.spoilage_cost_at_risk == pytest.approx(sum(risked(plain, g) for g in plain[2]), abs=0.01)
    none = serving.kpis(served.filter("false")).first()
    assert (none.sku_days, none.ok_pct, none.stockout_lost_revenue_per_day) == (0, 0.0, 0.0)


def test_pivots(served, frames, plain):
    counts = Counter((plain[1][g[0]][1], g[10]) for g in plain[2])
    gold, _, stores = frames
    for df in (serving.flags_by_dimension(served, "region"), serving.flags_by_dimension_from_gold(gold, stores, "store_id", "region")):
        assert {(r.region, f): r[f] for r in df.collect() for f in FLAGS} == {(x, f): counts[x, f] for x in ("north", "south") for f in FLAGS}
    with pytest.raises(ValueError):
        serving.flags_by_dimension(served, "weather")


@pytest.mark.parametrize("flag,money,column", [("STOCKOUT", lost, "stockout_lost_revenue_per_day"), ("SPOILAGE", risked, "spoilage_cost_at_risk")])
def test_top_lists(served, plain, flag, money, column):
    expected = sorted((money(plain, g) for g in plain[2] if g[10] == flag), reverse=True)[:6]
    top = serving.top_risks(served, flag, 6)
    assert top.columns[-1] == column and [r[column] for r in top.collect()] == pytest.approx(expected)
    with pytest.raises(ValueError):
        serving.top_risks(served, "FINE")


def test_days_and_trend(served, plain):
    assert sorted(r[0] for r in serving.available_dates(served).collect()) == [str(d) for d in DAYS]
    counts = Counter((str(g[2]), g[10]) for g in plain[2])
    assert {(str(r.snapshot_date), r.risk_flag): r.n for r in serving.daily_trend(served).collect()} == dict(counts)
