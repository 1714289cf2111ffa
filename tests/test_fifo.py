"""FIFO lot ageing against a unit-by-unit simulation, whole and cut into pieces."""
from __future__ import annotations

import random

import pytest

from conftest import SMOKE_DIR
from shelfrisk.operators.fifo import OUT_FIELDS, fifo_age
from shelfrisk.plans.catalog import QUERIES

LEDGER = "store_id string, product_id string, day int, received long, demand long, life long, opening long, age long"


def _brute(days, life, opening, age):
    """Every unit is an entry of one queue: the day it came. Old units leave at the front, so do sold ones."""
    first = min(days)
    queue, out = [first - age] * opening, {}
    for today in range(first - age, max(days) + 1):
        received, demand = days.get(today, (0, 0))
        fresh = [day for day in queue if day > today - life]
        spoiled = len(queue) - len(fresh)
        queue = fresh + [today] * received
        sold = len(queue[:demand])
        queue = queue[sold:]
        if today in days:
            out[today] = (len(queue), today - queue[0] if queue else 0, spoiled, sold, demand - sold)
    return out


def _series(rng, n, dense=True, start=0):
    days = {}
    for t in range(start, start + n):
        if dense or rng.random() < 0.5 or t == start:
            days[t] = (rng.choice([0, 0, rng.randint(1, 15)]), rng.randint(0, 8))
    return days, rng.randint(1, 40 if rng.random() < 0.2 else 6), rng.randint(0, 12)


def _check(spark, series, **options):
    rows, expected = [], {}
    for s, (days, life, opening, age) in enumerate(series):
        rows += [(f"S{s % 3}", f"P{s}", t, r, d, life, opening if t == min(days) else 999, age) for t, (r, d) in days.items()]
        expected |= {(f"S{s % 3}", f"P{s}", t): v for t, v in _brute(days, life, opening, age).items()}
    random.Random(1).shuffle(rows)
    out = fifo_age(spark.createDataFrame(rows, LEDGER), ["store_id", "product_id"], "day", "received", "demand", "life", "opening", "age", **options)
    assert dict(out.dtypes)["day"] == "int"
    got = {(r["store_id"], r["product_id"], r["day"]): tuple(r[c] for c in OUT_FIELDS) for r in out.collect()}
    assert got == expected
    return out


@pytest.mark.parametrize(("piece_days", "split"), [(1, False), (3, True), (32, False)])
def test_fifo_matches_unit_simulation_however_series_are_cut(spark, piece_days, split):
    rng = random.Random(7)
    series = [(*_series(rng, rng.randint(1, 60), dense=s % 2 == 0, start=rng.choice([0, 0, -40, 1000])), 1 + s % 4) for s in range(40)]
    series = [(days, life, opening, min(age, life)) for days, life, opening, age in series]
    _check(spark, series, piece_days=piece_days, split=split)


def test_one_series_over_many_tasks_without_python(spark):
    rng = random.Random(11)
    days = {t: (rng.choice([0, 0, 0, rng.randint(1, 25)]), rng.randint(0, 9)) for t in range(700)}
    out = _check(spark, [(days, 9, 30, 2)], piece_days=16, split=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert any("REPARTITION_BY_COL" in line and "piece" in line for line in plan.splitlines())  # its pieces are dealt out over tasks


def test_unlisted_defaults_and_empty_ledger(spark):
    df = spark.createDataFrame([("S", "P", 0, 0, 1, 1, 5, 0), ("S", "P", 1, 2, 1, 1, 5, 0)], LEDGER)
    got = fifo_age(df, ["store_id", "product_id"], "day", "received", "demand", "life", "opening").orderBy("day").collect()
    assert [tuple(r)[3:] for r in got] == [(0, 0, 5, 0, 1), (1, 0, 0, 1, 0)]  # opening stock came the day before, lives one day
    assert fifo_age(df.limit(0), ["store_id", "product_id"], "day", "received", "demand", "life", "opening").collect() == []


def test_ledger_of_stored_facts_is_not_shuffled(spark):
    plan = QUERIES["fifo_aging"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "lineitem" not in plan
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("(product_id" in line for line in moved) and len(moved) <= 1  # at most the products' shelf lives


def test_a_series_of_stored_facts_is_walked_without_a_sort_or_a_window(spark):
    plan = QUERIES["fifo_aging"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and "Window" not in plan  # a row per lot and piece was sorted by units before
    assert plan.count("Generate") == 1  # one row a day, at the end


@pytest.mark.parametrize("piece_days", [1, 8])
def test_lots_past_their_life_before_the_first_day_in_gaps_and_at_once(spark, piece_days):
    series = [({0: (4, 1), 1: (0, 9)}, 2, 7, 5),               # the opening stock went before the first day
              ({0: (4, 1), 3: (2, 0), 9: (0, 1)}, 3, 7, 3),    # it goes on the first day; later lots on days without a row
              ({5: (6, 2), 6: (3, 1), 7: (0, 0)}, 0, 0, 1),    # a life of no day: what comes is written off at once
              ({t: (1, 0) for t in range(40)}, 100, 3, 1),     # nothing sells: all lots stay open
              ({t: (0, 3) for t in range(-20, 5)}, 4, 0, 1)]   # nothing comes
    rows = [("S", f"P{s}", t, r, d, life, opening, age) for s, (days, life, opening, age) in enumerate(series) for t, (r, d) in days.items()]
    expected = {(f"P{s}", t): v for s, (days, life, opening, age) in enumerate(series) for t, v in _brute(days, life, opening, age).items()}
    expected |= {("P2", t): (0, 0, r, 0, d) for t, (r, d) in series[2][0].items()}  # the write-off of its own day comes before demand
    out = fifo_age(spark.createDataFrame(rows, LEDGER), ["product_id", "store_id"], "day", "received", "demand", "life", "opening", "age", piece_days=piece_days)
    assert {(r["product_id"], r["day"]): tuple(r[c] for c in OUT_FIELDS) for r in out.collect()} == expected
