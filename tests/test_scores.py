"""Score columns, flag precedence and rounding."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfrisk.functions.numeric import exact_sum, round_half_away
from shelfrisk.functions.scores import (
    days_remaining_shelf_life,
    register_sql,
    risk_flag,
    spoilage_risk_score,
    stockout_risk_score,
)


def _one(spark, col, schema, row):
    return spark.createDataFrame([row], schema).select(col.alias("v")).first()["v"]


S = "on_hand int, st double, days int, lead int"


@pytest.mark.parametrize("row, spoil, stock", [
    ((0, 2.0, 3, 2), 0.0, 1.0),          # empty shelf: no spoilage, full stockout risk
    ((10, None, 3, 2), 1.0, 0.0),        # no velocity: all stock at risk, no stockout
    ((10, 2.0, 3, 2), 0.4, 0.0),         # 10 - 2*3 = 4 of 10; cover 5 days > lead
    ((10, 5.0, 3, 4), 0.0, 0.5),         # sells out; cover 2 days vs lead 4
    ((10, 5.0, -2, 0), 1.0, 0.0),        # negative runway clamps to 0; lead 0 -> 0
])
def test_scores(spark, row, spoil, stock):
    sp = spoilage_risk_score("on_hand", "st", "days")
    so = stockout_risk_score("on_hand", "st", "lead")
    assert _one(spark, sp, S, row) == pytest.approx(spoil)
    assert _one(spark, so, S, row) == pytest.approx(stock)


def test_flag_precedence(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 0.9), (5, 1.0, 0.7), (5, 0.0, 0.69), (0, 0.0, 0.0)],
        "on_hand int, st double, spoil double")
    flags = [r[0] for r in df.select(risk_flag("on_hand", "st", "spoil")).collect()]
    assert flags == ["STOCKOUT", "SPOILAGE", "OK", "OK"]


def test_days_remaining_never_negative(spark):
    df = spark.createDataFrame([(3, 5), (7, 2)], "life int, age int")
    assert [r[0] for r in df.select(days_remaining_shelf_life("life", "age")).collect()] == [0, 5]


def test_round_half_away_and_exact_sum(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (-0.125,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    assert got == [0.13, 2.68, -0.13]
    total = spark.createDataFrame([(0.1,)] * 10, "x double").agg(exact_sum("x")).first()[0]
    assert total == 1.0


def test_sql_functions(spark):
    register_sql(spark)
    v = spark.sql("SELECT spoilage_risk_score(10, 2.0, 3) AS s, "
                  "stockout_risk_score(10, 5.0, 4) AS o").first()
    assert v["s"] == pytest.approx(0.4) and v["o"] == pytest.approx(0.5)


def test_rounding_is_that_of_the_binary_value_half_away_from_zero(spark):
    import math
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from shelfrisk.functions.numeric import round_half_away

    rng = random.Random(3)
    given = [0.49999999999999994, 0.5, -0.5, 1.5, 2.5, -2.5, -0.3, 0.0, 4503599627370495.5, 4503599627370496.0, 9007199254740993.0, -1e300, 0.285, 1.005, 2.675]
    given += [math.nextafter(k + 0.5, to) for k in (0, 1, 2, 1000, 2**40) for to in (-math.inf, math.inf)] + [rng.uniform(-1e4, 1e4) for _ in range(2000)]
    given += [k / 1000 + 0.0005 for k in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x double")
    for scale in (0, 2, 3):
        got = {r["i"]: r["y"] for r in df.select("i", round_half_away("x", scale).alias("y")).collect()}
        for i, x in enumerate(given):
            scaled = x * 10**scale
            want = float(Decimal(scaled).quantize(Decimal(1), ROUND_HALF_UP) if abs(scaled) < 1e20 else scaled) / 10**scale
            assert got[i] == want and (want or math.copysign(1, got[i]) > 0), (scale, x)
    odd = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (None,)], "x double").select(round_half_away("x", 2)).collect()
    assert math.isnan(odd[0][0]) and [r[0] for r in odd[1:]] == [math.inf, -math.inf, None]
