"""Declarative data-quality checks as DataFrames.

Every check yields rows ``(target, check, violations, passed)``. Row-level
checks on one table (not null, accepted values, ranges, minimums, business
rules) are fused into ONE aggregate pass with ``count_if`` per check and then
unpivoted, however many checks a suite holds. Key checks (unique,
relationships, density) aggregate keys map-side before their shuffle, so a
key holding a third of the rows arrives as one partial count per task.

``violating_*`` functions return the offending rows themselves (the shape of
a singular warehouse test). A suite guards a table where it is published
(``plans.mart``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shelfrisk.functions import scores
from shelfrisk.functions.numeric import count_where, round_half_away
from shelfrisk.sources.schemas import GRAIN, RISK_FLAGS, SPOILAGE_FLAG_THRESHOLD

RESULT_COLUMNS = ("target", "check", "violations", "passed")


def _result(df: DataFrame, target: str, check: str, violations: Column) -> DataFrame:
    v = F.coalesce(violations, F.lit(0)).cast("bigint")
    return df.select(F.lit(target).alias("target"), F.lit(check).alias("check"),
                     v.alias("violations")).withColumn("passed", F.col("violations") == 0)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# -- row-level conditions (True = violation) ------------------------------------
def is_null(col: str) -> Column:
    return F.col(col).isNull()


def not_in(col: str, values: Sequence[object]) -> Column:
    return ~F.col(col).isin(list(values))


def outside(col: str, lo: float, hi: float) -> Column:
    return (F.col(col) < lo) | (F.col(col) > hi)


def below(col: str, minimum: float) -> Column:
    return F.col(col) < minimum


def flag_disagrees(threshold: float = SPOILAGE_FLAG_THRESHOLD) -> Column:
    """The flag is not the one that the row's own scores give."""
    return F.col("risk_flag") != scores.risk_flag("on_hand_qty", "trailing_7d_sell_through", "spoilage_risk_score", threshold)


def revenue_mismatch(tolerance: float = 0.01) -> Column:
    recomputed = round_half_away(F.col("units_sold") * F.col("unit_price"), 2)
    return F.abs(recomputed - F.col("revenue")) >= tolerance


def row_checks(df: DataFrame, target: str, checks: Mapping[str, Column]) -> DataFrame:
    """All row-level checks of one table in a single scan."""
    names = list(checks)
    counts = df.agg(*[count_where(checks[n]).alias(f"_c{i}") for i, n in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"_c{i}").alias("violations"))
                     for i, n in enumerate(names)])
    return (counts.select(F.inline(rows))
            .select(F.lit(target).alias("target"), "check", "violations",
                    (F.col("violations") == 0).alias("passed")))


def grain_and_row_checks(df: DataFrame, target: str, keys: Sequence[str],
                         checks: Mapping[str, Column]) -> DataFrame:
    """``unique(keys)`` plus ``row_checks`` from ONE scan and one shuffle.

    Rows are grouped by the grain with per-group violation counts; a second
    (single-row) aggregate sums them and counts the duplicated groups (keys
    all non-null, as in ``unique``). Same rows as the two checks apart.
    """
    keys = list(keys)
    names = list(checks)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[count_where(checks[n]).alias(f"_c{i}") for i, n in enumerate(names)])
    totals = groups.agg(
        count_where((F.col("_n") > 1) & present).alias("_dup"),
        *[F.sum(f"_c{i}").cast("bigint").alias(f"_c{i}") for i in range(len(names))])
    rows = F.array(
        F.struct(F.lit(f"unique({', '.join(keys)})").alias("check"), F.col("_dup").alias("violations")),
        *[F.struct(F.lit(n).alias("check"), F.coalesce(F.col(f"_c{i}"), F.lit(0)).cast("bigint")
                   .alias("violations")) for i, n in enumerate(names)])
    return (totals.select(F.inline(rows))
            .select(F.lit(target).alias("target"), "check", "violations",
                    (F.col("violations") == 0).alias("passed")))


def grain_holds(df: DataFrame, target: str, keys: Sequence[str], date_col: str, checks: Mapping[str, Column]) -> DataFrame:
    """``grain_and_row_checks``, at once, without grouping the rows of the grain one by one.

    ``keys`` are the grain without its DATE column. Rows are counted by keys and span of ``WORD`` days, whose days are the
    bits of a word: as many bits as rows, and none occurs twice. Only the rows of spans with fewer bits are grouped by the
    grain, to count the violations. The row checks are counted by day, in a scan of their own that carries no key.
    """
    return grain_profile(df, target, keys, date_col, checks)[0]


def grain_profile(df: DataFrame, target: str, keys: Sequence[str], date_col: str, checks: Mapping[str, Column],
                  bound_cols: Sequence[str] = ()) -> tuple[DataFrame, dict[dt.date | None, tuple[int, dict[str, tuple]]]]:
    """The rows of ``grain_holds``, and from the same scans the number of rows and the (min, max) of ``bound_cols`` per day.

    A bound column is a number or one of ``keys``. A key's bounds come from the spans: keys that have the same days meet first.
    """
    keys, names, spark = list(keys), list(checks), df.sparkSession
    numbers, texts = [c for c in bound_cols if c not in keys], [c for c in bound_cols if c in keys]
    per_day = df.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("_rows"), *[count_where(checks[n]).alias(f"_c{i}") for i, n in enumerate(names)],
        *[f(c).alias(f"{end}_{c}") for c in numbers for end, f in (("min", F.min), ("max", F.max))]).collect()  # a row per day
    spans = _day_spans(df, keys, date_col)
    more, ends = 0, {}
    if texts:
        more, ends = _text_ends(spans, texts)
    else:
        more = spans.agg(F.sum("_more")).first()[0] or 0
    counts = [_duplicate_groups(df, spans, keys, date_col) if more else 0] + [sum(r[f"_c{i}"] for r in per_day) for i in range(len(names))]
    rows = [(target, check, n, n == 0) for check, n in zip((f"unique({', '.join([*keys, date_col])})", *names), counts)]
    profile = {r[date_col]: (r["_rows"], {c: ends.get((r[date_col], c), (None, None)) if c in keys else (r[f"min_{c}"], r[f"max_{c}"]) for c in bound_cols})
               for r in per_day}
    return spark.createDataFrame(rows, "target string, check string, violations bigint, passed boolean"), profile


def _day_spans(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """(keys, _span, _days, _more): per keys and span of ``WORD`` days its days, one bit each, and how many rows of the grain (all
    keys and the day non-null) it has more than days."""
    present = F.col(date_col).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    bit = F.expr(f"shiftleft(1L, pmod(unix_date({date_col}), {WORD}))")
    grouped = df.groupBy(*keys, F.floor(F.unix_date(F.col(date_col)) / WORD).alias("_span")).agg(
        count_where(present).alias("_n"), F.bit_or(bit).alias("_days"))
    whole = F.col("_span").isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return grouped.select(*keys, "_span", "_days", F.when(whole, F.col("_n") - F.bit_count("_days")).otherwise(F.lit(0)).alias("_more"))


def _text_ends(spans: DataFrame, texts: Sequence[str]) -> tuple[int, dict[tuple[dt.date, str], tuple[str, str]]]:
    """The sum of ``_more``, and per day and key column its least and greatest text."""
    ends: dict[tuple[dt.date, str], tuple[str, str]] = {}
    more = 0
    for text in texts:
        held = spans.groupBy(text, "_span").agg(F.bit_or("_days").alias("_days"), F.sum("_more").alias("_more"))
        alike = held.groupBy("_span", "_days").agg(F.min(text).alias("_min"), F.max(text).alias("_max"), F.sum("_more").alias("_more"))
        has, first = F.expr("getbit(_days, _at) = 1"), F.col("_at") == 0
        by_day = alike.select("*", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1))).alias("_at")).groupBy("_span", "_at").agg(
            F.min(F.when(has, F.col("_min"))).alias("_min"), F.max(F.when(has, F.col("_max"))).alias("_max"), F.sum(F.when(first, F.col("_more"))).alias("_more"))
        found = by_day.select(F.expr(f"date_from_unix_date(CAST(_span * {WORD} + _at AS INT))").alias("_day"), "_min", "_max", "_more").collect()  # a row per day
        more = sum(r["_more"] or 0 for r in found)
        ends |= {(r["_day"], text): (r["_min"], r["_max"]) for r in found if r["_min"] is not None}
    return more, ends


def _duplicate_groups(df: DataFrame, spans: DataFrame, keys: Sequence[str], date_col: str) -> int:
    """How many (keys, day) occur more than once; only rows of the spans that have more rows than days are grouped."""
    doubled = spans.where(F.col("_more") > 0).select(*keys, "_span").hint("shuffle_hash")
    rows = df.select(*keys, date_col, F.floor(F.unix_date(F.col(date_col)) / WORD).alias("_span"))
    groups = rows.join(doubled, [*keys, "_span"], "left_semi").groupBy(*keys, date_col).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(count_where(F.col("_n") > 1)).first()[0]


# -- key checks ----------------------------------------------------------------
def unique(df: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    """Key groups (all keys non-null) that occur more than once."""
    keys = list(keys)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    dup = df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _result(dup.agg(F.count(F.lit(1)).alias("v")), target, f"unique({', '.join(keys)})",
                   F.col("v"))


def violating_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The duplicated key groups with their row counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


@dataclass(frozen=True)
class ForeignKey:
    """Rows of ``target`` whose non-null ``key`` (an expression over the child's key columns) has no row in ``parent``."""

    target: str
    name: str
    key: Column
    parent: str


def relationships(children: Sequence[tuple[DataFrame, Sequence[str], Sequence[ForeignKey]]],
                  parents: Mapping[str, DataFrame]) -> DataFrame:
    """All foreign keys in one pass: each child is read once, each parent once.

    A child is counted per combination of its key ``columns``, which then spreads into one (parent, key) row per foreign
    key; together with the parents' own keys these rows meet in one aggregate by (parent, key), whose flags
    tell whether the parent has the key and how many rows of each foreign key point at it. Both aggregates
    combine map-side, so a hot key costs a row per task. A parent's key is its first column.
    """
    tagged = [df.select(F.lit(name).alias("parent"), F.col(df.columns[0]).cast("string").alias("key"),
                        F.lit(None).cast("int").alias("fk"), F.lit(0).cast("bigint").alias("n"))
              for name, df in parents.items()]
    every: list[ForeignKey] = []
    for df, columns, keys in children:
        links = F.array(*[F.struct(F.lit(k.parent).alias("parent"), k.key.cast("string").alias("key"), F.lit(len(every) + i).alias("fk"))
                          for i, k in enumerate(keys)])
        counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
        tagged.append(counted.select(F.inline(links), F.col("_rows").alias("n")).where(F.col("key").isNotNull()).select("parent", "key", "fk", "n"))
        every += keys
    per_key = union_all(tagged).groupBy("parent", "key").agg(
        F.bool_or(F.col("fk").isNull()).alias("known"), *[F.sum(F.when(F.col("fk") == i, F.col("n"))).alias(f"_{i}") for i in range(len(every))])
    orphans = per_key.where(~F.col("known")).agg(*[F.coalesce(F.sum(f"_{i}"), F.lit(0)).cast("bigint").alias(f"_{i}") for i in range(len(every))])
    rows = F.array(*[F.struct(F.lit(k.target).alias("target"), F.lit(f"relationship({k.name})").alias("check"), F.col(f"_{i}").alias("violations"))
                     for i, k in enumerate(every)])
    return orphans.select(F.inline(rows)).withColumn("passed", F.col("violations") == 0)


# -- density: a bitmap of days per series --------------------------------------------
WORD = 64


def day_bitmaps(df: DataFrame, keys: Sequence[str], date_col: str, start: dt.date, days: int) -> DataFrame:
    """(keys, rows, beyond, words): per series its rows, those outside the calendar of ``days`` days from
    ``start``, and the calendar's days that it has, one bit each in 64-bit words. One aggregate, no distinct count."""
    day = F.datediff(F.col(date_col), F.lit(start))
    inside = F.coalesce((day >= 0) & (day < days), F.lit(False))
    bit = F.expr(f"shiftleft(1L, CAST(_day % {WORD} AS INT))")
    words = [F.coalesce(F.bit_or(F.when(F.col("_in") & (F.floor(F.col("_day") / WORD) == w), bit)), F.lit(0).cast("bigint"))
             for w in range(-(-days // WORD))]
    return (df.select(*keys, day.alias("_day"), inside.alias("_in")).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("rows"), count_where(~F.col("_in")).alias("beyond"), F.array(*words).alias("words")))


def _bits(words: Column) -> Column:
    return F.aggregate(F.transform(words, lambda w: F.bit_count(w).cast("bigint")), F.lit(0).cast("bigint"), lambda a, b: a + b)


def _calendar(bitmaps: DataFrame, days: int) -> DataFrame:
    """One row: the days that any series has."""
    n = -(-days // WORD)
    return bitmaps.agg(F.array(*[F.coalesce(F.bit_or(F.element_at("words", w + 1)), F.lit(0).cast("bigint")) for w in range(n)]).alias("all_words"))


def density_detail(bitmaps: DataFrame, days: int) -> DataFrame:
    """rows, series, days, missing cells and duplicate rows of ``day_bitmaps``, with the verdict."""
    n = -(-days // WORD)
    stats = bitmaps.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("series"),
        F.coalesce(F.sum(_bits(F.col("words"))), F.lit(0)).alias("cells"), F.coalesce(F.sum("beyond"), F.lit(0)).alias("beyond"),
        F.array(*[F.coalesce(F.bit_or(F.element_at("words", w + 1)), F.lit(0).cast("bigint")) for w in range(n)]).alias("all_words"))
    return stats.select("rows", "series", _bits(F.col("all_words")).alias("days"), "cells", "beyond").select(
        "rows", "series", "days", (F.col("series") * F.col("days") - F.col("cells")).alias("missing_cells"),
        (F.col("rows") - F.col("cells") - F.col("beyond")).alias("duplicate_rows"), "beyond",
    ).withColumn("passed", (F.col("missing_cells") == 0) & (F.col("duplicate_rows") == 0) & (F.col("beyond") == 0)).drop("beyond")


def density_gaps(bitmaps: DataFrame, keys: Sequence[str], start: dt.date, days: int) -> DataFrame:
    """(keys, missing, missing_days): series that lack days which others have, with the days named."""
    joined = bitmaps.join(F.broadcast(_calendar(bitmaps, days)))  # one row
    lacking = joined.withColumn("gap", F.zip_with("words", "all_words", lambda own, all_: all_.bitwiseAND(F.bitwise_not(own))))
    gaps = lacking.where(F.exists("gap", lambda w: w != 0))
    absent = F.filter(F.sequence(F.lit(0), F.lit(days - 1)), lambda d: F.getbit(F.element_at(F.col("gap"), (F.floor(d / WORD) + 1).cast("int")), (d % WORD).cast("int")) == 1)
    named = F.transform(absent, lambda d: F.date_add(F.lit(start), d).cast("string"))
    return gaps.select(*keys, F.size(absent).cast("bigint").alias("missing"), F.array_join(named, ",").alias("missing_days"))


def one_current_version(history: DataFrame, target: str, key: str = "product_id",
                        current_col: str = "is_current") -> DataFrame:
    """Keys that do not have exactly one current version."""
    per_key = history.groupBy(key).agg(count_where(F.col(current_col)).alias("c"))
    bad = per_key.where(F.col("c") != 1).agg(F.count(F.lit(1)).alias("v"))
    return _result(bad, target, "one_current_version", F.col("v"))


def column_minimums(df: DataFrame, columns: Sequence[str], minimum: float = 0) -> DataFrame:
    """Minimum of each column in one pass, with a >= minimum verdict."""
    mins = df.agg(*[F.min(c).cast("bigint").alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("min_value"))
                     for c in columns])
    return (mins.select(F.inline(rows))
            .withColumn("passed", F.coalesce(F.col("min_value") >= minimum, F.lit(True))))


def violating_outlived_stock(inventory: DataFrame, shelf_life: DataFrame) -> DataFrame:
    """Stock still on the shelf at or past its current shelf life."""
    current = shelf_life.where("is_current").select("product_id", "shelf_life_days")
    return (
        inventory.where(F.col("on_hand_qty") > 0)
        .select("store_id", "product_id", "snapshot_date", "on_hand_qty", "oldest_batch_age_days")
        .join(current, "product_id")
        .where(F.col("oldest_batch_age_days") >= F.col("shelf_life_days"))
    )


# -- suites ------------------------------------------------------------------------
def inventory_suite(inventory: DataFrame, target: str = "fact_inventory_snapshot") -> DataFrame:
    """Dense daily snapshot: grain, non-null day, non-negative stock. (Its columns are held to the declared
    schema when it lands.)"""
    return grain_and_row_checks(inventory, target, GRAIN, _inventory_checks(inventory))


def _inventory_checks(inventory: DataFrame) -> dict[str, Column]:
    return {
        "not_null(snapshot_date)": is_null("snapshot_date"),
        "min(on_hand_qty) >= 0": below("on_hand_qty", 0),
        "min(received_qty) >= 0": below("received_qty", 0),
        "min(spoiled_qty) >= 0": below("spoiled_qty", 0),
    }


def _risk_checks(gold: DataFrame) -> dict[str, Column]:
    checks = {
        "between(spoilage_risk_score, 0, 1)": outside("spoilage_risk_score", 0, 1),
        "between(stockout_risk_score, 0, 1)": outside("stockout_risk_score", 0, 1),
        "in_set(risk_flag)": not_in("risk_flag", RISK_FLAGS),
    }
    if "computed_at" in gold.columns:
        checks["not_null(computed_at)"] = is_null("computed_at")
    return checks


def risk_suite(gold: DataFrame, target: str = "perishables_risk") -> DataFrame:
    """Gold table: grain, bounded scores, known flags, build stamp present."""
    return grain_and_row_checks(gold, target, GRAIN, _risk_checks(gold))


class GrainAudit:
    """A suite of row checks and the grain, run at once (``grain_holds``); with ``profiled`` also what a manifest says of each day."""

    def __init__(self, target: str, grain: Sequence[str], checks: Callable[[DataFrame], Mapping[str, Column]]):
        *self.keys, self.date_col = grain
        self.target, self.checks = target, checks

    def __call__(self, df: DataFrame, target: str | None = None) -> DataFrame:
        return grain_holds(df, target or self.target, self.keys, self.date_col, self.checks(df))

    def profiles(self, partition_col: str, schema: StructType, bound_cols: Sequence[str]) -> bool:
        """Whether ``profiled`` describes the partitions of such a table: a partition is a day, and texts with bounds are keys."""
        texts = [c for c in bound_cols if isinstance(schema[c].dataType, StringType)]
        return partition_col == self.date_col and all(c in self.keys for c in texts) and all(c in texts or c not in self.keys for c in bound_cols)

    def profiled(self, df: DataFrame, bound_cols: Sequence[str]) -> tuple[DataFrame, dict[dt.date | None, tuple[int, dict[str, tuple]]]]:
        return grain_profile(df, self.target, self.keys, self.date_col, self.checks(df), bound_cols)


#: ``risk_suite`` and ``inventory_suite``, at once and without grouping the rows by the grain.
risk_audit = GrainAudit("perishables_risk", GRAIN, _risk_checks)
inventory_audit = GrainAudit("fact_inventory_snapshot", GRAIN, _inventory_checks)
