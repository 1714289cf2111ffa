"""Chat formatting of preference pairs (operator 1), in DataFrame functions only.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (equal role and text) is
rendered once, as the prompt; what follows in either is its completion, with a mask that tells which characters
are trained on: the contents and end marks of assistant turns. A mask is written in runs, ``length:0`` or
``length:1``, whose lengths add up to the completion's. Every conversation is one record, as a text is.

Defined results: turns are ordered by turn, then role, then text (nulls first), whatever gaps or ties their
numbers have; a null role is rendered as ``unknown`` and a null text as empty; two nulls are equal; a repeated
row is a turn of its own; rows without a conversation take no part. Status is ``pair``, ``identical`` (both
completions empty) or ``incomplete`` (one side has no turns: then there is no prompt).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit(CLOSE))


def content(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), content(t))), "")


def mask(turns: Column) -> Column:
    def runs(t: Column) -> Column:
        trained = F.when(t["role"] == TRAINED, F.lit("1")).otherwise(F.lit("0"))
        return F.concat(F.length(header(t)).cast("string"), F.lit(":0,"), F.length(content(t)).cast("string"), F.lit(":"), trained)

    return F.array_join(F.transform(turns, runs), ",")


def preference_format(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair. ``turns``: conv_id, turn, role, text; ``pairs``: pair_id, chosen, rejected (conv_ids)."""
    sides = pairs.select(F.col("pair_id").alias("_pair"), F.explode(F.array(
        F.struct(F.col("chosen").alias("_conv"), F.lit(True).alias("_chosen")),
        F.struct(F.col("rejected").alias("_conv"), F.lit(False).alias("_chosen")))).alias("_s")).select("_pair", "_s.*")
    said = turns.select(F.col("conv_id").alias("_conv"), *_turn())
    return _formatted(said.join(sides, "_conv"))


def _turn() -> list[Column]:
    return [F.col("turn").cast("long").alias("_turn"), F.col("role").cast("string").alias("_role"), F.col("text").cast("string").alias("_text")]


def _formatted(said: DataFrame) -> DataFrame:
    """``said``: _pair, _chosen, _turn, _role, _text, one row a turn."""
    turn = F.struct(F.col("_turn").alias("turn"), F.col("_role").alias("role"), F.col("_text").alias("text"))
    both = said.groupBy("_pair").agg(F.sort_array(F.collect_list(F.when(F.col("_chosen"), turn))).alias("c"),
                                     F.sort_array(F.collect_list(F.when(~F.col("_chosen"), turn))).alias("r"))
    same = F.zip_with("c", "r", lambda a, b: a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    split = F.array_position(same, F.lit(False))
    both = both.withColumn("n", F.when(split == 0, F.size("c")).otherwise(split - 1).cast("int"))
    rest = both.select("_pair", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"),
                       F.slice("c", F.col("n") + 1, F.greatest(F.size("c") - F.col("n"), F.lit(0))).alias("c"),
                       F.slice("r", F.col("n") + 1, F.greatest(F.size("r") - F.col("n"), F.lit(0))).alias("r"))
    status = (F.when((F.size("p") == 0) & ((F.size("c") == 0) | (F.size("r") == 0)), "incomplete")
              .when((F.size("c") == 0) & (F.size("r") == 0), "identical").otherwise("pair"))
    return rest.select(F.col("_pair").alias("pair_id"), status.alias("status"), F.size("p").cast("long").alias("n_prompt_turns"),
                       rendered(F.col("p")).alias("prompt"), rendered(F.col("c")).alias("chosen"), mask(F.col("c")).alias("chosen_mask"),
                       rendered(F.col("r")).alias("rejected"), mask(F.col("r")).alias("rejected_mask"))


def op1_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations; the table names no pairs, so 2n is the chosen and 2n + 1 the rejected one of pair n."""
    turns = table(spark, sf_dir, "conversations").filter("conv_id IS NOT NULL")
    pair, chosen = F.floor(F.col("conv_id") / 2).cast("long"), F.pmod(F.col("conv_id"), F.lit(2)) == 0
    return _formatted(turns.select(pair.alias("_pair"), chosen.alias("_chosen"), *_turn()))


OP1_SQL = r"""
WITH t AS (
    SELECT CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, conv_id % 2 = 0 AS is_chosen, role, text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos,
           '<|' || coalesce(role, 'unknown') || '|>' || chr(10) AS head, coalesce(text, '') || '<|end|>' || chr(10) AS body
    FROM conversations WHERE conv_id IS NOT NULL
), aligned AS (
    SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.pos, r.pos) AS pos,
           c.pos IS NOT NULL AND r.pos IS NOT NULL AND c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text AS same
    FROM (SELECT * FROM t WHERE is_chosen) c FULL JOIN (SELECT * FROM t WHERE NOT is_chosen) r ON c.pair_id = r.pair_id AND c.pos = r.pos
), prefix AS (
    SELECT pair_id, coalesce(min(pos) FILTER (WHERE NOT same) - 1, max(pos)) AS n FROM aligned GROUP BY pair_id
), parts AS (
    SELECT t.pair_id, n, CASE WHEN pos <= n THEN CASE WHEN is_chosen THEN 'p' END WHEN is_chosen THEN 'c' ELSE 'r' END AS part, pos, head || body AS said,
           length(head) || ':0,' || length(body) || ':' || CASE WHEN role = 'assistant' THEN '1' ELSE '0' END AS runs
    FROM t JOIN prefix USING (pair_id)
)
SELECT pair_id,
       CASE WHEN n = 0 AND (count(*) FILTER (WHERE part = 'c') = 0 OR count(*) FILTER (WHERE part = 'r') = 0) THEN 'incomplete'
            WHEN count(*) FILTER (WHERE part IN ('c', 'r')) = 0 THEN 'identical' ELSE 'pair' END AS status,
       n AS n_prompt_turns,
       coalesce(string_agg(said, '' ORDER BY pos) FILTER (WHERE part = 'p'), '') AS prompt,
       coalesce(string_agg(said, '' ORDER BY pos) FILTER (WHERE part = 'c'), '') AS chosen,
       coalesce(string_agg(runs, ',' ORDER BY pos) FILTER (WHERE part = 'c'), '') AS chosen_mask,
       coalesce(string_agg(said, '' ORDER BY pos) FILTER (WHERE part = 'r'), '') AS rejected,
       coalesce(string_agg(runs, ',' ORDER BY pos) FILTER (WHERE part = 'r'), '') AS rejected_mask
FROM parts GROUP BY pair_id, n
"""
