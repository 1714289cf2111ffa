"""Hard-negative mining by anchor spanning-tree bounds (operator 13).

Vectors are whole numbers, floor(256 * x), and a score is their inner product. An anchor's positives are its first rows
of the same label; for each positive the hard negatives are the first rows of other labels whose score lies in a window
that the positive's score sets.

Anchors are put into groups of about ``GROUP`` neighbours, and each group is joined by its minimum spanning tree. Rows are
read in blocks. In a task (a group and a block) the root anchor's scores are computed; a child's score can't differ
from its parent's by more than the length of the edge times the row's norm, so each child starts from an interval per
row, first scores the few rows with the highest bounds, and then only rows whose interval overlaps a window and reaches that
window's last place so far. Rows that aren't scored keep their interval, widened by the next edge. The heaviest subtree comes
last, so intervals of at most log2(``GROUP``) anchors are held at once.

First pass: positives (the window is everything at or above the last place). Second pass: negatives. Each task returns its
best few per anchor and window, and a ranked window joins the blocks' results. The results are exact.

How many rows need no score depends on how close anchors lie: where even the nearest anchor is further away than the rows'
norm, every interval reaches every window and all rows are scored.

Defined results: rows without vec_id or label, with a null vector, or with components that are null or not finite (or not
finite when multiplied by 256) take no part; vectors are scored against those of their own length; each row counts,
also rows that share a vec_id or repeat (an anchor's own row alone is left out); ties go to the smaller vec_id; scores
beyond a long are cut to its range; extra columns don't matter.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .adaptive_scan import matrix
from .common import stored, table

POSITIVES, NEGATIVES = 5, 10
#: Anchors of a group (a tree); bound of the sample of anchors that groups are made around.
GROUP, PIVOTS = 2048, 1024
#: Rows and components of a block; rows from which tables are cut into several blocks, and how many then at most.
BLOCK, BLOCK_CELLS, LEAST_BLOCK, SPREAD = 16_384, 1 << 23, 1024, 48
#: Rows scored first, those with the highest bounds; largest whole number up to which sums of doubles are exact.
AHEAD, EXACT = 64, 2.0**53
FOUND = "anchor long, p long, row long, vec_id long, score long"


def lengths_of(x: np.ndarray) -> np.ndarray:
    """Row norms; scaled by the largest component first, so that no square overflows."""
    most = np.maximum(np.abs(x).max(axis=1, initial=0), 1.0)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(1))


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge length) of each point in the minimum spanning tree; the root is the first point, its parent -1."""
    n = len(x)
    square = (x * x).sum(1)
    parent, best, left, now = np.zeros(n, dtype=int), np.full(n, np.inf), np.arange(1, n), 0
    parent[0] = -1
    while len(left):
        near = square[left] + square[now] - 2 * (x[left] @ x[now])
        closer = left[near < best[left]]
        best[closer], parent[closer] = near[near < best[left]], now
        pick = int(best[left].argmin())
        now, left = int(left[pick]), np.delete(left, pick)
    edge = np.zeros(n)
    edge[1:] = lengths_of(x[1:] - x[parent[1:]])  # from differences: the squares above would round short edges away
    return parent, edge


def walk(parent: np.ndarray) -> list[tuple[int, int, bool]]:
    """(anchor, parent, is the parent's last child), parents first, lighter subtrees before the heaviest."""
    n = len(parent)
    children = [[] for _ in range(n)]
    for i in range(1, n):
        children[parent[i]].append(i)
    order = [0]
    for i in order:
        order.extend(children[i])
    weight = np.ones(n, dtype=int)
    for i in reversed(order[1:]):
        weight[parent[i]] += weight[i]
    out, stack = [], [(0, -1, True)]
    while stack:
        i, up, last = stack.pop()
        out.append((i, up, last))
        below = sorted(children[i], key=lambda c: weight[c])
        stack.extend((c, i, c == below[-1]) for c in reversed(below))
    return out


def scores_of(rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (rows @ anchor).astype(np.int64)
    a = [int(c) for c in anchor]
    sums = [sum(int(c) * b for c, b in zip(r, a, strict=True)) for r in rows]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in sums], dtype=np.int64)


def place(scores: np.ndarray, k: int) -> float:
    """The score at the k-th place, -inf if there are fewer."""
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def windows_of(positives: list[int] | None) -> list[tuple[int | None, float, float]]:
    """(positive's score, least, most) of each window; without positives' scores one window that holds all."""
    if positives is None:
        return [(None, -np.inf, np.inf)]
    return [(p, -((-30 * p) // 100), (90 * p) // 100) for p in sorted(set(positives)) if p >= 0]


def mine(anchors: pa.Table, rows: pa.Table, negatives: bool, k: int) -> tuple[pa.Table, int, int]:
    """The best ``k`` rows of the block for each anchor and window; also how many rows were scored, and of how many."""
    a, x = matrix(anchors.column("x").combine_chunks()), matrix(rows.column("x").combine_chunks())
    a_key, key, ids = (t.column(c).to_numpy() for t, c in ((anchors, "key"), (rows, "key"), (rows, "vec_id")))
    a_label, label = anchors.column("label").to_numpy(), rows.column("label").to_numpy()
    limits = anchors.column("ps").to_pylist() if negatives else [None] * len(a)
    norm = lengths_of(x)
    exact = bool(norm.max() * lengths_of(a).max() < EXACT)
    parent, edge = spanning_tree(a)
    inner = set(parent.tolist())
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out, scored, of = [], 0, 0
    for i, up, last in walk(parent):
        if up < 0:
            low, high = np.full(len(x), -np.inf), np.full(len(x), np.inf)
        else:
            low, high = held.pop(up) if last else held[up]
            reach = edge[i] * norm * (1 + 1e-9) + 1 + 1e-12 * np.maximum(np.abs(low), np.abs(high))  # more than what doubles round
            reach[np.isnan(reach)] = np.inf
            low, high = low - reach, high + reach
        fits = (label != a_label[i]) if negatives else (label == a_label[i]) & (key != a_key[i])
        at = np.flatnonzero(fits)
        windows = windows_of(limits[i])
        score, known = np.zeros(len(x), np.int64), np.zeros(len(x), dtype=bool)

        def look(which, i=i, score=score, known=known, low=low, high=high):
            score[which] = scores_of(x[which], a[i], exact)
            known[which] = True
            low[which] = high[which] = score[which]

        if up < 0:
            look(np.arange(len(x)))
        elif len(at) and windows:
            wanted = np.zeros(len(at), dtype=bool)
            for _, least, most in windows:
                open_ = at[(high[at] >= least) & (low[at] <= most)]
                bound = np.minimum(high[open_], most)
                ahead = open_[np.argpartition(-bound, AHEAD)[:AHEAD]] if len(open_) > AHEAD else open_
                look(ahead[~known[ahead]])
                inside = score[at[known[at]]]
                last_place = place(inside[(inside >= least) & (inside <= most)], k)
                wanted |= (high[at] >= max(least, last_place)) & (low[at] <= most)
            look(at[wanted & ~known[at]])
        scored, of = scored + int(known.sum()), of + len(x)
        if i in inner:
            held[i] = low, high
        seen = at[known[at]]
        for p, least, most in windows:
            inside = seen[(score[seen] >= least) & (score[seen] <= most)]
            best = inside[np.lexsort((key[inside], ids[inside], -score[inside]))[:k]]
            if len(best):
                out.append((np.full(len(best), a_key[i]), [p] * len(best), key[best], ids[best], score[best]))
    columns = [np.concatenate(c) if n != 1 else sum(c, []) for n, c in enumerate(zip(*out, strict=True))] if out else [[]] * 5
    names = [f.split()[0] for f in FOUND.split(", ")]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)}), scored, of


def miner(negatives: bool, k: int):
    def run(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return pa.table({f.split()[0]: pa.array([], pa.int64()) for f in FOUND.split(", ")})
        return mine(anchors.combine_chunks().sort_by("key"), rows.combine_chunks().sort_by("key"), negatives, k)[0]
    return run


def first_rows(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and window over all blocks, with their rank."""
    best = Window.partitionBy("anchor", "p").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def whole_rows(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v")).filter(
        "vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # A long's floor would cut large components; rint and a comparison keep them doubles.
    x = F.transform("v", lambda c: F.rint(c * 256) - F.when(F.rint(c * 256) > c * 256, 1.0).otherwise(0.0))
    whole = rows.select("vec_id", label.alias("label"), x.alias("x")).filter(F.forall("x", lambda c: F.abs(c) < float("inf")))
    return whole.withColumn("key", F.monotonically_increasing_id())


def grouped_anchors(spark: SparkSession, anchors: DataFrame, count: int, d: int) -> tuple[DataFrame, int]:
    """Anchors with ``grp``: about ``GROUP`` each, neighbours of the same pivots together."""
    groups = -(-count // GROUP)
    if groups <= 1:
        return anchors.withColumn("grp", F.lit(0)), 1
    picked = anchors.orderBy(F.xxhash64("key")).limit(min(PIVOTS, groups)).select("x").collect()
    pivots = spark.sparkContext.broadcast(np.array([r["x"] for r in picked]).reshape(len(picked), d))

    def nearest(batches):
        for batch in batches:
            if batch.num_rows:
                x, p = matrix(batch.column("x")), pivots.value
                own = ((p * p).sum(1) - 2 * (x @ p.T)).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], names=[*batch.schema.names, "pivot"])

    kinds = ", ".join(f"{n} {t}" for n, t in anchors.dtypes)
    placed = stored(anchors.mapInArrow(nearest, f"{kinds}, pivot int"), "pivots")
    sizes = {r["pivot"]: r["count"] for r in placed.groupBy("pivot").count().collect()}
    per = [sizes.get(i, 0) for i in range(len(picked))]
    before = np.cumsum([0, *per[:-1]]).tolist()
    at = F.col("pivot") + 1
    share = F.pmod(F.xxhash64("key"), F.lit(1 << 40)) / float(1 << 40)
    position = F.element_at(F.array(*map(F.lit, before)), at) + share * F.element_at(F.array(*map(F.lit, per)), at)
    return placed.withColumn("grp", F.floor(position / GROUP).cast("int")).drop("pivot"), groups


def hard_negatives(spark: SparkSession, vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors: rows whose vec_id is divisible by ``every``."""
    rows = stored(whole_rows(vectors), "whole")
    is_anchor = F.col("vec_id") % every == 0
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors")).filter("anchors > 0").orderBy("d").collect()
    out = [of_one_length(spark, rows.filter(F.size("x") == r["d"]), is_anchor, r["d"], r["n"], r["anchors"], positives, negatives) for r in sizes]
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionAll, out) if out else empty


def of_one_length(spark: SparkSession, rows: DataFrame, is_anchor, d: int, n: int, anchors: int, positives: int, negatives: int) -> DataFrame:
    size = max(LEAST_BLOCK // 4, min(BLOCK, BLOCK_CELLS // max(1, d)))
    blocks = max(-(-n // size), min(SPREAD, -(-n // LEAST_BLOCK)))
    # New names of the columns, as both sides of the cogroups come from one table.
    grouped, groups = grouped_anchors(spark, rows.filter(is_anchor).select(*[F.col(c).alias(c) for c in rows.columns]), anchors, d)
    held = (rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
            .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    in_blocks = grouped.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def found(of: DataFrame, mined) -> DataFrame:
        return of.groupBy("grp", "block").cogroup(held.groupBy("grp", "block")).applyInArrow(mined, FOUND)

    best = stored(first_rows(found(in_blocks, miner(False, positives)), positives).select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("p")), "positives")
    marks = best.groupBy(F.col("anchor").alias("key")).agg(F.collect_set("p").alias("ps"))  # at most ``positives`` of an anchor
    hard = first_rows(found(in_blocks.join(marks, "key"), miner(True, negatives)), negatives)
    return (hard.join(best, ["anchor", "p"]).join(grouped.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    F.col("p").alias("positive_score"), F.col("score").alias("negative_score")))


def op13_anchor_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark, table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH rows_ AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same, CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
    FROM rows_ a JOIN rows_ r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10"""
