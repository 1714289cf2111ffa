"""Approximate nearest neighbours by an adaptive dimension scan (operator 3).

Nearness is the inner product. Each vector gets one more component that gives all the same length, so that the
largest inner product is the least distance. Lists: k-means on a sample of about ``SAMPLE`` vectors; every
vector is in the list of its nearest centre. A query probes the nearest lists, as many as give a recall of
``RECALL`` on the sample. Inside a probed list vectors are rotated by a fixed random rotation and kept in column
blocks; after each block a hypothesis test on the partial distance abandons candidates that are very unlikely to come
among the query's ``k`` best. The test knows that the columns left are few: its width shrinks to nothing with the last
one, so what survives all blocks is nearer than the bound, and only the survivors' inner products are computed, on
the original vectors.

The nearest ``1 / NEAR`` of a query's lists are scanned first. The k-th best found there is the bound with which the other lists are
scanned, so most of their candidates go early.

Lists are scanned in blocks of about ``BLOCK`` vectors by groups of about ``QUERIES`` queries that probe the list, so neither
a crowded list nor many queries gather in one task, and vectors go only to groups that probe their list.

Each dimension is searched among its own vectors, one after the other.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
rows without vec_id; a row that is repeated whole (vec_id and vector) counts once; different vectors under one vec_id are rows of their
own, each with its own results; ties go to the smaller vec_id; with at most ``k`` candidates all are returned.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

#: Vectors on which lists are fitted and recall is measured (a bound of the sample), and queries of that measure.
SAMPLE, PILOTS, RECALL = 20_000, 200, 0.96
#: Bound of the number of lists; vectors of a block, queries of a group, rotated columns of a block.
LISTS, BLOCK, QUERIES, COLUMNS = 4096, 4096, 4096, 16
#: Candidates measured whole where there is no bound yet; the tests' width (2.1 loses next to nothing); share of lists scanned first.
WARM, EPSILON, NEAR = 64, 2.1, 6
#: Partial distances held at once; share of candidates left from which on they are listed one by one.
CELLS, FEW = 1 << 20, 0.25


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else flat.reshape(0, 0)


def lifted(x: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
    """With the component that gives all vectors the length of the longest; queries get 0."""
    last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, longest**2 - (x * x).sum(1)))
    return np.hstack([x, last[:, None]])


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances up to each row's own constant."""
    return (centres * centres).sum(1) - 2 * (x @ centres.T)


def fit_lists(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(11)
    centres = sample[np.sort(rng.choice(len(sample), lists, replace=False))]
    for _ in range(rounds):
        own = distances(sample, centres).argmin(1)
        count = np.bincount(own, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def probes_needed(sample: np.ndarray, queries: np.ndarray, centres: np.ndarray, k: int) -> int:
    """How many lists the pilot queries must probe for the recall, by brute force on the sample."""
    own = distances(sample, centres).argmin(1)
    order = distances(queries, centres).argsort(1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(centres))[None, :], 1)
    near = np.argpartition(distances(queries, sample), min(k, len(sample) - 1), axis=1)[:, :k]
    return int(np.quantile(np.take_along_axis(rank, own[near], 1), RECALL)) + 1


@lru_cache(maxsize=4)
def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(23).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def test_factor(t: int, size: int) -> float:
    """A candidate goes if its partial distance over ``t`` of ``size`` rotated columns times this is above the bound."""
    return size / t / (1 + EPSILON * math.sqrt((1 - t / size) / t)) ** 2


def survivors(x: np.ndarray, queries: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) of rotated rows that no test abandons, for few queries at a time."""
    size = x.shape[1]
    cuts = [*range(0, size, COLUMNS), size]
    partial = np.zeros((len(queries), len(x)))
    i = j = part = None
    for a, b in zip(cuts, cuts[1:], strict=False):
        xs, qs = x[:, a:b], queries[:, a:b]
        factor, slack = test_factor(b, size), 1 + 1e-9
        if i is None:
            partial += (xs * xs).sum(1) + (qs * qs).sum(1)[:, None] - 2 * (qs @ xs.T)
            alive = partial * factor <= limit[:, None] * slack + 1e-12
            if b < size and np.count_nonzero(alive) > FEW * alive.size:
                continue
            i, j = np.nonzero(alive)
            part = partial[i, j]
        else:
            part = part + ((xs[j] - qs[i]) ** 2).sum(1)
            alive = part * factor <= limit[i] * slack + 1e-12
            i, j, part = i[alive], j[alive], part[alive]
    return i, j


def scan(keys: np.ndarray, ids: np.ndarray, x: np.ndarray, query_keys: np.ndarray, queries: np.ndarray, bounds: np.ndarray, longest: float, k: int):
    """For each query its k best of the block that reach its bound (a score, -inf for none): (query, row, score)."""
    turn = rotation(x.shape[1] + 1)
    rotated, points = lifted(x, longest) @ turn, lifted(queries, longest, query=True) @ turn
    reach = (queries * queries).sum(1) + longest**2 - 2 * bounds
    step, out = max(1, CELLS // max(1, len(x))), []
    for a in range(0, len(queries), step):
        q, own, limit = points[a:a + step], query_keys[a:a + step], reach[a:a + step].copy()
        if np.isinf(limit).any() and len(x) > WARM:
            warm = (rotated[:WARM] ** 2).sum(1) + (q * q).sum(1)[:, None] - 2 * (q @ rotated[:WARM].T)
            warm[keys[:WARM] == own[:, None]] = np.inf
            limit = np.minimum(limit, np.sort(warm, axis=1)[:, k - 1] * (1 + 1e-9) if k <= WARM else np.inf)
        i, j = survivors(rotated, q, limit)
        other = keys[j] != own[i]
        i, j = i[other] + a, j[other]
        # row by row, so that equal vectors have equal scores
        score = np.concatenate([np.zeros(0), *((x[j[c:c + CELLS // 8]] * queries[i[c:c + CELLS // 8]]).sum(1) for c in range(0, len(j), CELLS // 8))])
        order = np.lexsort((keys[j], ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        out.append((i[rank < k], j[rank < k], score[rank < k]))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]


def valid_vectors(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("_id"), v.alias("_v")).filter("_id IS NOT NULL AND size(_v) > 0")
    good = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("_v", lambda c: c != 0)
    return rows.filter(F.coalesce(good, F.lit(False))).dropDuplicates(["_id", "_v"]).withColumn("_k", F.monotonically_increasing_id())


def nearest(spark: SparkSession, vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """For each row whose vec_id is divisible by ``every`` its k nearest others: query_id, rank, vec_id, score."""
    valid = stored(valid_vectors(vectors), "vectors")
    sizes = valid.groupBy(F.size("_v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("_v", F.lit(0.0), lambda a, c: a + c * c)).alias("m")).orderBy(F.desc("n"), F.desc("d")).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionAll, [nearest_of_one_dimension(spark, valid, r["d"], r["n"], math.sqrt(r["m"]), k, every) for r in sizes])


def nearest_of_one_dimension(spark: SparkSession, valid: DataFrame, dimension: int, n: int, longest: float, k: int, every: int) -> DataFrame:
    """``nearest`` among the ``n`` vectors of a dimension, the longest of which has the length ``longest``."""
    valid = valid.filter(F.size("_v") == dimension)
    share = max(1, int((1 << 40) * min(1.0, SAMPLE / n)))
    sampled = valid.filter(F.pmod(F.xxhash64("_k"), F.lit(1 << 40)) < share).orderBy("_k").select("_v").collect()
    sample = np.array([r["_v"] for r in sampled]).reshape(-1, dimension)
    lists = int(min(LISTS, max(1, math.sqrt(n) / 2), max(1, len(sample) // 16)))
    raised = lifted(sample, longest)
    centres = fit_lists(raised, lists) if lists > 1 else np.zeros((1, dimension + 1))
    probes = probes_needed(raised, lifted(sample[:: max(1, len(sample) // PILOTS)], longest, query=True), centres, k) if lists > 1 else 1
    shared = spark.sparkContext.broadcast(centres)  # at most LISTS centres

    def assign(batches):
        for batch in batches:
            own = distances(lifted(matrix(batch.column("_v")), longest), shared.value).argmin(1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], names=["_id", "_v", "_k", "list"])

    listed = stored(valid.select("_id", "_v", "_k").mapInArrow(assign, "_id long, _v array<double>, _k long, list int"), "listed")
    count = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}
    filled = np.array([count.get(i, 0) for i in range(lists)])

    def probe(batches):
        """(key, list, near) of the lists that each query probes."""
        for batch in batches:
            if not batch.num_rows:
                continue
            order = distances(lifted(matrix(batch.column("_v")), longest, query=True), shared.value).argsort(1)
            reach = np.cumsum(filled[order], axis=1) - filled[order]  # candidates in the lists before
            take = (np.arange(lists) < probes) | (reach <= k)
            near = (np.arange(lists) < -(-probes // NEAR)) | (reach <= k)
            rows, which = np.nonzero(take & (filled[order] > 0))
            yield pa.RecordBatch.from_arrays([batch.column("_k").take(pa.array(rows)), pa.array(order[rows, which], pa.int32()), pa.array(near[rows, which])],
                                             names=["_k", "list", "near"])

    queries = listed.filter(F.col("_id") % every == 0).select("_k", "_id", "_v")
    probed = stored(queries.select("_k", "_v").mapInArrow(probe, "_k long, list int, near boolean"), "probed")
    unbounded = queries.withColumn("bound", F.lit(float("-inf")))
    first = stored(scanned(listed, unbounded, probed.filter("near"), filled, longest, k), "first")
    # the k-th best so far, if there are k
    bound = best_of(first, k).filter(F.col("rank") == k).select("_k", F.col("score").alias("bound"))
    bounded = queries.join(bound, "_k", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    rest = scanned(listed, bounded, probed.filter("NOT near"), filled, longest, k)
    best = best_of(first.unionByName(rest), k).join(queries.select("_k", F.col("_id").alias("query_id")), "_k")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def best_of(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("_k").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def scanned(listed: DataFrame, queries: DataFrame, probed: DataFrame, filled: np.ndarray, longest: float, k: int) -> DataFrame:
    """(_k, row, vec_id, score): the best of every probed block. ``queries``: (_k, _id, _v, bound)."""
    asking = {r["list"]: r["count"] for r in probed.groupBy("list").count().collect()}  # a number a list
    blocks = F.element_at(F.array(*[F.lit(int(max(1, -(-c // BLOCK)))) for c in filled]), F.col("list") + 1)
    groups = F.element_at(F.array(*[F.lit(-(-asking.get(i, 0) // QUERIES)) for i in range(len(filled))]), F.col("list") + 1)
    left = (listed.filter(groups > 0).withColumn("block", F.pmod(F.xxhash64("_k"), blocks).cast("int"))
            .withColumn("grp", F.explode(F.sequence(F.lit(0), groups - 1))).select("list", "block", "grp", "_k", "_id", "_v"))
    right = (probed.select("_k", "list").join(queries.select(*[F.col(c).alias(c) for c in ("_k", "_v", "bound")]), "_k")
             .withColumn("grp", F.pmod(F.xxhash64("_k"), groups).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select("list", "block", "grp", "_k", "_v", "bound"))
    schema = "_k long, row long, vec_id long, score double"

    def run(key, rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table({"_k": pa.array([], pa.int64()), "row": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        rows, asked = rows.combine_chunks().sort_by("_k"), asked.combine_chunks().sort_by("_k")
        keys, ids, own = rows.column("_k").to_numpy(), rows.column("_id").to_numpy(), asked.column("_k").to_numpy()
        i, j, score = scan(keys, ids, matrix(rows.column("_v").combine_chunks()), own, matrix(asked.column("_v").combine_chunks()),
                           asked.column("bound").to_numpy(), longest, k)
        return pa.table({"_k": own[i], "row": keys[j], "vec_id": ids[j], "score": score})

    return left.groupBy("list", "block", "grp").cogroup(right.groupBy("list", "block", "grp")).applyInArrow(run, schema)


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"))
