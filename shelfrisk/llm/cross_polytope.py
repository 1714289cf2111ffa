"""Embedding near-duplicates by cross-polytope hashing (operator 11).

Two vectors link if their cosine is at least ``COSINE``. A hash function turns a vector by three fast Hadamard
transforms with random signs and takes its largest component by size, with its sign: the nearest corner of the
cross-polytope. A table joins a few such functions to one bucket. Every vector stands in its own bucket of each table and
probes the buckets of its next-likely corners too; all pairs that meet in a bucket are verified by their cosine.

How many functions a table has, how many buckets are probed and how many tables there are follows from a trial on
made-up pairs whose cosine is exactly ``COSINE`` (the hardest to find), so that such a pair meets with the chance ``RECALL``
at least, whatever the data are. Nothing is fitted on the data.

Equal vectors are one class with a count. A crowded bucket is cut into blocks of about ``BLOCK`` vectors, and each task
compares two blocks. A pair that meets several times counts only in the first table where it meets, which both vectors
tell, so no list of pairs is made or shuffled: tasks return sums of links and the roots of their local components.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do
vectors of unequal lengths link; every row is returned, also rows without vec_id and repeated ones; the component of a row
without vec_id and without links is null, and ``kept`` is then false; extra columns don't matter.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .ngram_join import components

COSINE, RECALL = 0.9, 0.99
#: Vectors of a block of a crowded bucket; corners of a function that probes may use; least length after padding.
BLOCK, CORNERS, PADDED = 2048, 3, 32
#: Functions of a table and probes that the trial tries, its pairs and tables.
FUNCTIONS, PROBES, TRIAL_PAIRS, TRIAL_TABLES = (1, 2, 3, 4, 5), (1, 2, 4, 8), 300, 6


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row (its length is a power of two)."""
    n, size = x.shape
    h = 1
    while h < size:
        x = x.reshape(n, size // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, size) / math.sqrt(size)


def padded_size(d: int) -> int:
    return max(PADDED, 1 << (d - 1).bit_length())


def turned(x: np.ndarray, t: int, k: int) -> np.ndarray:
    """The rotation of function ``k`` of table ``t``."""
    signs = np.random.default_rng([41, x.shape[1], t, k]).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buckets(unit: np.ndarray, t: int, functions: int, probes: int) -> np.ndarray:
    """(rows, probes) bucket keys in table ``t``, the own bucket first, then the next-likely ones."""
    n, d = unit.shape
    size = padded_size(d)
    x = np.zeros((n, size))
    x[:, :d] = unit
    corners, gaps = [], []
    for k in range(functions):
        y = turned(x, t, k)
        height = np.abs(y)
        top = np.argsort(-height, axis=1, kind="stable")[:, :CORNERS]
        at = np.take_along_axis(height, top, 1)
        corners.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
        gaps.append((at[:, :1] - at) ** 2)
    choices = np.array(list(product(range(CORNERS), repeat=functions)))
    loss = sum(gaps[k][:, choices[:, k]] for k in range(functions))
    probes = min(probes, len(choices))
    order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
    key = np.full(order.shape, np.uint64((t + 1) * 1_000_003 + d))
    for k in range(functions):
        corner = np.take_along_axis(corners[k], choices[order, k], 1)
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + corner.astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows of bucket keys ``a`` and ``b`` meet: one's own bucket is among the other's."""
    out = np.zeros(len(a), dtype=bool)
    for k in range(a.shape[1]):
        out |= (a[:, 0] == b[:, k]) | (b[:, 0] == a[:, k])
    return out


@lru_cache(maxsize=256)
def tables_for(d: int, magnitude: int) -> tuple[int, int, int]:
    """(functions, probes, tables) for about 2 ** magnitude vectors of length ``d``: the cheapest that gives ``RECALL``."""
    rng = np.random.default_rng([43, d])
    u = rng.standard_normal((TRIAL_PAIRS, d))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((TRIAL_PAIRS, d))
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-300)
    v = COSINE * u + math.sqrt(1 - COSINE**2) * w if d > 1 else u
    best = None
    for functions in FUNCTIONS:
        keys = [(buckets(u, t, functions, max(PROBES)), buckets(v, t, functions, max(PROBES))) for t in range(TRIAL_TABLES)]
        for probes in PROBES:
            p = np.mean([meet(a[:, :probes], b[:, :probes]).mean() for a, b in keys])
            p = min(max(p, 1e-3), 1 - 1e-6)
            need = max(2, math.ceil(math.log(1 - RECALL) / math.log(1 - p)))
            others = 2.0**magnitude * probes / (2.0 * padded_size(d)) ** functions
            cost = need * probes * (1 + 0.05 * others)
            if best is None or cost < best[0]:
                best = (cost, functions, probes, need)
    return best[1:]


def unit_rows(flat: np.ndarray, d: int) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that no square overflows."""
    x = flat.reshape(-1, d).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def by_length(column: pa.Array):
    """(length, positions, unit rows) for each length among the rows of a list column."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        yield d, at, unit_rows(flat[(starts[at][:, None] + np.arange(d)).ravel()], d)


def signer(plans: dict):
    """Arrow batches of (cls, _v) -> (key, t, cls, own)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cls = batch.column("cls").to_numpy()
            for d, at, unit in by_length(batch.column("_v")):
                functions, probes, tables = plans[d]
                for t in range(tables):
                    keys = buckets(unit, t, functions, probes)
                    n, p = keys.shape
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), pa.array(np.full(n * p, t, np.int32)), pa.array(np.repeat(cls[at], p)),
                         pa.array(np.tile(np.arange(p) == 0, n))], names=["key", "t", "cls", "own"])
    return run


def pairs_of_runs(run: np.ndarray, ok, unit: np.ndarray, short: int = 64):
    """Yield (i, j) arrays of linked pairs inside the runs of equal ``run`` numbers (rows sorted by them)."""
    n = len(run)
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, n])
    size_of = np.repeat(sizes, sizes)
    left = np.flatnonzero(size_of <= short)
    for shift in range(1, short):
        left = left[left + shift < n]
        left = left[run[left] == run[left + shift]]
        if not len(left):
            break
        i, j = left, left + shift
        pick = ok(i, j)
        i, j = i[pick], j[pick]
        hit = np.einsum("ij,ij->i", unit[i], unit[j]) >= COSINE
        yield i[hit], j[hit]
    for a, size in zip(starts[sizes > short].tolist(), sizes[sizes > short].tolist(), strict=True):
        for b in range(a, a + size, 512):
            i, j = np.nonzero(unit[b:min(b + 512, a + size)] @ unit[b:a + size].T >= COSINE)
            i, j = i[i < j] + b, j[i < j] + b
            pick = ok(i, j)
            yield i[pick], j[pick]


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the components of linked rows: ``label`` is a row's root, the smallest row of its component."""
    while len(i):
        a, b = label[i], label[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        i, j, low, high = i[open_], j[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label[:] = label[label]


def comparer(plans: dict):
    """Runs of (key, one, two), sorted -> (cls, n, root): links counted in this run's bucket, and a root of the task."""
    names = ["key", "one", "two", "block", "t", "cls", "own", "mult", "_v"]

    def compare(part: pa.Table):
        column = {c: part.column(c).combine_chunks() for c in names}
        key, t, cls, own, mult, one, two, block = (column[c].to_numpy(zero_copy_only=False) for c in ("key", "t", "cls", "own", "mult", "one", "two", "block"))
        classes, row = np.unique(cls, return_inverse=True)
        total, label = np.zeros(len(classes), np.int64), np.arange(len(classes))
        for d, at, unit in by_length(column["_v"]):
            functions, probes, tables = plans[d]
            change = (np.diff(key[at]) != 0) | (np.diff(one[at]) != 0) | (np.diff(two[at]) != 0)
            run = np.r_[0, np.cumsum(change)]

            def ok(i, j, at=at):
                a, b = at[i], at[j]
                return (own[a] | own[b]) & ((one[a] == two[a]) | (block[a] != block[b]))

            for i, j in pairs_of_runs(run, ok, unit):
                if not len(i):
                    continue
                rows, both = np.unique(np.r_[i, j], return_inverse=True)
                i, j = both[:len(i)], both[len(i):]
                swap = cls[at[rows[i]]] > cls[at[rows[j]]]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                when = t[at[rows[i]]]
                for earlier in range(int(when.max()) + 1):
                    keys = buckets(unit[rows], earlier, functions, probes)
                    here = when == earlier
                    own_i, in_j = keys[i, 0], np.zeros(len(i), dtype=bool)
                    for k in range(keys.shape[1]):
                        in_j |= own_i == keys[j, k]
                    counted = here & (key[at[rows[i]]] == np.where(in_j, own_i, keys[j, 0]))
                    a, b = at[rows[i[counted]]], at[rows[j[counted]]]
                    np.add.at(total, row[a], mult[b])
                    np.add.at(total, row[b], mult[a])
                    join_labels(label, row[a], row[b])
                    later = (when > earlier) & ~(in_j | meet(keys[i], keys[j]))
                    i, j, when = i[later], j[later], when[later]
                    if not len(i):
                        break
        hit = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(classes[hit]), pa.array(total[hit]), pa.array(classes[label[hit]])], names=["cls", "n", "root"])

    def run(batches):
        carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch]).select(names)
            part = part if carry is None else pa.concat_tables([carry, part])
            last = [part.column(c)[-1].as_py() for c in ("key", "one", "two")]
            same = np.ones(part.num_rows, dtype=bool)
            for c, x in zip(("key", "one", "two"), last, strict=True):
                same &= part.column(c).to_numpy() == x
            cut = int(np.argmax(same))
            carry = part.slice(cut)
            if cut:
                yield compare(part.slice(0, cut))
        if carry is not None and carry.num_rows:
            yield compare(carry)
    return run


def near_duplicates(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    kind = dict(vectors.dtypes)["embedding"]
    v = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    good = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("_v", lambda c: c != 0)
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("_v"))
            .withColumn("_v", F.when(F.coalesce(good, F.lit(False)), F.col("_v")))
            .withColumns({"_a": F.xxhash64("_v"), "_b": F.xxhash64(F.lit(1), "_v")}))
    classes = stored(rows.filter("_v IS NOT NULL").groupBy("_a", "_b").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("mult"), F.first("_v").alias("_v"))
                     .withColumn("cls", F.monotonically_increasing_id()), "classes")
    lengths = classes.groupBy(F.size("_v").alias("d")).count().collect()  # one row per length of vectors
    plans = {r["d"]: tables_for(r["d"], max(1, int(r["count"]).bit_length())) for r in lengths}

    entries = stored(classes.select("cls", "_v").mapInArrow(signer(plans), "key long, t int, cls long, own boolean"), "entries")
    shared = (entries.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.max("own").alias("any")).filter("m > 1 AND any")
              .select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    placed = (entries.join(shared, "key").withColumn("block", block)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "t", "cls", "own"))
    runs = (placed.join(classes.select("cls", "mult", "_v"), "cls").select("key", "one", "two", "block", "t", "cls", "own", "mult", "_v")
            .repartition("key", "one", "two").sortWithinPartitions("key", "one", "two"))
    found = stored(runs.mapInArrow(comparer(plans), "cls long, n long, root long"), "found")

    links = found.groupBy("cls").agg(F.sum("n").alias("n"))
    edges = found.filter("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b"))
    component = components(edges).withColumnRenamed("key", "cls")
    one = stored(classes.select("_a", "_b", "cls", "mult", "least").join(links, "cls", "left").join(component, "cls", "left")
                 .withColumn("component", F.coalesce("component", "cls")), "linked")
    least = one.groupBy("component").agg(F.min("least").alias("component_id"))
    known = one.join(least, "component").select("_a", "_b", "component_id", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    out = rows.select("vec_id", F.col("_v").isNotNull().alias("valid"), "_a", "_b")
    linked = out.filter("valid").join(known, ["_a", "_b"]).select("vec_id", "n_links", "component_id")
    alone = out.filter("NOT valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) >= 0.9 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))
),
reach(a, b) AS (
    SELECT vec_id, vec_id FROM v
    UNION
    SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v JOIN least l ON l.a = v.vec_id"""
