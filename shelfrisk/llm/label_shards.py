"""Sharding by balanced label propagation (operator 10), in DataFrame functions only.

Law ``rows``: the shards' counts differ by one at most. Documents with equal texts are linked. Every document
starts in a shard by its hash; then, in rounds, linked documents ask to move to the shard that holds most of their
neighbours and has room, and a shard lets in as many as its capacity leaves, whole groups where it can. The rounds
end when nobody moves.
Since neighbours are alike, a round works on counts (group, shard), of which a group of copies has one per shard, not
one per document. Documents without links have no edge to cut and fill what is left of every shard's quota exactly.

Ranks over many rows are counted in two steps, inside hash buckets and over the buckets' totals, so no shard, group
of copies or list of all rows is ordered in one task.

Defined results: a null text has no links, size 8 and checksum 0; an empty text is a text; a null doc_id is placed
like any other; repeated rows are documents of their own. ``grown_shard`` belongs to another law and is null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small, stored, table

SHARDS = 24
#: Bins by which a shard's room is shared out: classes of group sizes, the largest groups first, and hashes in each; rows of
#: the small tables of labels that a file holds.
CLASSES, HASHES, ROWS_A_FILE = 12, 32, 500_000
BINS = CLASSES * HASHES


def bucket_count(rows: int) -> int:
    """As many buckets as rows in each: neither a bucket nor the list of their totals gets long."""
    return max(1, math.isqrt(rows))


def ranked(rows: DataFrame, within: list[str], order: list[str], spread: Column, buckets: int, name: str, weight: str | None = None) -> DataFrame:
    """``rows`` with ``name``: the rank from 0 in each ``within`` (or the weights before the row), in the order of
    the buckets of ``spread`` and then of ``order``."""
    placed = rows.withColumn("_b", F.pmod(spread, F.lit(buckets)))
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    totals = placed.groupBy(*within, "_b").agg(amount.alias("_n"))
    before = Window.partitionBy(*within).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*within, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*within, "_b").orderBy(*order)
    own = F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) if weight else F.row_number().over(inside) - 1
    placed = placed.withColumn(name, own)
    return placed.join(totals, [*within, "_b"]).withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_b", "_before")


def asked(counts: DataFrame, free: list[int]) -> DataFrame:
    """(group, all, shard, n, to, smaller): where the documents of a group ask to move, null if they stay.

    ``all``: the group's size. A group gathers in the shard that holds most of it among those where all of it fits, else in
    as many of the shards that hold most of it as it needs, and the others' documents are dealt between these.
    ``smaller``: they come from fewer; only these may move in part. The sum of the squares of n therefore grows
    with every move, and the rounds come to an end.
    """
    room = F.array(*[F.lit(f).cast("long") for f in free])

    def free_in(h):
        return F.element_at(room, 1 - h["less"])

    held = counts.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("n", (-F.col("shard")).alias("less"))), asc=False).alias("held"),
                                       F.sum("n").alias("all"))  # at most one entry a shard
    held = held.withColumn("fit", F.filter("held", lambda h: h["n"] + free_in(h) >= F.col("all"))).withColumn(
        "reach", F.transform("held", lambda h, i: F.aggregate(F.slice("held", F.lit(1), i + 1), F.lit(0).cast("long"), lambda t, o: t + o["n"] + free_in(o))))
    needed = F.size(F.filter("reach", lambda r: r < F.col("all"))) + 1
    held = held.withColumn("into", F.when(F.size("fit") > 0, F.slice("fit", 1, 1)).otherwise(F.slice("held", F.lit(1), needed)))
    held = held.withColumn("open", F.filter("into", lambda h: free_in(h) > 0))
    rows = held.select("group", "all", "into", "open", F.posexplode("held").alias("place", "h"))
    to = F.try_element_at("open", (F.col("place") % F.greatest(F.size("open"), F.lit(1)) + 1).cast("int"))
    leaves = ~F.array_contains("into", F.col("h"))
    return rows.select("group", "all", (-F.col("h.less")).alias("shard"), F.col("h.n").alias("n"), F.when(leaves, -to["less"]).alias("to"),
                       F.coalesce(F.col("h") < to, F.lit(False)).alias("smaller"))


def admitted(asks: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], tuple[int, int]]:
    """What each shard lets in of each bin: (let in, of all asked); bins in order, the last one in part."""
    out, left = {}, list(free)
    for (to, slot), n in sorted(asks.items()):
        if left[to] > 0:
            out[to, slot] = (min(n, left[to]), n)
            left[to] -= min(n, left[to])
    return out


def propagate(counts: DataFrame, room: list[int]) -> DataFrame:
    """(group, shard, n) of linked documents when no more move. ``room``: each shard's capacity.

    A round is two jobs with one exchange each: the asked numbers by shard and bin of groups (a fixed number of sums),
    from which each shard's admissions follow, and the new counts. Where a bin fits in part, each of its groups does.
    """
    spark = counts.sparkSession
    counts = stored(counts, "labels")
    files = 1 + counts.count() // ROWS_A_FILE  # moves never make more rows
    while True:
        loads = counts.agg(*[F.coalesce(F.sum(F.when(F.col("shard") == s, F.col("n"))), F.lit(0)).alias(str(s)) for s in range(len(room))]).first()
        free = [r - loads[s] for s, r in enumerate(room)]
        kind = F.least(F.lit(CLASSES - 1), F.floor(F.log2("all")).cast("int"))
        asks = asked(counts, free).withColumn("bin", ((CLASSES - 1 - kind) * HASHES + F.pmod(F.xxhash64("group"), F.lit(HASHES))).cast("int"))
        wanted = {(r["to"], r["bin"]): r["n"] for r in asks.filter("to IS NOT NULL").groupBy("to", "bin").agg(F.sum("n").alias("n")).collect()}
        let_in = admitted(wanted, free)
        if not let_in:
            return counts
        # at most shards x bins rows: what is let in; without a row nobody is
        shares = spark.createDataFrame([(to, slot, x, n) for (to, slot), (x, n) in let_in.items()], "to int, bin int, some long, of long")
        shared = asks.join(F.broadcast(shares), ["to", "bin"], "left")
        part = F.floor(F.col("n").cast("decimal(38,0)") * F.col("some") / F.col("of"))
        going = F.when(F.col("some") == F.col("of"), F.col("n")).when(F.col("smaller"), part).cast("long")
        moved = shared.withColumn("going", F.coalesce(going, F.lit(0).cast("long")))
        parts = F.array(F.struct(F.col("shard"), (F.col("n") - F.col("going")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("going").alias("n")))
        after = moved.select("group", F.inline(parts)).filter("n > 0").groupBy("group", "shard").agg(F.sum("n").alias("n"))
        new = stored(after.coalesce(files), "labels")
        if not new.join(counts, ["group", "shard", "n"], "left_anti").limit(1).count():
            return counts
        counts = new


def shards(spark: SparkSession, docs: DataFrame, k: int = SHARDS) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
                       F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), F.md5(text).alias("group"))
    rows = stored(rows, "documents")
    n = rows.count()
    quota = [n // k + (s < n % k) for s in range(k)]
    buckets = bucket_count(n)
    linked = stored(rows.filter("group IS NOT NULL").groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "linked")
    mine = rows.join(small(linked.select("group")), "group")
    spread = F.xxhash64("doc_id", "group")
    start = mine.groupBy("group", F.pmod(spread, F.lit(k)).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    final = propagate(settled(start, quota), quota)
    # the linked: the i-th of a group goes to the shard in whose stretch of the group i lies
    until = Window.partitionBy("group").orderBy("shard")
    stretch = (final.withColumn("until", F.sum("n").over(until)).groupBy("group")
               .agg(F.sort_array(F.collect_list(F.struct("until", "shard"))).alias("stretch")))  # a row a shard at most
    mine = ranked(mine, ["group"], ["doc_id"], spread, buckets, "i")
    mine = mine.join(stretch, "group").withColumn("shard", F.filter("stretch", lambda s: s["until"] > F.col("i"))[0]["shard"])
    # the others fill up the quotas
    loads = {r["shard"]: r["n"] for r in final.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    ends, total = [], 0
    for s in range(k):
        total += quota[s] - loads.get(s, 0)
        ends.append(total)
    alone = rows.join(small(linked.select("group")), "group", "left_anti").withColumn("_all", F.lit(0))
    alone = ranked(alone, ["_all"], ["doc_id", "group"], spread, buckets, "i")
    place = F.array(*[F.struct(F.lit(e).cast("long").alias("end"), F.lit(s).alias("shard")) for s, e in enumerate(ends)])
    alone = alone.withColumn("shard", F.filter(place, lambda p: p["end"] > F.col("i"))[0]["shard"])
    columns = ["doc_id", "size", "text_crc32", "group", "shard"]
    placed = stored(mine.select(*columns).unionByName(alone.select(*columns)), "placed")
    slots = ranked(placed, ["shard"], ["doc_id", "group"], spread, buckets, "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def settled(counts: DataFrame, quota: list[int]) -> DataFrame:
    """Start labels within the quotas: what hashing put into a shard beyond its quota goes to the ones with room.

    Only possible where nearly all documents are linked; the excess is dealt out as whole stretches of a ranking.
    """
    counts = stored(counts, "start")
    loads = {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    over = {s: loads.get(s, 0) - q for s, q in enumerate(quota)}
    if max(over.values()) <= 0:
        return counts
    buckets = bucket_count(counts.count())
    rank = ranked(counts, ["shard"], ["group"], F.xxhash64("group"), buckets, "ahead", "n")
    limit = F.element_at(F.array(*map(F.lit, quota)), F.col("shard") + 1)
    rank = stored(rank.withColumn("stay", F.greatest(F.lit(0), F.least("n", limit - F.col("ahead"))).cast("long")), "stay")
    excess = rank.filter("n > stay").select("group", (F.col("n") - F.col("stay")).alias("n"), F.lit(0).alias("_all"), "shard")
    excess = ranked(excess, ["_all"], ["group", "shard"], F.xxhash64("group"), buckets, "ahead", "n")
    gaps, total = [], 0
    for s, o in over.items():
        if o < 0:
            gaps.append(F.struct(F.lit(s).alias("shard"), F.lit(total).cast("long").alias("lo"), F.lit(total - o).cast("long").alias("hi")))
            total -= o
    dealt = (excess.withColumn("gap", F.explode(F.array(*gaps))).withColumn("lo", F.greatest("gap.lo", "ahead"))
             .withColumn("hi", F.least(F.col("gap.hi"), F.col("ahead") + F.col("n"))).filter("hi > lo")
             .select("group", F.col("gap.shard").alias("shard"), (F.col("hi") - F.col("lo")).alias("n")))
    return (rank.filter("stay > 0").select("group", "shard", F.col("stay").alias("n")).union(dealt)
            .groupBy("group", "shard").agg(F.sum("n").alias("n")))


def op10_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(spark, table(spark, sf_dir, "documents"))
