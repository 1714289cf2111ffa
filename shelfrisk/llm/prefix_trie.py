"""Conversation prefix trie by time-forward processing (operator 12).

Conversations that share their first turns share a path from the root; a node stands for one distinct sequence of first
turns. Its totals (children, leaves, bytes that sharing saves) sum over its subtree. Nodes are known by a 128-bit hash of
their sequence: the exclusive or of the hashes of its turns with their positions, a running window sum.

Totals go up by time-forward processing: nodes are sorted externally by reverse level order; each takes its children's
messages from a priority queue, adds them up and sends its own to its parent. The queue keeps ``QUEUE`` messages in memory
and spills sorted runs to the task's scratch disk. A message carries its child's finished row, so the parent also tells
the child its ``conv_id``.

Shards: a node with more than 1 / ``SHARDS`` of all turns below it is heavy; there are at most ``SHARDS`` of them (and the
root), which bounds what is broadcast. What hangs below a heavy node is a shard of its own. Shards are processed side by
side, then the shard roots' totals, summed per heavy parent, go up through the heavy nodes in a second pass.
A conversation's turns are put in order by one task, as are the members that end at one node for their digest (a
SHA-256 is sequential by nature); both are external sorts that stream.

Defined results: rows without conv_id belong to no conversation; null role or text is empty; turns of one number stand in
the order of role and text, null turns come first; repeated rows are repeated turns; ``c - c % 5`` takes the remainder's sign
from c; without any conversation there is no root, so no row; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

#: Bound of the number of heavy nodes; conversations that make no node heavy; messages of a queue in memory; open runs.
SHARDS, LEAST, QUEUE, RUNS = 2000, 64, 200_000, 64
NODE = ["d", "a", "b", "pa", "pb", "conv_id", "n_convs", "bytes", "top", "children0", "leaves0", "saved0"]
DONE = "d long, a long, b long, pa long, pb long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean"


class SpillingQueue:
    """A priority queue of tuples that keeps at most ``limit`` in memory and the rest in sorted runs on scratch disk."""

    def __init__(self, limit: int = QUEUE, runs: int = RUNS):
        self.heap, self.limit, self.most = [], limit, runs
        self.runs: list[tuple] = []  # (first message, number, the run's remaining messages)
        self.number = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self.heap.sort()
            half = len(self.heap) // 2
            self._add(iter(self._written(self.heap[half:])))
            del self.heap[half:]  # a sorted list is a heap
            if len(self.runs) > self.most:
                merged = heapq.merge(*[self._whole(r) for r in self.runs])
                self.runs = []
                self._add(iter(self._written(merged)))

    @staticmethod
    def _whole(run):
        yield run[0]
        yield from run[2]

    @staticmethod
    def _written(messages, chunk: int = 4096):
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        part = []
        for m in messages:
            part.append(m)
            if len(part) == chunk:
                pickle.dump(part, file)
                part = []
        if part:
            pickle.dump(part, file)
        end = file.tell()
        file.seek(0)

        def read():
            with file:
                while file.tell() < end:
                    yield from pickle.load(file)
        return read()

    def _add(self, messages) -> None:
        first = next(messages, None)
        if first is not None:
            self.number += 1
            heapq.heappush(self.runs, (first, self.number, messages))

    def take(self, key: tuple):
        """Yield all messages whose first fields are ``key``; none smaller may be left."""
        n = len(key)
        while True:
            if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
                first, _, rest = self.runs[0]
                if first[:n] != key:
                    return
                heapq.heappop(self.runs)
                self._add(rest)
                yield first
            elif self.heap and self.heap[0][:n] == key:
                yield heapq.heappop(self.heap)
            else:
                return


def done_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in DONE.split(", ")]
    kinds = [pa.bool_() if n == "top" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def passed_up(batches):
    """Nodes in reverse level order (deepest first, then by hash) -> their finished rows."""
    queue, out = SpillingQueue(), []
    for batch in batches:
        for d, a, b, pa_, pb, conv, n, size, top, children, leaves, saved in zip(*(batch.column(c).to_pylist() for c in NODE), strict=True):
            for message in queue.take((-d, a, b)):
                out.append((*message[3:9], conv, *message[9:], False))
                children += 1
                leaves += message[11]
                saved += message[12]
                if len(out) >= 8192:
                    yield done_rows(out)
                    out = []
            saved += (n - 1) * size
            row = (d, a, b, pa_, pb, conv)
            totals = (n, children, leaves if children else 1, saved)
            if top:
                out.append((*row, None, *totals, True))
            else:
                queue.push((1 - d, pa_, pb, *row, *totals))
    if out:
        yield done_rows(out)


def digests(batches):
    """(d, a, b, c), sorted -> (d, a, b, ends_sha256), a digest that grows as the members stream by."""
    state, key = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in ("d", "a", "b")]
        cut = np.flatnonzero(np.r_[True, np.logical_or.reduce([x[1:] != x[:-1] for x in columns])])
        members = batch.column("c").to_numpy().astype(str).tolist()
        done = []
        for start, end in zip(cut.tolist(), [*cut[1:].tolist(), batch.num_rows], strict=True):
            this = tuple(int(x[start]) for x in columns)
            text = ",".join(members[start:end])
            if this == key:
                state.update(b"," + text.encode())
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = this, hashlib.sha256(text.encode())
        yield digest_rows(done)
    if key is not None:
        yield digest_rows([(*key, state.hexdigest())])


def digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], names=["d", "a", "b", "ends_sha256"])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, d, role, text): the turns of the rebuilt conversations, and (c, size): their lengths, 0 included."""
    turns = (conversations.filter("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("long").alias("c"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    turns = turns.withColumn("pos", F.row_number().over(Window.partitionBy("c").orderBy(F.asc_nulls_first("turn"), "role", "text"))).drop("turn")
    lengths = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    convs = lengths.select("c", "own", (F.col("c") - F.col("c") % 5).alias("s"), (F.crc32(F.col("c").cast("string")) % 9).alias("h"))
    convs = (convs.join(lengths.select(F.col("c").alias("s"), F.col("own").alias("of_source")), "s", "left")
             .withColumn("first", F.least("h", F.coalesce("of_source", F.lit(0)))))
    heads = turns.filter("pos <= 8").withColumnRenamed("c", "s")
    first = convs.select("c", "s", "h").join(heads, "s").filter("pos <= h").select("c", F.col("pos").cast("long").alias("d"), "role", "text")
    rest = (turns.join(convs.select("c", "h", "first"), "c").filter("pos > h")
            .select("c", (F.col("first") + F.col("pos") - F.col("h")).alias("d"), "role", "text"))
    sizes = convs.select("c", (F.col("first") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"))
    return first.unionByName(rest), sizes


def prefix_trie(spark: SparkSession, conversations: DataFrame, shards: int = SHARDS, least: int = LEAST) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    return trie_of(*rebuilt(conversations), shards, least)


def trie_of(turns: DataFrame, sizes: DataFrame, shards: int = SHARDS, least: int = LEAST) -> DataFrame:
    """The trie of (c, d, role, text) with d from 1 without gaps, and (c, size) for every conversation, turnless ones too."""
    sizes = stored(sizes, "sizes")
    so_far = Window.partitionBy("c").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = turns.select("c", "d", F.octet_length("text").cast("long").alias("bytes"),
                         *[F.xxhash64(F.lit(k), "d", "role", "text").alias(x) for k, x in enumerate("xy")])
    paths = stored(steps.withColumns({"a": F.bit_xor("x").over(so_far), "b": F.bit_xor("y").over(so_far)})
                   .select("c", "d", "bytes", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb")), "paths")
    # A parent of depth 0 is the root, whose hashes are 0.
    root = sizes.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").selectExpr(
        "0L AS d", "0L AS a", "0L AS b", "0L AS pa", "0L AS pb", "conv_id", "n_convs", "0L AS bytes")
    nodes = stored(paths.groupBy("d", "a", "b").agg(F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.min("c").alias("conv_id"),
                                                    F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes")).unionByName(root), "nodes")
    quota = max(least, (nodes.agg(F.sum("n_convs")).first()[0] or 0) // shards)
    is_heavy = (F.col("n_convs") > quota) | (F.col("d") == 0)
    heavy = nodes.filter(is_heavy)  # at most ``shards`` nodes and the root: each has more than the quota of all members

    at_heavy = F.broadcast(heavy.select("d", "a", "b"))
    tops = paths.join(at_heavy, ["d", "a", "b"], "left_anti").groupBy("c").agg(F.min(F.struct("d", "a", "b")).alias("shard"))
    light = (nodes.filter(~is_heavy).join(tops.withColumnRenamed("c", "conv_id"), "conv_id")
             .withColumn("top", F.col("shard") == F.struct("d", "a", "b"))
             .withColumns({c: F.lit(0).cast("long") for c in NODE[-3:]}))
    below = stored(light.repartition("shard").sortWithinPartitions(F.desc("d"), "a", "b").select(*NODE).mapInArrow(passed_up, DONE), "below")

    held = below.filter("top").groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("children0"), F.sum("n_leaves").alias("leaves0"), F.sum("saved_tokens").alias("saved0"))
    above = (heavy.join(held, ["d", "a", "b"], "left").na.fill(0, NODE[-3:]).withColumn("top", F.col("d") == 0)
             .coalesce(1).sortWithinPartitions(F.desc("d"), "a", "b").select(*NODE).mapInArrow(passed_up, DONE))
    parents = F.broadcast(heavy.select((F.col("d") + 1).alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent")))
    hung = below.join(parents, ["d", "pa", "pb"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent")).drop("parent")
    done = above.unionByName(hung)

    ends = paths.join(sizes, "c").filter("d = size").select("d", "a", "b", "c").unionByName(sizes.filter("size = 0").selectExpr("0L AS d", "0L AS a", "0L AS b", "c"))
    ends = ends.repartition("d", "a", "b").sortWithinPartitions("d", "a", "b", "c").mapInArrow(digests, "d long, a long, b long, ends_sha256 string")
    return done.join(ends, ["d", "a", "b"], "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark, table(spark, sf_dir, "conversations"))


OP12_SQL = """
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT c, count(*) AS own, c - c % 5 AS s,
           xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda crc, x: list_reduce(list_prepend(xor(crc, x), range(8)),
                   lambda y, i: xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 9 AS h
    FROM turns GROUP BY c
),
placed AS (
    SELECT v.*, least(v.h, coalesce(s.own, 0)) AS f FROM convs v LEFT JOIN convs s ON s.c = v.s
),
rebuilt AS (
    SELECT p.c, t.pos AS d, t.role, t.text FROM placed p JOIN turns t ON t.c = p.s AND t.pos <= p.h
    UNION ALL
    SELECT p.c, p.f + t.pos - p.h, t.role, t.text FROM placed p JOIN turns t ON t.c = p.c AND t.pos > p.h
),
paths AS (
    SELECT c, d, strlen(text) AS bytes, md5(to_json(list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY d))) AS node FROM rebuilt
    UNION ALL SELECT c, 0, 0, '' FROM convs
),
lasts AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
nodes AS (
    SELECT p.node, p.d, min(p.c) AS conv_id, count(*) AS n, max(bytes) AS bytes,
           sha256(coalesce(string_agg(CASE WHEN l.d = p.d THEN CAST(p.c AS VARCHAR) END, ',' ORDER BY p.c), '')) AS ends
    FROM paths p JOIN lasts l ON l.c = p.c GROUP BY p.node, p.d
),
linked AS (
    SELECT n.*, up.node AS parent FROM nodes n LEFT JOIN paths up ON up.c = n.conv_id AND up.d = n.d - 1
),
kids AS (SELECT parent, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
below AS (
    SELECT above.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum((n.n - 1) * n.bytes) AS saved
    FROM nodes n JOIN paths above ON above.c = n.conv_id AND above.d <= n.d
    LEFT JOIN (SELECT parent AS node FROM kids) k ON k.node = n.node
    GROUP BY above.node
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n_children, 0) AS n_children,
       b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM linked n LEFT JOIN nodes u ON u.node = n.parent LEFT JOIN kids k ON k.parent = n.node JOIN below b ON b.node = n.node"""
