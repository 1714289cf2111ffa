"""Near-duplicate vectors, the prefix trie and hard negatives: brute force on small tables, edge cases."""
from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfrisk.llm import anchor_tree, cross_polytope, prefix_trie
from shelfrisk.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>, n_links string, component_id string, kept string, least long, cls long"


# -- operator 11 -----------------------------------------------------------------
def near(rng, x, cosine):
    w = rng.standard_normal(len(x))
    w -= (w @ x) / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def brute_links(rows):
    """(links of each row, component of each row), vectors of unequal lengths apart, rows without a usable vector alone."""
    units = {}
    for k, (_, v) in enumerate(rows):
        if v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            units[k] = x / np.linalg.norm(x)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in units:
        for j in units:
            if i < j and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    return links, [min((i for i in least[find(k)] if i is not None), default=None) for k in range(len(rows))]


def linked(spark, rows):
    df = spark.createDataFrame([(i, v, "x", "y", "z", 5, 6) for i, v in rows], VECTORS)
    got = cross_polytope.near_duplicates(spark, df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return got.collect()


@pytest.mark.parametrize("block", [2048, 40])
def test_sure_links_count_once_in_crowded_buckets(spark, monkeypatch, block):
    monkeypatch.setattr(cross_polytope, "BLOCK", block)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(32)
    rows = [(1000 + i, near(rng, centre, 0.995).tolist()) for i in range(220)]  # one crowded group of near copies
    rows += [(i, (3.0 * (i + 1) * centre).tolist()) for i in range(5)]  # multiples of its centre
    rows += [(100 + i, [1.0] * 32) for i in range(60)] + [(7, [1.0] * 32), (None, [1.0] * 32)]  # equal vectors, a shared vec_id, none
    rows += [(5000 + i, rng.standard_normal(32).tolist()) for i in range(200)]
    rows += [(6000, None), (6001, []), (6002, [0.0] * 32), (6003, [math.nan] * 32), (6004, [math.inf] + [1.0] * 31), (6005, [None] + [1.0] * 31), (None, None),
             (6006, [1.0] * 31), (6007, [1e200] * 32), (6008, [1e-200] * 32), (6009, [-1.0] * 32)]
    links, component = brute_links(rows)
    expected = sorted((i is None, i or 0, n, c is None, c or 0, i is not None and i == c) for (i, _), n, c in zip(rows, links, component, strict=True))
    got = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id is None, r.component_id or 0, r.kept) for r in linked(spark, rows))
    assert got == expected


def test_recall_of_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((700, 48))
    rows = [(i, x.tolist()) for i, x in enumerate(base)] + [(10_000 + i, near(rng, x, 0.9 + 1e-9).tolist()) for i, x in enumerate(base)]
    links, _ = brute_links(rows)
    got = {r.vec_id: r.n_links for r in linked(spark, rows)}
    assert all(got[i] <= n for (i, _), n in zip(rows, links, strict=True))
    assert sum(got.values()) >= 0.97 * sum(links) >= 1300


def test_no_vectors(spark):
    assert linked(spark, []) == []
    assert [tuple(r) for r in linked(spark, [(3, None)])] == [(3, 0, 3, True)]


def test_hadamard_keeps_lengths_and_own_bucket_comes_first():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((50, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose(np.linalg.norm(cross_polytope.hadamard(np.pad(x, ((0, 0), (0, 12)))), axis=1), 1)
    one, four = cross_polytope.buckets(x, 3, 2, 1), cross_polytope.buckets(x, 3, 2, 4)
    assert (one[:, 0] == four[:, 0]).all() and all(len(set(r)) == 4 for r in four.tolist())


# -- operator 12 -----------------------------------------------------------------
CONVERSATIONS = "conv_id long, turn long, role string, text string, depth string, n_convs string, c long, a long, size long"


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        path = turns.get(c - c % 5, [])[:h] + turns[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def totals(p):
        leaves, saved = int(not children[p]), (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        for q in children[p]:
            below = totals(q)
            leaves, saved = leaves + below[0], saved + below[1]
        return leaves, saved

    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), *totals(p),
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def trie(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], CONVERSATIONS)
    got = prefix_trie.prefix_trie(spark, df, **options)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if x is None else x for x in r) for r in got.collect())


def conversations():
    rng = random.Random(8)
    rows = []
    for c in range(260):
        hot = c % 3 == 0
        for turn in range(rng.randint(1, 14)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", f"hot {turn}" if hot and turn < 9 else f"é{rng.randint(0, 2)}"))
    rows += [(400, 0, "user", "w" * 300_000), (401, 0, "user", "only")]  # a very long text; a conversation that may keep nothing
    rows += [(700, t, None, None) for t in (None, 1, 2, 2, 2)] + [(705, 3, "user", None), (705, 3, None, "user"), (705, None, "b", "a"), (None, 1, "user", "no id")]
    rows += rows[:30]  # repeated rows are repeated turns
    rows += [(c, 0, "r", "t") for c in (901, 902, 903, 904, 906, 907)]  # no source: some end at the root
    return rows


@pytest.mark.parametrize("options", [{}, {"shards": 12, "least": 2}, {"shards": 1, "least": 1}])
def test_trie_equals_brute_force(spark, options):
    rows = conversations()
    random.Random(9).shuffle(rows)
    expected = brute_trie(rows)
    assert trie(spark, rows, **options) == expected
    assert expected[0][1] == 0 or any(r[1] == 0 for r in expected)


def test_no_conversations(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "x")]) == []


def test_queue_spills_and_merges_runs():
    rng = random.Random(10)
    queue, all_ = prefix_trie.SpillingQueue(limit=20, runs=3), []
    for _ in range(2000):
        message = (rng.randint(0, 40), rng.randint(0, 5), rng.random())
        all_.append(message)
        queue.push(message)
    assert len(queue.heap) <= 20 and queue.runs
    out = [m for key in sorted({x[:2] for x in all_}) for m in queue.take(key)]
    assert out == sorted(all_)


def test_digest_streams_over_batches():
    rows = [(1, 2, 3, c) for c in range(10)] + [(1, 2, 4, 7)] + [(2, 0, 0, c) for c in (-5, 3)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[i:i + 3])], names=["d", "a", "b", "c"]) for i in range(0, len(rows), 3)]
    got = {tuple(r.values())[:3]: r["ends_sha256"] for b in prefix_trie.digests(batches) for r in b.to_pylist()}
    assert got == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in (((1, 2, 3), "0,1,2,3,4,5,6,7,8,9"), ((1, 2, 4), "7"), ((2, 0, 0), "-5,3"))}


# -- operator 13 -----------------------------------------------------------------
LABELLED = "vec_id long, embedding array<double>, label int, score long, rank int, key long, x string, p long"


def brute_negatives(rows, every=100):
    whole = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            whole.append((i, [math.floor(256 * c) for c in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for k, (i, a, label) in enumerate(whole):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, m, other) for m, (j, b, other) in enumerate(whole) if m != k and len(a) == len(b))
        for s, j, _, _ in [x for x in scored if x[3] == label][:5]:
            window = [x for x in scored if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, r, n[1], -s, -n[0]) for r, n in enumerate(window, 1)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, "x", 4) for r in rows], LABELLED)
    got = anchor_tree.hard_negatives(spark, df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def labelled(n=900, d=12):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((9, d)) * 2
    rows = [(i, (centres[i % 9] + 0.4 * rng.standard_normal(d)).tolist(), int(rng.integers(0, 10))) for i in range(n)]
    rows += [(1000 + i, rows[3][1], 3 + i % 2) for i in range(60)]  # equal vectors: ties
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, small):
    if small:  # several groups of anchors and blocks of rows
        monkeypatch.setattr(anchor_tree, "GROUP", 3)
        monkeypatch.setattr(anchor_tree, "LEAST_BLOCK", 100)
        monkeypatch.setattr(anchor_tree, "AHEAD", 4)
    rows = labelled()
    rows += [rows[200], rows[200], (200, rows[5][1], 4), (300, rows[7][1], None)]  # repeated anchors, one id with two vectors
    rows += [(2000, None, 1), (2100, [math.nan] * 12, 1), (2200, [math.inf] * 12, 1), (2300, [None] * 12, 1), (None, [1.0] * 12, 1)]
    rows += [(2400, [1.0, 2.0, 3.0], 1), (2403, [1.0, 2.0, 2.5], 1), (2402, [0.5, 1.0, 1.5], 2), (2500, [], 1), (2501, [], 1), (2502, [], 2), (2600, [0.0] * 12, 1)]
    expected = brute_negatives(rows)
    assert mined(spark, rows) == expected
    assert {2400, 2500, 200} <= {r[0] for r in expected}


def test_large_components_are_exact(spark):
    rows = [(0, [1e7, 1.0], 1), (1, [1e7, 2.0], 1), (2, [8e6, 3.0], 2), (3, [8e6, 3.00390625], 3), (4, [1e250, 1.0], 1), (5, [1.7e308, 1.0], 2)]
    got = mined(spark, rows)
    # The row with 1e250 leads the positives with a score cut to a long's range; the others' scores are exact.
    assert [r for r in got if r[1] == 1] == [r for r in brute_negatives(rows[:4]) if r[1] == 1]
    assert mined(spark, []) == [] and mined(spark, [(3, [1.0], 1)]) == []


def test_close_anchors_spare_most_scores():
    rng = np.random.default_rng(12)
    x = np.floor(256 * rng.standard_normal((3000, 16)))
    close = np.floor(256 * rng.standard_normal(16)) + rng.integers(-3, 4, (40, 16))
    rows = pa.table({"key": np.arange(3040), "vec_id": np.arange(3040), "label": np.arange(3040) % 2, "x": pa.array(np.vstack([x, close]).tolist())})
    anchors = rows.slice(3000)
    out, scored, of = anchor_tree.mine(anchors, rows, False, 5)
    assert scored < 0.1 * of
    points = np.vstack([x, close])
    for anchor in range(3000, 3040):
        s = points @ points[anchor]
        expected = sorted((-s[j], j) for j in range(3040) if j % 2 == anchor % 2 and j != anchor)[:5]
        assert [r["row"] for r in out.to_pylist() if r["anchor"] == anchor] == [j for _, j in expected]


def test_queries_are_registered():
    assert {"op11_cross_polytope", "op12_prefix_trie", "op13_anchor_tree"} <= set(QUERIES)
