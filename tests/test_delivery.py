"""Store order across batches and size-aware packing of delivered files."""
from __future__ import annotations

import json
import random
from collections import defaultdict

from pyspark.sql import functions as F

from shelfrisk.session import scratch_path
from shelfrisk.sources import files
from shelfrisk.streaming import delivery, job

COLUMNS = ("event_id", "event_type", "event_ts", "store_id", "product_id", "units", "dt", "extra")


def batch_of(spark, rng, n, stores=("S001", "S002", "S002", "S002"), days=2):
    events = [{"event_type": "pos_sale", "event_id": f"e{rng.randint(0, 10**9)}", "event_ts": f"2031-03-0{rng.randint(1, days)}T{rng.randint(10, 19)}:00:00Z",
               "store_id": rng.choice(stores), "product_id": "P00001", "units": 1, "unit_price": 2.5, "note": "x" * rng.randint(0, 30)} for _ in range(n)]
    return spark.createDataFrame([(json.dumps(e),) for e in events] + [("[1]",)], "value string").repartition(4), events


def content(spark, lake):
    return sorted(tuple(str(x) for x in r) for r in job.read_good(spark, lake).select(*COLUMNS).collect())


def test_store_numbers_run_on_over_batches_and_replays(spark):
    rng, lake = random.Random(3), job.Lake(scratch_path(spark, "test-sequence"))
    deliver = job.split_and_deliver(lake, numbered=True)
    expected, last = {}, defaultdict(int)
    for batch_id in range(4):
        batch, events = batch_of(spark, rng, 80)
        deliver(batch, batch_id)
        if batch_id % 2:
            deliver(batch, batch_id)  # replayed after a failure
        for e in sorted(events, key=lambda e: (e["store_id"], e["event_ts"], e["event_id"])):
            last[e["store_id"]] += 1
            expected[e["event_id"]] = last[e["store_id"]]
    rows = job.read_good(spark, lake).collect()
    assert {r["event_id"]: r["store_seq"] for r in rows} == expected and len(rows) == 320
    deliver(spark.createDataFrame([("[1]",)], "value string"), 4)  # a batch without a good event keeps the totals
    batch, events = batch_of(spark, rng, 5, stores=("S002",))
    deliver(batch, 5)
    assert max(r["store_seq"] for r in job.read_good(spark, lake).where("store_id = 'S002'").collect()) == last["S002"] + 5


def test_a_busy_store_is_numbered_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would else be one task
    rows = [("S001", f"2031-03-01T{i % 24:02d}:00:00Z", f"e{i:04d}") for i in range(400)] + [("S002", "2031-03-01T00:00:00Z", "x")]
    root = scratch_path(spark, "test-busy")
    try:
        got = delivery.numbered(spark.createDataFrame(rows, "store_id string, event_ts string, event_id string"), f"{root}/s", f"{root}/t", 0).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = [r for r in sorted(rows) if r[0] == "S001"]
    assert [(r.store_id, r.event_ts, r.event_id) for r in sorted(got, key=lambda r: (r.store_id, r.store_seq)) if r.store_id == "S001"] == ordered
    assert spark.read.parquet(f"{root}/s/batch_id=0").where("store_id = 'S001'").select("_range").distinct().count() > 1


def test_bins_hold_the_target_and_never_mix_days():
    rng = random.Random(5)
    found = [delivery.Delivered(f"event_type=pos_sale/dt=2031-03-0{1 + i % 3}/batch_id={i}/p", rng.randint(1, 120)) for i in range(300)]
    packed = delivery.bins(found, target=100)
    assert all(sum(f.bytes for f in b) <= 100 and len({f.group for f in b}) == 1 and len(b) > 1 for b in packed)
    small = [f for f in found if f.bytes < 50]
    assert len({f.path for b in packed for f in b}) == sum(map(len, packed)) >= len(small) - 6
    assert sum(sum(f.bytes for f in b) < 50 for b in packed) <= 3  # at most the last bin of a day stays light
    assert delivery.bins(found[:1], 100) == []


def test_small_files_are_packed_and_nothing_changes_for_readers(spark):
    rng, lake = random.Random(6), job.Lake(scratch_path(spark, "test-pack"))
    deliver = job.split_and_deliver(lake)
    batches = [batch_of(spark, rng, 60)[0] for _ in range(7)]
    for batch_id, batch in enumerate(batches[:6]):
        deliver(batch, batch_id)
    before, raw = content(spark, lake), delivery.delivered_files(spark, lake.good, -1)
    target = sum(f.bytes for f in raw) // 3
    done = delivery.pack(spark, lake.good, lake.packings, job.GOOD_SCHEMA, upto=5, target=target)
    assert content(spark, lake) == before and done.upto == 5
    assert len(done.files) < len(raw) / 2
    by_group = defaultdict(list)
    for f in done.files:
        by_group[f.group].append(f.bytes)
    # Joined text compresses better than its parts: full bins come out somewhat below the target, none above it.
    assert all(max(sizes) <= 1.1 * target and sum(s < 0.35 * target for s in sizes) <= 1 for sizes in by_group.values())

    deliver(batches[6], 6)
    deliver(batches[6], 6)  # the newest batch replayed after the packing
    after = content(spark, lake)
    assert len(after) == 7 * 60 and set(before) < set(after)
    assert delivery.pack(spark, lake.good, lake.packings, job.GOOD_SCHEMA, upto=6, target=target).version == 2
    assert content(spark, lake) == after
    one_day = job.read_good(spark, lake).where((F.col("dt") == "2031-03-01") & (F.col("event_type") == "pos_sale"))
    assert one_day.count() == sum(r[6] == "2031-03-01" for r in after)


def test_a_packing_that_died_or_came_second_is_not_seen(spark, monkeypatch):
    rng, lake = random.Random(7), job.Lake(scratch_path(spark, "test-pack-twice"))
    deliver = job.split_and_deliver(lake, pack_every=2, target_bytes=1 << 20)
    for batch_id in range(3):
        deliver(batch_of(spark, rng, 30)[0], batch_id)
    assert delivery.newest_packing(spark, lake.packings).upto == 1  # batch 2 itself may still be replayed
    before = content(spark, lake)
    real = files.create_text

    def another_first(spark_, path, text):
        real(spark_, path, text)
        return real(spark_, path, text)

    monkeypatch.setattr(files, "create_text", lambda *a: False)
    assert delivery.pack(spark, lake.good, lake.packings, job.GOOD_SCHEMA, upto=2) is None
    assert content(spark, lake) == before
    monkeypatch.setattr(files, "create_text", another_first)
    assert delivery.pack(spark, lake.good, lake.packings, job.GOOD_SCHEMA, upto=2) is None
    assert content(spark, lake) == before and len(before) == 90
