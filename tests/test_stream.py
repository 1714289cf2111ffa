"""Stream end to end: known mix in -> exact counts out, enriched rows in the lake."""
from __future__ import annotations

import base64
import json
import os

from pyspark.sql import functions as F

from shelfrisk.session import scratch_path
from shelfrisk.streaming import job


def _event(i: int) -> dict:
    return {"event_type": "pos_sale", "event_id": f"e{i}", "event_ts": f"2026-07-0{1 + i % 3}T10:00:00Z",
            "store_id": f"S{i % 4:03d}", "product_id": f"P{i:05d}", "units": 1 + i % 3,
            "unit_price": 2.5}


def test_stream_end_to_end(spark):
    source = scratch_path(spark, "test-source")
    os.makedirs(source.replace("file:", ""), exist_ok=True)
    good = [json.dumps(_event(i)) for i in range(30)]
    bad = ['{"event_type": "refund"}', "[1]", '{"broken"', json.dumps(dict(_event(99), units=0)),
           json.dumps(dict(_event(98), store_id="x"))]
    lines = good + bad
    for n in range(3):  # three files -> three micro-batches
        with open(os.path.join(source.replace("file:", ""), f"part-{n}.json"), "w") as fh:
            fh.write("\n".join(lines[n::3]) + "\n")
    lake = job.Lake(scratch_path(spark, "test-lake"))
    q = job.start(spark, source, lake, scratch_path(spark, "test-ckpt"), max_bytes_per_trigger=1)
    q.awaitTermination(300)
    assert not q.isActive and q.exception() is None

    s = job.read_summary(spark, lake).agg(F.sum("received"), F.sum("delivered"),
                                          F.sum("rejected"), F.count("*")).first()
    assert tuple(s) == (35, 30, 5, 3)
    rows = job.read_good(spark, lake).collect()
    assert len(rows) == 30
    assert all(r["event_date"] and r["ingest_ts"] and r["dt"] == r["event_date"] for r in rows)
    assert job.read_rejects(spark, lake).count() == 5


def test_replayed_batch_replaces_its_output(spark):
    """A micro-batch re-run after a failure overwrites its own files."""
    lake = job.Lake(scratch_path(spark, "test-replay-lake"))
    batch = spark.createDataFrame([(json.dumps(_event(i)),) for i in range(6)] + [("[1]",)],
                                  "value string")
    deliver = job.split_and_deliver(lake)
    deliver(batch, 7)
    deliver(batch, 7)  # replay of the same batch id
    deliver(batch.limit(2), 8)
    assert job.read_good(spark, lake).count() == 6 + 2
    assert job.read_rejects(spark, lake).count() == 1
    assert job.read_summary(spark, lake).where("batch_id = 7").count() == 1


def test_enveloped_stream_keeps_extra_fields_and_quarantines_payloads(spark):
    source = scratch_path(spark, "test-envelopes")
    os.makedirs(source.replace("file:", ""), exist_ok=True)
    def coded(x):
        return base64.b64encode(json.dumps(x).encode()).decode()
    payloads = [coded(_event(i) | {"till": i, "promo": {"code": "X"}}) for i in range(6)] + [coded(_event(7) | {"units": 0}), "YWI", "//5B", coded([1])]
    with open(os.path.join(source.replace("file:", ""), "part-0.json"), "w") as fh:
        fh.write("\n".join([json.dumps({"kinesis": {"data": p}}) for p in payloads] + ["garbage"]) + "\n")
    lake = job.Lake(scratch_path(spark, "test-lake-envelopes"))
    q = job.start(spark, source, lake, scratch_path(spark, "test-ckpt-envelopes"), enveloped=True)
    q.awaitTermination(300)
    assert q.exception() is None
    good = {r["event_id"]: r for r in job.read_good(spark, lake).collect()}
    assert {k: json.loads(r["extra"]) for k, r in good.items()} == {f"e{i}": {"till": i, "promo": {"code": "X"}} for i in range(6)}
    rejects = {r["raw"]: r["reason"] for r in job.read_rejects(spark, lake).collect()}
    assert rejects == {payloads[6]: "units must be a positive integer", "YWI": "payload is not base64", "//5B": "payload is not UTF-8 text",
                       payloads[9]: "event is not a JSON object", "garbage": "record has no payload"}
    assert tuple(job.read_summary(spark, lake).select("received", "delivered", "rejected").first()) == (11, 6, 5)
