"""Event contract on the library's own records: what passes, what is refused and why, what enrichment adds."""
from __future__ import annotations

import base64
import datetime as dt
import json
import random

import pytest

from shelfrisk.streaming import events

SALE = {"event_type": "pos_sale", "event_id": "t-88", "event_ts": "2031-03-09T07:45:12.5+01:00", "store_id": "S777", "product_id": "P70707",
        "units": 12, "unit_price": 0.35}
STOCK = {"event_type": "inventory_update", "event_id": "t-89", "event_ts": "2031-03-09 07:45", "store_id": "S778", "product_id": "P70708",
         "on_hand_qty": 0, "received_qty": 250}


def tagged(spark, records):
    texts = [x if isinstance(x, str) else json.dumps(x) for x in records]
    df = spark.createDataFrame(list(enumerate(texts)), "record_id long, value string")
    return [r.reason for r in events.with_reason(df).orderBy("record_id").collect()]


STAMPS = {"2031-03-09": True, "2031-03-09T07:45": True, "2031-03-09 07:45:12": True, "2031-03-09T07:45:12.123456Z": True, "2031-03-09T07:45:12-0330": True,
          "2031-03-09T7:4:1": False, "2031-03-09 07:45:12 America/Los_Angeles": False, "2031-03-09T07:45:12UTC+3": False, "2031-03-09 ": False,
          "2031-02-30": False, "09.03.2031": False, "2031-03-09T25:00:00": False, "": False}


def test_stamps(spark):
    got = tagged(spark, [SALE | {"event_ts": t} for t in STAMPS])
    assert got == [None if ok else f"event_ts is not valid ISO-8601: {t}" for t, ok in STAMPS.items()]


@pytest.mark.parametrize("field,bad,reason", [
    ("units", [0, -7, 2.5, "12", True], "units must be a positive integer"),
    ("unit_price", [0, -0.01, "0.35", False], "unit_price must be a positive number"),
])
def test_amounts_of_sales(spark, field, bad, reason):
    assert tagged(spark, [SALE | {field: v} for v in bad]) == [reason] * len(bad)


def test_amounts_of_stock(spark):
    assert tagged(spark, [STOCK, STOCK | {"on_hand_qty": -1}, STOCK | {"received_qty": 1.0}]) == [
        None, "on_hand_qty must be a non-negative integer", "received_qty must be a non-negative integer"]


def test_shape_comes_before_values(spark):
    without = {k: v for k, v in SALE.items() if k not in ("event_id", "units")}
    got = tagged(spark, ["", "{", "3", "null", without, without | {"event_id": None}, {k: v for k, v in SALE.items() if k != "units"},
                         SALE | {"event_type": 5}, SALE | {"event_type": "audit"}, SALE | {"store_id": "S7"}, SALE | {"product_id": 70707}, SALE | {"event_ts": 5}])
    assert got == ["invalid json", "invalid json", "event is not a JSON object", "event is not a JSON object", "missing fields: event_id", "missing fields: event_id",
                   "missing fields: units", "unknown event_type: 5", "unknown event_type: 'audit'", "malformed store_id: 'S7'", "malformed product_id: 70707",
                   "event_ts must be an ISO-8601 string"]


def test_enrichment_keeps_large_numbers_and_the_written_date(spark):
    large = 2**53 + 1
    records = [SALE, STOCK | {"received_qty": large}, SALE | {"event_ts": "2031-12-31T23:59:59-11:00", "units": 3, "unit_price": 0.335}, "[]"]
    df = spark.createDataFrame([(i, json.dumps(r) if r != "[]" else r) for i, r in enumerate(records)], "record_id long, value string")
    got = {r.record_id: r for r in events.validate_and_enrich(df).collect()}
    assert set(got) == {0, 1, 2}
    assert (got[0].event_date, got[0].revenue, got[0].units) == ("2031-03-09", 4.2, 12)
    assert (got[1].received_qty, got[1].revenue, got[1].unit_price) == (large, None, None)
    assert (got[2].event_date, got[2].revenue) == ("2031-12-31", 1.01)


def test_envelopes(spark):
    coded = [base64.b64encode(json.dumps(STOCK).encode()).decode(), base64.b64encode(b"no json").decode(), "*not base64*"]
    df = spark.createDataFrame([(c,) for c in coded], "data string")
    assert [r[0] for r in df.select(events.decode_base64_json(df.data).isNull()).collect()] == [False, True, True]


def _accepted(stamp):
    """What the standard library's ISO parser makes of a stamp whose Z is read as +00:00: the date written, or None."""
    try:
        return dt.datetime.fromisoformat(stamp.replace("Z", "+00:00")).date().isoformat()
    except ValueError:
        return None


def test_stamps_as_the_standard_parser_reads_them(spark):
    dates = ["2031-03-09", "20310309", "2031-W10-7", "2031-W10", "2031W107", "2031W10", "2032-W53-7", "2031-W53-1", "2026-W53-4", "2031-W00-1", "2031-W10-0", "2031-W10-8",
             "2031-02-29", "2032-02-29", "2031-13-01", "0000-01-01", "0001-01-01", "9999-12-31", "2031-3-9", "2031-03", "31-03-09", "2020-W01-1", "2021-W01-1"]
    clocks = ["", "T10", "t10:00", " 10:00:00,5", "T10:00:00.123456789", "_1000", "T100000", "T100000.25", "T1000:00", "T24:00", "T23:60", "T23:59:60", "T1", "T10:0", "T10:00:00.", " ", "T"]
    offsets = ["", "Z", "+05:30", "-0330", "+01", "+23:59:59.5", "+24:00", "+05:60", "+5", "z", " UTC"]
    rng = random.Random(4)
    stamps = sorted({d + c + o for d in dates for c in clocks for o in rng.sample(offsets, 3)} | {"", "yesterday", "2031-03-09\n10:00", "2031-03-09T10:00\n"})
    got = spark.createDataFrame([(SALE["event_type"], json.dumps(SALE | {"event_ts": t}), t) for t in stamps], "x string, value string, stamp string")
    read = {r.stamp: r.event_date for r in events.validate_and_enrich(got).collect()}
    expected = {t: _accepted(t) for t in stamps}
    assert sum(v is not None for v in expected.values()) > 100
    assert {t: (read.get(t), v) for t, v in expected.items() if read.get(t) != v} == {}


def test_fields_beyond_the_contract_stay(spark):
    records = [SALE | {"till": 3, "promo": {"b": [1, 2.5, None], "a": "x"}, "note": None, "on_hand_qty": 7}, STOCK,
               STOCK | {"units": "2", "revenue": 9.99, "event_date": "1999-01-01", "ingest_ts": 5}, SALE | {"revenue": 1, "event_date": "x", "": "empty name"}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "record_id long, value string")
    got = {r.record_id: r for r in events.validate_and_enrich(df).collect()}
    assert json.loads(got[0].extra) == {"note": None, "on_hand_qty": 7, "promo": {"a": "x", "b": [1, 2.5, None]}, "till": 3}
    assert got[0].on_hand_qty is None and got[1].extra is None
    assert json.loads(got[2].extra) == {"revenue": 9.99, "units": "2"} and got[2].revenue is None and got[2].event_date == "2031-03-09"
    assert json.loads(got[3].extra) == {"": "empty name"} and got[3].revenue == 4.2


def _envelope(payload):
    return json.dumps({"kinesis": {"data": payload, "partitionKey": "S1"}, "eventID": "x"})


def test_envelopes_are_opened_or_told_why_not(spark):
    good = base64.b64encode(json.dumps(SALE | {"event_id": "é"}).encode()).decode()
    cases = [(_envelope(good), None, good), (_envelope(good[:40] + "\r\n !" + good[40:]), None, good[:40] + "\r\n !" + good[40:]),
             (_envelope(good[:-1] if len(good) % 4 == 0 else good), "payload is not base64", good[:-1]), (_envelope("YWI"), "payload is not base64", "YWI"),
             (_envelope("//5B"), "payload is not UTF-8 text", "//5B"), (_envelope("YWI="), "invalid json", "YWI="), (_envelope(""), "invalid json", ""),
             (_envelope(None), "record has no payload", _envelope(None)), ("{}", "record has no payload", "{}"), ("no json", "record has no payload", "no json"),
             (_envelope("WzFd"), "event is not a JSON object", "WzFd")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "record_id long, value string")
    got = events.with_reason(events.opened(df), fault_col="fault").orderBy("record_id").collect()
    assert [(r.reason, r.raw) for r in got] == [c[1:] for c in cases]
    assert json.loads(got[0].value)["event_id"] == "é" and got[0].value == got[1].value
