"""Point-of-sale / inventory JSON event records derived from the driver's
``events`` table (the stream's test input; one record per driver event).

Mapping: purchase / click -> ``pos_sale``, every other type ->
``inventory_update``; store S + 3 digits of user_id % 25; product P + 5
digits of the ``k`` property; units 1 + k % 5; unit_price the event value;
on_hand k; received user_id % 7; the timestamp as ISO text with a ``Z``,
``+00:00`` or ``-05:00`` suffix (event_id % 3). A defect is chosen by
event_id % 20:

   0-8  valid                     14  store_id 'store-1'
   9    event_id, store_id absent 15  event_type 'refund'
   10   event_ts is a number      16  event_ts is no ISO-8601 stamp (``BAD_STAMPS``)
   11   record is a JSON array    17  units 0 / on_hand_qty -5
   12   unit_price -1.0 /         18  units 2.5 / received_qty "3" (text)
        received_qty absent       19  truncated JSON
   13   product_id absent

With e = event_id div 20 mod 10: defect 8 has the e-th of ``STAMP_FORMS``, defect 16 the e-th of ``BAD_STAMPS``.
Fields beyond the contract: till (event_id % 3 = 1), a nested promo (event_id % 8 = 3), and, where event_id % 5 = 2, the other
type's on_hand_qty on sales, revenue and an event_date of its own on updates.

Envelopes: defect 19 is cut base64 where e = 1, no UTF-8 where e = 2, without payload where e = 3, no envelope where e = 4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrisk.sources.domain import padded_id
from shelfrisk.sources.tables import read_table

TS_SUFFIXES = ("Z", "+00:00", "-05:00")
#: Other valid ways to write the stamp, as format strings of a timestamp.
STAMP_FORMS = ("yyyy-MM-dd'T'HH", "yyyy-MM-dd'T'HH:mm:ss',5'", "yyyy-MM-dd't'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'.123456789'", "yyyyMMdd'T'HHmmss'Z'",
               "yyyyMMdd", "yyyy-MM-dd", "yyyy-MM-dd HH:mm'+0530'", "yyyy-MM-dd'_'HHmm", "yyyy-MM-dd'T'HH:mm:ss'.5-05:00:30'")
BAD_STAMPS = ("yesterday", "2026-13-01", "2026-02-30T10:00", "2026-07-01T25:00", "2026-07-01T10:60", "2026-W54-1", "2026-07-01T10:00+25:00", "", "2026-7-1",
              "2026-07-01T10:00 Z")


def _common(d: Column, etype: Column, eid: Column, ets: Column, sid: Column, pid: Column,
            ts_override: Column | None = None) -> list[Column]:
    none = F.lit(None).cast("string")
    return [
        F.when(d == 15, F.lit("refund")).otherwise(etype).alias("event_type"),
        F.when(d == 9, none).otherwise(eid).alias("event_id"),
        (ts_override if ts_override is not None else ets).alias("event_ts"),
        F.when(d == 9, none).when(d == 14, F.lit("store-1")).otherwise(sid).alias("store_id"),
        F.when(d == 13, none).otherwise(pid).alias("product_id"),
    ]


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id BIGINT, value STRING): one JSON text per driver event."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value",
                    "props")
    i, u = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    d = i % 20
    is_sale = F.col("event_type").isin("purchase", "click")
    etype = F.when(is_sale, F.lit("pos_sale")).otherwise(F.lit("inventory_update"))
    eid = F.concat(F.lit("e"), i.cast("string"))
    suffix = F.element_at(F.array(*[F.lit(s) for s in TS_SUFFIXES]), (i % 3 + 1).cast("int"))
    e = (F.floor(i / 20) % 10).cast("int")
    other_forms = F.element_at(F.array(*[F.date_format("ts", form) for form in STAMP_FORMS]), e + 1)
    bad_stamp = F.element_at(F.array(*[F.lit(x) for x in BAD_STAMPS]), e + 1)
    ets = (F.when(d == 8, other_forms).when(d == 16, bad_stamp)
           .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), suffix)))
    sid, pid = padded_id("S", u % 25, 3), padded_id("P", k, 5)
    units, price = k % 5 + 1, F.col("value")
    on_hand, received = k, u % 7
    common = _common(d, etype, eid, ets, sid, pid)
    beyond = [F.when(i % 8 == 3, F.struct(F.concat(F.lit("X"), k.cast("string")).alias("code"), F.lit(0.5).alias("pct"))).alias("promo"),
              F.when(i % 3 == 1, i % 9).alias("till")]
    of_sale = [F.when(i % 5 == 2, k).alias("on_hand_qty"), *beyond]
    of_stock = [F.when(i % 5 == 2, F.lit(1.5)).alias("revenue"), F.when(i % 5 == 2, F.lit("1999-01-01")).alias("event_date"), *beyond]

    sale = F.to_json(F.struct(
        *common, F.when(d == 17, F.lit(0)).otherwise(units).alias("units"),
        F.when(d == 12, F.lit(-1.0)).otherwise(price).alias("unit_price"), *of_sale))
    sale_decimal_units = F.to_json(F.struct(*common, F.lit(2.5).alias("units"),
                                            price.alias("unit_price"), *of_sale))
    stock = F.to_json(F.struct(
        *common, F.when(d == 17, F.lit(-5)).otherwise(on_hand).alias("on_hand_qty"),
        F.when(d == 12, F.lit(None)).otherwise(received).alias("received_qty"), *of_stock))
    stock_text_qty = F.to_json(F.struct(*common, on_hand.alias("on_hand_qty"),
                                        F.lit("3").alias("received_qty"), *of_stock))
    numeric_ts = _common(d, etype, eid, ets, sid, pid, ts_override=u)
    ts_number = F.when(
        is_sale, F.to_json(F.struct(*numeric_ts, units.alias("units"), price.alias("unit_price"), *of_sale))
    ).otherwise(F.to_json(F.struct(*numeric_ts, on_hand.alias("on_hand_qty"),
                                   received.alias("received_qty"), *of_stock)))
    normal = F.when(is_sale, sale).otherwise(stock)
    value = (
        F.when(d == 11, F.to_json(F.array(i, u)))
        .when(d == 19, F.expr("substring(_normal, 1, length(_normal) - 1)"))
        .when(d == 10, ts_number)
        .when(d == 18, F.when(is_sale, sale_decimal_units).otherwise(stock_text_qty))
        .otherwise(F.col("_normal"))
    )
    # The common valid text is computed once (``_normal``) and reused by the
    # truncated-JSON defect.
    return (ev.withColumn("_normal", normal)
            .select(i.alias("record_id"), value.alias("value")))


def _envelope_fault() -> Column:
    return F.when(F.col("record_id") % 20 == 19, F.floor(F.col("record_id") / 20) % 10)


def enveloped_records(records: DataFrame) -> DataFrame:
    """The same records as a stream envelope: base64 ``data`` per record, some of it broken."""
    data = F.regexp_replace(F.base64(F.col("value").cast("binary")), r"[\r\n]", "")  # one line per envelope
    e = _envelope_fault()
    broken = (F.when(e == 1, F.substring(data, F.lit(1), F.length(data) - 1)).when(e == 2, F.base64(F.unhex(F.lit("FFFE41"))))
              .when(e.isin(3, 4), F.lit(None).cast("string")).otherwise(data))
    return records.select("record_id", broken.alias("data"))


def envelope_lines(records: DataFrame) -> DataFrame:
    """(record_id, value): the envelopes as the stream receives them, one JSON text per record."""
    line = F.to_json(F.struct(F.struct("data").alias("kinesis")))
    return enveloped_records(records).select(
        "record_id", F.when(_envelope_fault() == 4, F.lit("no envelope")).otherwise(line).alias("value"))
