"""Structured Streaming job: JSON records -> validated, enriched bronze lake.

    readStream.text(source)           one record per line, oldest first: an event, or an envelope around its base64 text
      -> foreachBatch(split_and_deliver)
           open envelopes; tag each record with its reason (one parse, persisted for the batch)
           good  -> enrich -> range-partitioned and sorted by (store_id, event_ts, event_id)
                    -> gzip JSON under bronze/stream/event_type=../dt=../batch_id=..
           bad   -> (reason, raw: the payload as received) JSON under bronze/stream/_errors/batch_id=..
           summary (received, delivered, rejected) under bronze/stream/_summary/batch_id=..

Every sink of a batch is written with dynamic partition overwrite keyed by
``batch_id``, so a batch replayed after a failure replaces its own output
instead of appending duplicates; with the checkpoint this gives
exactly-once files. Nothing is kept between batches but, if asked for, the
stores' sequence numbers (``streaming.delivery``, which also packs small
files): no windows, no watermarks, no de-duplication by event_id.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, DoubleType, StringType, StructField, StructType

from shelfrisk.streaming import delivery, events

log = logging.getLogger(__name__)

GOOD_SCHEMA = StructType([
    StructField("event_id", StringType()), StructField("event_ts", StringType()),
    StructField("store_id", StringType()), StructField("product_id", StringType()),
    StructField("units", LongType()), StructField("unit_price", DoubleType()),
    StructField("on_hand_qty", LongType()), StructField("received_qty", LongType()),
    StructField("event_date", StringType()), StructField("revenue", DoubleType()),
    StructField("extra", StringType()), StructField("ingest_ts", StringType()), StructField("store_seq", LongType()),
    StructField("event_type", StringType()), StructField("dt", StringType()),
    StructField("batch_id", LongType()),
])
REJECT_SCHEMA = StructType([
    StructField("reason", StringType()), StructField("raw", StringType()),
    StructField("batch_id", LongType()),
])
SUMMARY_SCHEMA = StructType([
    StructField("received", LongType()), StructField("delivered", LongType()),
    StructField("rejected", LongType()), StructField("batch_id", LongType()),
])


@dataclass(frozen=True)
class Lake:
    root: str

    @property
    def good(self) -> str:
        return f"{self.root}/bronze/stream/events"

    @property
    def errors(self) -> str:
        return f"{self.root}/bronze/stream/_errors"

    @property
    def summary(self) -> str:
        return f"{self.root}/bronze/stream/_summary"

    @property
    def packings(self) -> str:
        return f"{self.root}/bronze/stream/_packings"

    @property
    def staging(self) -> str:
        return f"{self.root}/bronze/stream/_staging"

    @property
    def totals(self) -> str:
        return f"{self.root}/bronze/stream/_totals"


def _overwrite(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "json",
               compression: str | None = "gzip") -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if compression:
        w = w.option("compression", compression)
    w.partitionBy(*partition_cols).format(fmt).save(path)


def split_and_deliver(lake: Lake, enveloped: bool = False, numbered: bool = False, pack_every: int = 0,
                      target_bytes: int = delivery.TARGET_BYTES):
    """The ``foreachBatch`` function: open, validate, enrich and deliver one batch.

    ``numbered``: each store's events get ``store_seq``. ``pack_every``: every so many batches the small files of
    the batches before this one (which are committed by then) are packed to about ``target_bytes``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        plain = batch.withColumns({"raw": F.col("value"), "fault": F.lit(None).cast("string")})
        received = events.opened(batch) if enveloped else plain
        tagged = events.with_reason(received, fault_col="fault").drop("fault").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid = (
                events.enrich(tagged.where(F.col("reason").isNull()), with_ingest_ts=True)
                .drop("reason", "raw")
                .withColumn("ingest_ts", F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
                .withColumn("dt", F.col("event_date"))
            )
            if numbered:
                valid = delivery.numbered(valid, lake.staging, lake.totals, batch_id)
            good = (
                valid.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                # A store's events stay in order: range partitions on (store, ts, id)
                # hold contiguous runs, and a store with a large share of the batch
                # is split across several tasks instead of landing on one.
                # The partition columns lead, so a task writes few folders.
                .repartitionByRange("event_type", "dt", "store_id", "event_ts", "event_id")
                .sortWithinPartitions("event_type", "dt", "store_id", "event_ts", "event_id")
            )
            _overwrite(good, lake.good, ["event_type", "dt", "batch_id"])
            bad = tagged.where(F.col("reason").isNotNull()).select(
                "reason", "raw", F.lit(batch_id).cast("bigint").alias("batch_id"))
            _overwrite(bad, lake.errors, ["batch_id"])
            for row in bad.select("reason").limit(10).collect():  # bounded log sample
                log.warning("batch %s reject reason: %s", batch_id, row["reason"])
            summary = tagged.agg(
                F.count(F.lit(1)).alias("received"),
                F.count_if(F.col("reason").isNull()).cast("bigint").alias("delivered"),
                F.count_if(F.col("reason").isNotNull()).cast("bigint").alias("rejected"),
            ).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            _overwrite(summary, lake.summary, ["batch_id"], compression=None)
            if pack_every and batch_id and batch_id % pack_every == 0:
                delivery.pack(batch.sparkSession, lake.good, lake.packings, GOOD_SCHEMA, batch_id - 1, target_bytes)
        finally:
            tagged.unpersist()

    return run


def start(spark: SparkSession, source_dir: str, lake: Lake, checkpoint_dir: str,
          max_bytes_per_trigger: int = 64 << 30, available_now: bool = True,
          processing_time: str = "60 seconds", **options):
    """Start the stream over text files in ``source_dir``; ``options``: those of ``split_and_deliver``.

    ``available_now`` drains what is there in micro-batches and stops (batch
    back-fill, tests); otherwise the query triggers every ``processing_time``.
    """
    records = (spark.readStream.format("text")
               .option("maxBytesPerTrigger", max_bytes_per_trigger).load(source_dir))
    writer = (records.writeStream.foreachBatch(split_and_deliver(lake, **options))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    return writer.start()


def read_good(spark: SparkSession, lake: Lake) -> DataFrame:
    return delivery.read_delivered(spark, lake.good, lake.packings, GOOD_SCHEMA)


def read_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(REJECT_SCHEMA).json(lake.errors)


def read_summary(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).json(lake.summary)
