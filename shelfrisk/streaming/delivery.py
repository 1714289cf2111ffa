"""What happens to delivered files and their order: sequence numbers per store, and packing of small files.

Sequence numbers. A store's events are numbered across batches in the order of (batch, event_ts, event_id). A batch's numbers
start from the totals that the batch before it left; a replayed batch reads the same totals again, so it gives the same
numbers. Inside a batch events are dealt in ranges of (store, ts, id) and numbered per range, and the ranges' counts give
each range its start: a store with most of the events is spread over many tasks.

Packing. Every batch leaves a file per task and (event_type, day). ``pack`` joins the small ones of batches that can't
be replayed any more into files of about ``TARGET_BYTES``, first-fit by size, never across types or days. The packed files lie
beside the batches' folders; a manifest names the files that readers take for all batches up to a number. It is
created once and never changed, so a packing that dies half-way, or runs again, changes nothing that readers see.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrisk.sources import files

#: Size at which a file is delivered (the buffer of the delivery stream); smaller than this share of it counts as small.
TARGET_BYTES, SMALL = 5 << 20, 0.5
ORDER = ("store_id", "event_ts", "event_id")


# -- sequence numbers ----------------------------------------------------------------
def numbered(good: DataFrame, staging: str, totals: str, batch_id: int) -> DataFrame:
    """``good`` with ``store_seq``. ``staging`` and ``totals`` are folders of the lake; both keep one folder per
    batch, which a replay overwrites."""
    spark = good.sparkSession
    here = f"{staging}/batch_id={batch_id}"
    # Stored, as a range's number must not change between the count and the numbering.
    good.repartitionByRange(*ORDER).withColumn("_range", F.spark_partition_id()).write.mode("overwrite").parquet(here)
    staged = spark.read.parquet(here)
    counts = staged.groupBy("store_id", "_range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("store_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")))  # a row per store and range
    earlier = _earlier_totals(spark, totals, batch_id)
    starts = (starts.join(earlier, "store_id", "left")
              .select("store_id", "_range", (F.col("_start") + F.coalesce("total", F.lit(0))).alias("_start")))
    (counts.groupBy("store_id").agg(F.sum("n").alias("n")).join(earlier, "store_id", "full")
     .select("store_id", (F.coalesce("n", F.lit(0)) + F.coalesce("total", F.lit(0))).alias("total"))
     .write.mode("overwrite").parquet(f"{totals}/batch_id={batch_id}"))
    inside = Window.partitionBy("store_id", "_range").orderBy(*ORDER[1:])
    return (staged.withColumn("_position", F.row_number().over(inside)).join(starts, ["store_id", "_range"])
            .withColumn("store_seq", F.col("_start") + F.col("_position")).drop("_start", "_position", "_range"))


def _earlier_totals(spark: SparkSession, totals: str, batch_id: int) -> DataFrame:
    done = [int(m[1]) for path, _, _ in files.listed(spark, totals) if (m := re.search(r"batch_id=(\d+)$", path)) and int(m[1]) < batch_id]
    if not done:
        return spark.createDataFrame([], "store_id string, total long")
    return spark.read.schema("store_id string, total long").parquet(f"{totals}/batch_id={max(done)}")


# -- packing -------------------------------------------------------------------------
@dataclass(frozen=True)
class Delivered:
    """A delivered file: its path below the folder of good events, and its bytes."""

    path: str
    bytes: int

    @property
    def group(self) -> str:
        """event_type=../dt=.."""
        return self.path.rsplit("/", 2)[0]


@dataclass(frozen=True)
class Packed:
    """Readers take ``files`` for all batches up to ``upto``, and the later batches' own files."""

    version: int
    upto: int
    files: tuple[Delivered, ...]


def newest_packing(spark: SparkSession, manifests: str) -> Packed | None:
    found = files.listed(spark, manifests)
    if not found:
        return None
    raw = json.loads(files.read_text(spark, max(path for path, _, _ in found)))
    return Packed(raw["version"], raw["upto"], tuple(Delivered(p, n) for p, n in raw["files"]))


def delivered_files(spark: SparkSession, root: str, after: int, upto: int | None = None) -> list[Delivered]:
    """The batches' own files, of batches after ``after`` (and up to ``upto``)."""
    out = []
    for type_folder, _, _ in files.listed(spark, root):
        for day_folder, _, _ in files.listed(spark, type_folder):
            for folder, _, _ in files.listed(spark, day_folder):
                m = re.search(r"(event_type=[^/]+/dt=[^/]+/batch_id=(\d+))$", folder)
                if m and int(m[2]) > after and (upto is None or int(m[2]) <= upto):
                    out += [Delivered(f"{m[1]}/{path.rsplit('/', 1)[1]}", size) for path, size, _ in files.listed(spark, folder)
                            if not path.rsplit("/", 1)[1].startswith(("_", "."))]
    return out


def bins(found: list[Delivered], target: int = TARGET_BYTES) -> list[list[Delivered]]:
    """Small files of each (event_type, day) in bins of at most ``target`` bytes, largest first, first fit;
    bins of a single file are left out."""
    by_group = defaultdict(list)
    for f in found:
        if f.bytes < SMALL * target:
            by_group[f.group].append(f)
    out = []
    for group in by_group.values():
        open_: list[tuple[int, list[Delivered]]] = []
        for f in sorted(group, key=lambda f: (-f.bytes, f.path)):
            at = next((i for i, (held, _) in enumerate(open_) if held + f.bytes <= target), None)
            if at is None:
                open_.append((f.bytes, [f]))
            else:
                open_[at] = (open_[at][0] + f.bytes, [*open_[at][1], f])
        out += [b for _, b in open_ if len(b) > 1]
    return out


def pack(spark: SparkSession, root: str, manifests: str, schema, upto: int, target: int = TARGET_BYTES) -> Packed | None:
    """Pack the small files of all batches up to ``upto``, which must be committed; None if another packing
    came first. Each bin is one task and one file, in the stores' order."""
    now = newest_packing(spark, manifests)
    version, after = (now.version + 1, now.upto) if now else (1, -1)
    found = [*(now.files if now else ()), *delivered_files(spark, root, after, upto)]
    packed = bins(found, target)
    gone = {f.path for b in packed for f in b}
    kept = [f for f in found if f.path not in gone]
    if packed:
        place = {f.path: -(version * 1_000_000 + i) for i, b in enumerate(packed) for f in b}  # negative: not a batch
        mapping = spark.createDataFrame(sorted(place.items()), "_path string, _bin long")
        path = F.regexp_extract(F.col("_metadata.file_path"), r"(event_type=[^/]+/dt=[^/]+/batch_id=[^/]+/[^/]+)$", 1)
        rows = (spark.read.schema(schema).option("basePath", root).json([f"{root}/{p}" for p in sorted(gone)])
                .withColumn("_path", F.url_decode(path)).join(mapping, "_path").drop("_path", "batch_id").withColumnRenamed("_bin", "batch_id"))
        (rows.repartition("event_type", "dt", "batch_id").sortWithinPartitions("event_type", "dt", "batch_id", *ORDER)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
         .partitionBy("event_type", "dt", "batch_id").json(root))
        for folder in sorted({f"{b[0].group}/batch_id={place[b[0].path]}" for b in packed}):
            kept += [Delivered(f"{folder}/{p.rsplit('/', 1)[1]}", size) for p, size, _ in files.listed(spark, f"{root}/{folder}")
                     if not p.rsplit("/", 1)[1].startswith(("_", "."))]
    done = Packed(version, upto, tuple(sorted(kept, key=lambda f: f.path)))
    text = json.dumps({"version": version, "upto": upto, "files": [(f.path, f.bytes) for f in done.files]})
    return done if files.create_text(spark, f"{manifests}/{version:012d}.json", text) else None


def read_delivered(spark: SparkSession, root: str, manifests: str, schema) -> DataFrame:
    """Every delivered event once, whether packed or not; filters on event_type and dt prune files."""
    now = newest_packing(spark, manifests)
    if now is None:
        return spark.read.schema(schema).json(root)
    paths = [f"{root}/{f.path}" for f in (*now.files, *delivered_files(spark, root, now.upto))]
    return spark.read.schema(schema).option("basePath", root).json(paths) if paths else spark.createDataFrame([], schema)
