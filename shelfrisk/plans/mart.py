"""A published table: write, audit, publish.

Rows are staged in a folder of their own that no reader knows, its suite runs on what was written, and only if every check
passes does the next manifest name the staged partitions. A manifest is a small numbered file that is created
once and never changed, so a publish is one atomic step: readers that resolved the manifest before it keep their files, and
of two writers that started from one version the second is told to start again. A refused copy stays unreferenced.

The manifest holds, per partition, its folder, its number of rows and the bounds of some columns. The newest day, the
list of days and the choice of folders come from it without opening a data file. A publish of some partitions
leaves the others' folders as they are.

With ``bucket``, a column and a number, the staged copy is also a table of the session, each partition bucketed by it: rows that lie by that column
already (landed facts) are written where they are, and audits and readers in the session group by a key that holds it without an exchange.

    root/data/<generation>/<partition column>=<value>/part-*.parquet
    root/manifests/<version>.json
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shelfrisk.operators import quality
from shelfrisk.sources import files, lake
from shelfrisk.sources.landing import as_declared


class Refused(Exception):
    """The staged copy failed its suite; readers still see the version before."""


class Conflict(Exception):
    """Another writer published in between."""


@dataclass(frozen=True)
class Partition:
    value: str
    folder: str
    rows: int
    bounds: dict[str, tuple]


@dataclass(frozen=True)
class Manifest:
    version: int
    partitions: tuple[Partition, ...]
    checks: tuple[dict, ...]


@dataclass(frozen=True)
class Outcome:
    """``version``: that of the new manifest, None if the copy was refused; ``checks``: one row per check."""

    version: int | None
    checks: tuple[dict, ...]


class Mart:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, partition_col: str, sort_cols: tuple[str, ...],
                 bound_cols: tuple[str, ...] = (), bucket: tuple[str, int] | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.partition_col, self.sort_cols, self.bound_cols, self.bucket = partition_col, sort_cols, bound_cols, bucket
        self._tables: dict[str, tuple[str, frozenset[str]]] = {}  # generation: its table and all its partition values

    # -- readers -------------------------------------------------------------
    def manifest(self) -> Manifest | None:
        """The newest manifest, None before the first publish."""
        found = files.listed(self.spark, f"{self.root}/manifests")
        if not found:
            return None
        raw = json.loads(files.read_text(self.spark, max(path for path, _, _ in found)))
        parts = tuple(Partition(p["value"], p["folder"], p["rows"], {c: tuple(b) for c, b in p["bounds"].items()}) for p in raw["partitions"])
        return Manifest(raw["version"], parts, tuple(raw["checks"]))

    def partitions(self) -> tuple[Partition, ...]:
        now = self.manifest()
        return now.partitions if now else ()

    def values(self) -> list[str]:
        """Published partition values in order; no data file is opened."""
        return sorted(p.value for p in self.partitions())

    def newest(self) -> str | None:
        return max(self.values(), default=None)

    def read(self) -> DataFrame:
        """The published rows. Filters on the partition column prune folders."""
        return self._rows(self.partitions())

    def _rows(self, parts: Iterable[Partition]) -> DataFrame:
        generations: dict[str, list[Partition]] = {}
        for p in parts:
            generations.setdefault(p.folder.rsplit("/", 1)[0], []).append(p)
        frames = [self._of_generation(base, found).select(*self.schema.names) for base, found in sorted(generations.items())]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], self.schema)

    def _of_generation(self, base: str, parts: list[Partition]) -> DataFrame:
        if base not in self._tables:  # another session's, or one without buckets
            return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/{base}").parquet(*sorted(f"{self.root}/{p.folder}" for p in parts))
        name, all_values = self._tables[base]
        wanted = {p.value for p in parts}
        whole = self.spark.table(name)
        return whole if wanted == all_values else whole.where(F.col(self.partition_col).cast("string").isin(sorted(wanted)))

    # -- writers -------------------------------------------------------------
    def publish(self, rows: DataFrame, audit: Callable[[DataFrame], DataFrame], replace: Iterable[str] | None = None, in_order: bool = False) -> Outcome:
        """Stage ``rows``, run the suite ``audit`` on the staged copy and publish it if every check passed.

        Without ``replace`` the table becomes ``rows``. With it only the partitions of these values change (one
        that got no rows goes), and rows of any other partition are an error. ``in_order``: the rows of a bucket come by partition.
        """
        before = self.manifest()
        generation = f"data/{uuid.uuid4().hex[:12]}"
        staged = self._staged(as_declared(rows, self.schema), generation, in_order)
        profile = None
        if isinstance(audit, quality.GrainAudit) and audit.profiles(self.partition_col, self.schema, self.bound_cols):
            found, profile = audit.profiled(staged, self.bound_cols)
        else:
            found = audit(staged)
        checks = tuple(r.asDict() for r in found.collect())  # one row per check
        if not checks or not all(c["passed"] for c in checks):
            return Outcome(None, checks)
        fresh = self._described(staged, generation) if profile is None else self._from_profile(profile, generation)
        if self.bucket and all(p.value is not None for p in fresh):
            self._tables[generation] = (_table_name(generation), frozenset(p.value for p in fresh))
        kept: tuple[Partition, ...] = ()
        if replace is not None:
            touched = set(map(str, replace))
            beyond = sorted(p.value for p in fresh if p.value not in touched)
            if beyond:
                raise ValueError(f"rows of partitions that are not to be replaced: {beyond[:5]}")
            kept = tuple(p for p in (before.partitions if before else ()) if p.value not in touched)
        version = before.version + 1 if before else 1
        now = Manifest(version, tuple(sorted((*kept, *fresh), key=lambda p: p.value)), checks)
        if not files.create_text(self.spark, f"{self.root}/manifests/{version:012d}.json", json.dumps(asdict(now), default=str)):
            raise Conflict(f"version {version} of {self.root} was published by another writer")
        return Outcome(version, checks)

    def publish_or_raise(self, rows: DataFrame, audit: Callable[[DataFrame], DataFrame], replace: Iterable[str] | None = None, in_order: bool = False) -> Outcome:
        outcome = self.publish(rows, audit, replace, in_order)
        if outcome.version is None:
            raise Refused("; ".join(f"{c['check']}: {c['violations']}" for c in outcome.checks if not c["passed"]) or "the suite has no check")
        return outcome

    def _staged(self, rows: DataFrame, generation: str, in_order: bool = False) -> DataFrame:
        """Write the rows to the generation's folder; the frame that reads them."""
        staged_at = f"{self.root}/{generation}"
        if self.bucket:
            by, buckets = self.bucket
            # No exchange where the rows come from facts of these buckets; the writer's sort by partition keeps their order.
            lake.write_bucketed_table(rows.repartition(buckets, by), _table_name(generation), buckets, [by], path=staged_at,
                                      partition_cols=[self.partition_col], in_order=[self.partition_col] if in_order else ())
            return self.spark.table(_table_name(generation)).select(*self.schema.names)
        (rows.hint("rebalance", F.col(self.partition_col)).sortWithinPartitions(self.partition_col, *self.sort_cols)
         .write.partitionBy(self.partition_col).parquet(staged_at))
        return self.spark.read.schema(self.schema).parquet(staged_at).select(*self.schema.names)

    def _from_profile(self, profile: dict, generation: str) -> tuple[Partition, ...]:
        """The partitions as the audit's own scans have found them."""
        return tuple(Partition(str(value), f"{generation}/{self.partition_col}={value}", rows, bounds) for value, (rows, bounds) in profile.items())

    def _described(self, staged: DataFrame, generation: str) -> tuple[Partition, ...]:
        """Rows and bounds per partition. Texts have no bounds in a hash aggregate, so they are grouped by first: then only one
        row per partition and text is sorted, not every row."""
        texts = [c for c in self.bound_cols if isinstance(self.schema[c].dataType, StringType)]
        ends = [(f"{n}_{c}", c, f) for c in self.bound_cols for n, f in (("min", F.min), ("max", F.max))]
        grouped = staged.groupBy(self.partition_col, *texts).agg(F.count(F.lit(1)).alias("_rows"), *[f(c).alias(name) for name, c, f in ends if c not in texts])
        found = (grouped.groupBy(self.partition_col).agg(F.sum("_rows").alias("_rows"), *[f(c if c in texts else name).alias(name) for name, c, f in ends])
                 .withColumn("_value", F.col(self.partition_col).cast("string")).collect())
        return tuple(Partition(r["_value"], f"{generation}/{self.partition_col}={r['_value']}", r["_rows"],
                               {c: (r[f"min_{c}"], r[f"max_{c}"]) for c in self.bound_cols}) for r in found)


def _table_name(generation: str) -> str:
    return f"shelfrisk_mart_{generation.rsplit('/', 1)[-1]}"
