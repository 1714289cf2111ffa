"""Lake I/O: CSV extracts, zone writes, partitioned reloads and pruned reads.

Paths are plain strings (local, HDFS or object-store URIs alike). Writers
repartition on the partition columns first, so each output partition is
written by one task (few, large files instead of one file per task and
partition).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_extract_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV, values written verbatim (padding kept, nulls empty)."""
    (df.write.mode(mode).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_extract(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a headered CSV extract as typed-as-declared (all-string) columns.

    The file path is captured at scan time from the hidden ``_metadata``
    column: ``input_file_name()`` evaluated after a shuffle returns ''.
    """
    df = (spark.read.schema(schema).option("header", True)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))
    return df.select("*", F.col("_metadata.file_path").alias("source_file"))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Full-rebuild Parquet write (dimension tables, facts without partitions)."""
    df.write.mode(mode).parquet(path)


def write_dims(dims: dict[str, DataFrame], root: str) -> None:
    """Dimensions as Parquet under ``root/dims`` and CSV under ``root/dims_csv``."""
    for name, df in dims.items():
        write_parquet(df, f"{root}/dims/{name}.parquet")
        df.write.mode("overwrite").option("header", True).csv(f"{root}/dims_csv/{name}")


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      sort_cols: Sequence[str] = (), in_order: bool = False) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite).

    A static overwrite with ``partitionBy`` would delete every other
    partition of the table; dynamic mode replaces just the reloaded ones.
    Rows are clustered by partition and sorted within files so Parquet
    min/max statistics can skip row groups. The rebalance hint lets adaptive
    execution split a large partition value over several tasks.

    ``in_order`` is for a large fact whose tasks hold rows of every partition anyway, those of a partition together: each task writes
    its rows as they come, a file per partition, and no row crosses the network or its disks.
    """
    if in_order:
        with unsorted_writes(df.sparkSession, PARTITIONS_OPEN):
            _overwrite_partitions(df, path, partition_cols)
        return
    out = df.hint("rebalance", *[F.col(c) for c in partition_cols])
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    _overwrite_partitions(out, path, partition_cols)


def _overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def read_partitions(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Read a partitioned table; a filter on partition columns prunes folders."""
    df = spark.read.parquet(path)
    return df if where is None else df.where(where)


def write_bucketed_table(df: DataFrame, table: str, buckets: int, by: Sequence[str],
                         sort_by: Sequence[str] = (), path: str | None = None,
                         partition_cols: Sequence[str] = (), in_order: Sequence[str] = ()) -> None:
    """Save a fact as a catalog table bucketed (and sorted) on its join key.

    Facts bucketed on the same key with the same bucket count join, and feed
    windows partitioned by a superset of the key, without any shuffle: the
    Spark form of a distribution key. ``path`` places the files (e.g. under
    the shared warehouse folder); otherwise the catalog's default location.
    With ``partition_cols`` each partition's folder holds the buckets.

    ``in_order`` declares the order that the rows of a bucket have already, which are then written as they come; the
    caller answers for it, and for one task a bucket. With ``partition_cols`` it names these columns: the rows of a partition come
    together, and the next one's after them. Rows that don't are written rightly, but at a cost.
    """
    if partition_cols and in_order:
        with unsorted_writes(df.sparkSession, PARTITIONS_OPEN):
            write_bucketed_table(df, table, buckets, by, path=path, partition_cols=partition_cols)
        return
    if in_order:
        with unsorted_writes(df.sparkSession):
            write_bucketed_table(df, f"{table}_as_written", buckets, by, path=path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        df.sparkSession.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(by)}) "
                            f"SORTED BY ({', '.join(in_order)}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *by)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if sort_by:
        w = w.sortBy(*sort_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


#: Files that a task keeps open where the writer doesn't sort by file; rows that need more are sorted after all.
FILES_OPEN = 4
#: The same for tables with partitions, whose files are closed at the task's end.
PARTITIONS_OPEN = 64


@contextmanager
def unsorted_writes(spark: SparkSession, files_open: int = FILES_OPEN) -> Iterator[None]:
    """Writers of buckets take rows as they come, for tasks with few files (a task that changes its file with every row is
    slower than one that sorts by file)."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(files_open))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
