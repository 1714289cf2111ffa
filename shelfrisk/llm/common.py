"""Helpers shared by the operators of this subpackage: table access, cut points, size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrisk.session import scratch_path

#: Rows up to which a narrow table (a few numbers a row) may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the cut point of a lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a *stored* narrow table for broadcast if it was counted to be within the bound, else leave it alone."""
    return F.broadcast(df) if df.count() <= rows else df
