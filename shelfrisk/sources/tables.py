"""Readers for the driver's Parquet tables.

Each reader selects only the columns the domain derivation needs, so the scan
carries a narrow ``ReadSchema`` and filters reach the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table: {name}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
