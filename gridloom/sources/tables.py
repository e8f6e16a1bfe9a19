"""Parquet inputs: one directory per scale, one parquet per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.session import ship_package


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Read a table, projecting early so that the scan's ReadSchema is minimal."""
    ship_package(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Each key once.

    Redelivered rows equal the first in all columns but ``loaded_at``, which is
    therefore not read; a null key is kept as one row.
    """
    return df.dropDuplicates([key])
