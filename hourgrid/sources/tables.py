"""Stored tables: Parquet data, CSV metrics, JSON parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

METRICS_SCHEMA = "model string, mae double, rmse double"


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table; the scan reads only `columns` when they are given."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), order_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table.

    `order_by` sorts the rows of each task as they are distributed already: row groups then carry narrow min/max
    statistics, and no further shuffle of the whole table is needed.
    """
    if order_by:
        df = df.sortWithinPartitions(*order_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """One CSV file with header: one row per model, so a single task is enough."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)
