"""Counts that describe each stage of the work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.spec import DemandSpec


def distinct_with_null(column: str, approximate: bool = False) -> Column:
    """Distinct values, null counted as one of them."""
    distinct = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return distinct + F.max(F.col(column).isNull().cast("int"))


def profile_raw(raw: DataFrame, spec: DemandSpec = DemandSpec(), approximate: bool = False) -> DataFrame:
    """One row over the raw rows: count, time range, unparsable times, series."""
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(spec.ts).alias("min_ts"),
        F.max(spec.ts).alias("max_ts"),
        F.count_if(F.col(spec.ts).isNull()).alias("n_ts_parse_fail"),
        distinct_with_null(spec.series_id, approximate).cast("bigint").alias("n_stations"),
    )


def profile_rollup(rolled: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """`profile_raw` from a rollup of the raw rows, without another scan of them."""
    null_time = F.when(F.col(spec.ts).isNull(), F.col("n_raw")).otherwise(0)
    return rolled.agg(
        F.sum("n_raw").alias("n_rows"),
        F.min(spec.ts).alias("min_ts"),
        F.max(spec.ts).alias("max_ts"),
        F.sum(null_time).cast("bigint").alias("n_ts_parse_fail"),
        distinct_with_null(spec.series_id).cast("bigint").alias("n_stations"),
    )


def unread_cells(rolled: DataFrame) -> DataFrame:
    """One row: raw rows, and those whose measure was missing or unreadable and counts as 0."""
    return rolled.agg(F.sum("n_raw").alias("n_rows"), F.sum("n_unread").alias("n_unread"))


def table_summary(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: rows, distinct series, time range of a cleaned or feature table."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct_with_null(spec.series_id).cast("bigint").alias("n_stations"),
        F.min(spec.ts).alias("min_ts"),
        F.max(spec.ts).alias("max_ts"),
    )


def stage_counts(stages: dict[str, DataFrame], spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row per named stage with its rows and series, in the given order."""
    rows = [
        table_summary(df, spec).select(F.lit(i).alias("seq"), F.lit(name).alias("stage"), "n_rows", "n_stations")
        for i, (name, df) in enumerate(stages.items())
    ]
    return reduce(DataFrame.unionByName, rows)


def lineage(rolled: DataFrame, station_step: DataFrame, grid: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: raw rows, summed rows, grid rows and the gaps that were filled with 0."""
    raw = rolled.agg(F.sum("n_raw").alias("n_raw"))
    return grid.agg(F.count(F.lit(1)).alias("n_grid")).select(
        raw.scalar().alias("n_raw"),
        station_step.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_station_step"),
        "n_grid",
    ).withColumn("n_gaps_filled", F.col("n_grid") - F.col("n_station_step"))

