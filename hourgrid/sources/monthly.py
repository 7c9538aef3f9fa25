"""Tables stored in one folder per month, of which a time range reads only its months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.timegrid import timestamp_literal

MONTH = "ts_month"


def month_of(ts: Column) -> Column:
    """First day of the month, on the naive calendar."""
    return F.trunc(ts.cast("date"), "month")


def write_months(df: DataFrame, path: str, partition_by: Sequence[str] = (MONTH,)) -> None:
    """Replace the folders that `df` has rows for and leave all others as they are.

    The rows are rebalanced by month first: a small month becomes one file, a large one is split by adaptive
    execution. Writing the same rows again gives the same table, so a lost job is simply repeated.
    """
    writer = df.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def read_months(spark: SparkSession, path: str, months: Sequence[object] | None = None) -> DataFrame:
    """The whole table, or the folders of some months."""
    df = spark.read.parquet(path)
    return df if months is None else df.filter(F.col(MONTH).isin(list(months)))


def in_range(df: DataFrame, ts: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of [start, end); the months of the bounds prune folders, the bounds themselves prune rows."""
    for bound, whole, exact in (
        (start, F.col(MONTH).__ge__, F.col(ts).__ge__),
        (end, F.col(MONTH).__le__, F.col(ts).__lt__),
    ):
        if bound is not None:
            at = timestamp_literal(bound)
            df = df.filter(whole(month_of(at)) & exact(at))
    return df
