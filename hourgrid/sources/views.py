"""Raw demand views over general event and order tables.

Taps per hour from an event stream, and units shipped per day from order lines, by nation (dense) or supplier (sparse).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.timegrid import floor_to_hour
from hourgrid.spec import DemandSpec

HOURLY = DemandSpec(
    exclude=({"station_complex_id": "3", "transit_mode": "tram"},),
    train_end="2024-01-26 00:00:00",
    validation_end="2024-01-28 12:00:00",
)

DAILY = DemandSpec(
    step="day",
    lags=(1, 7, 28),
    windows=(3, 7),
    exclude=(),
    train_end="2000-06-01 00:00:00",
    validation_end="2001-02-01 00:00:00",
    block_steps=1024,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hourly_taps(spark: SparkSession, folder: str) -> DataFrame:
    """Events as taps: one row per event, station = user bucket, borough = region."""
    events = _table(spark, folder, "events")
    regions = _table(spark, folder, "region")
    sid = (F.col("user_id") % 20).cast("int")
    taps = events.withColumn("sid", sid).withColumn("region_key", F.col("sid") % 5)
    even = F.col("event_id") % 2 == 0
    penalty = F.when(F.col("event_type") == "error", 40).otherwise(0)
    mode = (
        F.when((F.col("sid") == 3) & (F.col("event_id") % 50 == 0), "tram")
        .when(F.col("sid") < 16, "subway")
        .when(F.col("sid") < 19, "staten_island_railway")
        .otherwise("tram")
    )
    return taps.join(regions, F.col("region_key") == F.col("r_regionkey"), "inner").select(
        floor_to_hour(F.col("ts")).alias("transit_timestamp"),
        mode.alias("transit_mode"),
        F.col("sid").cast("string").alias("station_complex_id"),
        F.concat(F.lit("S"), (F.col("sid") % 18).cast("string")).alias("station_complex"),
        F.col("r_name").alias("borough"),
        F.when(even, "card").otherwise("tap").alias("payment_method"),
        F.col("event_type").alias("fare_class_category"),
        (F.round("value").cast("bigint") - penalty).alias("ridership"),
        (F.get_json_object("props", "$.k").cast("bigint") % 3).alias("transfers"),
        (40.5 + F.col("sid") * 0.02 + (F.col("event_id") % 2) * 0.001).alias("latitude"),
        (-74.0 + F.col("sid") * 0.01).alias("longitude"),
    )


def _shipped(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem")
    places = (
        _table(spark, folder, "supplier")
        .join(_table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "s_name", "n_nationkey", "n_name", "r_name")
    )
    return lines.join(places, F.col("l_suppkey") == F.col("s_suppkey"))


def _units(shipped: DataFrame, mode: str, series: str, name: str) -> DataFrame:
    return shipped.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("transit_timestamp"),
        F.col(mode).alias("transit_mode"),
        F.col(series).cast("string").alias("station_complex_id"),
        F.col(name).alias("station_complex"),
        F.col("r_name").alias("borough"),
        F.col("l_returnflag").alias("payment_method"),
        F.col("l_quantity").cast("bigint").alias("ridership"),
        F.col("l_linenumber").cast("bigint").alias("transfers"),
    )


def daily_units(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as units per nation: one row per line, station = nation. Most days of a nation have sales."""
    return _units(_shipped(spark, folder), "r_name", "n_nationkey", "n_name")


def supplier_units(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as units per supplier: sparse series, in which most days are gaps."""
    return _units(_shipped(spark, folder), "n_name", "s_suppkey", "s_name")


def order_values(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as rows with many names: station = customer, borough = priority, mode = status, entries = rounded value."""
    return _table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("station_complex"),
        F.col("o_orderpriority").alias("borough"),
        F.col("o_orderstatus").alias("transit_mode"),
        F.floor("o_totalprice").cast("bigint").alias("entries"),
    )
