"""Rankings, profiles and slices over cleaned, location and prediction tables.

Rankings take `key`: the station name by default, which several ids may share and whose series then merge, or the
series id. Ties are broken by key so that results repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.numeric import millions
from hourgrid.functions.timegrid import day_of_week, is_weekend
from hourgrid.operators import metrics
from hourgrid.spec import DemandSpec

# Weekday labels of the heat map, Monday first, and the labels of the commuter profile.
DAY_NAMES = ("Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu")
WEEKEND_LABEL, WEEKDAY_LABEL = "Weekend", "Weekday"


def _hour(spec: DemandSpec) -> Column:
    return F.hour(spec.ts)


def week_part(flag: Column) -> Column:
    return F.when(flag, WEEKEND_LABEL).otherwise(WEEKDAY_LABEL)


def hourly_profile(cleaned: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Mean per hour of day, weekdays apart from weekends."""
    weekend = is_weekend(F.col(spec.ts)).alias("is_weekend")
    means = cleaned.groupBy(_hour(spec).alias("hour_of_day"), weekend).agg(F.avg(spec.target).alias("avg_entries"))
    return means.withColumn("category", week_part(F.col("is_weekend"))).orderBy("is_weekend", "hour_of_day")


def hourly_mean(cleaned: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Mean per hour over all days, busiest first."""
    means = cleaned.groupBy(_hour(spec).alias("hour_of_day")).agg(F.avg(spec.target).alias("avg_entries"))
    return means.orderBy(F.desc("avg_entries"), "hour_of_day")


def weekday_hour_pivot(
    cleaned: DataFrame, spec: DemandSpec = DemandSpec(), day_names: Sequence[str] = DAY_NAMES
) -> DataFrame:
    """Heat map: one row per weekday, Monday first, one column of means per hour."""
    names = F.array(*(F.lit(n) for n in day_names))
    slots = cleaned.select(
        day_of_week(F.col(spec.ts)).alias("day_of_week"), _hour(spec).alias("hour"), F.col(spec.target)
    )
    table = slots.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.avg(spec.target))
    hours = [F.col(str(h)).alias(f"h{h:02d}") for h in range(24)]
    day_name = F.get(names, F.col("day_of_week")).alias("day_name")
    return table.select("day_of_week", day_name, *hours).orderBy("day_of_week")


def weekday_ratio(cleaned: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: mean on weekdays, mean on weekends and their ratio."""
    weekend = is_weekend(F.col(spec.ts))
    means = cleaned.agg(
        F.avg(F.when(~weekend, F.col(spec.target))).alias("weekday_mean"),
        F.avg(F.when(weekend, F.col(spec.target))).alias("weekend_mean"),
    )
    return means.withColumn("ratio", F.try_divide("weekday_mean", "weekend_mean"))


def totals(cleaned: DataFrame, key: str, spec: DemandSpec = DemandSpec()) -> DataFrame:
    return cleaned.groupBy(key).agg(F.sum(spec.target).alias("total_entries"))


def top_stations(
    cleaned: DataFrame, n: int = 20, key: str | None = None, spec: DemandSpec = DemandSpec()
) -> DataFrame:
    """The n largest totals."""
    key = key or spec.name
    return totals(cleaned, key, spec).orderBy(F.desc("total_entries"), key).limit(n)


def borough_totals(cleaned: DataFrame, spec: DemandSpec = DemandSpec(), key: str = "borough") -> DataFrame:
    return totals(cleaned, key, spec).orderBy(F.desc("total_entries"), key)


def busiest_station(df: DataFrame, key: str | None = None, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: the key with the largest total, in a cleaned or a prediction table."""
    return top_stations(df, 1, key, spec)


def station_list(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    return df.select(spec.name).distinct().orderBy(spec.name)


def volatility(cleaned: DataFrame, key: str | None = None, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Coefficient of variation (sample standard deviation over mean) per key, most volatile first."""
    key = key or spec.name
    moments = cleaned.groupBy(key).agg(
        F.avg(spec.target).alias("avg_entries"), F.stddev_samp(spec.target).alias("std_entries")
    )
    return moments.withColumn("cv", F.try_divide("std_entries", "avg_entries")).orderBy(F.desc_nulls_last("cv"), key)


def volatile_stations(
    cleaned: DataFrame, threshold: float = 1.3, key: str | None = None, spec: DemandSpec = DemandSpec()
) -> DataFrame:
    return volatility(cleaned, key, spec).filter(F.col("cv") > threshold)


def station_hourly(cleaned: DataFrame, key: str | None = None, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Mean per key and hour of day over the whole history."""
    return cleaned.groupBy(key or spec.name, _hour(spec).alias("hour_of_day")).agg(
        F.avg(spec.target).alias("avg_entries")
    )


def peak_hours(cleaned: DataFrame, key: str | None = None, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Hour with the largest mean per key; the earlier hour wins a tie.

    The best of at most 24 rows is a plain maximum of (mean, -hour): partial maxima, no sort.
    """
    key = key or spec.name
    best = F.max(F.struct(F.col("avg_entries"), -F.col("hour_of_day"))).alias("best")
    peaks = station_hourly(cleaned, key, spec).groupBy(key).agg(best)
    return peaks.select(
        key, (-F.col("best")["col2"]).alias("peak_hour"), F.col("best")["avg_entries"].alias("peak_avg_entries")
    )


def map_table(locations: DataFrame, cleaned: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Locations with the total of their station *name*, repeated for ids that share it."""
    return locations.join(totals(cleaned, spec.name, spec), spec.name, "left")


def date_bounds(predictions: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    date = F.col(spec.ts).cast("date")
    return predictions.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def station_slice(
    df: DataFrame, station: str, start: str, end: str, spec: DemandSpec = DemandSpec()
) -> DataFrame:
    """Rows of one station name between two dates, both included, in time order."""
    return _slice(df, station, start, end, spec).orderBy(spec.ts, spec.series_id)


def _slice(df: DataFrame, station: str, start: str, end: str, spec: DemandSpec) -> DataFrame:
    """The dates are turned into a half-open range of the stored column, which the scan can use."""
    ts = F.col(spec.ts)
    first, last = (F.lit(str(d)).cast("date").cast("timestamp_ntz") for d in (start, end))
    chosen = (F.col(spec.name) == station) & (ts >= first) & (ts < last + F.expr("INTERVAL 1 DAY"))
    return df.filter(chosen)


def slice_metrics(
    predictions: DataFrame,
    station: str,
    start: str,
    end: str,
    columns: Sequence[str],
    spec: DemandSpec = DemandSpec(),
) -> DataFrame:
    """Errors of each model over one slice; no rows for an empty slice."""
    return metrics.compare_models(_slice(predictions, station, start, end, spec), columns, (), spec)


def actual_vs_predicted(
    predictions: DataFrame, columns: Sequence[str], spec: DemandSpec = DemandSpec()
) -> DataFrame:
    """Series of the busiest station name: actual value and each prediction, long form, in time order."""
    name = busiest_station(predictions, spec.name, spec).select(spec.name).scalar()
    one = predictions.filter(F.col(spec.name) == name)
    series = F.array(
        F.struct(F.lit("actual").alias("series"), F.col(spec.target).cast("double").alias("value")),
        *(
            F.struct(F.lit(c.removeprefix("pred_")).alias("series"), F.col(c).cast("double").alias("value"))
            for c in columns
        ),
    )
    return one.select(spec.name, spec.series_id, spec.ts, F.inline(series)).orderBy(
        spec.ts, spec.series_id, "series"
    )


def crowding_alerts(
    predictions: DataFrame,
    cleaned: DataFrame,
    prediction: str,
    threshold: float = 0.30,
    spec: DemandSpec = DemandSpec(),
) -> DataFrame:
    """Rows whose prediction exceeds the series' usual value at that hour by the threshold or more."""
    usual = station_hourly(cleaned, spec.series_id, spec).withColumnRenamed("avg_entries", "usual_entries")
    above = F.try_divide(F.col(prediction), F.col("usual_entries")) - 1
    return (
        predictions.withColumn("hour_of_day", _hour(spec))
        .join(usual, [spec.series_id, "hour_of_day"], "inner")
        .withColumn("above_usual", above)
        .filter(F.col("above_usual") >= threshold)
        .select(*spec.keys, "hour_of_day", prediction, "usual_entries", "above_usual")
    )


def summary(
    cleaned: DataFrame, spec: DemandSpec = DemandSpec(), top: int = 8, unit: float = 1e6
) -> DataFrame:
    """Figures for a slide deck in one long table: hourly means, largest series by id, totals by borough."""
    profile = hourly_profile(cleaned, spec).select(
        F.lower("category").alias("section"),
        F.lpad(F.col("hour_of_day").cast("string"), 2, "0").alias("label"),
        F.lit("").alias("series_id"),
        F.round("avg_entries", 1).alias("value"),
    )
    by_id = cleaned.groupBy(spec.series_id, spec.name).agg(F.sum(spec.target).alias("total_entries"))
    largest = by_id.orderBy(F.desc("total_entries"), spec.series_id).limit(top).select(
        F.lit("top_stations").alias("section"),
        F.col(spec.name).alias("label"),
        F.col(spec.series_id).alias("series_id"),
        millions(F.col("total_entries"), 1, unit).alias("value"),
    )
    boroughs = borough_totals(cleaned, spec).select(
        F.lit("boroughs").alias("section"),
        F.col("borough").alias("label"),
        F.lit("").alias("series_id"),
        millions(F.col("total_entries"), 0, unit).alias("value"),
    )
    return profile.unionByName(largest).unionByName(boroughs)


def location_points(locations: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Coordinates for a map, to four decimals."""
    return locations.select(
        spec.series_id, F.round("longitude", 4).alias("longitude"), F.round("latitude", 4).alias("latitude")
    )
