"""From raw tap counts to a gap-free, capped table of one row per station and step.

The large input is scanned once: `rollup` reduces it to one row per station and step, with partial sums before
the shuffle, and keeps enough counts that the raw profile and the mean coordinates come from the reduced table too.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.functions.numeric import cap_upper, clip_lower, nearest_rank, sum_or_zero
from hourgrid.functions.timegrid import add_steps, complete_steps, on_grid, steps_between
from hourgrid.spec import LOWER_QUANTILE, UPPER_QUANTILE, DemandSpec

COORDINATES = ("latitude", "longitude")
FIRST = "_first_step"


def _and(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def exclude_rows(df: DataFrame, rules: Iterable[Mapping[str, str]]) -> DataFrame:
    """Drop rows that match every pair of some rule.

    A rule that compares with null is unknown, and unknown rows are dropped as well (a filter, not an anti join).
    """
    return df.filter(_and(~_and(F.col(k) == v for k, v in rule.items()) for rule in rules))


def to_station_step(raw: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Sum both measures over everything but station and time."""
    return raw.groupBy(*spec.keys).agg(
        sum_or_zero(F.col(spec.raw_measure)).alias(spec.target),
        sum_or_zero(F.col(spec.second_measure)).alias(spec.second_measure),
    )


def rollup(raw: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Station-step sums of *all* raw rows, with the counts needed to profile the raw input afterwards."""
    sums = [
        sum_or_zero(F.col(spec.raw_measure)).alias(spec.target),
        sum_or_zero(F.col(spec.second_measure)).alias(spec.second_measure),
        F.count(F.lit(1)).alias("n_raw"),
        F.count_if(F.col(spec.raw_measure).isNull()).alias("n_unread"),
    ]
    for column in COORDINATES:
        if column in raw.columns:
            sums += [F.sum(column).alias(f"{column}_sum"), F.count(column).alias(f"{column}_n")]
    return raw.groupBy(*spec.keys).agg(*sums)


def station_step_of(rolled: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """The cleaned-up station-step sums of a rollup: the rules only name key columns, so they apply to groups."""
    return exclude_rows(rolled, spec.exclude).select(*spec.keys, spec.target, spec.second_measure)


def with_latest_attributes(rolled: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """A rollup in which every id has the attributes of its latest step; rows that fall together are summed."""
    latest = rolled.groupBy(spec.series_id).agg(
        F.max_by(F.struct(*spec.attributes), F.struct(F.col(spec.ts), *spec.attributes)).alias("_latest")
    ).withColumnRenamed(spec.series_id, "_sid")
    same = F.col(spec.series_id).eqNullSafe(F.col("_sid"))
    renamed = rolled.join(latest, same).withColumns({a: F.col(f"_latest.{a}") for a in spec.attributes})
    sums = [c for c in rolled.columns if c not in spec.keys]
    return renamed.groupBy(*spec.keys).agg(*(F.sum(c).alias(c) for c in sums))


def station_locations(raw: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Mean coordinates per station tuple, weighted by raw rows."""
    return exclude_rows(raw, spec.exclude).groupBy(*spec.station_keys).agg(
        *(F.avg(c).alias(c) for c in COORDINATES)
    )


def station_locations_of(rolled: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """`station_locations` from a rollup: sums and counts instead of another scan of the raw rows."""
    return exclude_rows(rolled, spec.exclude).groupBy(*spec.station_keys).agg(
        *(F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(c) for c in COORDINATES)
    )


def time_bounds(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: first and last time of the table and the number of steps from the first to the last."""
    bounds = df.agg(F.min(spec.ts).alias("min_ts"), F.max(spec.ts).alias("max_ts"))
    return bounds.withColumn("n_steps", complete_steps(F.col("min_ts"), F.col("max_ts"), spec.step) + 1)


def stations(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    return df.select(*spec.station_keys).distinct()


def _with_first_step(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """The bound as a scalar subquery: it stays in the plan, without a join or a trip to the driver."""
    return df.withColumn(FIRST, bounds.select("min_ts").scalar())


def _has_station(spec: DemandSpec) -> Column:
    """Sums whose station has a null key match no station, as in any equi join."""
    return _and(F.col(k).isNotNull() for k in spec.station_keys)


def _anchors(station_rows: DataFrame, bounds: DataFrame, carried: list[str], spec: DemandSpec) -> DataFrame:
    """An empty row per station at the start of each block of steps, with the carried values of its series."""
    size = spec.block_steps
    bounded = _with_first_step(station_rows, bounds).withColumn("_n", bounds.select("n_steps").scalar())
    offsets = F.sequence(F.lit(0), F.col("_n") - 1, F.lit(size).cast("bigint"))
    return bounded.withColumn("_offset", F.explode(offsets)).select(
        *spec.station_keys,
        add_steps(F.col(FIRST), F.col("_offset"), spec.step).alias(spec.ts),
        F.lit(0).cast("bigint").alias(spec.target),
        F.lit(0).cast("bigint").alias(spec.second_measure),
        F.col("_offset"),
        F.least(F.col("_offset") + size, F.col("_n")).alias("_block_end"),
        *carried,
    )


def reindex(
    station_step: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec(), carry: DataFrame | None = None
) -> DataFrame:
    """Complete the grid between the bounds for every station; missing steps count 0.

    The result equals stations x steps left-joined with the sums, but the product is never shuffled: only the rows
    that exist, and one anchor per station and block, are brought together. Each row then fills the steps up to the
    next row of its block. Blocks keep a long series from being the work of one task.

    `carry` is a table of one row per series. Its columns are joined to the few anchors and copied to all rows of
    their block, so the large grid is not joined with it.

    Rows whose time is null or off the grid are not carried over; two rows for one step are refused.
    """
    measures = (spec.target, spec.second_measure)
    first = F.col(FIRST)
    station_rows = stations(station_step, spec)
    carried: dict[str, str] = {}
    if carry is not None:
        station_rows = station_rows.join(carry, spec.series_id, "left")
        carried = {f.name: f.dataType.simpleString() for f in carry.schema if f.name != spec.series_id}
    rows = _with_first_step(station_step.filter(_has_station(spec)), bounds)
    rows = rows.filter(on_grid(F.col(spec.ts), first, spec.step)).select(
        *spec.keys,
        *(F.coalesce(m, F.lit(0)).cast("bigint").alias(m) for m in measures),
        steps_between(first, F.col(spec.ts), spec.step).alias("_offset"),
        F.lit(None).cast("bigint").alias("_block_end"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in carried.items()),
    )
    anchored = rows.unionByName(_anchors(station_rows, bounds, list(carried), spec)).withColumn(
        "_block", F.floor(F.col("_offset") / spec.block_steps)
    )
    block = Window.partitionBy(*spec.station_keys, "_block").orderBy("_offset", F.col("_block_end").desc())
    # The anchor sorts first, so its values are the first ones of the window.
    windowed = {name: F.first(name).over(block) for name in carried}
    following = F.coalesce(F.lead("_offset").over(block), F.first("_block_end").over(block))
    windowed["_run"] = following - F.col("_offset")
    run, k = F.col("_run"), F.col("_k")
    # An anchor in front of a row for the same step fills nothing and disappears.
    fills = F.when(run > 0, F.sequence(F.lit(0).cast("bigint"), run - 1)).when(
        F.col("_block_end").isNull(), F.raise_error(F.concat(F.lit("two rows for one step of "), F.col(spec.series_id)))
    )
    filled = anchored.withColumns(windowed).withColumn("_k", F.explode(fills))
    return filled.select(
        *spec.station_keys,
        add_steps(F.col(spec.ts), k, spec.step).alias(spec.ts),
        *(F.when(k == 0, F.col(m)).otherwise(0).alias(m) for m in measures),
        *carried,
    )


def clip_negative(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    return df.withColumns({m: clip_lower(F.col(m)) for m in (spec.target, spec.second_measure)})


def _caps(histogram: DataFrame, spec: DemandSpec, min_cap: float | None) -> DataFrame:
    """Exact nearest-rank quartiles from (series, value, n, n_zero) rows.

    Only distinct values are sorted, at most one per step of the calendar. `n_zero` further steps of the series have
    value 0 without being listed; all listed values are 0 or more, so they rank after those. The running count is
    compared with the wanted rank, and the first value that passes it is the quantile.
    """
    series = Window.partitionBy(spec.series_id)
    running = series.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = histogram.select(
        spec.series_id,
        "value",
        "n_zero",
        (F.sum("n").over(running) + F.col("n_zero")).alias("upto"),
        (F.sum("n").over(series) + F.col("n_zero")).alias("total"),
    )

    def quantile(q: float) -> Column:
        rank = nearest_rank(F.col("total"), q)
        value = F.when(F.col("n_zero") > rank, 0).when(F.col("upto") > rank, F.col("value"))
        return F.min(value).cast("double")

    caps = (
        ranked.groupBy(spec.series_id)
        .agg(quantile(LOWER_QUANTILE).alias("q1"), quantile(UPPER_QUANTILE).alias("q3"))
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .withColumn("upper_cap", F.col("q3") + F.lit(spec.iqr_multiplier) * F.col("iqr"))
    )
    if min_cap is not None:
        caps = caps.withColumn("upper_cap", F.greatest("upper_cap", F.lit(float(min_cap))))
    return caps


def iqr_caps(grid: DataFrame, spec: DemandSpec = DemandSpec(), min_cap: float | None = None) -> DataFrame:
    """Upper cap per series, q3 + k * (q3 - q1), over a completed and clipped grid.

    A series that is 0 for three quarters of its steps gets cap 0 and is flattened; `min_cap` can prevent that.
    """
    histogram = grid.groupBy(spec.series_id, F.col(spec.target).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return _caps(histogram.withColumn("n_zero", F.lit(0)), spec, min_cap)


def value_counts(station_step: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """How many sums of each station have each clipped value; counts of disjoint ranges of time add up.

    Sums that the grid cannot hold are listed with count 0, so that their series still gets its zeros.
    """
    counted = _has_station(spec) & on_grid(F.col(spec.ts), F.col(FIRST), spec.step)
    value = F.when(counted, clip_lower(F.coalesce(spec.target, F.lit(0)))).otherwise(0)
    return (
        _with_first_step(station_step, bounds)
        .withColumns({"value": value.cast("bigint"), "counted": counted})
        .groupBy(*spec.station_keys, "value")
        .agg(F.count_if("counted").alias("n"))
    )


def caps_of_counts(
    histogram: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec(), min_cap: float | None = None
) -> DataFrame:
    """Caps from `value_counts` of the whole history."""
    # Stations of a series and its counted sums, in two levels so that no series is one task's work.
    per_station = histogram.groupBy(*spec.station_keys).agg(F.sum("n").alias("n"))
    per_series = per_station.groupBy(spec.series_id).agg(F.count(F.lit(1)).alias("tuples"), F.sum("n").alias("counted"))
    zeros = (F.col("tuples") * bounds.select("n_steps").scalar() - F.col("counted")).alias("n_zero")
    return _caps(histogram.join(per_series.select(spec.series_id, zeros), spec.series_id), spec, min_cap)


def iqr_caps_of_sums(
    station_step: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec(), min_cap: float | None = None
) -> DataFrame:
    """The same caps from the sums *before* the grid is completed.

    Steps without taps are not generated to be counted: their number is the number of steps of all stations of the
    series minus the sums that lie on the grid.
    """
    return caps_of_counts(value_counts(station_step, bounds, spec), bounds, spec, min_cap)


def cap_outliers(df: DataFrame, caps: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Lower the target to its series' cap. The second measure is never capped.

    Caps are one row per series; whether they are broadcast is left to the planner, which checks their size.
    """
    return _capped(df.join(caps.select(spec.series_id, "upper_cap"), spec.series_id, "left"), spec)


def _capped(df: DataFrame, spec: DemandSpec) -> DataFrame:
    target = cap_upper(F.col(spec.target), F.col("upper_cap")).alias(spec.target)
    return df.select(*spec.keys, target, spec.second_measure)


def grid_with_caps(
    station_step: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec(), min_cap: float | None = None
) -> DataFrame:
    """Completed grid, not yet clipped, with the cap of each row's series."""
    caps = iqr_caps_of_sums(station_step, bounds, spec, min_cap)
    return reindex(station_step, bounds, spec, carry=caps.select(spec.series_id, "upper_cap"))


def cleaned_from(
    station_step: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec(), min_cap: float | None = None
) -> DataFrame:
    """Sums to cleaned table: complete with 0, clip at 0, cap at the exact per-series bound.

    The rows are shuffled once, for the grid; the caps travel with the anchors.
    """
    return _capped(clip_negative(grid_with_caps(station_step, bounds, spec, min_cap), spec), spec)


def quality_counts(grid: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: negative values, and values above the cap, in a completed, not yet clipped grid with caps."""
    return grid.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(spec.target) < 0).alias("n_negative_entries"),
        F.count_if(F.col(spec.second_measure) < 0).alias("n_negative_transfers"),
        F.count_if(clip_lower(F.col(spec.target)) > F.col("upper_cap")).alias("n_capped"),
    ).withColumn("pct_capped", F.round(F.try_divide(F.col("n_capped") * 100.0, F.col("n_rows")), 4))


def ambiguous_series(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Ids that come with more than one attribute tuple; such ids would mix two series."""
    return stations(df, spec).groupBy(spec.series_id).agg(F.count(F.lit(1)).alias("n_tuples")).filter("n_tuples > 1")


def off_grid_rows(station_step: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: sums that the grid cannot hold, because their time is null or not a whole step from the first."""
    lost = _with_first_step(station_step, bounds).filter(~on_grid(F.col(spec.ts), F.col(FIRST), spec.step))
    return lost.agg(
        F.count(F.lit(1)).alias("n_off_grid"), sum_or_zero(F.col(spec.target)).alias("lost_entries")
    )
