"""Approximate caps for long histories: quantile sketches per station and month that merge.

Opt-in. `clean.iqr_caps_of_sums` is exact and needs the values of the whole history; here each month of a station is
one sketch of bounded size, and caps of any number of months come from the merged sketches. Months that do not
change are never read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.numeric import clip_lower, nearest_rank
from hourgrid.functions.timegrid import on_grid
from hourgrid.operators import clean
from hourgrid.sources.monthly import MONTH, month_of
from hourgrid.spec import LOWER_QUANTILE, UPPER_QUANTILE, DemandSpec

SIZE = 200
# A sketch is asked at fixed ranks, the middles of this many equal shares.
RANKS = 1024


def rank_error_bound(size: int = SIZE) -> float:
    """Error of rank, as a share of the steps, that merged sketches keep: twice the published 99 % error, and the grid."""
    # The published fit of the error of KLL sketches by their size.
    return 2 * 2.296 / size**0.9723 + 0.5 / RANKS


def value_sketches(
    sums: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec(), size: int = SIZE
) -> DataFrame:
    """One row per station and month: a sketch of the positive sums and their number.

    Zeros, given or filled, are most of a sparse series and are counted exactly when the caps are taken. A month
    without positive sums has an empty sketch; sums without a time or off the grid are in month null and count nothing.
    """
    counted = clean._has_station(spec) & on_grid(F.col(spec.ts), F.col(clean.FIRST), spec.step)
    value = clip_lower(F.coalesce(spec.target, F.lit(0))).cast("bigint")
    positive = F.when(counted & (value > 0), value)
    marked = clean._with_first_step(sums, bounds).withColumns({"value": positive, MONTH: month_of(F.col(spec.ts))})
    return marked.groupBy(*spec.station_keys, MONTH).agg(
        F.kll_sketch_agg_bigint("value", F.lit(size)).alias("sketch"), F.count("value").alias("n_positive")
    )


def caps_of_sketches(sketched: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Columns of `clean.iqr_caps` from stored sketches, with quartiles within `rank_error_bound` of their rank.

    The sketches must cover the grid of `bounds`. Stations of a series that share its id are merged, as in the exact
    caps. Series of at most as many positive sums as a sketch and the rank grid hold get the exact quartiles.
    """
    per_station = sketched.groupBy(*spec.station_keys).agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("n_positive").alias("n")
    )
    per_series = per_station.groupBy(spec.series_id).agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
        F.sum("n").alias("n"),
        (F.count(F.lit(1)) * F.max(bounds.select("n_steps").scalar())).alias("total"),
    )
    zeros = F.col("total") - F.col("n")
    ranks = F.array(*(F.lit((i + 0.5) / RANKS) for i in range(RANKS)))
    asked = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", ranks))
    known = per_series.filter(F.col(spec.series_id).isNotNull()).withColumn("_values", asked)

    def quantile(q: float) -> Column:
        rank = nearest_rank(F.col("total"), q)
        # The middle of the value's own share of the sketched ranks.
        share = (rank - zeros + F.lit(0.5)) / F.col("n")
        found = F.get("_values", F.floor(share * RANKS).cast("int"))
        return F.when(rank < zeros, F.lit(0).cast("bigint")).otherwise(found).cast("double")

    return (
        known.select(spec.series_id, quantile(LOWER_QUANTILE).alias("q1"), quantile(UPPER_QUANTILE).alias("q3"))
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .withColumn("upper_cap", F.col("q3") + F.lit(spec.iqr_multiplier) * F.col("iqr"))
    )


def rank_errors(caps: DataFrame, counts: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Per series, how far the ranks of `q1` and `q3` are from those wanted, as a share of its steps.

    A value has the ranks from the number of smaller values to that of values not larger; inside them the error is 0.
    `counts` is `clean.value_counts` of the same history.
    """
    per_station = counts.groupBy(*spec.station_keys).agg(F.sum("n").alias("n"))
    totals = per_station.groupBy(F.col(spec.series_id).alias("_sid")).agg(
        (F.count(F.lit(1)) * F.max(bounds.select("n_steps").scalar())).alias("total"), F.sum("n").alias("listed")
    )
    values = counts.groupBy(spec.series_id, "value").agg(F.sum("n").alias("n"))
    ranked = values.join(caps.select(spec.series_id, "q1", "q3"), spec.series_id)
    quantiles = {"q1": LOWER_QUANTILE, "q3": UPPER_QUANTILE}
    below = [F.sum(F.when(F.col("value") < F.col(c), F.col("n")).otherwise(0)).alias(f"{c}_below") for c in quantiles]
    upto = [F.sum(F.when(F.col("value") <= F.col(c), F.col("n")).otherwise(0)).alias(f"{c}_upto") for c in quantiles]
    placed = ranked.groupBy(spec.series_id).agg(
        *below, *upto, F.first("q1").alias("q1"), F.first("q3").alias("q3")
    ).join(totals, F.col(spec.series_id) == F.col("_sid"))
    # Steps that are not listed are zeros.
    unlisted = F.col("total") - F.col("listed")

    def error(c: str, q: float) -> Column:
        low = F.col(f"{c}_below") + F.when(F.col(c) > 0, unlisted).otherwise(0)
        high = F.col(f"{c}_upto") + F.when(F.col(c) >= 0, unlisted).otherwise(0) - 1
        rank = nearest_rank(F.col("total"), q)
        return (F.greatest(low - rank, rank - high, F.lit(0)) / F.col("total")).alias(f"{c}_error")

    return placed.select(spec.series_id, *(error(c, q) for c, q in quantiles.items()))
