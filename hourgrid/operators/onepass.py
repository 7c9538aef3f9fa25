"""From station-step sums to features in one shuffle.

`clean.cleaned_from` followed by `features.build_features` shuffles the rows that exist, fills the grid, and shuffles
the filled grid again. Here the sums are dealt to blocks of a series together with the sums the next block looks back
on, before anything is filled; filling, capping, lags and rolling means then all happen in the partitions of that
one shuffle. A range of time is cut out before the fill, so only its blocks are generated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.functions.numeric import cap_upper, clip_lower
from hourgrid.functions.timegrid import add_steps, on_grid, step_interval, steps_between, timestamp_literal
from hourgrid.operators import clean
from hourgrid.operators.features import BLOCK, OWN, POSITION, add_calendar, drop_warmup, history_in_blocks
from hourgrid.spec import DemandSpec

FROM, UPTO = "_from", "_upto"


def series_with_caps(
    sums: DataFrame, bounds: DataFrame, spec: DemandSpec = DemandSpec(), min_cap: float | None = None
) -> DataFrame:
    """One row per station tuple with the cap of its series over the whole history."""
    caps = clean.iqr_caps_of_sums(sums, bounds, spec, min_cap)
    return clean.stations(sums, spec).join(caps.select(spec.series_id, "upper_cap"), spec.series_id, "left")


def _with_range(df: DataFrame, bounds: DataFrame, start: str | None, end: str | None, spec: DemandSpec) -> DataFrame:
    """First step of the grid, and the steps [FROM, UPTO) counted from it that are wanted."""
    first, n = F.col(clean.FIRST), F.col("_n")
    begin: Column = F.lit(0).cast("bigint")
    stop = n
    if start is not None:
        begin = F.greatest(begin, steps_between(first, timestamp_literal(start), spec.step))
    if end is not None:
        # The step in which the bound lies may still begin before it; the exact bound is applied to the rows.
        stop = F.least(n, steps_between(first, timestamp_literal(end), spec.step) + 1)
    ranged = df.withColumns({clean.FIRST: bounds.select("min_ts").scalar(), "_n": bounds.select("n_steps").scalar()})
    return ranged.withColumns({FROM: begin, UPTO: stop})


def _dealt_rows(sums: DataFrame, bounds: DataFrame, start: str | None, end: str | None, spec: DemandSpec) -> DataFrame:
    """Sums of the range and its look-back, each in its block, and once more in the next block if that needs it."""
    size, ts = _block_size(spec), F.col(spec.ts)
    # Plain bounds on the time column, which reach the scan and its partitions.
    if start is not None:
        sums = sums.filter(ts >= timestamp_literal(start) - step_interval(spec.step, spec.history + 1))
    if end is not None:
        sums = sums.filter(ts < timestamp_literal(end))
    rows = _with_range(sums.filter(clean._has_station(spec)), bounds, start, end, spec)
    rows = rows.filter(on_grid(ts, F.col(clean.FIRST), spec.step)).withColumn(
        "_offset", steps_between(F.col(clean.FIRST), ts, spec.step)
    )
    ahead = F.col("_offset") - F.col(FROM)
    home = F.floor(ahead / size)
    late = F.pmod(ahead, F.lit(size)) >= size - spec.history
    dealt = rows.withColumn(BLOCK, F.explode(F.when(late, F.array(home, home + 1)).otherwise(F.array(home))))
    return dealt.filter((F.col(BLOCK) >= 0) & (F.col(BLOCK) * size + F.col(FROM) < F.col(UPTO))).select(
        *spec.keys,
        F.coalesce(spec.target, F.lit(0)).cast("bigint").alias(spec.target),
        "_offset",
        F.lit(None).cast("bigint").alias("_block_end"),
        F.lit(None).cast("bigint").alias("_own_from"),
        BLOCK,
        F.lit(None).cast("double").alias("upper_cap"),
    )


def _block_size(spec: DemandSpec) -> int:
    """A block looks back into the one before it only."""
    return max(spec.block_steps, spec.history)


def _anchors(series: DataFrame, bounds: DataFrame, start: str | None, end: str | None, spec: DemandSpec) -> DataFrame:
    """An empty row per station and block, at the first step the block looks back on, with the cap of its series."""
    size = _block_size(spec)
    wanted = _with_range(series, bounds, start, end, spec).filter(F.col(UPTO) > F.col(FROM))
    last = F.floor((F.col(UPTO) - F.col(FROM) - 1) / size)
    blocks = wanted.withColumn(BLOCK, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    own_from = F.col(FROM) + F.col(BLOCK) * size
    offset = F.greatest(F.lit(0).cast("bigint"), own_from - spec.history)
    return blocks.select(
        *spec.station_keys,
        add_steps(F.col(clean.FIRST), offset, spec.step).alias(spec.ts),
        F.lit(0).cast("bigint").alias(spec.target),
        offset.alias("_offset"),
        F.least(own_from + size, F.col(UPTO)).alias("_block_end"),
        own_from.alias("_own_from"),
        BLOCK,
        F.col("upper_cap").cast("double").alias("upper_cap"),
    )


def features_of_sums(
    sums: DataFrame,
    bounds: DataFrame,
    spec: DemandSpec = DemandSpec(),
    start: str | None = None,
    end: str | None = None,
    min_cap: float | None = None,
    series: DataFrame | None = None,
) -> DataFrame:
    """The rows of `build_features(cleaned_from(sums, bounds, spec, min_cap), spec, start, end)`.

    `series` (one row per station tuple with `upper_cap`) replaces the caps computed here; with stored caps a range
    reads the sums of the range and its look-back and nothing else.

    As in `clean.reindex`, sums whose time is null or off the grid are not carried over, and those of a station with
    a null key match no station, which then has zeros only. Two rows for one step, and an id with several attribute
    tuples, stop the job. An empty range gives no rows.
    """
    if series is None:
        series = series_with_caps(sums, bounds, spec, min_cap)
    dealt = _dealt_rows(sums, bounds, start, end, spec).unionByName(_anchors(series, bounds, start, end, spec))
    # One exchange; both windows below are satisfied with it.
    dealt = dealt.repartition(spec.series_id, BLOCK)
    block = Window.partitionBy(*spec.station_keys, BLOCK).orderBy("_offset", F.col("_block_end").desc())
    following = F.coalesce(F.lead("_offset").over(block), F.first("_block_end").over(block))
    opened = dealt.withColumns({
        "upper_cap": F.first("upper_cap").over(block),
        "_own_from": F.first("_own_from").over(block),
        "_run": following - F.col("_offset"),
    })
    run, k = F.col("_run"), F.col("_k")
    # An anchor in front of a row for the same step fills nothing and disappears.
    fills = F.when(run > 0, F.sequence(F.lit(0).cast("bigint"), run - 1)).when(
        F.col("_block_end").isNull(), F.raise_error(F.concat(F.lit("two rows for one step of "), F.col(spec.series_id)))
    )
    columns = [*spec.keys, spec.target]
    filled = opened.withColumn("_k", F.explode(fills)).select(
        *spec.station_keys,
        add_steps(F.col(spec.ts), k, spec.step).alias(spec.ts),
        cap_upper(clip_lower(F.when(k == 0, F.col(spec.target)).otherwise(0)), F.col("upper_cap")).alias(spec.target),
        BLOCK,
        (F.col("_offset") + k).alias(POSITION),
        (F.col("_offset") + k >= F.col("_own_from")).alias(OWN),
    )
    featured = drop_warmup(add_calendar(history_in_blocks(filled, columns, True, spec), spec), spec)
    ts = F.col(spec.ts)
    if start is not None:
        featured = featured.filter(ts >= timestamp_literal(start))
    return featured if end is None else featured.filter(ts < timestamp_literal(end))
