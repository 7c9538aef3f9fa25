"""Leak-free features: every value of a row is known before its step begins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.functions.timegrid import day_of_week, is_weekend, step_index, step_interval, timestamp_literal
from hourgrid.spec import DemandSpec

BLOCK, OWN, POSITION = "_block", "_own", "_position"
RUNNING_SUM, RUNNING_COUNT = "_running_sum", "_running_count"


def _with_row_position(df: DataFrame, spec: DemandSpec) -> DataFrame:
    """0-based row number inside each series, without sorting a whole series in one task.

    Rows are counted per series and time block; a running sum over the few blocks gives each block's first
    position, and rows are numbered inside their block only.
    """
    order = [spec.ts, *spec.attributes]
    chunk = F.floor(step_index(F.col(spec.ts), spec.step) / spec.block_steps)
    chunked = df.withColumn("_chunk", chunk)
    earlier = Window.partitionBy(spec.series_id).orderBy(F.col("_chunk").asc_nulls_first())
    starts = (
        chunked.groupBy(spec.series_id, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)))
        .select(
            F.col(spec.series_id).alias("_sid"),
            F.col("_chunk").alias("_c"),
            F.coalesce("_start", F.lit(0)).alias("_start"),
        )
    )
    inside = Window.partitionBy(spec.series_id, "_chunk").orderBy(*order)
    numbered = chunked.withColumn("_row", F.row_number().over(inside))
    same = F.col(spec.series_id).eqNullSafe(F.col("_sid")) & F.col("_chunk").eqNullSafe(F.col("_c"))
    return (
        numbered.join(starts, same, "left")
        .withColumn(POSITION, F.col("_start") + F.col("_row") - 1)
        .drop("_chunk", "_row", "_start", "_sid", "_c")
    )


def _in_blocks(df: DataFrame, spec: DemandSpec) -> DataFrame:
    """Give each row its block, and the next block a copy of the last rows it has to look back to."""
    size = max(spec.block_steps, spec.history)
    block = F.floor(F.col(POSITION) / size)
    needed_next = F.pmod(F.col(POSITION), F.lit(size)) >= size - spec.history
    blocks = F.when(needed_next, F.array(block, block + 1)).otherwise(F.array(block))
    return df.withColumn("_home", block).withColumn(BLOCK, F.explode(blocks)).withColumn(
        OWN, F.col("_home") == F.col(BLOCK)
    ).drop("_home")


def _window(spec: DemandSpec) -> WindowSpec:
    return Window.partitionBy(spec.series_id, BLOCK).orderBy(POSITION)


def lag_expr(spec: DemandSpec, k: int, window: WindowSpec) -> Column:
    return F.lag(spec.target, k).over(window)


def rolling_by_frame(spec: DemandSpec, w: int, window: WindowSpec) -> Column:
    """Mean of the w rows strictly before the row; null unless all w exist."""
    frame = window.rowsBetween(-w, -1)
    return F.when(F.count(spec.target).over(frame) == w, F.avg(spec.target).over(frame))


def rolling_by_running_sum(w: int, window: WindowSpec) -> Column:
    """The same mean as a difference of two running sums: the work per row does not grow with w."""

    def change(running: str) -> Column:
        return F.lag(running, 1).over(window) - F.lag(running, w + 1, 0).over(window)

    return F.when(change(RUNNING_COUNT) == w, change(RUNNING_SUM) / w)


def history_in_blocks(blocks: DataFrame, columns: list[str], exact: bool, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """`columns`, lags and rolling means of the rows that a block owns.

    The input has BLOCK, OWN and POSITION and, in front of a block's own rows, copies of the `spec.history` rows
    before them. `exact` says that the target is whole, so that running sums may serve all windows.
    """
    window = _window(spec)
    history = {spec.lag_name(k): lag_expr(spec, k, window) for k in spec.lags}
    if exact and spec.windows:
        sofar = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        blocks = blocks.withColumns({
            RUNNING_SUM: F.coalesce(F.sum(spec.target).over(sofar), F.lit(0)),
            RUNNING_COUNT: F.count(spec.target).over(sofar),
        })
        history |= {spec.rolling_name(w): rolling_by_running_sum(w, window) for w in spec.windows}
    else:
        history |= {spec.rolling_name(w): rolling_by_frame(spec, w, window) for w in spec.windows}
    history["_before"] = F.lag(POSITION, 1).over(window)
    consecutive = F.col("_before").isNull() | (F.col("_before") == F.col(POSITION) - 1)
    checked = F.when(consecutive, F.col(OWN)).otherwise(
        F.raise_error(F.concat(F.lit("series is not a gap-free grid: "), F.col(spec.series_id)))
    )
    with_history = blocks.withColumns(history)
    return with_history.filter(checked).select(*columns, *spec.lag_columns, *spec.rolling_columns)


def add_history(df: DataFrame, spec: DemandSpec = DemandSpec(), gap_free: bool = True) -> DataFrame:
    """Lags and rolling means of the target, counted in rows of the series.

    A series is cut into blocks of `spec.block_steps` rows, each with a copy of the `spec.history` rows before it,
    so one long series is spread over many tasks; one shuffle and one sort serve all columns. The result leaves each
    task in the order of series and time.

    On a gap-free grid the position of a row follows from its time. That is checked while computing: a missing or
    doubled step stops the job instead of giving shifted values. `gap_free=False` counts the rows of any table.
    """
    if gap_free:
        positioned = df.withColumn(POSITION, step_index(F.col(spec.ts), spec.step))
    else:
        positioned = _with_row_position(df, spec)
    # Running sums are exact for whole numbers only.
    exact = isinstance(df.schema[spec.target].dataType, T.IntegralType)
    return history_in_blocks(_in_blocks(positioned, spec), df.columns, exact, spec)


def add_lags(df: DataFrame, spec: DemandSpec = DemandSpec(), gap_free: bool = True) -> DataFrame:
    return add_history(df, spec.with_(windows=()), gap_free)


def add_rolling(df: DataFrame, spec: DemandSpec = DemandSpec(), gap_free: bool = True) -> DataFrame:
    both = add_history(df, spec.with_(lags=(1,)), gap_free)
    return both.drop(spec.lag_name(1))


def add_calendar(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    ts = F.col(spec.ts)
    return df.withColumns({
        "hour_of_day": F.hour(ts),
        "day_of_week": day_of_week(ts),
        "month": F.month(ts),
        "is_weekend": is_weekend(ts),
    })


def drop_warmup(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Drop the first rows of each series, where some lag does not exist yet."""
    return df.na.drop(how="any", subset=spec.lag_columns)


def build_features(
    cleaned: DataFrame,
    spec: DemandSpec = DemandSpec(),
    start: str | None = None,
    end: str | None = None,
    gap_free: bool = True,
) -> DataFrame:
    """Cleaned table to feature table.

    With `start` or `end` only rows in [start, end) come out, and only these rows plus their look-back are read:
    the bounds reach the scan, which a filter placed after the windows could not.
    """
    source = cleaned.drop(spec.second_measure)
    ts = F.col(spec.ts)
    if start is not None:
        # Counting rows back instead of steps would need all earlier rows.
        if not gap_free:
            raise ValueError("a start bound needs a gap-free grid")
        source = source.filter(ts >= timestamp_literal(start) - step_interval(spec.step, spec.history))
    if end is not None:
        source = source.filter(ts < timestamp_literal(end))
    featured = drop_warmup(add_calendar(add_history(source, spec, gap_free), spec), spec)
    return featured if start is None else featured.filter(ts >= timestamp_literal(start))
