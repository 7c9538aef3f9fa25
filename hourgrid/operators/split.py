"""Chronological split of a feature table."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.functions.timegrid import steps_between, timestamp_literal
from hourgrid.spec import DemandSpec

SPLITS = ("train", "val", "test")


def split_label(spec: DemandSpec = DemandSpec()) -> Column:
    ts = F.col(spec.ts)
    return (
        F.when(ts < timestamp_literal(spec.train_end), "train")
        .when(ts < timestamp_literal(spec.validation_end), "val")
        .when(ts.isNotNull(), "test")
    )


def by_time(df: DataFrame, spec: DemandSpec = DemandSpec()) -> dict[str, DataFrame]:
    """Three half-open time ranges as filters, which reach a Parquet scan."""
    ts = F.col(spec.ts)
    first, second = timestamp_literal(spec.train_end), timestamp_literal(spec.validation_end)
    return {
        "train": df.filter(ts < first),
        "val": df.filter((ts >= first) & (ts < second)),
        "test": df.filter(ts >= second),
    }


def with_split(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Label column instead of three tables; written partitioned by it, each split is one folder."""
    return df.filter(F.col(spec.ts).isNotNull()).withColumn("split", split_label(spec))


def train_and_validation(parts: dict[str, DataFrame]) -> DataFrame:
    return parts["train"].unionByName(parts["val"])


def _ranges(name_of: Column, ts: str) -> list[Column]:
    return [
        (F.min if end == "first" else F.max)(F.when(name_of == name, F.col(ts))).alias(f"{name}_{end}")
        for name in SPLITS
        for end in ("first", "last")
    ]


def split_ranges(parts: dict[str, DataFrame], spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row with first and last time of each stored part, in one pass over all of them."""
    marked = [part.select(spec.ts, F.lit(name).alias("split")) for name, part in parts.items()]
    return reduce(DataFrame.unionByName, marked).agg(*_ranges(F.col("split"), spec.ts))


def table_ranges(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """The same row from one scan of a table that is not split yet."""
    return df.agg(*_ranges(split_label(spec), spec.ts))


def _checked(ranges: DataFrame) -> DataFrame:
    ordered = (F.col("train_last") < F.col("val_first")) & (F.col("val_last") < F.col("test_first"))
    return ranges.withColumn("chronological", F.coalesce(ordered, F.lit(False)))


def table_check(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: the ranges that the cuts give and whether all three parts have rows."""
    return _checked(table_ranges(df, spec))


def leak_check(parts: dict[str, DataFrame], spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: the ranges and whether train < val < test without overlap."""
    return _checked(split_ranges(parts, spec))


def assert_chronological(parts: dict[str, DataFrame], spec: DemandSpec = DemandSpec()) -> None:
    row = leak_check(parts, spec).first()
    if not row["chronological"]:
        raise AssertionError(f"train, val and test overlap or are empty: {row.asDict()}")


def split_counts(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Rows, share and time range per split, plus the step count of the whole range."""
    counts = with_split(df, spec).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(spec.ts).alias("min_ts"),
        F.max(spec.ts).alias("max_ts"),
    )
    total = df.filter(F.col(spec.ts).isNotNull()).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n_rows") * 100.0 / F.col("_total")
    return counts.withColumn("_total", total.scalar()).withColumn("pct", F.round(share, 1)).drop("_total")


def range_steps(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: first and last time and the steps they span, both ends included."""
    bounds = df.agg(F.min(spec.ts).alias("min_ts"), F.max(spec.ts).alias("max_ts"))
    span = steps_between(F.col("min_ts"), F.col("max_ts"), spec.step) + 1
    return bounds.withColumn("total_steps", span)


def proportional_cuts(
    df: DataFrame, fractions: tuple[float, float] = (0.8, 0.1), spec: DemandSpec = DemandSpec()
) -> DataFrame:
    """One row: cut points that give train and validation their share of the real time range."""
    first, second = fractions[0], fractions[0] + fractions[1]

    def cut(share: float) -> Column:
        # Rounded first, so that 0.8 + 0.1 counts as 0.9.
        whole = F.floor(F.round(F.col("total_steps") * F.lit(share), 6)).cast("int")
        interval = F.make_dt_interval(hours=whole) if spec.step == "hour" else F.make_dt_interval(days=whole)
        return F.col("min_ts") + interval

    return range_steps(df, spec).withColumns({"train_end": cut(first), "validation_end": cut(second)})


def spec_with_cuts(
    df: DataFrame,
    fractions: tuple[float, float] = (0.8, 0.1),
    spec: DemandSpec = DemandSpec(),
    train_end: str | None = None,
) -> DemandSpec:
    """Spec whose cuts follow the data (one aggregated row comes to the driver).

    `train_end` moves the first cut, for example off a holiday. The second cut then keeps the validation share,
    counted from the moved cut and rounded up to a whole day.
    """
    row = proportional_cuts(df, fractions, spec).first()
    if train_end is None:
        return spec.with_(train_end=str(row["train_end"]), validation_end=str(row["validation_end"]))
    unit = timedelta(hours=1) if spec.step == "hour" else timedelta(days=1)
    moved = datetime.fromisoformat(train_end) + int(row["total_steps"] * fractions[1]) * unit
    midnight = moved.replace(hour=0, minute=0, second=0, microsecond=0)
    second = midnight if moved == midnight else midnight + timedelta(days=1)
    return spec.with_(train_end=train_end, validation_end=str(second))


def day_scores(
    df: DataFrame, spec: DemandSpec = DemandSpec(), weeks: int = 4, limit: float = 4.0, floor: float = 0.01
) -> DataFrame:
    """One row per date: the network total, what is usual, and whether the day is unusual.

    Usual is the lower median of the totals of the same weekday at most `weeks` weeks away, so week and season drop out.
    A day is unusual if its relative deviation exceeds `limit` robust deviations: 1.4826 times the median absolute
    deviation of all days, at least `floor`. Days with fewer rows than the fullest day are not whole: they count
    neither as usual nor as unusual. The same holds for a day whose usual total is 0. One row per day of the calendar.
    """
    totals = daily_totals(df, spec).filter("date is not null")
    whole = totals.filter(F.col("n_rows") == totals.agg(F.max("n_rows").alias("n")).scalar())
    near = Window.partitionBy(F.weekday("date")).orderBy(F.unix_date("date")).rangeBetween(-7 * weeks, 7 * weeks)
    sorted_totals = F.sort_array(F.collect_list("total_entries").over(near))
    usual = F.element_at(sorted_totals, F.floor((F.size(sorted_totals) + 1) / 2).cast("int"))
    scored = whole.withColumn("usual_entries", usual).withColumn(
        "deviation", F.try_divide(F.col("total_entries") - F.col("usual_entries"), F.col("usual_entries"))
    )
    middle = scored.agg(F.median(F.abs("deviation")).alias("m"))
    scale = F.greatest(F.lit(1.4826) * middle.scalar(), F.lit(floor))
    unusual = F.coalesce(F.abs("deviation") > F.lit(limit) * scale, F.lit(False))
    return scored.select("date", "total_entries", "usual_entries", "deviation", unusual.alias("unusual"))


def quiet_cut(df: DataFrame, cut: str, spec: DemandSpec = DemandSpec(), ahead: int = 7, **how: float) -> DataFrame:
    """One row: the proposed cut and the first midnight from it on that begins `ahead` days without an unusual one.

    So a cut in the days after a holiday moves past the next holiday of the same season, and the part after it begins
    in ordinary days. Without such a day in the data the proposed cut stays. `how` goes to `day_scores`.
    """
    scores = day_scores(df, spec, **how)
    blocked = scores.filter("unusual").select(
        F.explode(F.sequence(F.date_sub("date", ahead - 1), F.col("date"))).alias("date")
    )
    at = timestamp_literal(cut)
    quiet = scores.filter(F.col("date").cast("timestamp_ntz") >= at).join(blocked, "date", "left_anti")
    moved = F.coalesce(F.min("date").cast("timestamp_ntz"), at)
    return quiet.agg(moved.alias("train_end")).select(at.alias("proposed"), "train_end")


def spec_with_quiet_cuts(
    df: DataFrame, fractions: tuple[float, float] = (0.8, 0.1), spec: DemandSpec = DemandSpec(), **how: float
) -> DemandSpec:
    """`spec_with_cuts` whose first cut keeps off unusual days by itself."""
    proposed = str(proportional_cuts(df, fractions, spec).first()["train_end"])
    row = quiet_cut(df, proposed, spec, **how).first()
    return spec_with_cuts(df, fractions, spec, None if row["train_end"] == row["proposed"] else str(row["train_end"]))


def daily_totals(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Network total per date: shows holidays near a cut point."""
    date = F.col(spec.ts).cast("date").alias("date")
    return df.groupBy(date).agg(F.sum(spec.target).alias("total_entries"), F.count(F.lit(1)).alias("n_rows"))
