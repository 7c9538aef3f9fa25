"""A store by month that takes raw rows in batches and rebuilds only the months that they change."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.timegrid import step_interval
from hourgrid.operators import clean, onepass
from hourgrid.sources import tables
from hourgrid.sources.monthly import MONTH, in_range, month_of, read_months, write_months
from hourgrid.spec import DemandSpec
from hourgrid.staging import stage

#: Ranges of months that one rebuild computes; all of them are written by one job.
RUNS = 4


@dataclass(frozen=True)
class Update:
    """Months with rows of the batch, and months whose features were written again."""

    touched: list[date]
    rebuilt: list[date]


def _next(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def _runs(months: list[date], most: int = RUNS) -> list[tuple[date, date]]:
    """Consecutive months as [first, one after the last); the smallest gaps are closed until `most` runs are left."""
    runs: list[tuple[date, date]] = []
    for month in sorted(months):
        if runs and runs[-1][1] == month:
            runs[-1] = runs[-1][0], _next(month)
        else:
            runs.append((month, _next(month)))
    while len(runs) > most:
        i = min(range(len(runs) - 1), key=lambda i: runs[i + 1][0] - runs[i][1])
        runs[i : i + 2] = [(runs[i][0], runs[i + 1][1])]
    return runs


class MonthlyStore:
    """Folder with these tables, all but the last in one folder per month:

    `rollup`    sums per station and step of each batch; a batch has its own folders, so taking it twice changes nothing
    `ranges`    first and last time of the raw rows
    `values`    how often each station has each clipped sum: the caps follow from these counts alone
    `features`  the feature table
    `series`    stations, and the caps and the time range that the stored features were built with

    `series` is written last. An update that was ended half-way is completed by taking its batch again. One update
    runs at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, spec: DemandSpec = DemandSpec()) -> None:
        self.spark, self.folder, self.spec = spark, folder.rstrip("/"), spec

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _read(self, name: str, months: list[date] | None = None) -> DataFrame:
        return read_months(self.spark, self.path(name), months)

    def rollup(self, start: str | None = None, end: str | None = None, months: list[date] | None = None) -> DataFrame:
        """Sums of all batches, of a range or some months."""
        spec = self.spec
        stored = in_range(self._read("rollup", months), spec.ts, start, end)
        counts = [c for c in stored.columns if c not in (*spec.keys, MONTH, "batch")]
        return stored.groupBy(*spec.keys).agg(*(F.sum(c).alias(c) for c in counts))

    def features(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Stored features; a range reads the folders of its months."""
        return in_range(self._read("features"), self.spec.ts, start, end).drop(MONTH)

    def caps(self) -> DataFrame:
        return self.series().select(self.spec.series_id, "upper_cap").distinct()

    def series(self) -> DataFrame:
        return self.spark.read.parquet(self.path("series"))

    def compute_features(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Features of a range from the sums of its months and the month before, with the stored caps."""
        return self._computed(self.series(), self._bounds(), start, end)

    def _computed(self, series: DataFrame, bounds: DataFrame, start: str | None, end: str | None) -> DataFrame:
        spec = self.spec
        # The look-back is bounded here as well, because the folders are named by month and not by time.
        first = None
        if start is not None:
            back = F.lit(start).cast("timestamp_ntz") - step_interval(spec.step, spec.history + 1)
            first = str(self.spark.range(1).select(back.cast("string")).first()[0])
        sums = clean.station_step_of(self.rollup(first, end), spec)
        return onepass.features_of_sums(sums, bounds, spec, start, end, series=series)

    def _bounds(self) -> DataFrame:
        """One row, as `clean.time_bounds` of all raw rows gives it."""
        ends = self._read("ranges").select(F.explode(F.array("min_ts", "max_ts")).alias(self.spec.ts))
        return clean.time_bounds(ends, self.spec)

    def update(self, raw: DataFrame, batch: str) -> Update:
        """Take a batch of raw rows, which may add to any month, and bring the features up to date.

        The result equals a build from all raw rows. Rows without a time are kept in the rollup only. A month is built
        again if the batch has rows in it, if the grid now reaches into it, or if the cap of a series moved and the month
        has a value above the lower one of both caps; then also the months whose rows look back on it. A new station or
        an earlier first time changes every month. An empty batch changes nothing.
        """
        spec = self.spec
        built = self._built()
        rolled = stage(clean.rollup(raw, spec), "batch").withColumns({MONTH: month_of(F.col(spec.ts)), "batch": F.lit(batch)})
        touched = [r[0] for r in rolled.select(MONTH).distinct().collect() if r[0] is not None]
        write_months(rolled, self.path("rollup"), (MONTH, "batch"))
        if not touched:
            return Update([], [])
        # A column that comes out as a folder name is not in the files; bounds and counts go by month.
        merged = stage(self.rollup(months=touched), "merged").withColumn(MONTH, month_of(F.col(spec.ts)))
        write_months(
            merged.groupBy(MONTH).agg(F.min(spec.ts).alias("min_ts"), F.max(spec.ts).alias("max_ts")), self.path("ranges")
        )
        bounds = stage(self._bounds(), "bounds")
        now = bounds.first()
        if built is None or built["built_from"] != now["min_ts"]:
            # Where the grid begins decides which sums lie on it.
            touched_values = [r[0] for r in self._read("ranges").select(MONTH).collect()]
            merged = self.rollup(months=touched_values).withColumn(MONTH, month_of(F.col(spec.ts)))
        by_month = spec.with_(attributes=(*spec.attributes, MONTH))
        sums = clean.exclude_rows(merged, spec.exclude)
        write_months(clean.value_counts(sums, bounds, by_month), self.path("values"))
        histogram = self._read("values").groupBy(*spec.station_keys, "value").agg(F.sum("n").alias("n"))
        caps = clean.caps_of_counts(stage(histogram, "histogram"), bounds, spec).select(spec.series_id, "upper_cap")
        series = stage(
            clean.stations(histogram, spec)
            .join(caps, spec.series_id, "left")
            .withColumns({"built_from": F.lit(now["min_ts"]), "built_upto": F.lit(now["max_ts"])}),
            "series",
        )
        rebuilt = self._changed(touched, built, series, now)
        parts = [
            self._computed(series, bounds, f"{first} 00:00:00", f"{after} 00:00:00") for first, after in _runs(rebuilt)
        ]
        if parts:
            rows = reduce(DataFrame.unionByName, parts).withColumn(MONTH, month_of(F.col(spec.ts)))
            write_months(rows.filter(F.col(MONTH).isin(rebuilt)), self.path("features"))
        tables.write_table(series, self.path("series"))
        return Update(sorted(touched), rebuilt)

    def _built(self):
        """Range of the stored features, None without any."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path("series"))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.series().select("built_from", "built_upto").first()

    def _changed(self, touched: list[date], built, series: DataFrame, now) -> list[date]:
        """Months of the grid to build again; one row per month comes to the driver."""
        spec = self.spec
        first, last = (now[c].date().replace(day=1) for c in ("min_ts", "max_ts"))
        grid = [first]
        while grid[-1] < last:
            grid.append(_next(grid[-1]))
        if built is None or built["built_from"] != now["min_ts"]:
            return grid
        before = self.series().select(*spec.station_keys, F.col("upper_cap").alias("old_cap"))
        same = [series[k].eqNullSafe(before[k]) for k in spec.station_keys]
        both = series.join(before, same, "left").select(*(series[k] for k in spec.station_keys), "upper_cap", "old_cap")
        if not both.filter("old_cap is null and upper_cap is not null").isEmpty():
            return grid
        moved = both.filter("upper_cap <> old_cap").select(
            spec.series_id, F.least("upper_cap", "old_cap").alias("lower_cap")
        ).distinct()
        above = self._read("values").join(moved, spec.series_id).filter("value > lower_cap")
        months = set(touched) | {r[0] for r in above.select(MONTH).distinct().collect()}
        if built["built_upto"] != now["max_ts"]:
            months |= {m for m in grid if m >= built["built_upto"].date().replace(day=1)}
        # Rows look back at most this many months.
        hours = spec.history * (1 if spec.step == "hour" else 24)
        reach = -(-hours // (28 * 24))
        for month in list(months):
            for _ in range(reach):
                month = _next(month)
                months.add(month)
        return [m for m in grid if m in months]
