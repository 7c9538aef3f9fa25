"""The chain of stages, each reading stored tables and writing stored tables.

Every stage can be run again on its own: it overwrites its output and depends only on what earlier stages stored,
so a lost executor costs tasks and a lost job costs one stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.operators import baseline, clean, features, metrics, model, profile, reports, split
from hourgrid.sources import tables
from hourgrid.spec import DemandSpec

MODEL_PREDICTIONS = ("pred_model_default", "pred_model")


@dataclass(frozen=True)
class Prepared:
    """The reduced raw table and what follows from it without reading raw rows again."""

    rolled: DataFrame
    sums: DataFrame
    bounds: DataFrame
    spec: DemandSpec

    @classmethod
    def of(cls, rolled: DataFrame, spec: DemandSpec) -> "Prepared":
        # The range covers all raw rows, also those that the rules drop.
        return cls(rolled, clean.station_step_of(rolled, spec), clean.time_bounds(rolled, spec), spec)

    def grid(self) -> DataFrame:
        return clean.reindex(self.sums, self.bounds, self.spec)

    def caps(self) -> DataFrame:
        return clean.iqr_caps_of_sums(self.sums, self.bounds, self.spec)

    def cleaned(self) -> DataFrame:
        return clean.cleaned_from(self.sums, self.bounds, self.spec)

    def locations(self) -> DataFrame:
        return clean.station_locations_of(self.rolled, self.spec)


class Workspace:
    """Folder of stored tables and models, with one method per stage."""

    def __init__(self, spark: SparkSession, folder: str, spec: DemandSpec = DemandSpec()) -> None:
        self.spark, self.folder, self.spec = spark, folder.rstrip("/"), spec

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.path(name))

    def _store(self, df: DataFrame, name: str, **how: object) -> DataFrame:
        tables.write_table(df, self.path(name), **how)
        return self.table(name)

    def prepare(self, raw: DataFrame, latest_attributes: bool = False) -> Prepared:
        """Raw rows to `rollup`, `profile`, `station_locations`, `cleaned` and the counts of what cleaning did.

        One scan of the raw rows. `ambiguous` lists ids with several attribute tuples, which features refuse;
        `latest_attributes` gives such an id those of its latest step.
        """
        spec = self.spec
        rolled = clean.rollup(raw, spec)
        if latest_attributes:
            rolled = clean.with_latest_attributes(self._store(rolled, "rollup_as_read"), spec)
        prepared = Prepared.of(self._store(rolled, "rollup"), spec)
        self._store(profile.profile_rollup(prepared.rolled, spec), "profile")
        self._store(profile.unread_cells(prepared.rolled), "unread")
        self._store(clean.ambiguous_series(prepared.sums, spec), "ambiguous")
        self._store(clean.off_grid_rows(prepared.sums, prepared.bounds, spec), "off_grid")
        if "latitude_sum" in prepared.rolled.columns:
            self._store(prepared.locations(), "station_locations")
        counts = clean.quality_counts(clean.grid_with_caps(prepared.sums, prepared.bounds, spec), spec)
        self._store(counts, "quality")
        cleaned = self._store(prepared.cleaned(), "cleaned")
        self._store(profile.lineage(prepared.rolled, prepared.sums, cleaned, spec), "lineage")
        return prepared

    def build_features(self) -> DataFrame:
        """Store `features`, and in `feature_counts` the rows and series before and after the warm-up is dropped."""
        spec = self.spec
        doubled = [r[spec.series_id] for r in self.table("ambiguous").limit(10).collect()]
        if doubled:
            raise ValueError(f"ids with several attribute tuples: {doubled}; see the stored table `ambiguous`")
        # Both large tables leave their windows in the order of series and time, so they are stored sorted as they are.
        table = self._store(features.build_features(self.table("cleaned"), spec), "features")
        self._store(profile.stage_counts({"cleaned": self.table("cleaned"), "features": table}, spec), "feature_counts")
        return table

    def part(self, name: str) -> DataFrame:
        return self.table("split").where(F.col("split") == name).drop("split")

    def parts(self) -> dict[str, DataFrame]:
        return {name: self.part(name) for name in split.SPLITS}

    def split(self) -> dict[str, DataFrame]:
        """Check the order in time in one scan, store the parts in one write, and their sizes in `split_counts`."""
        table = self.table("features")
        row = split.table_check(table, self.spec).first()
        if not row["chronological"]:
            raise AssertionError(f"train, val and test overlap or are empty: {row.asDict()}")
        self._store(split.with_split(table, self.spec), "split", partition_by=["split"])
        self._store(split.split_counts(table, self.spec), "split_counts")
        return self.parts()

    def tune(self, **options: object) -> DataFrame:
        """Search; stores the trial log and the best parameters."""
        parts = self.parts()
        trials = self._store(model.search(parts["train"], parts["val"], self.spec, **options), "trials")
        best = model.best_params(trials)
        tables.write_json(best, self.path("best_params"))
        return best

    def best_params(self) -> model.BoostingParams:
        return model.params_of(tables.read_json(self.spark, self.path("best_params"), model.PARAMS_SCHEMA))

    def train_final(self, params: model.BoostingParams | None = None) -> None:
        train_val = split.train_and_validation(self.parts())
        model.save(model.fit_final(train_val, params or self.best_params(), self.spec), self.path("model_final"))

    def train_default(self, **overrides: object) -> None:
        train_val = split.train_and_validation(self.parts())
        model.save(model.fit_default(train_val, self.spec, **overrides), self.path("model_default"))

    def baseline_metrics(self) -> DataFrame:
        predictions = baseline.baseline_predictions(self.part("test"), self.spec)
        columns = [baseline.naive_column(), baseline.rolling_column(self.spec)]
        return metrics.compare_models(predictions, columns, (), self.spec)

    def predict(self) -> DataFrame:
        """Store the prediction table, so that reports need no model."""
        loaded = {
            "pred_model_default": model.load(self.path("model_default")),
            "pred_model": model.load(self.path("model_final")),
        }
        return self._store(model.prediction_table(loaded, self.part("test"), self.spec), "predictions")

    def evaluate(self) -> DataFrame:
        """Store the metrics of all models as CSV, best first."""
        result = metrics.compare_models(self.table("predictions"), self._columns(), (), self.spec)
        tables.write_metrics(result, self.path("evaluation_metrics"))
        return tables.read_metrics(self.spark, self.path("evaluation_metrics"))

    def importance(self) -> DataFrame:
        return model.importance(model.load(self.path("model_final")))

    def report(
        self, name: str, station: str | None = None, start: str | None = None, end: str | None = None
    ) -> DataFrame:
        """A named report over the stored tables; those of one station take its name and two dates."""
        spec, cleaned = self.spec, self.table("cleaned")
        over_cleaned = {
            "hourly_profile": reports.hourly_profile,
            "hourly_mean": reports.hourly_mean,
            "weekday_hour_pivot": reports.weekday_hour_pivot,
            "weekday_ratio": reports.weekday_ratio,
            "borough_totals": reports.borough_totals,
            "summary": reports.summary,
            "daily_totals": split.daily_totals,
            "station_list": reports.station_list,
            "date_bounds": reports.date_bounds,
        }
        by_key = {
            "top_stations": lambda: reports.top_stations(cleaned, spec=spec),
            "volatility": lambda: reports.volatility(cleaned, spec=spec),
            "peak_hours": lambda: reports.peak_hours(cleaned, spec=spec),
            "map_table": lambda: reports.map_table(self.table("station_locations"), cleaned, spec),
            "importance": self.importance,
            "actual_vs_predicted": lambda: reports.actual_vs_predicted(self.table("predictions"), self._columns(), spec),
        }
        of_station = {
            "station_slice": lambda: reports.station_slice(cleaned, station, start, end, spec),
            "slice_metrics": lambda: reports.slice_metrics(
                self.table("predictions"), station, start, end, self._columns(), spec
            ),
            "station_hourly": lambda: reports.hourly_mean(cleaned.where(F.col(spec.name) == station), spec),
        }
        if name in over_cleaned:
            return over_cleaned[name](cleaned, spec)
        if name in by_key:
            return by_key[name]()
        if name in of_station:
            if station is None or name != "station_hourly" and (start is None or end is None):
                raise ValueError(f"report {name} needs a station, and dates unless it is station_hourly")
            return of_station[name]()
        raise KeyError(f"unknown report {name!r}; choose from {sorted([*over_cleaned, *by_key, *of_station])}")

    def _columns(self) -> list[str]:
        return [*MODEL_PREDICTIONS, baseline.naive_column(), baseline.rolling_column(self.spec)]
