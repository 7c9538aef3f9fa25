"""Named queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.timegrid import parse_timestamp
from hourgrid.operators import baseline, clean, features, metrics, model, onepass, profile, reports, sampler, sketches, split
from hourgrid.plans.monthly import MonthlyStore
from hourgrid.plans.pipeline import Prepared
from hourgrid.sources import raw as raw_source
from hourgrid.sources import tables
from hourgrid.sources.raw import WRITTEN_TIMESTAMP_FORMAT, compact_raw, read_raw, write_raw_csv
from hourgrid.sources.views import DAILY, HOURLY, daily_units, hourly_taps, order_values, supplier_units
from hourgrid.staging import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]

BASELINES = [baseline.naive_column(), baseline.rolling_column(HOURLY)]
# Trees that SQL can follow: one split, a tree of eight leaves, three trees of four.
STUMP = model.BoostingParams(num_leaves=2, learning_rate=1.0, n_estimators=1, min_data_in_leaf=1)
ONE_TREE = model.BoostingParams(num_leaves=8, learning_rate=1.0, n_estimators=1, min_data_in_leaf=20)
FEW_TREES = model.BoostingParams(num_leaves=4, learning_rate=0.3, n_estimators=3, min_data_in_leaf=20)
FEW_COLUMNS = ["hour_of_day", "day_of_week", "month", "station_complex"]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _prepared(spark: SparkSession, folder: str) -> Prepared:
    """One scan of the events; everything after reads the reduced table."""
    return Prepared.of(stage(clean.rollup(hourly_taps(spark, folder), HOURLY), "rollup"), HOURLY)


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared(spark, folder).cleaned()


def _features_of(prepared: Prepared, start: str | None = None, end: str | None = None) -> DataFrame:
    """Sums to features in one shuffle."""
    return onepass.features_of_sums(prepared.sums, prepared.bounds, prepared.spec, start, end)


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return _features_of(_prepared(spark, folder))


def _test_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Baseline predictions of the test range. Only this range and its look-back are filled."""
    test = _features_of(_prepared(spark, folder), start=HOURLY.validation_end)
    return baseline.baseline_predictions(test, HOURLY)


# Profiling and cleaning


def profile_raw(spark: SparkSession, folder: str) -> DataFrame:
    return profile.profile_raw(hourly_taps(spark, folder), HOURLY)


def parsed_times(spark: SparkSession, folder: str) -> DataFrame:
    """Event times as text in the raw format and back; damaged text becomes null."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    written = F.date_format("ts", WRITTEN_TIMESTAMP_FORMAT)
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), written)).otherwise(written)
    return events.select("event_id", parse_timestamp(text).alias("parsed"))


def profile_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return profile.profile_rollup(clean.rollup(hourly_taps(spark, folder), HOURLY), HOURLY)


def exclude_rows(spark: SparkSession, folder: str) -> DataFrame:
    return clean.exclude_rows(hourly_taps(spark, folder), HOURLY.exclude).drop("latitude", "longitude")


def station_hour(spark: SparkSession, folder: str) -> DataFrame:
    return clean.to_station_step(clean.exclude_rows(hourly_taps(spark, folder), HOURLY.exclude), HOURLY)


def station_locations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clean.station_locations(hourly_taps(spark, folder), HOURLY), "latitude", "longitude")


def location_points(spark: SparkSession, folder: str) -> DataFrame:
    return reports.location_points(clean.station_locations(hourly_taps(spark, folder), HOURLY))


def reindexed(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared(spark, folder).grid()


def off_grid_rows(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared(spark, folder)
    return clean.off_grid_rows(prepared.sums, prepared.bounds, HOURLY)


def ambiguous_series(spark: SparkSession, folder: str) -> DataFrame:
    """Before the bad rows are dropped, so the mislabelled id shows."""
    return clean.ambiguous_series(hourly_taps(spark, folder), HOURLY)


def quality_counts(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared(spark, folder)
    return clean.quality_counts(clean.grid_with_caps(prepared.sums, prepared.bounds, HOURLY), HOURLY)


def stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared(spark, folder)
    cleaned = stage(prepared.cleaned(), "cleaned")
    return profile.stage_counts(
        {
            "station_hour": prepared.sums,
            "cleaned": cleaned,
            "features": features.build_features(cleaned, HOURLY),
        },
        HOURLY,
    )


def lineage(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared(spark, folder)
    return profile.lineage(prepared.rolled, prepared.sums, prepared.grid(), HOURLY)


def iqr_caps(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared(spark, folder).caps()


def iqr_caps_of_grid(spark: SparkSession, folder: str) -> DataFrame:
    grid = clean.clip_negative(_prepared(spark, folder).grid(), HOURLY)
    return clean.iqr_caps(grid, HOURLY)


def cap_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """The cap as a join with stored caps."""
    prepared = _prepared(spark, folder)
    return clean.cap_outliers(clean.clip_negative(prepared.grid(), HOURLY), prepared.caps(), HOURLY)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder)


def table_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.table_summary(_cleaned(spark, folder), HOURLY)


def raw_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows as text in the source's format, scanned, compacted to Parquet and summed."""
    text = scratch_path(spark, "csv")
    write_raw_csv(hourly_taps(spark, folder), text)
    compact = compact_raw(read_raw(spark, text), scratch_path(spark, "compact"), HOURLY)
    return clean.to_station_step(compact, HOURLY)


def raw_losses(spark: SparkSession, folder: str) -> DataFrame:
    """Raw text with measures such as 12.0 and 1,234, unreadable and missing ones: what was lost is counted."""
    rows = hourly_taps(spark, folder)
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "value")
    value = F.round("value").cast("bigint")
    text = (
        F.when(F.col("event_id") % 13 == 1, "n/a")
        .when(F.col("event_id") % 17 == 2, F.lit(None))
        .when(F.col("event_id") % 10 == 3, F.concat(value.cast("string"), F.lit(".0")))
        .when(F.col("event_id") % 10 == 4, F.format_number(value * 1000, 0))
        .otherwise(value.cast("string"))
    )
    numbered = events.select("event_id", text.alias("ridership"), F.lit("1").alias("transfers"))
    times = spark.read.parquet(f"{folder}/events.parquet").select("event_id", F.col("ts").alias("transit_timestamp"))
    damaged = numbered.join(times, "event_id").withColumns(
        {c: F.lit("x") for c in ("transit_mode", "station_complex_id", "station_complex", "borough")}
    )
    path = scratch_path(spark, "damaged")
    write_raw_csv(damaged, path)
    read = read_raw(spark, path).agg(F.sum("ridership").alias("total_read"))
    return raw_source.raw_losses(spark, path).withColumn("total_read", read.scalar())


# Features and split


def lags(spark: SparkSession, folder: str) -> DataFrame:
    return features.add_lags(_cleaned(spark, folder), HOURLY)


def rolling(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.add_rolling(_cleaned(spark, folder), HOURLY), *HOURLY.rolling_columns)


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_features(spark, folder), *HOURLY.rolling_columns)


def features_by_row(spark: SparkSession, folder: str) -> DataFrame:
    """History counted in rows of the summed table, which has gaps."""
    sums = _prepared(spark, folder).sums
    return rounded(features.build_features(sums, HOURLY, gap_free=False), *HOURLY.rolling_columns)


def features_range(spark: SparkSession, folder: str) -> DataFrame:
    """Features of the validation range only, from this range and its look-back."""
    part = _features_of(_prepared(spark, folder), HOURLY.train_end, HOURLY.validation_end)
    return rounded(part, *HOURLY.rolling_columns)


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_counts(stage(_features(spark, folder), "features"), HOURLY)


def split_check(spark: SparkSession, folder: str) -> DataFrame:
    return split.table_check(_features(spark, folder), HOURLY)


def split_check_of_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The same check over parts as they are stored."""
    return split.leak_check(split.by_time(stage(_features(spark, folder), "features"), HOURLY), HOURLY)


def proportional_cuts(spark: SparkSession, folder: str) -> DataFrame:
    return split.proportional_cuts(_features(spark, folder), spec=HOURLY)


def daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    return split.daily_totals(_cleaned(spark, folder), HOURLY)


def train_val_union(spark: SparkSession, folder: str) -> DataFrame:
    parts = split.by_time(stage(_features(spark, folder), "features"), HOURLY)
    return rounded(split.train_and_validation(parts), *HOURLY.rolling_columns)


# Baselines and errors


def baseline_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_test_predictions(spark, folder), BASELINES[1])


def attach_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Stored predictions joined back to the feature rows of the test range."""
    test = stage(features.build_features(_cleaned(spark, folder), HOURLY, start=HOURLY.validation_end), "test")
    predictions = stage(baseline.baseline_predictions(test, HOURLY), "predictions")
    return rounded(model.attach_predictions(test, predictions, HOURLY), *HOURLY.rolling_columns, BASELINES[1])


def evaluate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.evaluate(_test_predictions(spark, folder), BASELINES[0], HOURLY), "mae", "rmse")


def baseline_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.compare_models(_test_predictions(spark, folder), BASELINES, (), HOURLY), "mae", "rmse")


def baseline_by_station(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.by_station(_test_predictions(spark, folder), BASELINES, HOURLY), "mae", "rmse")


def improvement(spark: SparkSession, folder: str) -> DataFrame:
    table = metrics.compare_models(_test_predictions(spark, folder), BASELINES, (), HOURLY)
    return rounded(metrics.improvement(table, "rolling_avg_24h", "naive"), "improvement_pct")


def slice_metrics(spark: SparkSession, folder: str) -> DataFrame:
    predictions = _test_predictions(spark, folder)
    return rounded(
        reports.slice_metrics(predictions, "S0", "2024-01-29", "2024-01-30", BASELINES, HOURLY), "mae", "rmse"
    )


# Reports


def hourly_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.hourly_profile(_cleaned(spark, folder), HOURLY), "avg_entries")


def hourly_mean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.hourly_mean(_cleaned(spark, folder), HOURLY), "avg_entries")


def weekday_hour_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        reports.weekday_hour_pivot(_cleaned(spark, folder), HOURLY), *(f"h{h:02d}" for h in range(24))
    )


def weekday_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        reports.weekday_ratio(_cleaned(spark, folder), HOURLY), "weekday_mean", "weekend_mean", "ratio"
    )


def top_stations(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_stations(_cleaned(spark, folder), spec=HOURLY)


def top_stations_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_stations(_cleaned(spark, folder), 8, HOURLY.series_id, HOURLY)


def borough_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.borough_totals(_cleaned(spark, folder), HOURLY)


def busiest_station(spark: SparkSession, folder: str) -> DataFrame:
    return reports.busiest_station(_cleaned(spark, folder), spec=HOURLY)


def station_list(spark: SparkSession, folder: str) -> DataFrame:
    return reports.station_list(_cleaned(spark, folder), HOURLY)


def volatility(spark: SparkSession, folder: str) -> DataFrame:
    table = reports.volatility(_cleaned(spark, folder), spec=HOURLY)
    return rounded(table, "avg_entries", "std_entries", "cv")


def volatile_stations(spark: SparkSession, folder: str) -> DataFrame:
    table = reports.volatile_stations(_cleaned(spark, folder), 1.3, spec=HOURLY)
    return rounded(table, "avg_entries", "std_entries", "cv")


def summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.summary(stage(_cleaned(spark, folder), "cleaned"), HOURLY, unit=1e3)


def station_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.station_hourly(_cleaned(spark, folder), spec=HOURLY), "avg_entries")


def peak_hours(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.peak_hours(_cleaned(spark, folder), spec=HOURLY), "peak_avg_entries")


def map_table(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared(spark, folder)
    return rounded(
        reports.map_table(prepared.locations(), prepared.cleaned(), HOURLY), "latitude", "longitude"
    )


def date_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return reports.date_bounds(_test_predictions(spark, folder), HOURLY)


def station_slice(spark: SparkSession, folder: str) -> DataFrame:
    return reports.station_slice(_cleaned(spark, folder), "S0", "2024-01-10", "2024-01-20", HOURLY)


def crowding_alerts(spark: SparkSession, folder: str) -> DataFrame:
    table = stage(_cleaned(spark, folder), "cleaned")
    test = features.build_features(table, HOURLY, start=HOURLY.validation_end)
    predictions = baseline.baseline_predictions(test, HOURLY)
    alerts = reports.crowding_alerts(predictions, table, baseline.naive_column(), 0.30, HOURLY)
    return rounded(alerts, "usual_entries", "above_usual")


def baseline_series(spark: SparkSession, folder: str) -> DataFrame:
    predictions = stage(_test_predictions(spark, folder), "predictions")
    return rounded(reports.actual_vs_predicted(predictions, BASELINES, HOURLY), "value")


# Boosted trees


def _parts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return split.by_time(stage(_features(spark, folder), "features"), HOURLY)


#: Results that several queries read, by application and folder.
_shared: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, folder: str, name: str, make: Callable[[], object]):
    """What `make` gives, computed by the first query that asks for it."""
    key = spark.sparkContext.applicationId, folder, name
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def _trials(spark: SparkSession, folder: str) -> DataFrame:
    def run() -> DataFrame:
        parts = _parts(spark, folder)
        return stage(model.search(parts["train"], parts["val"], HOURLY), "trials")

    return _once(spark, folder, "trials", run)


def _models(spark: SparkSession, folder: str) -> dict[str, model.DemandModel]:
    """The default model and the best of the whole search, both on train and validation."""

    def run() -> dict[str, model.DemandModel]:
        best = model.params_of(model.best_params(_trials(spark, folder)))
        rows = split.train_and_validation(_parts(spark, folder))
        fitted = model.fit_many(rows, [model.BoostingParams(), best], HOURLY, bagging=False)
        return dict(zip(("pred_model_default", model.PREDICTION), fitted, strict=True))

    return _once(spark, folder, "models", run)


def gbt_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Default model and the best of the search against both baselines."""
    fitted = _models(spark, folder)
    predictions = stage(model.prediction_table(fitted, _parts(spark, folder)["test"], HOURLY), "predictions")
    return metrics.compare_models(predictions, [*fitted, *BASELINES], (), HOURLY)


def gbt_trials(spark: SparkSession, folder: str) -> DataFrame:
    return _trials(spark, folder)


def gbt_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of the tuned model and of the baselines on the test range."""
    fitted = {model.PREDICTION: _models(spark, folder)[model.PREDICTION]}
    return model.prediction_table(fitted, _parts(spark, folder)["test"], HOURLY)


def gbt_default_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Fit and predictions of the default model."""
    parts = _parts(spark, folder)
    fitted = model.fit_default(split.train_and_validation(parts), HOURLY)
    return model.prediction_table({model.PREDICTION: fitted}, parts["test"], HOURLY)


def gbt_importance(spark: SparkSession, folder: str) -> DataFrame:
    return model.importance(_models(spark, folder)[model.PREDICTION])


def actual_vs_predicted(spark: SparkSession, folder: str) -> DataFrame:
    predictions = stage(gbt_predictions(spark, folder), "predictions")
    return reports.actual_vs_predicted(predictions, [model.PREDICTION, *BASELINES], HOURLY)


def _few(spark: SparkSession, folder: str, params: model.BoostingParams, columns: list[str]) -> tuple[DataFrame, model.DemandModel]:
    rows = stage(split.train_and_validation(_parts(spark, folder)), "fit")
    return rows, model.fit(rows, params, HOURLY, columns=columns)


def _scored(rows: DataFrame, fitted: model.DemandModel, columns: list[str]) -> DataFrame:
    return rounded(model.score(fitted, rows, spec=HOURLY).select(*columns, model.PREDICTION).distinct(), model.PREDICTION)


def gbt_leafwise(spark: SparkSession, folder: str) -> DataFrame:
    """One tree of eight leaves, split best first, over numbers and sets of stations."""
    return _scored(*_few(spark, folder, ONE_TREE, FEW_COLUMNS), FEW_COLUMNS)


def gbt_boosted(spark: SparkSession, folder: str) -> DataFrame:
    """Three trees of four leaves, each on what the ones before it left."""
    return _scored(*_few(spark, folder, FEW_TREES, FEW_COLUMNS), FEW_COLUMNS)


def gbt_category_set(spark: SparkSession, folder: str) -> DataFrame:
    """One split over stations alone: the two sets of least squared error."""
    return _scored(*_few(spark, folder, STUMP, ["station_complex"]), ["station_complex"])


def gbt_gain(spark: SparkSession, folder: str) -> DataFrame:
    """Total gain of each feature in the three trees."""
    return rounded(model.importance(_few(spark, folder, FEW_TREES, FEW_COLUMNS)[1]), "importance", digits=0)


def gbt_tree_table(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves of the tree of eight as rows of the stored table: training rows and value."""
    nodes = _few(spark, folder, ONE_TREE, FEW_COLUMNS)[1].table()
    return rounded(nodes.where("feature is null").select("n_rows", "value"), "value", digits=4)


def gbt_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Target means of the training rows, on the rows of the test range."""
    parts = _parts(spark, folder)
    encoder = model.fit_encoder(split.train_and_validation(parts), HOURLY)
    means = [f"{c}_mean" for c in HOURLY.categorical]
    return rounded(encoder.columns(parts["test"], HOURLY).select(*HOURLY.keys, *means), *means)


def gbt_encoding_of_many(spark: SparkSession, folder: str) -> DataFrame:
    """The same encoding of a column with as many values as there are customers."""
    rows = order_values(spark, folder)
    prior = rows.agg(F.avg("entries")).first()[0]
    return rounded(model.target_means(rows, prior, HOURLY), "mean", digits=4)


def _stump(parts: dict[str, DataFrame]) -> model.DemandModel:
    return model.fit_final(split.train_and_validation(parts), STUMP, HOURLY)


def gbt_stump(spark: SparkSession, folder: str) -> DataFrame:
    """One tree of one split over calendar columns: the two means that the best split by squared error gives."""
    names = HOURLY.calendar_columns
    return _scored(*_few(spark, folder, STUMP, names), names)


def gbt_prediction_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Keys, actual value and baselines of a prediction table with a model in it, and whether its value is there."""
    parts = _parts(spark, folder)
    table = model.prediction_table({model.PREDICTION: _stump(parts)}, parts["test"], HOURLY)
    return rounded(table.withColumn("predicted", F.col(model.PREDICTION).isNotNull()).drop(model.PREDICTION), BASELINES[1])


def _made_up_log(spark: SparkSession, folder: str) -> DataFrame:
    """A trial log made from order lines."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return lines.groupBy((F.col("l_partkey") % 50).cast("int").alias("trial")).agg(
        F.max("l_linenumber").cast("int").alias("num_leaves"),
        F.min("l_linenumber").cast("int").alias("max_depth"),
        F.max("l_discount").cast("double").alias("learning_rate"),
        F.count(F.lit(1)).cast("int").alias("n_estimators"),
        F.max("l_quantity").cast("int").alias("min_data_in_leaf"),
        F.max("l_tax").cast("double").alias("feature_fraction"),
        F.min("l_tax").cast("double").alias("bagging_fraction"),
        (F.count(F.lit(1)) % 97).cast("int").alias("best_iteration"),
        F.round(F.avg("l_quantity"), 3).alias("val_mae"),
        F.round(F.max("l_quantity"), 3).cast("double").alias("val_rmse"),
    )


def gbt_best_trial(spark: SparkSession, folder: str) -> DataFrame:
    """The winner of a trial log."""
    return model.best_params(_made_up_log(spark, folder))


def gbt_next_draws(spark: SparkSession, folder: str) -> DataFrame:
    """The three next parameter sets after a log of 50 trials whose parameters are sums over order lines."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    log = lines.groupBy((F.col("l_partkey") % 50).cast("int").alias("trial")).agg(
        (F.sum("l_linenumber") % 241 + 15).cast("int").alias("num_leaves"),
        (F.exp(F.lit(-4.6) + (F.sum("l_suppkey") % 34) / 10)).alias("learning_rate"),
        (F.lit(0.5) + (F.sum("l_orderkey") % 51) / 100).alias("feature_fraction"),
        F.round(F.avg("l_quantity"), 3).cast("double").alias("val_mae"),
    )
    ranges = {p: model.SEARCH_RANGES[p] for p in ("num_leaves", "learning_rate", "feature_fraction")}
    found = sampler.suggest(log, ranges, model.LOG_UNIFORM, model.WHOLE, draws=3)
    return rounded(found, "learning_rate", "feature_fraction")


def gbt_early_stop(spark: SparkSession, folder: str) -> DataFrame:
    """Where patience ends a validation curve, for the monthly totals of every order status as curves."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    curve = orders.groupBy("o_orderstatus", F.date_trunc("month", "o_orderdate").alias("m")).agg(
        F.round(F.avg("o_totalprice"), 2).alias("e")
    )
    return model.best_iterations(curve, "o_orderstatus", "m", "e", patience=10)


# Stored tables


def stored_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features written in folders per part and read back, test part and two columns only."""
    path = scratch_path(spark, "features")
    tables.write_table(split.with_split(_features(spark, folder), HOURLY), path, ["split"], [HOURLY.series_id, HOURLY.ts])
    return tables.read_table(spark, path, [*HOURLY.keys, "entries", "split"]).where("split = 'test'").drop("split")


def stored_metrics(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    tables.write_metrics(baseline_metrics(spark, folder), path)
    return tables.read_metrics(spark, path)


def stored_params(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "params")
    tables.write_json(gbt_best_trial(spark, folder), path)
    return tables.read_json(spark, path, model.PARAMS_SCHEMA)


def stored_model(spark: SparkSession, folder: str) -> DataFrame:
    """A model saved and loaded scores every row as before: rows, and rows whose score differs."""
    parts, path = _parts(spark, folder), scratch_path(spark, "model")
    fitted = _stump(parts)
    model.save(fitted, path)
    both = model.score(model.load(path), model.score(fitted, parts["test"], "a", HOURLY), "b", HOURLY)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_changed"))


# Daily units per nation or supplier: the same operators on another key, step and set of lags


def _daily(spark: SparkSession, folder: str) -> Prepared:
    return Prepared.of(stage(clean.rollup(daily_units(spark, folder), DAILY), "daily"), DAILY)


def _sparse(spark: SparkSession, folder: str) -> Prepared:
    return Prepared.of(stage(clean.rollup(supplier_units(spark, folder), DAILY), "suppliers"), DAILY)


def supplier_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse series: most rows of the grid are filled."""
    prepared = _sparse(spark, folder)
    return profile.lineage(prepared.rolled, prepared.sums, prepared.grid(), DAILY)


def supplier_grid_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Days, days without sales and units per supplier of the completed grid."""
    return _sparse(spark, folder).grid().groupBy(DAILY.series_id).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(F.col("entries") == 0).alias("n_empty"),
        F.sum("entries").alias("total_entries"),
    )


def supplier_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of sparse series, summed per supplier."""
    return rounded(
        _features_of(_sparse(spark, folder)).groupBy(DAILY.series_id).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("entries").alias("total_entries"),
            F.sum("lag_28d").alias("total_lag"),
            F.sum("rolling_mean_7d").alias("total_mean"),
        ),
        "total_mean",
        digits=3,
    )


def daily_station_day(spark: SparkSession, folder: str) -> DataFrame:
    return clean.to_station_step(daily_units(spark, folder), DAILY)


def daily_caps(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder).caps()


def daily_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder).cleaned()


def _daily_capped(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder).cleaned()


def daily_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_features_of(_daily(spark, folder)), *DAILY.rolling_columns)


def daily_baseline_metrics(spark: SparkSession, folder: str) -> DataFrame:
    test = _features_of(_daily(spark, folder), start=DAILY.validation_end)
    columns = [baseline.naive_column(), baseline.rolling_column(DAILY)]
    predictions = baseline.baseline_predictions(test, DAILY)
    return rounded(metrics.compare_models(predictions, columns, (), DAILY), "mae", "rmse")


def daily_baseline_by_station(spark: SparkSession, folder: str) -> DataFrame:
    test = _features_of(_daily(spark, folder), start=DAILY.validation_end)
    columns = [baseline.naive_column(), baseline.rolling_column(DAILY)]
    predictions = baseline.baseline_predictions(test, DAILY)
    return rounded(metrics.compare_models(predictions, columns, [DAILY.series_id], DAILY), "mae", "rmse")


def daily_quality_counts(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _daily(spark, folder)
    return clean.quality_counts(clean.grid_with_caps(prepared.sums, prepared.bounds, DAILY), DAILY)


def daily_lineage(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _daily(spark, folder)
    return profile.lineage(prepared.rolled, prepared.sums, prepared.grid(), DAILY)


def daily_top_stations(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_stations(_daily_capped(spark, folder), key=DAILY.series_id, spec=DAILY)


def daily_borough_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.borough_totals(_daily_capped(spark, folder), DAILY)


def daily_network_totals(spark: SparkSession, folder: str) -> DataFrame:
    return split.daily_totals(_daily_capped(spark, folder), DAILY)


def daily_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_counts(stage(_features_of(_daily(spark, folder)), "features"), DAILY)


def daily_volatility(spark: SparkSession, folder: str) -> DataFrame:
    table = reports.volatility(_daily_capped(spark, folder), DAILY.series_id, DAILY)
    return rounded(table, "avg_entries", "std_entries", "cv")


# Stored by month, taken in batches


#: Order lines shipped before this day are the first batch.
BATCH_CUT = "2000-05-17 00:00:00"


def _monthly(spark: SparkSession, folder: str) -> MonthlyStore:
    """Daily units in two batches."""

    def build() -> MonthlyStore:
        store = MonthlyStore(spark, scratch_path(spark, "monthly"), DAILY)
        lines = daily_units(spark, folder)
        early = F.col(DAILY.ts) < F.lit(BATCH_CUT).cast("timestamp_ntz")
        store.update(lines.filter(early), "first")
        store.update(lines.filter(~early), "second")
        return store

    return _once(spark, folder, "monthly", build)


def monthly_updated(spark: SparkSession, folder: str) -> DataFrame:
    """Features after an update: those of all rows."""
    return rounded(_monthly(spark, folder).features(), *DAILY.rolling_columns)


def monthly_caps(spark: SparkSession, folder: str) -> DataFrame:
    """Caps from the counts that are stored by month."""
    return _monthly(spark, folder).caps()


def monthly_range(spark: SparkSession, folder: str) -> DataFrame:
    """Stored features of the validation range: only its months are read."""
    return rounded(_monthly(spark, folder).features(DAILY.train_end, DAILY.validation_end), *DAILY.rolling_columns)


def monthly_computed_range(spark: SparkSession, folder: str) -> DataFrame:
    """Features of the validation range from the sums of its months and its look-back."""
    part = _monthly(spark, folder).compute_features(DAILY.train_end, DAILY.validation_end)
    return rounded(part, *DAILY.rolling_columns)


# Caps from sketches


def _caps_checked(prepared: Prepared) -> DataFrame:
    """Exact quartiles, and whether those of merged monthly sketches are within the stated error of rank."""
    stored = stage(sketches.value_sketches(prepared.sums, prepared.bounds, prepared.spec), "sketches")
    counts = clean.value_counts(prepared.sums, prepared.bounds, prepared.spec)
    errors = sketches.rank_errors(sketches.caps_of_sketches(stored, prepared.bounds, prepared.spec), counts, prepared.bounds, prepared.spec)
    exact = prepared.caps().select(prepared.spec.series_id, "q1", "q3")
    bound = sketches.rank_error_bound()
    within = [(F.col(f"{q}_error") <= bound).alias(f"{q}_within") for q in ("q1", "q3")]
    return exact.join(errors, prepared.spec.series_id).select(*exact.columns, *within)


def sketch_caps(spark: SparkSession, folder: str) -> DataFrame:
    return _caps_checked(_prepared(spark, folder))


def daily_sketch_caps(spark: SparkSession, folder: str) -> DataFrame:
    return _caps_checked(_daily(spark, folder))


# A cut that keeps off holidays


def unusual_days(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(split.day_scores(_cleaned(spark, folder), HOURLY), "deviation")


def daily_unusual_days(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(split.day_scores(_daily_capped(spark, folder), DAILY), "deviation")


def quiet_cut(spark: SparkSession, folder: str) -> DataFrame:
    """The second cut, which lies before an unusual day, moves past it."""
    return split.quiet_cut(_cleaned(spark, folder), HOURLY.validation_end, HOURLY, ahead=2)


def daily_quiet_cut(spark: SparkSession, folder: str) -> DataFrame:
    return split.quiet_cut(_daily_capped(spark, folder), "2000-04-21 00:00:00", DAILY)


QUERIES: dict[str, Query] = {
    **{f.__name__: f for f in (
        profile_raw, parsed_times, profile_rollup, exclude_rows, station_hour, station_locations, location_points, reindexed,
        off_grid_rows, ambiguous_series, quality_counts, stage_counts, lineage, iqr_caps, iqr_caps_of_grid,
        cap_outliers, cleaned,
        table_summary, raw_csv_roundtrip, raw_losses,
        lags, rolling, features_by_row, features_range, split_counts, split_check, split_check_of_parts, proportional_cuts, daily_totals,
        train_val_union,
        baseline_predictions, attach_predictions, evaluate, baseline_metrics, baseline_by_station, improvement, slice_metrics,
        hourly_profile, hourly_mean, weekday_hour_pivot, weekday_ratio, top_stations, top_stations_by_id,
        borough_totals, busiest_station, station_list, volatility, volatile_stations, summary, station_hourly,
        peak_hours, map_table, date_bounds, station_slice, crowding_alerts, baseline_series,
        gbt_metrics, gbt_trials, gbt_importance, gbt_predictions, gbt_default_predictions, actual_vs_predicted,
        gbt_leafwise, gbt_boosted, gbt_category_set, gbt_gain, gbt_tree_table, gbt_next_draws,
        gbt_encoding, gbt_encoding_of_many, gbt_stump, gbt_prediction_rows, gbt_best_trial, gbt_early_stop,
        stored_features, stored_metrics, stored_params, stored_model,
        supplier_lineage, supplier_grid_totals, supplier_features,
        daily_station_day, daily_caps, daily_cleaned, daily_features, daily_baseline_metrics, daily_split_counts,
        daily_volatility, daily_baseline_by_station, daily_quality_counts, daily_lineage, daily_top_stations,
        daily_borough_totals, daily_network_totals,
        monthly_updated, monthly_caps, monthly_range, monthly_computed_range,
        sketch_caps, daily_sketch_caps, unusual_days, daily_unusual_days, quiet_cut, daily_quiet_cut,
    )},
    "features": feature_table,
}
