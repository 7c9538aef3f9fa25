import json

import pytest
from pyspark.sql import functions as F

from conftest import values
from hourgrid.operators import features, metrics, model, split
from hourgrid.sources import tables
from hourgrid.spec import DemandSpec
from hourgrid.staging import stage

SPEC = DemandSpec(
    lags=(1, 24), windows=(3,), train_end="2024-01-08 00:00:00", validation_end="2024-01-10 00:00:00"
)
TINY = model.BoostingParams(num_leaves=8, n_estimators=4, min_data_in_leaf=5, learning_rate=0.3)


@pytest.fixture(scope="module")
def parts(spark):
    hours = spark.range(12 * 24).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR") * F.col("id")).alias("transit_timestamp")
    )
    stations = spark.createDataFrame(
        [(str(i), f"name {i}", "b" + str(i % 2), "subway", i) for i in range(4)],
        "station_complex_id string, station_complex string, borough string, transit_mode string, i int",
    )
    hour = F.hour("transit_timestamp")
    cleaned = hours.join(stations).select(
        "station_complex_id", "station_complex", "borough", "transit_mode", "transit_timestamp",
        (F.col("i") * 10 + F.abs(hour - 12) * 8 + F.xxhash64("i", "transit_timestamp") % 3).alias("entries"),
        F.lit(0).alias("transfers"),
    )
    return split.by_time(stage(features.build_features(cleaned, SPEC), "features"), SPEC)


@pytest.fixture(scope="module")
def fitted(parts):
    return model.fit_final(split.train_and_validation(parts), TINY, SPEC)


def test_prediction_table_has_one_row_per_test_row(fitted, parts):
    table = model.prediction_table({"pred_model": fitted}, parts["test"], SPEC)
    assert table.columns == [*SPEC.keys, "entries", "pred_model", "pred_naive", "pred_rolling_avg_3h"]
    assert table.count() == parts["test"].count() == table.select(*SPEC.keys).distinct().count()
    assert table.filter("pred_model IS NULL").count() == 0


def test_trees_learn_the_daily_shape(fitted, parts):
    table = model.prediction_table({"pred_model": fitted}, parts["test"], SPEC)
    errors = dict(values(metrics.compare_models(table, ["pred_model", "pred_rolling_avg_3h"]), "model", "mae"))
    assert errors["model"] < errors["rolling_avg_3h"]
    row = metrics.evaluate(table, "pred_model").first()
    manual = [abs(y - p) for y, p in values(table, "entries", "pred_model")]
    assert row["mae"] == pytest.approx(sum(manual) / len(manual))


def test_the_same_seed_gives_the_same_trees(fitted, parts):
    again = model.fit_final(split.train_and_validation(parts), TINY, SPEC)
    both = model.score(again, model.score(fitted, parts["test"], "a", SPEC), "b", SPEC)
    assert both.filter("a <> b").count() == 0


def test_model_store(tmp_path, fitted, parts):
    model.save(fitted, str(tmp_path / "m"))
    both = model.score(model.load(str(tmp_path / "m")), model.score(fitted, parts["test"], "a", SPEC), "b", SPEC)
    assert both.filter("a <> b").count() == 0


def test_importance_covers_all_features(fitted):
    rows = model.importance(fitted).collect()
    assert sorted(r["feature"] for r in rows) == sorted(SPEC.feature_columns)
    assert sum(r["importance"] for r in rows) == pytest.approx(sum(n[9] for n in fitted.nodes))
    assert [r["importance"] for r in rows] == sorted(r["importance"] for r in rows)


def test_unknown_categories_are_scored(fitted, parts):
    moved = parts["test"].withColumn("station_complex", F.lit("never seen"))
    assert model.score(fitted, moved, spec=SPEC).filter("pred_model IS NULL").count() == 0


def test_target_means(spark):
    rows = [("a", "x", "m", 10), ("a", "x", "m", 20), ("b", "x", None, 40), (None, "y", "m", 0)]
    frame = spark.createDataFrame(rows, "station_complex string, borough string, transit_mode string, entries bigint")
    got = {(r.feature, r.value): r["mean"] for r in model.target_means(frame, 17.5, SPEC, smoothing=2).collect()}
    assert got[("station_complex", "a")] == (30 + 35) / 4 and got[("station_complex", None)] == 35 / 3
    assert got[("borough", "x")] == (70 + 35) / 5 and got[("transit_mode", None)] == (40 + 35) / 3
    encoder = model.fit_encoder(frame, SPEC, smoothing=2)
    new = spark.createDataFrame([("zzz", None, "m")], "station_complex string, borough string, transit_mode string")
    assert encoder.prior == 17.5 and encoder.columns(new, SPEC).first().station_complex_mean == 17.5


def test_many_stations_take_the_same_encoding(spark):
    rows = spark.range(5000).select(
        F.concat(F.lit("s"), F.col("id") % 2000).alias("station_complex"), F.lit("b").alias("borough"),
        F.lit("m").alias("transit_mode"), (F.col("id") % 2000).alias("entries"),
    )
    encoder = model.fit_encoder(rows, SPEC)
    assert encoder.means.count() == 2002
    assert encoder.columns(rows, SPEC).select("station_complex_mean").distinct().count() > 1900


def test_patience():
    assert model.best_iteration([5, 4, 3, 3.5, 3.4, 2], patience=50) == 6
    assert model.best_iteration([5, 4, 3, 3.5, 3.4, 2], patience=2) == 3
    assert model.best_iteration([1.0]) == 1


def test_search_ranges_and_seed():
    draws = model.sample_params(18, seed=7)
    assert draws == model.sample_params(18, seed=7) != model.sample_params(18, seed=8)
    for params in draws:
        for name, (low, high) in model.SEARCH_RANGES.items():
            assert low <= getattr(params, name) <= high


def test_search_logs_trials_and_best_parameters_survive_a_file(spark, tmp_path, parts):
    ranges = {"n_estimators": (2, 3), "max_depth": (2, 2), "learning_rate": (0.1, 0.3)}
    trials = model.search(parts["train"], parts["val"], SPEC, n_trials=5, ranges=ranges, startup=2, draws=2)
    rows = trials.orderBy("trial").collect()
    assert [r["trial"] for r in rows] == [0, 1, 2, 3, 4] and all(1 <= r["best_iteration"] <= r["n_estimators"] for r in rows)
    best = model.best_params(trials)
    winner = min(rows, key=lambda r: r["val_mae"])
    assert best.first()["n_estimators"] == winner["best_iteration"]
    tables.write_json(best, str(tmp_path / "p"))
    assert model.params_of(tables.read_json(spark, str(tmp_path / "p"), model.PARAMS_SCHEMA)) == model.params_of(best)


def test_an_indented_parameter_file_is_read(spark, tmp_path):
    stored = {"num_leaves": 12, "max_depth": 7, "learning_rate": 0.25, "n_estimators": 33, "min_data_in_leaf": 5,
              "feature_fraction": 0.75, "bagging_fraction": 0.5}
    (tmp_path / "best.json").write_text(json.dumps(stored, indent=2))
    params = model.params_of(tables.read_json(spark, str(tmp_path / "best.json"), model.PARAMS_SCHEMA))
    assert params == model.BoostingParams(**stored)


def test_stored_predictions_join_back(fitted, parts):
    table = model.prediction_table({"pred_model": fitted}, parts["test"], SPEC)
    joined = model.attach_predictions(parts["test"], table, SPEC)
    assert joined.count() == parts["test"].count() and "pred_model" in joined.columns


def test_target_means_as_encoding(parts):
    train = split.train_and_validation(parts)
    fitted = model.fit(train, TINY, SPEC, encoding="means")
    assert "station_complex_mean" in fitted.columns and not any(n[5] for n in fitted.nodes)
    assert model.score(fitted, parts["test"], spec=SPEC).filter("pred_model IS NULL").count() == 0
    with pytest.raises(ValueError, match="encoding"):
        model.fit(train, TINY, SPEC, encoding="other")


def test_a_model_with_an_encoder_is_stored(tmp_path, parts):
    fitted = model.fit(parts["train"], TINY, SPEC, encoding="means")
    model.save(fitted, str(tmp_path / "m"))
    both = model.score(model.load(str(tmp_path / "m")), model.score(fitted, parts["test"], "a", SPEC), "b", SPEC)
    assert both.filter("a <> b").count() == 0


def test_best_iterations_over_a_table(spark):
    curves = {"a": [5, 4, 3, 3.5, 3.4, 2], "b": [1.0], "c": [2, 2, 1, 1, 1, 0], "d": [3, 4, 4, 4, 2]}
    rows = [(k, i, float(e)) for k, c in curves.items() for i, e in enumerate(c)]
    table = spark.createDataFrame(rows, "k string, i int, e double")
    for patience in (1, 2, 3, 50):
        got = dict(values(model.best_iterations(table, "k", "i", "e", patience), "k", "best_iteration"))
        assert got == {k: model.best_iteration(c, patience) for k, c in curves.items()}


def test_many_trees_are_scored_outside_whole_stage_code(spark, parts):
    fitted = model.fit(parts["train"], model.BoostingParams(num_leaves=31, n_estimators=60, min_data_in_leaf=2), SPEC)
    assert fitted.n_trees == 60 and len(fitted.nodes) > 60 * 20
    assert model.score(fitted, parts["test"], spec=SPEC).filter("pred_model IS NULL").count() == 0
