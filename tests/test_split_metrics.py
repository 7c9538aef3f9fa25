from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import GRID, START, plan_of, values
from hourgrid.operators import baseline, metrics, profile, split
from hourgrid.spec import DemandSpec

SPEC = DemandSpec(train_end="2024-01-02 00:00:00", validation_end="2024-01-02 12:00:00")


def test_half_open_ranges(grid_table):
    table = grid_table(("1", 0, [1] * 48))
    parts = split.by_time(table, SPEC)
    assert {k: v.count() for k, v in parts.items()} == {"train": 24, "val": 12, "test": 12}
    assert parts["val"].agg(F.min(SPEC.ts)).first()[0] == datetime(2024, 1, 2)
    union = split.train_and_validation(parts).unionByName(parts["test"])
    assert sorted(map(str, union.collect())) == sorted(map(str, table.collect()))


def test_labels_agree_with_ranges(grid_table):
    table = grid_table(("1", 0, [1] * 48))
    counts = {r["split"]: (r["n_rows"], r["pct"]) for r in split.split_counts(table, SPEC).collect()}
    assert counts == {"train": (24, 50.0), "val": (12, 25.0), "test": (12, 25.0)}


def test_split_reaches_the_scan(spark, tmp_path, grid_table):
    grid_table(("1", 0, [1] * 48)).write.parquet(str(tmp_path / "f"))
    plan = plan_of(split.by_time(spark.read.parquet(str(tmp_path / "f")), SPEC)["val"])
    assert "GreaterThanOrEqual(transit_timestamp,2024-01-02T00:00)" in plan


def test_order_is_asserted(grid_table):
    parts = split.by_time(grid_table(("1", 0, [1] * 48)), SPEC)
    split.assert_chronological(parts, SPEC)
    with pytest.raises(AssertionError):
        split.assert_chronological({**parts, "train": parts["train"].unionByName(parts["val"])}, SPEC)
    with pytest.raises(AssertionError):
        split.assert_chronological({**parts, "val": parts["val"].limit(0)}, SPEC)


def test_proportional_cuts_of_the_published_range(spark):
    """The published range gives a cut the day after Christmas; moved off the holidays, the second cut follows."""
    ends = [("1", "n", "b", "m", t, 1, 0) for t in (datetime(2022, 5, 22, 9), datetime(2024, 5, 20, 8))]
    df = spark.createDataFrame(ends, GRID)
    row = split.proportional_cuts(df).first()
    assert row["total_steps"] == 17_496
    assert row["train_end"] == datetime(2023, 12, 26, 13)
    assert row["validation_end"] == datetime(2022, 5, 22, 9) + timedelta(hours=15_746)
    moved = split.spec_with_cuts(df, train_end="2024-01-02 00:00:00")
    assert (moved.train_end, moved.validation_end) == ("2024-01-02 00:00:00", "2024-03-15 00:00:00")
    assert split.spec_with_cuts(df).train_end == "2023-12-26 13:00:00"


def test_daily_totals(grid_table):
    table = grid_table(("1", 0, [1] * 30), ("2", 0, [2] * 30))
    assert values(split.daily_totals(table).orderBy("date"), "total_entries", "n_rows") == [(72, 48), (18, 12)]


@pytest.fixture
def predictions(spark):
    rows = [
        ("1", "A", "x", "m", START, 10, 12.0, 10.0),
        ("1", "A", "x", "m", START + timedelta(hours=1), 20, 16.0, 21.0),
        ("2", "B", "x", "m", START, 0, 0.0, 3.0),
        ("2", "B", "x", "m", START + timedelta(hours=1), 4, 10.0, 4.0),
    ]
    return spark.createDataFrame(rows, GRID.replace(", transfers bigint", "") + ", pred_naive double, pred_model double")


def test_errors(predictions):
    row = metrics.evaluate(predictions, "pred_naive").first()
    assert row["mae"] == 3.0 and row["rmse"] == pytest.approx((56 / 4) ** 0.5)


def test_models_are_compared_best_first(predictions):
    table = metrics.compare_models(predictions, ["pred_naive", "pred_model"])
    assert values(table, "model", "mae") == [("model", 1.0), ("naive", 3.0)]
    assert metrics.improvement(table, "model", "naive").first()["improvement_pct"] == pytest.approx(100 * 2 / 3)


def test_errors_per_station(predictions):
    table = metrics.by_station(predictions, ["pred_naive", "pred_model"])
    assert values(table, "station_complex", "model", "mae") == [
        ("A", "model", 0.5), ("A", "naive", 3.0), ("B", "model", 1.5), ("B", "naive", 3.0),
    ]


def test_no_rows_have_no_errors(predictions):
    assert metrics.compare_models(predictions.limit(0), ["pred_naive"]).collect() == []


def test_comparison_does_not_multiply_rows_before_summing(predictions):
    plan = plan_of(metrics.compare_models(predictions, ["pred_naive", "pred_model"]))
    assert plan.index("Generate") < plan.index("HashAggregate")


def test_baselines_are_columns(spark):
    df = spark.createDataFrame([(7, 2.5)], "lag_168h bigint, rolling_mean_24h double")
    row = baseline.with_baselines(df).first()
    assert (row["pred_naive"], row["pred_rolling_avg_24h"]) == (7.0, 2.5)


def test_stage_counts(grid_table):
    a, b = grid_table(("1", 0, [1] * 5), ("2", 0, [1] * 5)), grid_table(("1", 0, [1] * 3))
    rows = values(profile.stage_counts({"a": a, "b": b}).orderBy("seq"), "stage", "n_rows", "n_stations")
    assert rows == [("a", 10, 2), ("b", 3, 1)]
