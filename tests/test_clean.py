from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import GRID, START, plan_of, values
from hourgrid.operators import clean
from hourgrid.spec import DemandSpec

SPEC = DemandSpec()
RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def grid_by_left_join(spark, sums, bounds, spec=SPEC):
    """The definition of the completed grid: every station x every step, left joined with the sums."""
    row = bounds.first()
    hours = int((row["max_ts"] - row["min_ts"]) / timedelta(hours=1)) + 1
    steps = spark.createDataFrame([(row["min_ts"] + timedelta(hours=i),) for i in range(hours)], "t timestamp_ntz")
    grid = sums.select(*spec.station_keys).distinct().join(steps).withColumnRenamed("t", spec.ts)
    return grid.join(sums, spec.keys, "left").fillna(0, ["entries", "transfers"]).select(*spec.keys, "entries", "transfers")


def nearest_rank(data, q):
    return sorted(data)[int((len(data) - 1) * q + 0.5)]


def same_rows(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_rules_drop_matches_and_unknowns(spark):
    df = spark.createDataFrame(
        [("502", "subway"), ("502", None), ("1", None), ("2", "x"), ("502", "rail")],
        "station_complex_id string, transit_mode string",
    )
    kept = clean.exclude_rows(df, SPEC.exclude)
    assert sorted(values(kept, "station_complex_id")) == [("1",), ("2",), ("502",)]


def test_no_rules_keep_everything(spark):
    df = spark.createDataFrame([("1",), (None,)], "station_complex_id string")
    assert clean.exclude_rows(df, ()).count() == 2


def test_station_step_sums(raw_table):
    raw = raw_table([(0, "1", 5, 1), (0, "1", -7, 2), (1, "1", None, None), (0, "2", 4, 0)])
    sums = clean.to_station_step(raw).orderBy("station_complex_id", "transit_timestamp")
    assert values(sums, "entries", "transfers") == [(-2, 3), (0, 0), (4, 0)]


def test_sums_are_partially_aggregated_before_the_shuffle(raw_table):
    plan = plan_of(clean.rollup(raw_table([(0, "1", 5, 1)])))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan[plan.index("Exchange"):]


def test_locations_are_weighted_by_rows(spark, raw_table):
    raw = raw_table([(0, "1", 1, 0), (1, "1", 1, 0), (2, "1", 1, 0), (0, "502", 9, 0, "subway")])
    raw = raw.withColumn("latitude", F.when(F.hour("transit_timestamp") == 2, 43.0).otherwise(40.0))
    raw = raw.withColumn("longitude", F.lit(-74.0))
    direct = clean.station_locations(raw)
    assert values(direct, "station_complex_id", "latitude", "longitude") == [("1", 41.0, -74.0)]
    same_rows(clean.station_locations_of(clean.rollup(raw)).select(*direct.columns), direct)


def test_gaps_are_filled_with_zero(raw_table):
    raw = raw_table([(0, "1", 5, 1), (1, "1", 6, 1), (4, "1", 7, 1)])
    sums, bounds = clean.to_station_step(raw), clean.time_bounds(raw)
    grid = clean.reindex(sums, bounds).orderBy("transit_timestamp")
    assert values(grid, "entries") == [(5,), (6,), (0,), (0,), (7,)]
    assert [r[0] for r in values(grid, "transit_timestamp")] == [START + timedelta(hours=i) for i in range(5)]


def test_the_range_covers_excluded_rows(raw_table):
    raw = raw_table([(0, "502", 1, 0, "subway"), (2, "1", 5, 0), (3, "1", 6, 0)])
    rolled = clean.rollup(raw)
    grid = clean.reindex(clean.station_step_of(rolled), clean.time_bounds(rolled))
    assert grid.count() == 4 and grid.select("station_complex_id").distinct().count() == 1


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_blocks_do_not_change_the_grid(spark, raw_table, block):
    raw = raw_table([(3, "1", 5, 1), (4, "1", 6, 1), (9, "1", 7, 1), (0, "2", 1, 1), (6, "2", 2, 2), (11, "3", 1, 0)])
    sums, bounds = clean.to_station_step(raw), clean.time_bounds(raw)
    same_rows(clean.reindex(sums, bounds, SPEC.with_(block_steps=block)), grid_by_left_join(spark, sums, bounds))


def test_off_grid_and_null_times_are_reported(spark, raw_table):
    raw = raw_table([(0, "1", 5, 0), (0.5, "1", 6, 0), (2, "1", 7, 0), (None, "1", 8, 0), (None, "2", 9, 0)])
    sums, bounds = clean.to_station_step(raw), clean.time_bounds(raw)
    same_rows(clean.reindex(sums, bounds), grid_by_left_join(spark, sums, bounds))
    assert clean.off_grid_rows(sums, bounds).first().asDict() == {"n_off_grid": 3, "lost_entries": 23}


def test_grid_may_start_between_hours(spark, raw_table):
    raw = raw_table([(0.5, "1", 5, 0), (2.5, "1", 6, 0), (3.25, "1", 7, 0)])
    sums, bounds = clean.to_station_step(raw), clean.time_bounds(raw)
    assert bounds.first()["n_steps"] == 3
    same_rows(clean.reindex(sums, bounds), grid_by_left_join(spark, sums, bounds))


def test_stations_with_null_keys_match_nothing(spark):
    rows = [("1", "A", None, "subway", START, 5, 1), ("2", "B", "X", "subway", START + timedelta(hours=1), 6, 1)]
    sums = spark.createDataFrame(rows, GRID)
    bounds = clean.time_bounds(sums)
    same_rows(clean.reindex(sums, bounds), grid_by_left_join(spark, sums, bounds))
    caps = clean.iqr_caps_of_sums(sums, bounds)
    same_rows(caps, clean.iqr_caps(clean.clip_negative(clean.reindex(sums, bounds))))


def test_grid_leaves_each_task_in_order(tmp_path, raw_table):
    import pyarrow.parquet as pq

    raw = raw_table([(h * 7 % 60, str(h % 9), 1, 0) for h in range(60)])
    grid = clean.reindex(clean.to_station_step(raw), clean.time_bounds(raw), SPEC.with_(block_steps=16))
    grid.write.parquet(str(tmp_path / "g"))
    for file in tmp_path.glob("g/*.parquet"):
        keys = pq.read_table(file, columns=["station_complex_id", "transit_timestamp"]).to_pylist()
        pairs = [(k["station_complex_id"], k["transit_timestamp"]) for k in keys]
        assert pairs == sorted(pairs)


def test_doubled_steps_are_refused(spark, grid_table):
    once = grid_table(("1", 0, [1, 2]))
    with pytest.raises(Exception, match="two rows for one step"):
        clean.reindex(once.unionByName(once), clean.time_bounds(once)).collect()


def test_grid_plan_has_no_cross_join_and_shuffles_rows_once(raw_table):
    raw = raw_table([(0, "1", 5, 1), (4, "2", 7, 1)])
    plan = plan_of(clean.reindex(clean.to_station_step(raw), clean.time_bounds(raw)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Join" not in plan
    main = plan[:plan.index("Union")]
    assert main.count("Exchange") == 1


def test_caps_reach_the_grid_without_joining_it(raw_table):
    raw = raw_table([(0, "1", 5, 1), (4, "2", 7, 1)])
    plan = plan_of(clean.cleaned_from(clean.to_station_step(raw), clean.time_bounds(raw)))
    main = plan[:plan.index("Union")]
    assert "Join" not in main and main.count("Exchange") == 1


def test_nearest_rank_quartiles(grid_table):
    row = clean.iqr_caps(grid_table(("1", 0, [4, 1, 3, 2]))).first()
    assert (row["q1"], row["q3"], row["iqr"], row["upper_cap"]) == (2.0, 3.0, 1.0, 6.0)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 720, 721])
def test_quartiles_of_a_ramp(grid_table, n):
    row = clean.iqr_caps(grid_table(("1", 0, list(range(1, n + 1))))).first()
    assert row["q1"] == nearest_rank(range(1, n + 1), 0.25)
    assert row["q3"] == nearest_rank(range(1, n + 1), 0.75)


@RELAXED
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from("ab"), st.integers(-5, 40)), min_size=1, max_size=60))
def test_caps_of_sums_equal_caps_of_grid(raw_table, rows):
    raw = raw_table([(h, s, v, 0) for h, s, v in rows])
    sums, bounds = clean.to_station_step(raw), clean.time_bounds(raw)
    grid = clean.clip_negative(clean.reindex(sums, bounds))
    expected = {}
    for sid, entries in values(grid, "station_complex_id", "entries"):
        expected.setdefault(sid, []).append(entries)
    found = {r["station_complex_id"]: r for r in clean.iqr_caps_of_sums(sums, bounds).collect()}
    assert found.keys() == expected.keys()
    for sid, data in expected.items():
        q1, q3 = nearest_rank(data, 0.25), nearest_rank(data, 0.75)
        assert (found[sid]["q1"], found[sid]["q3"], found[sid]["upper_cap"]) == (q1, q3, q3 + 3.0 * (q3 - q1))
    same_rows(clean.iqr_caps_of_sums(sums, bounds), clean.iqr_caps(grid))


def test_two_tuples_of_one_id_share_a_cap(raw_table):
    raw = raw_table([(0, "7", 8, 0, "subway"), (1, "7", 3, 0, "subway"), (0, "7", 5, 0, "tram"), (3, "8", 1, 0)])
    sums, bounds = clean.to_station_step(raw), clean.time_bounds(raw)
    grid = clean.clip_negative(clean.reindex(sums, bounds))
    same_rows(clean.iqr_caps_of_sums(sums, bounds), clean.iqr_caps(grid))
    assert values(clean.ambiguous_series(raw), "station_complex_id", "n_tuples") == [("7", 2)]


def test_spikes_are_capped_and_negatives_clipped(grid_table):
    ordinary = [10, 11, 12, 13, 14] * 4
    table = grid_table(("1", 0, [*ordinary, 10_000, -5]))
    caps = clean.iqr_caps(clean.clip_negative(table))
    out = [v for (v,) in values(clean.cap_outliers(clean.clip_negative(table), caps).orderBy("transit_timestamp"), "entries")]
    cap = caps.first()["upper_cap"]
    assert out == [*ordinary, int(cap), 0] and cap < 10_000
    again = clean.cap_outliers(clean.cap_outliers(clean.clip_negative(table), caps), caps)
    assert sorted(v for (v,) in values(again, "entries")) == sorted(out)


def test_transfers_are_clipped_but_never_capped(raw_table):
    raw = raw_table([(i, "1", 10, 1) for i in range(20)] + [(20, "1", 500, 900), (21, "1", 10, -4)])
    cleaned = clean.cleaned_from(clean.to_station_step(raw), clean.time_bounds(raw)).orderBy("transit_timestamp")
    assert values(cleaned, "entries", "transfers")[-2:] == [(10, 900), (10, 0)]


def test_one_pass_cleaning_equals_step_by_step(raw_table):
    raw = raw_table([(h * h % 50, s, h * 7 % 90 - 9, h % 4 - 1) for h in range(60) for s in ("1", "2", "3")])
    sums, bounds = clean.to_station_step(raw), clean.time_bounds(raw)
    clipped = clean.clip_negative(clean.reindex(sums, bounds))
    same_rows(clean.cleaned_from(sums, bounds), clean.cap_outliers(clipped, clean.iqr_caps(clipped)))


def test_a_mostly_empty_series_is_flattened_unless_bounded(raw_table):
    raw = raw_table([(0, "1", 9, 0), (99, "1", 4, 0)])
    sums, bounds = clean.to_station_step(raw), clean.time_bounds(raw)
    assert clean.cleaned_from(sums, bounds).agg(F.sum("entries")).first()[0] == 0
    assert clean.cleaned_from(sums, bounds, min_cap=5.0).agg(F.sum("entries")).first()[0] == 9


def test_quality_counts(raw_table):
    raw = raw_table([(i, "1", 10, 0) for i in range(20)] + [(20, "1", 500, 0), (21, "1", -3, -1)])
    grid = clean.grid_with_caps(clean.to_station_step(raw), clean.time_bounds(raw))
    assert clean.quality_counts(grid).first().asDict() == {
        "n_rows": 22, "n_negative_entries": 1, "n_negative_transfers": 1, "n_capped": 1, "pct_capped": 4.5455,
    }


def test_a_hot_station_with_most_raw_rows(spark):
    """One station holds nearly all raw rows; sums, grid and caps stay exact."""
    rows = spark.range(60_000).select(
        (F.lit(START).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR") * (F.col("id") % 400)).alias("transit_timestamp"),
        F.lit("subway").alias("transit_mode"),
        F.when(F.col("id") % 100 == 0, F.concat(F.lit("s"), F.col("id") % 7)).otherwise("hot").alias("station_complex_id"),
        F.lit("n").alias("station_complex"),
        F.lit("b").alias("borough"),
        F.lit(1).cast("bigint").alias("ridership"),
        F.lit(0).cast("bigint").alias("transfers"),
    )
    spec = SPEC.with_(block_steps=50)
    rolled = clean.rollup(rows, spec)
    bounds = clean.time_bounds(rolled, spec)
    grid = clean.reindex(clean.station_step_of(rolled, spec), bounds, spec)
    assert grid.count() == 8 * 400
    assert grid.agg(F.sum("entries")).first()[0] == 60_000


def test_daily_step(spark, raw_table):
    spec = SPEC.with_(step="day", lags=(1,), windows=())
    raw = raw_table([(0, "1", 5, 0), (72, "1", 6, 0), (25, "1", 9, 0)])
    sums, bounds = clean.to_station_step(raw, spec), clean.time_bounds(raw, spec)
    grid = clean.reindex(sums, bounds, spec).orderBy("transit_timestamp")
    assert values(grid, "entries") == [(5,), (0,), (0,), (6,)]
    assert grid.first()["transit_timestamp"] == datetime(2024, 1, 1)


def test_empty_input(raw_table):
    raw = raw_table([])
    assert clean.cleaned_from(clean.to_station_step(raw), clean.time_bounds(raw)).count() == 0
