import pytest
from pyspark.sql import functions as F

from conftest import plan_of, scan_of, values
from hourgrid.operators import reports

WEEK = 7 * 24


@pytest.fixture
def week(grid_table):
    """Two stations over one week from Monday: value = hour on weekdays, 1 at weekends."""
    data = [(i % 24) if i < 5 * 24 else 1 for i in range(WEEK)]
    return grid_table(("1", 0, data), ("2", 0, [2 * v for v in data]))


def test_hourly_profile(week):
    rows = {(r["category"], r["hour_of_day"]): r["avg_entries"] for r in reports.hourly_profile(week).collect()}
    assert len(rows) == 48 and rows["Weekday", 10] == 15.0 and rows["Weekend", 10] == 1.5


def test_hourly_mean_is_busiest_first(week):
    first = reports.hourly_mean(week).first()
    assert first["hour_of_day"] == 23 and first["avg_entries"] == pytest.approx((5 * 34.5 + 2 * 1.5) / 7)


def test_pivot(week):
    rows = reports.weekday_hour_pivot(week).collect()
    assert [r["day_name"] for r in rows] == list(reports.DAY_NAMES)
    assert rows[0]["h10"] == 15.0 and rows[6]["h10"] == 1.5
    english = reports.weekday_hour_pivot(week, day_names=("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"))
    assert english.first()["day_name"] == "Mon"


def test_weekday_ratio(week):
    row = reports.weekday_ratio(week).first()
    assert row["weekday_mean"] == 17.25 and row["weekend_mean"] == 1.5 and row["ratio"] == 11.5


def test_ranking_by_name_merges_ids_and_breaks_ties(grid_table):
    names = {"a": "N1", "b": "N1", "c": "N0", "d": "N2"}
    table = grid_table(("a", 0, [1]), ("b", 0, [2]), ("c", 0, [3]), ("d", 0, [9]), names=names)
    assert values(reports.top_stations(table, 3), "station_complex", "total_entries") == [("N2", 9), ("N0", 3), ("N1", 3)]
    assert values(reports.top_stations(table, 2, "station_complex_id"), "station_complex_id") == [("d",), ("c",)]
    assert values(reports.busiest_station(table.filter("station_complex <> 'N2'")), "station_complex") == [("N0",)]


def test_ranking_keeps_only_the_top_per_task(week):
    assert "TakeOrderedAndProject(limit=20" in plan_of(reports.top_stations(week))


def test_map_repeats_the_total_of_a_shared_name(spark, grid_table):
    names = {"a": "N1", "b": "N1", "c": "N3"}
    table = grid_table(("a", 0, [1]), ("b", 0, [2]), names=names)
    locations = spark.createDataFrame(
        [("a", "N1", "x", "m", 1.0, 2.0), ("b", "N1", "x", "m", 1.0, 2.0), ("c", "N3", "x", "m", 1.0, 2.0)],
        "station_complex_id string, station_complex string, borough string, transit_mode string, latitude double, longitude double",
    )
    rows = reports.map_table(locations, table).orderBy("station_complex_id")
    assert values(rows, "station_complex_id", "total_entries") == [("a", 3), ("b", 3), ("c", None)]


def test_peak_hours_prefer_the_earlier_hour(grid_table):
    table = grid_table(("1", 0, [5, 9, 9, 1] + [0] * 20), ("2", 0, [0] * 24))
    rows = values(reports.peak_hours(table).orderBy("station_complex"), "peak_hour", "peak_avg_entries")
    assert rows == [(1, 9.0), (0, 0.0)]


def test_slice_includes_both_dates_in_order(week):
    part = reports.station_slice(week, "name 1", "2024-01-02", "2024-01-03").collect()
    assert len(part) == 48
    assert [r["transit_timestamp"] for r in part] == sorted(r["transit_timestamp"] for r in part)


def test_slice_reaches_the_scan(spark, tmp_path, week):
    week.write.parquet(str(tmp_path / "w"))
    plan = scan_of(reports.station_slice(spark.read.parquet(str(tmp_path / "w")), "name 1", "2024-01-02", "2024-01-03"))
    assert "GreaterThanOrEqual(transit_timestamp,2024-01-02T00:00)" in plan and "EqualTo(station_complex,name 1)" in plan


def test_slice_metrics_of_two_stations_and_of_nothing(week):
    table = week.withColumn("pred_naive", F.col("entries") + F.when(F.col("station_complex") == "name 1", 1.0).otherwise(3.0))
    one = reports.slice_metrics(table, "name 1", "2024-01-02", "2024-01-03", ["pred_naive"])
    two = reports.slice_metrics(table, "name 2", "2024-01-02", "2024-01-03", ["pred_naive"])
    assert values(one, "mae", "rmse") == [(1.0, 1.0)] and values(two, "mae", "rmse") == [(3.0, 3.0)]
    assert reports.slice_metrics(table, "nobody", "2024-01-02", "2024-01-03", ["pred_naive"]).collect() == []


def test_station_list_and_dates(week):
    assert values(reports.station_list(week), "station_complex") == [("name 1",), ("name 2",)]
    assert list(map(str, reports.date_bounds(week).first())) == ["2024-01-01", "2024-01-07"]


def test_volatility(grid_table):
    table = grid_table(("1", 0, [0, 0, 0, 8]), ("2", 0, [4, 4, 4, 4]), ("3", 0, [0, 0, 0, 0]))
    rows = reports.volatility(table).collect()
    assert [(r["station_complex"], r["cv"]) for r in rows] == [("name 1", 2.0), ("name 2", 0.0), ("name 3", None)]
    assert values(reports.volatile_stations(table), "station_complex") == [("name 1",)]


def test_actual_vs_predicted_shows_the_busiest_name(week):
    table = week.withColumn("pred_naive", F.col("entries") + 1.0)
    rows = reports.actual_vs_predicted(table, ["pred_naive"]).collect()
    assert len(rows) == 2 * WEEK and {r["station_complex"] for r in rows} == {"name 2"}
    assert [r["series"] for r in rows[:2]] == ["actual", "naive"]


def test_crowding_alerts(grid_table):
    history = grid_table(("1", 0, [10] * 48), ("2", 0, [0] * 48))
    predicted = history.limit(0).unionByName(grid_table(("1", 48, [0, 0, 0]), ("2", 48, [0, 0, 0])))
    hour = F.hour("transit_timestamp")
    predicted = predicted.withColumn("pred_model", F.when(hour == 0, 12.9).when(hour == 1, 13.0).otherwise(20.0))
    rows = reports.crowding_alerts(predicted, history, "pred_model").orderBy("hour_of_day")
    assert values(rows, "station_complex_id", "hour_of_day", "usual_entries") == [("1", 1, 10.0), ("1", 2, 10.0)]


def test_summary_sections(week):
    rows = reports.summary(week, top=1, unit=1000.0).collect()
    by_section = {}
    for r in rows:
        by_section.setdefault(r["section"], []).append((r["label"], r["series_id"], r["value"]))
    assert len(by_section["weekday"]) == len(by_section["weekend"]) == 24
    total = 5 * sum(range(24)) + 48
    assert by_section["top_stations"] == [("name 2", "2", round(2 * total / 1000, 1))]
    assert by_section["boroughs"] == [("Manhattan", "", float(round(3 * total / 1000)))]
