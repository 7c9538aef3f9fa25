from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import RAW, scan_of
from hourgrid.operators import clean, features
from hourgrid.plans.monthly import MonthlyStore, _runs
from hourgrid.sources.monthly import month_of
from hourgrid.spec import DemandSpec

SPEC = DemandSpec(step="day", lags=(1, 3, 7), windows=(2, 5), block_steps=40, exclude=())


def days(spark, rows):
    """(day since 2024-01-01, id, value) to raw rows."""
    full = [
        (None if d is None else datetime(2024, 1, 1) + timedelta(days=d), "subway", sid, f"name {sid}", "Queens", v, 0)
        for d, sid, v in rows
    ]
    return spark.createDataFrame(full, RAW)


def whole(raw):
    rolled = clean.rollup(raw, SPEC)
    cleaned = clean.cleaned_from(clean.station_step_of(rolled, SPEC), clean.time_bounds(rolled, SPEC), SPEC)
    return features.build_features(cleaned, SPEC)


def rows(df):
    return sorted(map(str, df.collect()))


BASE = [(d, s, (d * 5 + int(s)) % 9) for s in "12" for d in range(150) if (d + int(s)) % 4]


@pytest.fixture
def store(spark, tmp_path):
    built = MonthlyStore(spark, str(tmp_path / "store"), SPEC)
    built.update(days(spark, BASE), "a")
    return built


def test_built_at_once(spark, store):
    assert rows(store.features()) == rows(whole(days(spark, BASE)))


@pytest.mark.parametrize("added, rebuilt", [
    # New days at the end: the month the grid ended in, and those after it.
    ([(d, "1", 3) for d in range(150, 170)], [date(2024, 5, 1), date(2024, 6, 1)]),
    # More of a value that is there already, in March: that month and the one that looks back on it.
    ([(70, "1", 0)], [date(2024, 3, 1), date(2024, 4, 1)]),
    # A new station and an earlier start change everything.
    ([(70, "9", 4)], [date(2024, m, 1) for m in range(1, 6)]),
    ([(-3, "1", 4)], [date(2023, 12, 1), *(date(2024, m, 1) for m in range(1, 6))]),
    # Without a time there is no month.
    ([(None, "1", 4)], []),
    ([], []),
])
def test_update_equals_a_full_build(spark, store, added, rebuilt):
    update = store.update(days(spark, added), "b")
    assert update.rebuilt == rebuilt
    assert rows(store.features()) == rows(whole(days(spark, [*BASE, *added])))


def test_moved_caps_rebuild_the_months_they_cut(spark, tmp_path):
    base = [(d, "1", 1 if d % 2 else 0) for d in range(150)] + [(20, "1", 50)]
    store = MonthlyStore(spark, str(tmp_path / "store"), SPEC)
    store.update(days(spark, base), "a")
    # Most days of May get larger, so the cap rises and the value of January is cut less.
    more = [(d, "1", 9) for d in range(121, 150)] + [(d, "1", 9) for d in range(100, 121)]
    update = store.update(days(spark, more), "b")
    assert date(2024, 1, 1) in update.rebuilt and date(2024, 3, 1) not in update.rebuilt
    assert rows(store.features()) == rows(whole(days(spark, [*base, *more])))


def test_a_batch_taken_twice_counts_once(spark, store):
    more = days(spark, [(140, "1", 3), (155, "2", 4)])
    store.update(more, "b")
    first = rows(store.features())
    store.update(more, "b")
    assert rows(store.features()) == first == rows(whole(days(spark, BASE).unionByName(more)))


def test_ranges_read_their_months_only(spark, store):
    start, end = "2024-03-05 00:00:00", "2024-04-02 00:00:00"
    expected = rows(store.features().filter((F.col(SPEC.ts) >= start) & (F.col(SPEC.ts) < end)))
    assert rows(store.features(start, end)) == expected and expected
    assert rows(store.compute_features(start, end)) == expected
    for df in (store.features(start, end), store.compute_features(start, end)):
        filters = [line for line in scan_of(df).splitlines() if line.startswith("PartitionFilters") and "ts_month" in line]
        assert any(">=" in line and "<=" in line for line in filters)
    files = store.features(start, end).select(F.input_file_name()).distinct().collect()
    assert {f[0].split("ts_month=")[1][:7] for f in files} == {"2024-03", "2024-04"}


def test_caps_are_those_of_all_rows(spark, store):
    rolled = clean.rollup(days(spark, BASE), SPEC)
    expected = clean.iqr_caps_of_sums(clean.station_step_of(rolled, SPEC), clean.time_bounds(rolled, SPEC), SPEC)
    assert rows(store.caps()) == rows(expected.select(SPEC.series_id, "upper_cap"))


def test_months_and_runs(spark):
    assert spark.range(1).select(month_of(F.lit("2024-02-29 23:59:59").cast("timestamp_ntz"))).first()[0] == date(2024, 2, 1)
    assert _runs([date(2024, 1, 1), date(2023, 12, 1), date(2024, 4, 1)]) == [
        (date(2023, 12, 1), date(2024, 2, 1)), (date(2024, 4, 1), date(2024, 5, 1))
    ]
    scattered = [date(2024, m, 1) for m in (1, 3, 7, 12)]
    assert _runs(scattered, 2) == [(date(2024, 1, 1), date(2024, 8, 1)), (date(2024, 12, 1), date(2025, 1, 1))]
