import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from conftest import plan_of
from hourgrid.operators import clean, features, onepass
from hourgrid.spec import DemandSpec

SPEC = DemandSpec(lags=(1, 3, 5), windows=(2, 4), block_steps=7, exclude=())


def parts_of(raw, spec=SPEC):
    rolled = clean.rollup(raw, spec)
    return clean.station_step_of(rolled, spec), clean.time_bounds(rolled, spec)


def two_steps(raw, spec=SPEC, start=None, end=None):
    sums, bounds = parts_of(raw, spec)
    return features.build_features(clean.cleaned_from(sums, bounds, spec), spec, start, end)


def one_step(raw, spec=SPEC, start=None, end=None):
    sums, bounds = parts_of(raw, spec)
    return onepass.features_of_sums(sums, bounds, spec, start, end)


def rows(df):
    return sorted(map(str, df.collect()))


def taps():
    """Series with gaps, negative sums, an extreme value, one that begins late and one with a single row."""
    a = [(h, "1", (h * 7) % 11 - 2, 1) for h in range(60) if h % 4 != 1]
    b = [(h, "2", 3 + h % 5, 0) for h in range(20, 58, 3)] + [(31, "2", 9000, 0)]
    return [*a, *b, (59, "3", 5, 0), (12, "4", None, 0), (None, "4", 8, 0)]


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_equals_cleaning_then_features(raw_table, block):
    spec = SPEC.with_(block_steps=block)
    raw = raw_table(taps())
    both = one_step(raw, spec), two_steps(raw, spec)
    assert both[0].columns == both[1].columns and both[0].dtypes == both[1].dtypes
    assert rows(both[0]) == rows(both[1]) and len(rows(both[0])) == 4 * 55


@pytest.mark.parametrize("block, start, end", [
    (6, "2024-01-02 03:00:00", None), (6, None, "2024-01-01 20:00:00"), (1, "2024-01-01 02:00:00", "2024-01-02 05:30:00"),
    (1000, "2024-01-01 23:59:00", "2024-01-02 00:01:00"), (6, "2025-01-01 00:00:00", None),
    (6, "2024-01-02 00:00:00", "2024-01-01 00:00:00"), (6, "2023-12-01 00:00:00", "2026-01-01 00:00:00"),
])
def test_ranges_equal_a_filter_of_all(raw_table, block, start, end):
    raw = raw_table(taps())
    whole = one_step(raw, SPEC)
    if start:
        whole = whole.filter(F.col(SPEC.ts) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        whole = whole.filter(F.col(SPEC.ts) < F.lit(end).cast("timestamp_ntz"))
    assert rows(one_step(raw, SPEC.with_(block_steps=block), start, end)) == rows(whole)


def test_no_exchange_between_fill_and_features(raw_table):
    sums, bounds = parts_of(raw_table(taps()))
    series = onepass.series_with_caps(sums, bounds, SPEC)
    plan = plan_of(onepass.features_of_sums(sums, bounds, SPEC, series=series))
    # From the top (features) down to the generator that fills the grid there is no exchange.
    above = plan[: plan.index("explode(")] if "explode(" in plan else plan[: plan.index("Generate")]
    assert "Window" in above and "Exchange" not in above
    old = plan_of(two_steps(raw_table(taps())))
    assert "Exchange" in old[: old.index("sequence(")]


def test_bounds_reach_the_rows_before_the_fill(raw_table):
    sums, bounds = parts_of(raw_table(taps()))
    plan = plan_of(onepass.features_of_sums(sums, bounds, SPEC, start="2024-01-02 00:00:00"))
    assert "2024-01-01 18:00:00" in plan[plan.index("Union"):]


def test_empty_table_gives_no_rows(raw_table):
    assert one_step(raw_table([])).count() == 0


def test_null_station_equals_the_two_steps(raw_table):
    raw = raw_table([*taps(), (3, None, 5, 0)])
    assert rows(one_step(raw)) == rows(two_steps(raw))


def test_two_tuples_of_an_id_are_refused(raw_table):
    raw = raw_table([(h, "1", 1, 0, mode) for h in range(9) for mode in ("subway", "tram")])
    with pytest.raises(SparkRuntimeException, match="gap-free"):
        one_step(raw).collect()


def test_doubled_steps_are_refused(raw_table):
    sums, bounds = parts_of(raw_table(taps()))
    with pytest.raises(SparkRuntimeException, match="two rows"):
        onepass.features_of_sums(sums.unionByName(sums), bounds, SPEC).collect()


def test_daily_steps(raw_table):
    spec = SPEC.with_(step="day")
    raw = raw_table([(24 * d, "1", d % 6, 0) for d in range(40) if d % 3])
    assert rows(one_step(raw, spec)) == rows(two_steps(raw, spec))
