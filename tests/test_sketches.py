import pytest
from pyspark.sql import functions as F

from conftest import values
from hourgrid.operators import clean, sketches
from hourgrid.spec import DemandSpec

SPEC = DemandSpec(exclude=())


def parts_of(raw):
    rolled = clean.rollup(raw, SPEC)
    return clean.station_step_of(rolled, SPEC), clean.time_bounds(rolled, SPEC)


def caps(df):
    return sorted(values(df, "station_complex_id", "q1", "q3", "iqr", "upper_cap"))


def test_few_values_give_the_exact_caps(raw_table):
    """Over two months, with gaps, negative sums, a series of zeros only, one without a time, and a late one."""
    rows = [(h, "1", (h * 37) % 101, 0) for h in range(0, 1400, 9)] + [(h, "2", 5 + h % 3, 0) for h in range(1300, 1400)]
    rows += [(h, "3", -4, 0) for h in range(20)] + [(None, "4", 7, 0), (1400, "4", None, 0)]
    rows += [(h, "5", h % 50, 0) for h in range(0, 1400, 2) if h % 11 == 0]
    sums, bounds = parts_of(raw_table(rows))
    sketched = sketches.value_sketches(sums, bounds, SPEC)
    assert sketched.where("station_complex_id = '1'").count() == 2
    assert caps(sketches.caps_of_sketches(sketched, bounds, SPEC)) == caps(clean.iqr_caps_of_sums(sums, bounds, SPEC))


def test_dense_series_have_the_exact_caps_while_a_sketch_holds_them(raw_table):
    sums, bounds = parts_of(raw_table([(h, "1", 1 + (h * 7) % 199, 0) for h in range(199)]))
    approximate = sketches.caps_of_sketches(sketches.value_sketches(sums, bounds, SPEC), bounds, SPEC)
    assert caps(approximate) == caps(clean.iqr_caps_of_sums(sums, bounds, SPEC))


@pytest.mark.parametrize("size", [50, 200])
def test_long_series_stay_within_the_bound(spark, size):
    """60,000 hours in 83 months, skewed: most values small, some very large, and every third hour without any."""
    hours = spark.range(60_000).filter("id % 3 > 0")
    first = F.lit("2015-01-01 00:00:00").cast("timestamp_ntz")
    value = F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0, 3).cast("bigint")
    sums = hours.select(
        F.lit("1").alias("station_complex_id"), F.lit("a").alias("station_complex"), F.lit("b").alias("borough"),
        F.lit("c").alias("transit_mode"), (first + F.expr("INTERVAL 1 HOUR") * F.col("id")).alias(SPEC.ts),
        value.alias("entries"), F.lit(0).cast("bigint").alias("transfers"),
    )
    bounds = clean.time_bounds(sums, SPEC)
    sketched = sketches.value_sketches(sums, bounds, SPEC, size)
    assert sketched.count() == 83
    approximate = sketches.caps_of_sketches(sketched, bounds, SPEC)
    errors = sketches.rank_errors(approximate, clean.value_counts(sums, bounds, SPEC), bounds, SPEC).first()
    assert max(errors["q1_error"], errors["q3_error"]) <= sketches.rank_error_bound(size)


def test_errors_of_wrong_caps_are_seen(raw_table):
    sums, bounds = parts_of(raw_table([(h, "1", h, 0) for h in range(100)]))
    exact = clean.iqr_caps_of_sums(sums, bounds, SPEC)
    counts = clean.value_counts(sums, bounds, SPEC)
    assert values(sketches.rank_errors(exact, counts, bounds, SPEC), "q1_error", "q3_error") == [(0.0, 0.0)]
    wrong = exact.withColumns({"q1": F.col("q1") + 10, "q3": F.col("q3") - 20})
    assert values(sketches.rank_errors(wrong, counts, bounds, SPEC), "q1_error", "q3_error") == [(0.1, 0.2)]


def test_empty_table(raw_table):
    sums, bounds = parts_of(raw_table([]))
    assert caps(sketches.caps_of_sketches(sketches.value_sketches(sums, bounds, SPEC), bounds, SPEC)) == []
