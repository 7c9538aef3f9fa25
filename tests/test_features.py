from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import START, plan_of, values
from hourgrid.operators import features
from hourgrid.spec import DemandSpec

SPEC = DemandSpec()
SMALL = SPEC.with_(lags=(1, 3, 5), windows=(2, 4), block_steps=7)


def plain_history(df, spec):
    """The definition: lag and guarded mean over one window per series."""
    w = Window.partitionBy(spec.series_id).orderBy(spec.ts)
    columns = {spec.lag_name(k): F.lag(spec.target, k).over(w) for k in spec.lags}
    for n in spec.windows:
        frame = w.rowsBetween(-n, -1)
        columns[spec.rolling_name(n)] = F.when(F.count(spec.target).over(frame) == n, F.avg(spec.target).over(frame))
    return df.withColumns(columns)


def same_rows(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_ramp(grid_table):
    table = grid_table(("1", 0, list(range(200))), ("2", 0, list(range(200))))
    out = features.build_features(table)
    assert out.count() == 2 * 32
    row = out.filter((F.col("station_complex_id") == "1") & (F.col("entries") == 190)).first()
    assert (row["lag_1h"], row["lag_24h"], row["lag_168h"]) == (189, 166, 22)
    assert (row["rolling_mean_3h"], row["rolling_mean_24h"]) == (188.0, sum(range(166, 190)) / 24)
    assert out.columns == [
        *SPEC.keys, "entries", "lag_1h", "lag_24h", "lag_168h", "rolling_mean_3h", "rolling_mean_24h",
        "hour_of_day", "day_of_week", "month", "is_weekend",
    ]


def test_warm_up_drops_the_longest_lag_per_series(grid_table):
    table = grid_table(("1", 0, [1] * 170), ("2", 0, [1] * 175))
    assert features.build_features(table).count() == 2 + 7


@pytest.mark.parametrize("block", [1, 5, 7, 16, 1000])
@pytest.mark.parametrize("gap_free", [True, False])
def test_blocks_do_not_change_history(grid_table, block, gap_free):
    table = grid_table(("1", 0, [i * i % 31 for i in range(60)]), ("2", 11, [i * 7 % 13 for i in range(33)]))
    spec = SMALL.with_(block_steps=block)
    same_rows(features.add_history(table, spec, gap_free), plain_history(table, spec))


def test_rows_are_counted_when_the_table_has_gaps(grid_table):
    table = grid_table(("1", 0, list(range(40))), ("2", 3, list(range(50, 90)))).filter(F.hour("transit_timestamp") % 3 != 0)
    same_rows(features.add_history(table, SMALL, gap_free=False), plain_history(table, SMALL))


def test_gaps_and_doubles_are_refused(grid_table):
    table = grid_table(("1", 0, list(range(40))))
    with pytest.raises(Exception, match="not a gap-free grid"):
        features.add_history(table.filter("entries <> 20"), SMALL).collect()
    with pytest.raises(Exception, match="not a gap-free grid"):
        features.add_history(table.unionByName(table.limit(1)), SMALL).collect()


def test_rolling_is_null_until_the_window_is_full(grid_table):
    out = features.add_rolling(grid_table(("1", 0, [1, 2, 3, 4, 5])), SPEC).orderBy("transit_timestamp")
    assert values(out, "rolling_mean_3h") == [(None,), (None,), (None,), (2.0,), (3.0,)]
    assert "lag_1h" not in out.columns


def test_lags_only(grid_table):
    out = features.add_lags(grid_table(("1", 0, [1, 2, 3])), SPEC).orderBy("transit_timestamp")
    assert values(out, "lag_1h") == [(None,), (1,), (2,)]
    assert "rolling_mean_3h" not in out.columns


def test_lag_equals_value_at_that_time(grid_table):
    table = grid_table(("1", 0, [i * i % 97 for i in range(400)]))
    lagged = features.add_lags(table, SPEC)
    earlier = table.select(
        (F.col("transit_timestamp") + F.expr("INTERVAL 24 HOURS")).alias("transit_timestamp"), F.col("entries").alias("then")
    )
    assert lagged.join(earlier, "transit_timestamp", "left").filter(~F.col("lag_24h").eqNullSafe(F.col("then"))).count() == 0


def test_no_feature_sees_the_present_or_future(grid_table):
    base = [i * 13 % 29 for i in range(60)]
    changed = [*base[:40], *(v + 1000 for v in base[40:])]
    cut = START + timedelta(hours=40)

    def upto_cut(data):
        return features.add_history(grid_table(("1", 0, data)), SMALL).filter(F.col("transit_timestamp") <= F.lit(str(cut)).cast("timestamp_ntz")).drop("entries")

    same_rows(upto_cut(base), upto_cut(changed))


def test_calendar(spark):
    times = [datetime(2024, 1, 1, 5), datetime(2024, 3, 9, 23), datetime(2024, 3, 10, 2), datetime(2024, 3, 11, 0)]
    df = spark.createDataFrame([(t,) for t in times], "transit_timestamp timestamp_ntz")
    rows = values(features.add_calendar(df), "hour_of_day", "day_of_week", "month", "is_weekend")
    assert rows == [(5, 0, 1, False), (23, 5, 3, True), (2, 6, 3, True), (0, 0, 3, False)]


def test_one_shuffle_and_one_sort(grid_table):
    plan = plan_of(features.build_features(grid_table(("1", 0, [1, 2, 3]))))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    # Running sums first, then all lags.
    assert plan.count("Window [") == 2


@pytest.mark.parametrize("kind", ["bigint", "int", "double"])
def test_missing_values_and_other_types(grid_table, kind):
    data = [None if i in (4, 5, 20) else i * i % 31 for i in range(40)]
    table = grid_table(("1", 0, data), ("2", 5, [3] * 20)).withColumn("entries", F.col("entries").cast(kind))
    same_rows(features.add_history(table, SMALL), plain_history(table, SMALL))


def test_rows_leave_each_task_in_order(tmp_path, grid_table):
    import pyarrow.parquet as pq

    table = grid_table(*((str(s), 0, list(range(50))) for s in range(9)))
    features.add_history(table.repartition(3), SMALL).write.parquet(str(tmp_path / "f"))
    for file in tmp_path.glob("f/*.parquet"):
        keys = pq.read_table(file, columns=["station_complex_id", "transit_timestamp"]).to_pylist()
        pairs = [(k["station_complex_id"], k["transit_timestamp"]) for k in keys]
        assert pairs == sorted(pairs)


def test_range_equals_filtered_whole_and_reaches_the_scan(spark, tmp_path, grid_table):
    grid_table(("1", 0, [i % 17 for i in range(400)]), ("2", 0, [i % 5 for i in range(400)])).write.parquet(str(tmp_path / "c"))
    table = spark.read.parquet(str(tmp_path / "c"))
    start, end = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
    part = features.build_features(table, SPEC, start, end)
    ts = F.col("transit_timestamp")
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    same_rows(part, features.build_features(table).filter((ts >= low) & (ts < high)))
    plan = plan_of(part)
    assert "GreaterThanOrEqual(transit_timestamp,2024-01-03T00:00)" in plan
    assert "transfers" not in plan


def test_daily_names():
    spec = SPEC.with_(step="day", lags=(1, 7), windows=(3,))
    assert spec.lag_columns == ["lag_1d", "lag_7d"] and spec.rolling_columns == ["rolling_mean_3d"]


def test_spec_rejects_unknown_steps():
    with pytest.raises(ValueError):
        SPEC.with_(step="minute")
    with pytest.raises(ValueError):
        SPEC.with_(lags=(0,))
    with pytest.raises(ValueError):
        SPEC.with_(exclude=({"payment_method": "cash"},))
