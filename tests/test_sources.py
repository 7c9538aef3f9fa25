from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, scan_of, values
from hourgrid.functions.timegrid import parse_timestamp
from hourgrid.operators import clean, profile
from hourgrid.sources import raw, tables

LINES = [
    ",".join(name for name, _ in raw.RAW_FIELDS),
    "05/15/2022 09:00:00 AM,subway,1,A St,Manhattan,omny,full,5,1,40.1,-73.9,POINT (1 2)",
    "05/15/2022 12:00:00 AM,tram,TRAM1,Tram,Manhattan,omny,full,7,0,40.2,-73.8,POINT (1 2)",
    "bad,subway,1,A St,Manhattan,omny,full,3,0,40.1,-73.9,POINT (1 2)",
    "05/15/2022 12:00:00 PM,subway,1,A St,Manhattan,omny",
    '3/12/2023 2:00:00 AM,subway,1,"A, St",Manhattan,omny,full,4,2,40.1,-73.9,POINT (1 2),surplus,more',
]


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("\n".join(LINES) + "\n")
    return str(path)


def test_csv_scan_is_tolerant(spark, csv_path):
    rows = raw.read_raw(spark, csv_path).collect()
    assert [r["station_complex_id"] for r in rows] == ["1", "TRAM1", "1", "1", "1"]
    assert [r["transit_timestamp"] for r in rows] == [
        datetime(2022, 5, 15, 9), datetime(2022, 5, 15, 0), None, datetime(2022, 5, 15, 12), datetime(2023, 3, 12, 2),
    ]
    assert [r["ridership"] for r in rows] == [5, 7, 3, None, 4]
    assert rows[4]["station_complex"] == "A, St"


def test_columns_are_found_by_name(spark, tmp_path):
    rows = ["ridership,transfers,extra,station_complex_id,transit_mode,station_complex,borough,transit_timestamp",
            "5,1,z,9,subway,A St,Queens,05/15/2022 09:00:00 AM"]
    (tmp_path / "a.csv").write_text("\n".join(rows) + "\n")
    row = raw.read_raw(spark, str(tmp_path)).first()
    assert (row["ridership"], row["station_complex_id"], row["extra"]) == (5, "9", "z")
    assert row["transit_timestamp"] == datetime(2022, 5, 15, 9)
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        raw.read_raw(spark, str(tmp_path))


def test_only_needed_columns_are_parsed(spark, csv_path):
    assert "ReadSchema: struct<ridership:string>" in scan_of(raw.read_raw(spark, csv_path).select("ridership"))


def test_corrupt_text_is_kept_on_request(spark, csv_path):
    rows = raw.read_raw(spark, csv_path, keep_corrupt=True).collect()
    assert [r[raw.CORRUPT] is not None for r in rows] == [False, False, True, True, True]


def test_profile_of_csv(spark, csv_path):
    row = profile.profile_raw(raw.read_raw(spark, csv_path)).first()
    assert (row["n_rows"], row["n_ts_parse_fail"], row["n_stations"]) == (5, 1, 2)
    assert row["max_ts"] == datetime(2023, 3, 12, 2)


def test_profile_of_rollup_equals_profile_of_raw(spark, csv_path):
    table = raw.read_raw(spark, csv_path)
    assert profile.profile_rollup(clean.rollup(table)).collect() == profile.profile_raw(table).collect()


def test_null_series_counts_as_a_value(raw_table):
    row = profile.profile_raw(raw_table([(0, "1", 1, 0), (0, None, 1, 0), (1, None, 1, 0)])).first()
    assert row["n_stations"] == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_local_times_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:00 does not exist in New York on that night.
        df = spark.createDataFrame([("03/12/2023 02:00:00 AM",), ("nonsense",), (None,)], "t string")
        parsed = [r[0] for r in df.select(parse_timestamp(F.col("t")).cast("string")).collect()]
        assert parsed == ["2023-03-12 02:00:00", None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_csv_round_trip(spark, tmp_path, raw_table):
    table = raw_table([(0, "1", 5, 1), (13, "TRAM1", -2, 0), (None, "2", 3, 1)])
    raw.write_raw_csv(table, str(tmp_path / "text"))
    back = raw.read_raw(spark, str(tmp_path / "text")).select(*table.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_compaction_drops_bad_rows_and_columns(spark, tmp_path, raw_table, spec):
    table = raw_table([(0, "502", 5, 1, "subway"), (0, "502", 6, 1, "staten_island_railway")])
    compact = raw.compact_raw(table, str(tmp_path / "compact"), spec)
    assert compact.columns == [*spec.keys, "ridership", "transfers"]
    assert values(compact, "ridership") == [(6,)]


def test_column_pruned_scan(spark, tmp_path, grid_table):
    tables.write_table(grid_table(("1", 0, [1, 2, 3])), str(tmp_path / "t"))
    plan = plan_of(tables.read_table(spark, str(tmp_path / "t"), ["entries"]))
    assert "ReadSchema: struct<entries:bigint>" in plan


def test_sorted_table_and_partitioned_table(spark, tmp_path, grid_table, spec):
    table = grid_table(("2", 0, [1, 2]), ("1", 0, [3, 4]))
    tables.write_table(table, str(tmp_path / "s"), order_by=[spec.series_id, spec.ts])
    assert values(tables.read_table(spark, str(tmp_path / "s")).orderBy("station_complex_id", "transit_timestamp"),
                  "entries") == [(3,), (4,), (1,), (2,)]
    tables.write_table(table, str(tmp_path / "p"), partition_by=["station_complex_id"])
    assert "PartitionFilters: [isnotnull(station_complex_id" in plan_of(
        tables.read_table(spark, str(tmp_path / "p")).filter("station_complex_id = '1'")
    )


def test_metrics_csv_and_parameter_json(spark, tmp_path):
    metrics = spark.createDataFrame([("naive", 1.5, 2.25), ("tuned", 0.5, 1.0)], tables.METRICS_SCHEMA)
    tables.write_metrics(metrics, str(tmp_path / "m"))
    assert sorted(tables.read_metrics(spark, str(tmp_path / "m")).collect()) == sorted(metrics.collect())


def test_measures_with_decimals_and_thousands_are_read_and_losses_counted(spark, tmp_path):
    head = "transit_timestamp,transit_mode,station_complex_id,station_complex,borough,ridership,transfers"
    cells = ["12.0", '"1,234"', "7", "n/a", "", " 5 ", "-3", "2.6"]
    lines = [f"05/15/2022 09:00:00 AM,subway,1,A,M,{c},0" for c in cells] + ["05/15/2022 09:00:00 AM,subway,1"]
    (tmp_path / "a.csv").write_text("\n".join([head, *lines, "bad,subway,1,A,M,4,x"]))
    read = [r["ridership"] for r in raw.read_raw(spark, str(tmp_path)).collect()]
    assert read == [12, 1234, 7, None, None, 5, -3, 3, None, 4]
    lost = raw.raw_losses(spark, str(tmp_path)).first().asDict()
    assert lost == {
        "n_rows": 10, "n_damaged_rows": 2, "n_without_time": 1, "n_ridership_missing": 2, "n_ridership_unreadable": 1,
        "n_transfers_missing": 1, "n_transfers_unreadable": 1,
    }


def test_files_with_another_header_are_refused(spark, tmp_path):
    head = "transit_timestamp,transit_mode,station_complex_id,station_complex,borough,ridership,transfers"
    swapped = head.replace("ridership,transfers", "transfers,ridership")
    (tmp_path / "a.csv").write_text(f"{head}\n05/15/2022 09:00:00 AM,subway,1,A,M,12,1")
    (tmp_path / "b.csv").write_text(f"{swapped}\n05/15/2022 09:00:00 AM,subway,1,A,M,1,12")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_raw(spark, str(tmp_path)).collect()
