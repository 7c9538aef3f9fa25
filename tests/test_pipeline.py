import pytest
from pyspark.sql import functions as F

from conftest import DATA
from hourgrid.__main__ import main
from hourgrid.operators import model
from hourgrid.plans.pipeline import Workspace
from hourgrid.sources.raw import read_raw, write_raw_csv
from hourgrid.sources.views import HOURLY, hourly_taps
from hourgrid.staging import shared_folder, stage


def test_all_stages_from_csv_to_reports(spark, tmp_path):
    """Counts are those of the same tables computed by another engine."""
    write_raw_csv(hourly_taps(spark, f"{DATA}/sf0.01"), str(tmp_path / "csv"))
    work = Workspace(spark, str(tmp_path / "work"), HOURLY)
    work.prepare(read_raw(spark, str(tmp_path / "csv")))
    assert work.table("lineage").first().asDict() == {
        "n_raw": 10_000, "n_station_step": 7_232, "n_grid": 14_400, "n_gaps_filled": 7_168,
    }
    assert work.table("profile").first()["n_ts_parse_fail"] == 0
    assert work.table("station_locations").count() == 20
    assert work.build_features().count() == 11_040
    parts = work.split()
    assert {k: v.count() for k, v in parts.items()} == {"train": 8_640, "val": 1_200, "test": 1_200}
    assert work.table("ambiguous").count() == 0 and work.table("unread").first()["n_unread"] == 0
    assert work.table("quality").first()["n_negative_entries"] == 731
    assert [r["n_rows"] for r in work.table("feature_counts").orderBy("seq").collect()] == [14_400, 11_040]
    assert {r["split"]: r["n_rows"] for r in work.table("split_counts").collect()}["train"] == 8_640
    naive = {r["model"]: (round(r["mae"], 6), round(r["rmse"], 6)) for r in work.baseline_metrics().collect()}
    assert naive == {"naive": (43.355, 66.271449), "rolling_avg_24h": (35.685868, 46.813391)}
    work.train_default(n_estimators=2, max_depth=2)
    work.train_final(model.BoostingParams(num_leaves=4, n_estimators=2))
    assert work.predict().count() == 1_200
    stored = {r["model"] for r in work.evaluate().collect()}
    assert stored == {"model_default", "model", "naive", "rolling_avg_24h"}
    assert work.importance().count() == 12
    assert work.report("top_stations").first().asDict() == {"station_complex": "S0", "total_entries": 38_628}
    assert work.report("map_table").count() == 20
    for name in ("hourly_profile", "weekday_hour_pivot", "summary", "peak_hours", "daily_totals"):
        assert work.report(name).count() > 0
    assert work.report("station_list").count() == 18 and work.report("date_bounds").count() == 1
    assert work.report("station_slice", "S5", "2024-01-10", "2024-01-11").count() == 48
    assert work.report("slice_metrics", "S5", "2024-01-29", "2024-01-30").count() == 4
    assert work.report("station_hourly", "S5").count() == 24 and work.report("actual_vs_predicted").count() > 0
    with pytest.raises(KeyError):
        work.report("unknown")
    with pytest.raises(ValueError):
        work.report("station_slice", "S5")
    # A stage can be repeated on its stored input.
    assert work.build_features().agg(F.sum("entries")).first() == work.table("features").agg(F.sum("entries")).first()


def test_command_line(spark, tmp_path, capsys):
    rows = hourly_taps(spark, f"{DATA}/sf0.001")
    write_raw_csv(rows, str(tmp_path / "csv"))
    out = str(tmp_path / "work")
    for stage_name in ("prepare", "features"):
        main([stage_name, "--out", out, "--raw", str(tmp_path / "csv"), "--exclude", "station_complex_id=3,transit_mode=tram"])
    main(["split", "--out", out, "--proportional"])
    main(["report", "--out", out, "--name", "borough_totals"])
    main(["report", "--out", out, "--name", "station_slice", "--station", "S2", "--start", "2024-01-02", "--end", "2024-01-02"])
    shown = capsys.readouterr().out
    assert "n_gaps_filled" in shown and "AFRICA" in shown
    with pytest.raises(SystemExit):
        main(["prepare", "--out", out])


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(spark.range(3), "probe")
    assert staged.inputFiles()[0].replace("file://", "").startswith(shared_folder(spark))
    assert sorted(r[0] for r in staged.collect()) == [0, 1, 2]


def test_ids_with_several_names_are_named_or_take_the_latest(spark, tmp_path, raw_table):
    rows = raw_table([(h, "1", 10 + h, 0) for h in range(300)])
    renamed = rows.withColumn("station_complex", F.when(F.col("ridership") < 150, "old").otherwise("new"))
    work = Workspace(spark, str(tmp_path / "a"), HOURLY.with_(exclude=()))
    work.prepare(renamed)
    assert [r["n_tuples"] for r in work.table("ambiguous").collect()] == [2]
    with pytest.raises(ValueError, match="several attribute tuples"):
        work.build_features()
    work.prepare(renamed, latest_attributes=True)
    assert work.table("ambiguous").count() == 0
    names = work.build_features().select("station_complex").distinct().collect()
    assert [r[0] for r in names] == ["new"] and work.table("cleaned").count() == 300


def test_update_and_quiet_cuts_on_the_command_line(spark, tmp_path, raw_table, capsys):
    rows = raw_table([(h, "1", 5 + h % 7, 0) for h in range(40 * 24)])
    late = rows.filter(F.col("transit_timestamp") >= F.lit("2024-02-01").cast("timestamp_ntz"))
    out = ["--out", str(tmp_path / "work")]
    for name, part in (("all", rows), ("late", late)):
        write_raw_csv(part, str(tmp_path / name))
        main(["update", *out, "--raw", str(tmp_path / name), "--batch", name])
    assert "built again: 2024-02-01" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["update", *out, "--raw", str(tmp_path / "all")])
    with pytest.raises(SystemExit):
        main(["split", *out, "--off-holidays"])
