from __future__ import annotations

import numpy as np
import pytest

from tallytide.schema import TELEMETRY, TELEMETRY_READ
from tallytide.sources import daily_index, telemetry
from tallytide.sources.registry import Registry, append_rows, write_table

HEADER = "time_iso,time_unix,itcs_numberOfPassengers,itcs_busRoute,itcs_stopName,odometry_vehicleSpeed,status_doorIsOpen"


def write_mission(folder, name, rows):
    (folder / f"{name}.csv").write_text("\n".join([HEADER, *rows]) + "\n")


@pytest.fixture
def missions(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_mission(folder, "B183_a", ["2019-04-30T03:18:56Z,1556594336,NaN,-,-,NaN,0", "2019-04-30T03:18:57Z,1556594337,12.0,83,Depot,1.5,1"])
    write_mission(folder, "B208_b", ["2019-05-01T03:00:00Z,1556679600,,31,-,2.0,0"])
    write_mission(folder, "stray", ["2019-05-01T03:00:00Z,1556679600,1.0,31,-,2.0,0"])
    meta = tmp_path / "metaData.csv"
    meta.write_text(
        "name,busNumber,startTime_iso,startTime_unix,endTime_iso,endTime_unix,busRoute\n"
        "B183_a,183,2019-04-30T03:18:56Z,1556594336,2019-04-30T08:44:20Z,1556613860,83\n"
        "B208_b,208,2019-05-01T03:00:00Z,1556679600,2019-05-01T04:00:00Z,1556683200,31\n"
        "gone,208,2019-05-01T03:00:00Z,1556679600,2019-05-01T04:00:00Z,1556683200,33\n"
    )
    return folder, meta


def test_metadata(spark, missions):
    meta = telemetry.read_metadata(spark, str(missions[1]))
    row = meta.filter("name = 'B183_a'").first()
    assert row["duration_hours"] == pytest.approx(19524 / 3600)
    assert row["busRoute"] == "83" and row["startTime_iso"].year == 2019
    assert dict(meta.dtypes)["busRoute"] == "string"


def test_scan_in_one_read(spark, missions):
    folder, meta_path = missions
    meta = telemetry.read_metadata(spark, str(meta_path))
    columns = ["time_unix", "itcs_numberOfPassengers", "itcs_busRoute", "odometry_vehicleSpeed"]
    df = telemetry.read_missions(spark, str(folder), meta, columns)
    rows = {(r["mission_name"], r["time_unix"]): r for r in df.collect()}
    assert set(df.columns) == {*columns, "mission_name", "busNumber"}
    assert len(rows) == 3  # the stray file and the missing file are both left out
    first = rows["B183_a", 1556594336]
    assert first["itcs_numberOfPassengers"] is None and first["odometry_vehicleSpeed"] is None
    assert first["itcs_busRoute"] == "-" and first["busNumber"] == 183
    assert rows["B208_b", 1556679600]["itcs_numberOfPassengers"] is None
    assert telemetry.read_missions(spark, str(folder), meta, columns, only=["B208_b"]).count() == 1


def test_scan_reads_only_what_is_selected(spark, missions):
    folder, meta_path = missions
    meta = telemetry.read_metadata(spark, str(meta_path))
    df = telemetry.read_missions(spark, str(folder), meta, ["time_unix"])
    plan = df.select("mission_name", "time_unix")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<time_unix:bigint>" in plan


def test_missing_files(spark, missions, tmp_path):
    assert telemetry.read_mission(spark, str(tmp_path / "nothing.csv")).schema == TELEMETRY
    meta = telemetry.read_metadata(spark, str(missions[1]))
    assert telemetry.read_missions(spark, str(tmp_path / "nowhere"), meta, TELEMETRY_READ).count() == 0


def test_corrupt_rows_are_counted(spark, tmp_path):
    write_mission(tmp_path, "bad", ["2019-04-30T03:18:56Z,1,2.0,83,X,1.0,0", "2019-04-30T03:18:57Z,not-a-number,2.0,83,X,1.0,0"])
    path = str(tmp_path / "bad.csv")
    assert telemetry.read_mission(spark, path).count() == 2
    assert telemetry.corrupt_rows(spark, path) == 1


def test_npy_vectors(spark, tmp_path):
    np.save(tmp_path / "B183_a.npy", np.arange(32, dtype=np.float32))
    row = telemetry.read_vectors(spark, str(tmp_path)).first()
    assert row["mission_name"] == "B183_a" and row["embedding"] == list(map(float, range(32)))


def test_daily_index_file(spark, tmp_path):
    path = tmp_path / "index.csv"
    path.write_text(
        "CountryCode,Date,StringencyIndex_Average\nCHE,20200301,\nCHE,20200302,10.5\nCHE,20200305,20\nCHE,bad,99\nAUT,20200303,77\n"
    )
    rows = daily_index.read_daily_index(spark, str(path)).orderBy("date").collect()
    assert [r["stringency"] for r in rows] == [0.0, 10.5, 10.5, 10.5, 20.0]
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="country"):
        daily_index.read_daily_index(spark, str(tmp_path / "other.csv"))


def test_registry(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "runs"))
    names = ["decision_tree", "random_forest", "boosted_trees"]
    assert registry.pending("r1", "temporal", names) == names
    metrics = spark.createDataFrame(
        [("random_forest", "temporal", 0.8, [[3, 0, 0], [0, 2, 1], [0, 0, 4]])],
        "model string, framework string, macro_f1 double, confusion_matrix array<array<long>>",
    )
    registry.record("r1", metrics)
    assert registry.pending("r1", "temporal", names) == ["decision_tree", "boosted_trees"]
    assert registry.pending("r1", "pooled", names) == names and registry.pending("r2", "temporal", names) == names
    row = registry.results("r1").first()
    assert row["confusion_matrix"] == [[3, 0, 0], [0, 2, 1], [0, 0, 4]] and row["macro_f1"] == 0.8
    registry.record("r1", metrics.selectExpr("model", "framework", "0.9d AS macro_f1"))
    assert [r["macro_f1"] for r in registry.results("r1").collect()] == [0.9]
    assert registry.comparison("r1").first()["model"] == "random_forest"
    assert registry.load_model("r1", "temporal", "random_forest") is None


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0)], "model string, f double")
    path = str(tmp_path / "comparison")
    write_table(df, path, ["model"])
    append_rows(spark.createDataFrame([("c", 3.0)], "model string, f double"), path)
    assert sorted(r["model"] for r in spark.read.option("header", True).csv(path).collect()) == ["a", "b", "c"]
