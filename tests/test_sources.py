"""Grids, manifests, landed responses, tables."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from gridseries import session
from gridseries.operators.joins import missing_locations
from gridseries.schemas import CLIMATE, LOCATION
from gridseries.sources import grids, manifests, responses, tables


def test_global_grid(spark):
    grid = grids.global_grid(spark)
    rows = grid.orderBy("location_id").collect()
    assert grid.schema.fieldNames() == LOCATION.fieldNames() and len(rows) == 703
    assert rows[0]["description"] == "Global_-90_-180" and rows[-1]["description"] == "Global_90_180"
    assert (rows[38]["latitude"], rows[38]["longitude"]) == (-80.0, -170.0)


def test_fractional_step_labels(spark):
    rows = grids.regional_grid(spark, 0, 1, 10, 11, 0.5).orderBy("location_id").collect()
    assert len(rows) == 9 and rows[1]["description"] == "Regional_0.0_10.5"


def test_india_passes_its_upper_bound(spark):
    rows = grids.india_grid(spark).agg(F.count("*"), F.max("latitude"), F.max("longitude")).first()
    assert tuple(rows) == (256, 38.0, 98.0)


def test_cities(spark, tmp_path):
    built_in = grids.city_locations(spark).orderBy("location_id").collect()
    assert len(built_in) == 10 and built_in[9]["description"] == "Sydney" and built_in[0]["grid_type"] == "city"
    (tmp_path / "c.csv").write_text("city_name,latitude,longitude,country\nZeta,1.5,2.5,X\nAlpha,3.0,4.0,Y\n")
    by_file = grids.city_locations(spark, str(tmp_path / "c.csv")).orderBy("location_id").collect()
    assert [r["description"] for r in by_file] == ["Zeta", "Alpha"] and by_file[0]["location_id"] == 0
    by_name = grids.city_locations(spark, str(tmp_path / "c.csv"), "city_name").orderBy("location_id").collect()
    assert [r["description"] for r in by_name] == ["Alpha", "Zeta"]


def test_manifests(spark):
    places = grids.city_locations(spark).where("location_id = 7")
    url = manifests.monthly_manifest(places, 2010, 2024, ["T2M"]).first()["url"]
    assert url.endswith("/api/temporal/monthly/point?parameters=T2M&community=SB&longitude=-0.13"
                        "&latitude=51.51&format=JSON&start=2010&end=2024")
    whole = grids.global_grid(spark).where("location_id = 0")
    assert "longitude=-180&latitude=-90&" in manifests.monthly_manifest(whole, 1, 2, whole_degrees=True).first()["url"]
    assert "longitude=-180.0&" in manifests.monthly_manifest(whole, 1, 2).first()["url"]
    html = manifests.indicators_manifest(places, 2001, 2016, "HTML").first()["url"]
    assert html.endswith("/indicators/point?longitude=-0.13&latitude=51.51&start=2001&end=2016&format=HTML")
    asked = spark.createDataFrame([(28.6139, 77.209, 24)], "latitude double, longitude double, months_back int")
    window = manifests.window_manifest(asked, dt.date(2025, 3, 1)).first()["url"]
    assert "community=RE" in window and "&start=202303&end=202503&" in window


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()

    def put(location, parameter):
        text = json.dumps({"type": "Feature", "properties": {"parameter": parameter}} if parameter is not None
                          else {"messages": ["no data"]}, indent=2)
        (folder / f"temporal_monthly_{location}_2020_2020.json").write_text(text)

    put(3, {"T2M": {"202001": 1.5, "202002": -999.0, "202013": 9.0}, "RH2M": {"202001": 50.0}})
    put(4, {"T2M": {"202012": 2.0}})
    put(5, None)
    return str(folder)


def test_responses(spark, landing):
    files = responses.read_landing(spark, landing)
    rows = responses.monthly_rows(files).orderBy("location_id", "time").collect()
    assert [(r["location_id"], r["time"], r["T2M"], r["RH2M"], r["QV2M"]) for r in rows] == [
        (3, dt.datetime(2020, 1, 1), 1.5, 50.0, None), (3, dt.datetime(2020, 2, 1), -999.0, None, None),
        (4, dt.datetime(2020, 12, 1), 2.0, None, None)]
    blanked = responses.monthly_rows(files, sentinel=-999).where("T2M is null").count()
    assert blanked == 1
    periods = {r["period"] for r in responses.climatology_rows(files).collect()}
    assert periods == {"202001", "202002", "202012", "202013"}
    window = responses.window_rows(files).where("location_id = 4").first()
    assert (window["year"], window["month"]) == (2020, 12)
    wanted = spark.createDataFrame([(3, 1.0, 2.0), (5, 3.0, 4.0)], "location_id long, latitude double, longitude double")
    assert [r["location_id"] for r in missing_locations(wanted, responses.monthly_rows(files)).collect()] == [5]
    placed = responses.with_coordinates(responses.monthly_rows(files), wanted).where("location_id = 3").first()
    assert (placed["latitude"], placed["longitude"]) == (1.0, 2.0)


def test_transposition_needs_no_shuffle(spark, landing):
    plan = responses.monthly_rows(responses.read_landing(spark, landing))._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_csv_keeps_infinities_spaces_and_gaps(spark, tmp_path):
    frame = spark.createDataFrame(
        [(1, math.inf, " a "), (2, -math.inf, None), (3, None, "b"), (4, math.nan, "c")], "i int, y double, s string")
    path = str(tmp_path / "t.csv")
    tables.write_table(frame, path)
    got = tables.read_csv(spark, path, frame.schema).orderBy("i").collect()
    assert [(r["y"], r["s"]) for r in got] == [(math.inf, " a "), (-math.inf, None), (None, "b"), (None, "c")]


def test_write_unless_empty(spark, tmp_path):
    empty = spark.createDataFrame([], CLIMATE)
    assert not tables.write_unless_empty(empty, str(tmp_path / "none"))
    assert not tables.write_unless_empty(None, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_baseline_input_refuses_scaled_tables(spark, tmp_path):
    raw = spark.createDataFrame(
        [(1.0, 2.0, dt.datetime(2020, 5, 1), 3.0, 4.0)],
        "latitude double, longitude double, time timestamp, T2M double, PRECTOTCORR double")
    for name in ("climate_cleaned", "climate_data"):
        raw.write.parquet(str(tmp_path / name))
    paths = [str(tmp_path / n) for n in ("climate_master", "climate_cleaned", "climate_data")]
    got = tables.read_baseline_input(spark, paths, raw.schema)
    assert got.first()["month"] == 5
    with pytest.raises(FileNotFoundError):
        tables.read_baseline_input(spark, paths[:2], raw.schema)


def test_names():
    assert tables.cleaned_path("x/climate_master_a.csv") == "x/climate_cleaned_a.csv"
    assert tables.cleaned_path("x/other.csv") == "x/other_cleaned.csv"


def test_year_filter_reaches_the_scan(spark, tmp_path):
    frame = spark.range(48).selectExpr(
        "id % 4 as location_id", "add_months(date'2019-01-01', cast(id as int)) as day").selectExpr(
        "location_id", "cast(day as timestamp) as time", "year(day) as year", "1.0D as T2M")
    path = str(tmp_path / "master")
    tables.write_master(frame, path)
    plan = spark.read.parquet(path).where("year = 2020").select("T2M")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<T2M:double>" in plan


def test_handed_over_tables_go_with_their_job(spark):
    frame = spark.range(5)
    with pytest.raises(RuntimeError), session.scratch_removed(spark):
        path = session.scratch_path(spark, "probe")
        frame.write.parquet(path)
        assert session.path_exists(spark, path)
        raise RuntimeError("the job fails")
    assert not session.path_exists(spark, path)
    assert not session._scratch.get(spark.sparkContext.applicationId)


def test_sessions_without_a_named_folder_use_the_warehouse(spark, monkeypatch):
    class Named:
        applicationId = "none"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            self.path = path

    class Session:
        sparkContext = Named()
        conf = {"spark.sql.warehouse.dir": "hdfs://x/warehouse/"}

    assert session.shared_folder(Session()) == "hdfs://x/warehouse/_handover" == Session.sparkContext.path
