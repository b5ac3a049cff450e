"""Scenarios, scoring, evaluation, streaming and the jobs."""

import datetime as dt
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridseries import jobs
from gridseries.operators import evaluate
from gridseries.operators.features import measured_features
from gridseries.plans import scenario, scoring
from gridseries.schemas import FEATURES, PARAMETERS, SCENARIO, TARGETS
from gridseries.streaming import landing


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), SCENARIO)


def test_months_carry_into_the_next_year(spark):
    rows = scenario.expand_months(requests(spark, (1.0, 2.0, 2024, 11, 3))).orderBy("year", "month").collect()
    assert [(r["year"], r["month"]) for r in rows] == [(2024, 11), (2024, 12), (2025, 1)]


def expected_zone(lat, month):
    em = month if lat >= 0 else (month + 5) % 12 + 1
    size = abs(lat)
    wave = math.sin(2 * math.pi * (em - 1) / 12 - math.pi / 2)
    mean, span = next(((m, s) for end, m, s in ((23.5, 27, 3), (35, 22, 10), (50, 15, 15), (60, 8, 20)) if size < end), (-5, 25))
    peak = math.sin(2 * math.pi * (em - 6) / 12)
    rain = (200 if size < 10 else 100 * (0.5 + 1.5 * max(0, peak)) if size < 30
            else 60 * (0.8 + 0.4 * peak) if size < 50 else 40)
    t = mean + wave * span
    rh = min(max(70 - 0.8 * t + rain / 10, 20), 95)
    sun = 220 * (1 - size / 90 * 0.3) * (0.7 + 0.3 * wave)
    q = 0.622 * 0.01 * rh * math.exp(17.27 * t / (t + 237.3)) / 1013.25 * 15
    return {"T2M": t, "T2M_MAX": t + 7, "T2M_MIN": t - 7, "PRECTOTCORR": rain, "RH2M": rh, "ALLSKY_SFC_SW_DWN": sun, "QV2M": q}


def test_zone_estimates(spark):
    points = [(lat, m) for lat in (0.0, 9.9, 10.0, 23.5, 30.0, -33.87, 35.0, 49.9, 50.0, 60.0, -90.0) for m in range(1, 13)]
    frame = scenario.estimate_climate(requests(spark, *[(lat, 0.0, 2030, m, 1) for lat, m in points]))
    for row in frame.collect():
        for name, value in expected_zone(row["latitude"], row["month"]).items():
            assert row[name] == pytest.approx(value, rel=1e-12), (row["latitude"], row["month"], name)


def test_southern_month_with_and_without_normals(spark):
    normals = spark.createDataFrame(
        [(-33.87, 151.21, 1, 23.0, 100.0)],
        "lat_rounded double, lon_rounded double, month int, baseline_temp double, baseline_precip double")
    asked = requests(spark, (-33.87, 151.21, 2030, 1, 1))
    assert scenario.effective_month(F.lit(-33.87), F.lit(1)) is not None
    known = scenario.estimate_climate(asked, normals).first()
    shifted = scenario.estimate_climate(asked, normals, hemisphere_fix=True).first()
    assert known["estimated_from"] == "baseline" and known["T2M"] == 23.0
    assert known["ALLSKY_SFC_SW_DWN"] < shifted["ALLSKY_SFC_SW_DWN"]


def test_features_are_complete_and_in_order(spark):
    frame = scenario.scenario_features(requests(spark, (28.6139, 77.209, 2031, 11, 1)))
    matrix = scenario.feature_matrix(frame)
    assert matrix.columns == FEATURES and len(FEATURES) == 18
    row = matrix.first()
    assert row["year_norm"] == 1.5 and row["season_Fall"] == 1 and row["T2M_range"] == 14.0


def test_worked_row(spark):
    row = spark.createDataFrame([(25.5, 32.0, 18.0, 45.5, 65.0)], "T2M double, T2M_MAX double, T2M_MIN double, PRECTOTCORR double, RH2M double")
    got = measured_features(row, "scoring").first()
    assert (got["T2M_range"], got["heat_index"]) == (14.0, 25.825) and got["precip_log"] == pytest.approx(math.log(46.5))


def test_ranges(spark):
    asked = requests(spark, (91.0, 0.0, 2030, 1, 1), (0.0, 0.0, 2030, 13, 1), (90.0, -180.0, 2030, 12, 1), (None, 0.0, 2030, 1, 1))
    good, bad = scenario.split_valid(asked)
    assert good.count() == 1 and bad.count() == 3
    assert "latitude must be between -90 and 90" in {r["reason"] for r in bad.collect()}
    with pytest.raises(PySparkException, match="month must be between 1 and 12"):
        scenario.assert_ranges(asked.where("month = 13")).select("latitude").collect()


def test_values_and_labels(spark):
    frame = spark.createDataFrame(
        [(10.0, 0.5, 0.05, -2.0), (10.0, 0.5, -0.2, 0.1)],
        "baseline_temp double, baseline_precip double, T2M_anom_predicted double, PRECTOTCORR_anom_predicted double")
    names = ("T2M_anom_predicted", "PRECTOTCORR_anom_predicted")
    got = scenario.three_way_labels(scenario.two_way_labels(scenario.predicted_values(frame), *names), *names)
    first, second = got.orderBy(F.desc("T2M_anom_predicted")).collect()
    assert first["predicted_precip"] == 0.0 and first["temperature_status"] == "Normal"
    assert first["temperature_label"] == "warmer than average" and first["precipitation_label"] == "drier than average"
    assert second["temperature_status"] == "Cooler than average"
    assert second["precipitation_status"] == "More precipitation than average"


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_histogram_matches_numpy(spark, seed):
    values = np.round(np.random.default_rng(seed).normal(size=700), 1)  # many values on bin edges
    table = spark.createDataFrame([(float(v),) for v in values], "e double")
    got = evaluate.error_histogram(table, "e").orderBy("bin").toPandas()
    counts, edges = np.histogram(values, bins=50)
    assert got["count"].tolist() == counts.tolist()
    np.testing.assert_allclose(got.low, edges[:-1], rtol=0, atol=1e-12)


def test_histogram_of_one_value(spark):
    got = evaluate.error_histogram(spark.createDataFrame([(2.0,), (2.0,)], "e double"), "e")
    rows = got.where("count > 0").collect()
    assert len(rows) == 1 and rows[0]["count"] == 2 and got.agg(F.min("low"), F.max("high")).first()[:] == (1.5, 2.5)


def test_metrics(spark):
    rng = np.random.default_rng(5)
    y, p = rng.normal(size=(2, 100)), rng.normal(size=(2, 100))
    rows = [tuple(float(v) for v in r) for r in zip(y[0], y[1], p[0], p[1])]
    table = spark.createDataFrame(rows, [*TARGETS, *[f"{t}_predicted" for t in TARGETS]])
    got = evaluate.regression_metrics(table).toPandas().set_index("target")
    for i, t in enumerate(TARGETS):
        e = y[i] - p[i]
        assert got.loc[t, "mae"] == pytest.approx(np.abs(e).mean())
        assert got.loc[t, "rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
        assert got.loc[t, "r2"] == pytest.approx(1 - (e ** 2).sum() / ((y[i] - y[i].mean()) ** 2).sum())
    loss = evaluate.overall_loss(table).first()
    assert loss["loss"] == pytest.approx(((y - p) ** 2).mean()) and loss["rmse"] == pytest.approx(math.sqrt(loss["loss"]))
    constant = spark.createDataFrame([(1.0, 2.0, 1.0, 3.0)] * 3, table.schema)
    got = evaluate.regression_metrics(constant).toPandas().set_index("target")
    assert got.r2.tolist() == [1.0, 0.0]


def test_split_is_stable_and_near_its_shares(spark):
    frame = spark.range(5000).withColumnRenamed("id", "k")
    parts = scoring.split_rows(frame, ["k"]).groupBy("part").count().toPandas().set_index("part")["count"]
    assert abs(parts["train"] / 5000 - 0.70) < 0.03 and abs(parts["test"] / 5000 - 0.15) < 0.03
    again = scoring.split_rows(frame.repartition(3), ["k"]).where("part = 'test'").count()
    assert again == parts["test"]


@pytest.fixture(scope="module")
def model_rows(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(400, len(FEATURES))), columns=FEATURES)
    pdf["T2M_anom"] = 2 * pdf.T2M_transformed - pdf.latitude + 1
    pdf["PRECTOTCORR_anom"] = 0.5 * pdf.precip_log
    pdf["location_id"], pdf["time"] = range(400), pd.Timestamp("2020-01-01")
    return spark.createDataFrame(pdf)


def test_linear_model_learns_saves_and_loads(spark, model_rows, tmp_path):
    model = scoring.fit_anomaly_model(model_rows, "linear")
    scored = scoring.prediction_errors(model.predict(model_rows))
    assert scored.count() == 400
    assert scored.agg(F.max(F.abs("T2M_error")), F.max(F.abs("PRECTOTCORR_error"))).first()[:] == pytest.approx((0, 0), abs=1e-6)
    model.save(spark, str(tmp_path))
    loaded = scoring.AnomalyModel.load(spark, str(tmp_path))
    gap = model_rows.withColumn("latitude", F.when(F.col("location_id") > 0, F.col("latitude")))
    rows = loaded.predict(gap).orderBy("location_id").collect()
    assert rows[0]["T2M_anom_predicted"] is None
    assert rows[5]["T2M_anom_predicted"] == pytest.approx(rows[5]["T2M_anom"], abs=1e-6)
    with pytest.raises(ValueError):
        scoring.fit_anomaly_model(model_rows, "lasso")


def write_response(folder, location, scale, months=24):
    periods = [f"{2020 + i // 12}{i % 12 + 1:02d}" for i in range(months)]
    parameter = {p: {**{d: scale * (i + 1.0) for i, d in enumerate(periods)}, "202013": 99.0} for p in PARAMETERS}
    path = folder / f"temporal_monthly_{location}_2020_2021.json"
    path.write_text(json.dumps({"properties": {"parameter": parameter}}, indent=1))


def test_stream_scores_files_as_they_land(spark, tmp_path):
    inbox = tmp_path / "raw"
    inbox.mkdir()
    sink, mark, warn = (str(tmp_path / n) for n in ("scored", "mark", "alerts"))

    def run():
        landing.start_scoring(spark, str(inbox), sink, mark, scoring.damped_anomaly(), warn, 0.5, 2).awaitTermination()
        return landing.read_scored(spark, sink)

    write_response(inbox, 1, 1.0)
    write_response(inbox, 2, 0.01)
    first = run()
    assert first.count() == 48
    write_response(inbox, 3, 2.0)
    second = run()
    assert second.count() == 72 and second.select("batch_id").distinct().count() == 2
    january = second.where("location_id = 1 and date = '2020-01'").first()
    assert january["temperature_anomaly"] == pytest.approx(0.5 * (1 - 12.5))
    alerted = spark.read.parquet(warn)
    assert alerted.where("temperature_anomaly <= 0.5").count() == 0
    assert {r["location_id"] for r in alerted.select("location_id").distinct().collect()} == {1, 3}


def test_summary_and_records(spark):
    scored = spark.createDataFrame(
        [(1, "2020-02", 1.0, 0.0, 5.0, 6.0), (1, "2020-01", 3.0, 0.0, 5.0, 6.0)],
        "location_id long, date string, temperature_anomaly double, precipitation_anomaly double, "
        "actual_temperature double, actual_precipitation double")
    row = scoring.response_records(scored, ["location_id"]).first()
    assert [p["date"] for p in row["predictions"]] == ["2020-01", "2020-02"]
    assert (row["samples"], row["temperature_anomaly_mean"], row["temperature_anomaly_std"]) == (2, 2.0, 1.0)
    assert scoring.alerts(scored, threshold=2.0).count() == 1
    assert scoring.latest_rows(scored, ["location_id"], ["date"], 1).first()["date"] == "2020-02"


def test_jobs_end_to_end(spark, model_rows, tmp_path):
    data = tmp_path / "data"
    assert jobs.acquire(spark, str(data), "cities", 2020, 2021, test=True) is None
    assert spark.read.csv(str(data / "manifest_cities_2020_2021.csv"), header=True).count() == 3
    raw = data / "raw"
    raw.mkdir()
    write_response(raw, 0, 1.0)
    write_response(raw, 1, 1.5)
    master = jobs.acquire(spark, str(data), "cities", 2020, 2021, test=True)
    assert master.count() == 48 and len(master.columns) == 19
    failed = spark.read.csv(str(data / "failed_cities_2020_2021.csv"), header=True).collect()
    assert [r["location_id"] for r in failed] == ["2"]
    master_path = str(data / "climate_master_cities_2020_2021")
    cleaned = jobs.clean_table(spark, master_path, models=str(tmp_path / "models"))
    assert cleaned.count() == 48 and (data / "climate_cleaned_cities_2020_2021").exists()
    normals = jobs.make_baselines(spark, [master_path], str(data / "baselines"))
    assert normals.count() == 24
    jobs.train(spark, _stored(model_rows, tmp_path), str(tmp_path / "model"), "linear").collect()
    scored = jobs.score_table(spark, _stored(model_rows, tmp_path), str(tmp_path / "model"), str(tmp_path / "scored"))
    assert {"T2M_error", "PRECTOTCORR_anom_predicted"} <= set(scored.columns)
    got = jobs.predict_scenario(spark, 28.61, 77.23, 2030, 12, 2, str(tmp_path / "model"), str(data / "baselines"))
    rows = scenario.prediction_records(got).orderBy("date.year").collect()
    assert [r["date"]["month_name"] for r in rows] == ["Dec", "Jan"]
    assert rows[0]["baseline"]["temperature"] == 18.0  # mean of 12 and 24


def _stored(model_rows, tmp_path):
    path = str(tmp_path / "ready")
    model_rows.write.mode("overwrite").parquet(path)
    return path
