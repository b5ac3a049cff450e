"""Cleaning operators by hand-made rows and against pandas or numpy formulas."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridseries.functions.columns import half_even, nan_to_null
from gridseries.operators import duplicates, encoding, infinite, missing, outliers, profile, scaling, standardize
from gridseries.operators.anomalies import anomalies
from gridseries.operators.features import complete_rows, lag_features
from gridseries.plans import artifacts, catalogue, cleaning
from gridseries.plans.master import master_dataset


def column(frame, name, order="i"):
    return [r[name] for r in frame.orderBy(order).collect()]


def test_half_even(spark):
    values = np.concatenate([[0.00005, 0.00015, -0.00005, 2.5, np.inf], np.random.default_rng(0).normal(size=500) * 100])
    table = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, y double")
    got = column(table.withColumn("y", half_even(table["y"], 4)), "y")
    assert got == np.round(values, 4).tolist()
    assert math.copysign(1, got[2]) == 1  # no -0.0


def test_fill_statistics(spark):
    table = spark.createDataFrame([(0, 1.0, 2), (1, None, None), (2, 4.0, 5), (3, 10.0, None)], "i int, y double, n long")
    assert column(missing.fill_missing(table, "mean"), "y")[1] == 5.0
    assert column(missing.fill_missing(table, "median"), "y")[1] == 4.0
    assert column(missing.fill_missing(table, "median"), "n")[1] == 3.5  # a whole column filled with a fraction
    modes = spark.createDataFrame([(0, "b", None), (1, "a", None), (2, "b", None), (3, "a", None), (4, None, None)],
                                  "i int, s string, e string")
    filled = missing.fill_missing(modes, "mode", fill_value="none")
    assert column(filled, "s")[4] == "a" and column(filled, "e") == ["none"] * 5


def test_fill_edges(spark):
    table = spark.createDataFrame([(0, 1.0)], "i int, y double")
    assert missing.fill_missing(table, "mean").collect() == table.collect()
    gap = spark.createDataFrame([(0, None)], "i int, y double")
    with pytest.raises(ValueError):
        missing.fill_missing(gap, "forward_fill")
    with pytest.raises(ValueError):
        missing.fill_missing(gap, "custom")
    assert missing.fill_missing(gap, "drop").count() == 0


def test_smart_fill_runs_text_across_locations(spark):
    day = [dt.datetime(2020, m, 1) for m in range(1, 4)]
    rows = [(1, day[0], 1.0, "a", 5.0), (1, day[1], None, None, None), (1, day[2], 3.0, None, 7.0),
            (2, day[0], None, None, 5.0), (2, day[1], None, "b", 5.0)]
    table = spark.createDataFrame(rows, "location_id long, time timestamp, y double, s string, latitude double")
    got = missing.fill_missing(table, "smart").orderBy("location_id", "time").collect()
    assert [r["s"] for r in got] == ["a", "a", "a", "a", "b"]
    assert [r["y"] for r in got] == [1.0, 2.0, 3.0, 2.0, 2.0]  # location 2 has no value: median of the rest
    assert got[1]["latitude"] == 5.0  # not interpolated: median
    got = missing.fill_missing(table, "smart", fill_text_within="location_id").orderBy("location_id", "time").collect()
    assert [r["s"] for r in got] == ["a", "a", "a", "a", "b"]  # leading gap of location 2: mode, smallest tie


def test_smart_fill_text_without_values(spark):
    table = spark.createDataFrame([(0, None), (1, None)], "i int, s string")
    assert column(missing.fill_missing(table, "smart", ["i"]), "s") == ["Unknown", "Unknown"]


def test_infinite(spark):
    inf = math.inf
    table = spark.createDataFrame([(0, 1.0, None), (1, inf, 2.0), (2, None, 3.0), (3, 5.0, 4.0), (4, -inf, 4.0)],
                                  "i int, y double, z double")
    replaced = infinite.handle_infinite(table, "replace")
    assert column(replaced, "y") == [1.0, 3.0, 3.0, 5.0, 3.0] and column(replaced, "z")[0] is None
    assert column(infinite.handle_infinite(table, "drop"), "i") == [3]
    assert column(infinite.handle_infinite(table, "clip"), "y") == [1.0, 5.0, None, 5.0, 1.0]
    with pytest.raises(ValueError):
        infinite.handle_infinite(table, "mean")


def test_duplicates(spark):
    nan = math.nan
    table = spark.createDataFrame(
        [(0, 1, nan), (1, 1, nan), (2, 1, 2.0), (3, None, 2.0), (4, None, 2.0)], "i int, k int, y double")
    assert duplicates.remove_duplicates(table.drop("i")).count() == 3
    assert duplicates.remove_duplicates(table.drop("i"), keep=False).count() == 1
    assert column(duplicates.remove_duplicates(table, ["k"], "first", ["i"]), "i") == [0, 3]
    assert column(duplicates.remove_duplicates(table, ["k"], "last", ["i"]), "i") == [2, 4]
    assert column(duplicates.remove_duplicates(table, ["k", "y"], False), "i") == [2]
    assert profile.duplicate_profile(table.drop("i")).first().asDict() == {"count": 2, "percent": 40.0}
    with pytest.raises(ValueError):
        duplicates.remove_duplicates(table, ["k"])


def test_standardize(spark):
    table = spark.createDataFrame([(0, "\t New  ", "2020-05-01", 1.23456, 7)], "i int, s string, time string, y double, year int")
    row = standardize.standardize_format(table).first()
    assert row["s"] == "new" and row["time"] == dt.datetime(2020, 5, 1) and row["y"] == 1.2346 and row["year"] == 7
    gap = spark.createDataFrame([(0, None)], "i int, s string")
    assert standardize.standardize_format(gap).first()["s"] is None
    assert standardize.standardize_format(gap, null_token="nan").first()["s"] == "nan"


def test_outliers(spark):
    values = [float(v) for v in range(20)] + [500.0, None]
    table = spark.createDataFrame([(i, v, float(i % 3)) for i, v in enumerate(values)], "i int, y double, z double")
    (found,) = outliers.detect_outliers(table.drop("i"), "iqr", 3.0)
    series = pd.Series(values, dtype=float)
    q1, q3 = series.quantile(0.25), series.quantile(0.75)
    assert (found.column, found.count) == ("y", 1) and found.upper == q3 + 3 * (q3 - q1)
    assert found.percent == pytest.approx(100 / 22)
    assert column(outliers.treat_outliers(table, "clip", [found]), "y")[20] == found.upper
    assert outliers.treat_outliers(table, "remove", [found]).count() == 20  # the NULL goes as well
    assert sum(column(outliers.flag_outliers(table, [found]), "y_outlier")) == 1
    by_score = outliers.detect_outliers(table.drop("i"), "zscore", 3.0)
    assert [o.column for o in by_score] == ["y"]
    assert column(outliers.treat_outliers(table, "clip", by_score), "y")[20] == 500.0  # compatible: no bounds
    usable = outliers.detect_outliers(table.drop("i"), "zscore", 3.0, reference_compat=False)
    assert column(outliers.treat_outliers(table, "clip", usable), "y")[20] < 500.0
    assert "y_log" not in outliers.treat_outliers(table, "log_transform", [found]).columns
    positive = table.withColumn("y", F.coalesce(F.col("y") + 1, F.lit(1.0)))
    assert "y_log" in outliers.treat_outliers(positive, "log_transform", [found]).columns
    with pytest.raises(ValueError):
        outliers.detect_outliers(table, "mad")


def test_named_columns_get_their_logs_whatever_they_hold(spark):
    values = [0.0, None, -0.5, -1.0, -2.0, *map(float, range(1, 20)), 500.0]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, y double")
    for found in ([], outliers.detect_outliers(table, "iqr", 3.0, ["y"])):
        treated = outliers.treat_outliers(table, "log_transform", found, logged=["y"])
        assert treated.columns == ["i", "y", "y_log"]
        assert column(treated, "y_log")[:5] == [0.0, None, pytest.approx(np.log(0.5)), None, None]
        assert column(treated, "y_log")[5:] == pytest.approx(np.log1p(values[5:]))


@pytest.mark.parametrize("values", [[0.0, *[float(v % 9) for v in range(1, 200)], 1000.0], [None, 0.0, 2.0], [5.0] * 30])
def test_log_query_gives_its_column_for_any_values(spark, tmp_path, values):
    """Zeros, gaps or a column without outliers once left out the column that the query rounds."""
    start = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i, start, i % 3, "view", v) for i, v in enumerate(values)],
                          "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(
        str(tmp_path / "events.parquet"))
    got = {r["event_id"]: r for r in catalogue.treat_log(spark, str(tmp_path)).collect()}
    assert len(got) == len(values)
    for i, v in enumerate(values):
        assert got[i]["PRECTOTCORR"] == v
        assert got[i]["PRECTOTCORR_log"] == (None if v is None else pytest.approx(np.log1p(v), abs=1e-6))


def test_zscore_of_constant_column_finds_nothing(spark):
    table = spark.createDataFrame([(1.0,), (1.0,)], "y double")
    assert outliers.detect_outliers(table, "zscore") == []


def test_scalers(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"i": range(50), "y": rng.normal(5, 2, 50), "c": 7.5})
    pdf.loc[3, "y"] = np.nan
    table = nan_to_null(spark.createDataFrame(pdf))
    y = pdf.y
    expected = {
        "standard": (y - y.mean()) / y.std(ddof=0), "minmax": (y - y.min()) / (y.max() - y.min()),
        "robust": (y - y.median()) / (y.quantile(0.75) - y.quantile(0.25))}
    for method, values in expected.items():
        scaled, fitted = scaling.scale_features(table, method, ["y", "c"])
        np.testing.assert_allclose(np.array(column(scaled, "y"), dtype=float), values, rtol=1e-12)
        assert column(scaled, "c") == [0.0] * 50
        again, _ = scaling.scale_features(table, method, scaler=scaling.Scaler.from_frame(fitted.to_frame(spark)))
        assert again.collect() == scaled.collect()
    with pytest.raises(ValueError):
        scaling.scale_features(table, "minmax", scaler=fitted)
    with pytest.raises(ValueError):
        fitted.apply(table.drop("y"))


def test_onehot(spark):
    train = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c"), (3, None)], "i int, col string")
    encoded, fitted = encoding.encode_categorical(train, "onehot")
    assert encoded.columns == ["i", "col_b", "col_c"] and column(encoded, "col_b") == [1, 0, 0, 0]
    batch = spark.createDataFrame([(0, "b"), (1, "c")], "i int, col string")
    applied, _ = encoding.encode_categorical(batch, "onehot", categories=fitted)
    assert (column(applied, "col_b"), column(applied, "col_c")) == ([1, 0], [0, 1])
    hot, _ = encoding.encode_categorical(train, "onehot", form="vector")
    assert hot.columns == ["i", "col_onehot"]
    assert [(v["size"], v["indices"], v["values"]) for v in column(hot, "col_onehot")] == [
        (2, [0], [1.0]), (2, [], []), (2, [1], [1.0]), (2, [], [])]


def test_the_form_decides_the_schema_not_the_number_of_categories(spark):
    def shapes(n):
        table = spark.range(n).selectExpr("id", "concat('v', id) as col")
        fitted = encoding.fit_categories(table)
        wide = [(f.name, f.dataType) for f in encoding.apply_onehot(table, fitted, "vector").schema]
        return wide, fitted

    few, many = shapes(3), shapes(600)
    assert few[0] == many[0]
    with pytest.raises(ValueError, match="vector"):
        encoding.apply_onehot(spark.createDataFrame([("v1",)], "col string"), many[1])
    with pytest.raises(ValueError, match="form"):
        encoding.apply_onehot(spark.createDataFrame([("v1",)], "col string"), many[1], "dense")


def test_labels(spark):
    train = spark.createDataFrame([(0, "b"), (1, "a"), (2, None)], "i int, col string")
    encoded, fitted = encoding.encode_categorical(train, "label")
    assert column(encoded, "col") == [1, 0, None]
    batch = spark.createDataFrame([(0, "z")], "i int, col string")
    with pytest.raises(PySparkException, match="unknown category in col: z"):
        encoding.apply_labels(batch, fitted).collect()
    assert column(encoding.apply_labels(batch, fitted, unknown="null"), "col") == [None]
    as_word = encoding.fit_categories(train, null_token="nan")
    assert column(encoding.apply_labels(train, as_word, null_token="nan"), "col") == [1, 0, 2]
    with pytest.raises(ValueError):
        encoding.encode_categorical(train, "target")


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"y": np.random.default_rng(4).normal(size=201), "n": np.arange(201)})
    got = profile.describe(spark.createDataFrame(pdf)).toPandas().set_index("column")
    expected = pdf.describe().T.rename(columns={"25%": "p25", "50%": "p50", "75%": "p75"})
    pd.testing.assert_frame_equal(got, expected, check_dtype=False, check_names=False, check_like=True)


def test_lags_and_complete_rows(spark):
    rows = [(k, dt.datetime(2020, m, 1), float(m), 1.0) for k in (1, 2) for m in range(1, 13)]
    table = spark.createDataFrame(rows, "location_id long, time timestamp, T2M double, RH2M double")
    lagged = lag_features(table, [1, 3])
    assert "PRECTOTCORR_lag1" not in lagged.columns
    assert complete_rows(lagged).count() == 2 * 9


def test_anomalies_without_base_value_are_null(spark):
    rows = [(1, dt.datetime(2000, 1, 1), 2.0, 99), (1, dt.datetime(2020, 1, 1), 5.0, 99), (1, dt.datetime(2020, 2, 1), 5.0, 99),
            (None, dt.datetime(2000, 1, 1), 5.0, 99)]
    table = spark.createDataFrame(rows, "location_id long, time timestamp, T2M double, year int")
    got = anomalies(table, (1999, 2001)).orderBy("location_id", "time").collect()
    assert got[0].asDict().keys() == {"location_id", "time", "T2M", "T2M_anom"}
    assert [r["T2M_anom"] for r in got] == [None, 0.0, 3.0, None]


@pytest.fixture(scope="module")
def monthly(spark):
    """Ten places, fifteen years of months, as the stored cleaning report describes them."""
    rng = np.random.default_rng(11)
    rows = [(k, dt.datetime(y, m, 1)) for k in range(10) for y in range(2010, 2025) for m in range(1, 13)]
    pdf = pd.DataFrame(rows, columns=["location_id", "time"])
    for name in ("ALLSKY_SFC_SW_DWN", "PRECTOTCORR", "QV2M", "RH2M", "T2M", "T2M_MAX", "T2M_MIN"):
        pdf[name] = np.round(rng.gamma(2.0, 5.0, len(pdf)), 3)
    pdf["latitude"], pdf["longitude"] = pdf.location_id * 1.5, pdf.location_id * 2.5
    places = pd.DataFrame({"location_id": range(10), "grid_type": "city", "description": [f"C{i}" for i in range(10)]})
    return master_dataset(spark.createDataFrame(pdf), spark.createDataFrame(places), add_anomalies=False).cache()


def test_clean_training_and_inference(spark, monthly, tmp_path):
    cleaned, fitted = cleaning.clean(monthly, artifacts_folder=str(tmp_path))
    assert cleaned.count() == 1800 and len(cleaned.columns) == 19
    assert fitted.report["encoding"]["columns"] == ["grid_type", "season"]
    statistics = fitted.report["validation"]["statistics"]
    assert statistics["T2M"]["std"] == pytest.approx(math.sqrt(1800 / 1799))
    assert statistics["grid_type"]["max"] == 0.0  # constant
    assert statistics["season"]["max"] == pytest.approx(1.341641, abs=1e-6)
    assert statistics["latitude"]["mean"] == pytest.approx(0.0, abs=1e-9)  # places are scaled too
    assert fitted.report["validation"]["passed"] is True

    stored = artifacts.load_artifacts(spark, str(tmp_path))
    assert stored.report["scaling"]["method"] == "standard"
    again, _ = cleaning.clean(monthly, stored, with_report=False)
    key = ["location_id", "time"]
    untouched = [c for c in cleaned.columns if c not in fitted.report["outliers"]["columns"]]
    left = cleaned.select(*untouched).toPandas().sort_values(key, ignore_index=True)
    right = again.select(*untouched).toPandas().sort_values(key, ignore_index=True)
    pd.testing.assert_frame_equal(left, right)
    for c in fitted.report["outliers"]["columns"]:  # inference leaves outliers as they are
        assert again.agg({c: "max"}).first()[0] >= cleaned.agg({c: "max"}).first()[0]
    with pytest.raises(ValueError):
        cleaning.clean(monthly, artifacts.load_artifacts(spark, str(tmp_path / "nothing")), with_report=False)


def test_inference_refuses_unknown_categories(spark, monthly, tmp_path):
    _, fitted = cleaning.clean(monthly.where("season <> 'fall'"), with_report=False)
    frame, _ = cleaning.clean(monthly, fitted, with_report=False)
    with pytest.raises(PySparkException, match="unknown category in season: fall"):
        frame.collect()
