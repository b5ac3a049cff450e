"""Registered queries: each runs an operator over the given tables, whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions import columns as C
from gridseries.operators import (
    anomalies as A, baselines as B, duplicates as D, encoding as E, evaluate as V, features as X, infinite as I,
    joins as J, missing as M, nearest as N, ordered as O, outliers as U, profile as P, scaling as S, standardize as Z)
from gridseries.plans import artifacts, cleaning, master, normals as normal_store, scenario, scoring, views
from gridseries.schemas import CONTINUOUS, FEATURES, PARAMETERS, TARGETS, TEMPERATURES
from gridseries.session import materialize, materialize_observed, scratch_path
from gridseries.sources import grids, manifests, responses, tables
from gridseries.streaming import landing, pieces

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = (1995, 1998)
AS_OF = dt.date(2024, 12, 15)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Six places: sums of doubles depend on the order in which tasks finish."""
    return df.withColumns({c: C.half_even(F.col(c), places) for c in columns})


# Grids, manifests, responses


def _coverage(grid: DataFrame, places: DataFrame, south: float, west: float, step: int) -> DataFrame:
    """How many places fall to each grid point."""
    def snap(column: str, origin: float):
        return F.rint((F.col(column) - origin) / step) * step + F.lit(float(origin))

    counts = places.groupBy(snap("latitude", south).alias("latitude"), snap("longitude", west).alias("longitude")).agg(
        F.count(F.lit(1)).alias("places"))
    return grid.join(counts, ["latitude", "longitude"], "left").fillna(0, ["places"])


@query
def grid_global(spark, folder):
    return _coverage(grids.global_grid(spark), views.locations(spark, folder), -90, -180, 10)


@query
def grid_regional(spark, folder):
    places = views.locations(spark, folder)
    box = places.agg(F.floor(F.min("latitude")), F.ceil(F.max("latitude")),
                     F.floor(F.min("longitude")), F.ceil(F.max("longitude"))).first()
    south, north, west, east = (int(v) for v in box)
    return _coverage(grids.regional_grid(spark, south, north, west, east, 5), places, south, west, 5)


@query
def grid_india(spark, folder):
    return _coverage(grids.india_grid(spark), views.locations(spark, folder), 8, 68, 2)


@query
def first_locations(spark, folder):
    return grids.first_locations(views.locations(spark, folder), 3)


@query
def manifest_monthly(spark, folder):
    places = views.locations(spark, folder).select("location_id", "latitude", "longitude")
    return manifests.with_landing_name(manifests.monthly_manifest(places, 2010, 2024), 2010, 2024)


@query
def manifest_climatology(spark, folder):
    places = views.locations(spark, folder).select("location_id", "latitude", "longitude")
    return manifests.climatology_manifest(places, 2010, 2024, ["T2M", "T2M_MAX"])


@query
def manifest_indicators(spark, folder):
    places = views.locations(spark, folder).select("location_id", "latitude", "longitude")
    return manifests.indicators_manifest(places, 2001, 2016)


@query
def manifest_window(spark, folder):
    asked = views.requests(spark, folder).select(
        "request_id", "latitude", "longitude", (12 + F.col("request_id") % 49).cast("int").alias("months_back"))
    return manifests.window_manifest(asked, AS_OF)


@query
def json_unpivot(spark, folder):
    return responses.monthly_rows(responses.parse_text(views.responses(spark, folder), "response")).drop("request")


@query
def json_climatology(spark, folder):
    rows = responses.climatology_rows(responses.parse_text(views.responses(spark, folder), "response"))
    return rounded(rows, *PARAMETERS)


@query
def json_window(spark, folder):
    rows = responses.window_rows(responses.parse_text(views.responses(spark, folder), "response"))
    return responses.with_coordinates(rows, views.locations(spark, folder))


@query
def failed_locations(spark, folder):
    landed = views.series(spark, folder).where(F.col("T2M_MAX") < 50).select("location_id")
    return J.missing_locations(views.requests(spark, folder).withColumnRenamed("request_id", "location_id"), landed)


@query
def union_by_name(spark, folder):
    frame = views.series(spark, folder)
    early = A.in_period(frame, PERIOD).drop("QV2M")
    late = A.in_period(frame, (1999, 2100)).select("time", "location_id", "QV2M", "T2M")
    return responses.union_all([early, late])


@query
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "dirty") + ".csv"
    frame = views.unique_dirty(spark, folder)
    tables.write_table(frame, path)
    return tables.read_csv(spark, path, frame.schema)


# Features


@query
def location_join(spark, folder):
    return J.join_location_metadata(views.series(spark, folder), views.locations(spark, folder))


@query
def climatology(spark, folder):
    return rounded(A.climatology(views.series(spark, folder), PERIOD), *[f"{p}_baseline" for p in TEMPERATURES])


@query
def anomaly(spark, folder):
    result = A.anomalies(views.series(spark, folder), PERIOD)
    return rounded(result.select("location_id", "time", *[f"{p}_anom" for p in TEMPERATURES]),
                   *[f"{p}_anom" for p in TEMPERATURES])


@query
def lags(spark, folder):
    # The view has one row per location and month, which bounds a group by the number of months.
    return X.lag_features(views.series(spark, folder), block_rows=None)


@query
def lags_cut(spark, folder):
    return X.lag_features(materialize(views.series(spark, folder), "series"), block_rows=O.BLOCK_ROWS)


@query
def lags_complete(spark, folder):
    return X.complete_rows(X.lag_features(views.series(spark, folder), block_rows=None))


@query
def derived(spark, folder):
    return rounded(X.derived_features(views.series(spark, folder)), "T2M_range", "heat_index", "precip_log")


@query
def calendar_scoring(spark, folder):
    frame = X.calendar_features(X.measured_features(views.series(spark, folder), "scoring"))
    frame = X.season_dummies(X.fixed_year_norm(X.cyclical_month(frame), first=1995, last=2001))
    return rounded(
        frame.select("location_id", "time", "heat_index", "month_sin", "month_cos", "year_norm", "season_Fall",
                     "season_Spring", "season_Summer", "season_Winter"),
        "heat_index", "month_sin", "month_cos", "year_norm")


@query
def season_quarter(spark, folder):
    frame = views.series(spark, folder).withColumn("month", F.month("time"))
    frame = X.season_dummies(frame, "quarter").withColumn("quarter_season", C.quarter_season_of(F.col("month")))
    return frame.select("location_id", "time", "quarter_season", "season_Fall", "season_Spring", "season_Summer",
                        "season_Winter")


@query
def window_anomaly(spark, folder):
    result = X.deviation_from_mean(views.series(spark, folder), ["location_id"])
    return rounded(result.select("location_id", "time", *TARGETS), *TARGETS)


@query
def year_norm(spark, folder):
    frame = views.series(spark, folder).withColumn("year", F.year("time"))
    return rounded(X.relative_year_norm(frame, ["location_id"]).select("location_id", "time", "year_norm"), "year_norm")


@query
def transformed(spark, folder):
    frame = views.series(spark, folder)
    scaler = S.fit_scaler(frame, "standard", ["T2M", "RH2M"])
    names = [f"{c}_transformed" for c in CONTINUOUS]
    return rounded(X.transformed_features(frame, scaler).select("location_id", "time", *names), *names)


@query
def master_table(spark, folder):
    result = master.master_dataset(views.series(spark, folder), views.locations(spark, folder),
                                   baseline_period=PERIOD, add_lags=True, block_rows=None)
    return rounded(result, *[f"{p}_anom" for p in TEMPERATURES], "T2M_range", "heat_index", "precip_log")


# Baselines


def _located(spark, folder) -> DataFrame:
    places = views.locations(spark, folder).select("location_id", "latitude", "longitude")
    return J.lookup_join(views.series(spark, folder), places, ["location_id"])


def _normals(spark, folder) -> DataFrame:
    return B.monthly_normals(_located(spark, folder))


@query
def baselines(spark, folder):
    return rounded(_normals(spark, folder), "baseline_temp", "baseline_precip")


@query
def baselines_landed(spark, folder):
    """The same normals from states: two landings, the second twice."""
    store = scratch_path(spark, "normals")
    located = _located(spark, folder)
    early = F.year("time") < 1996
    normal_store.land_normals(located.where(early), store, "early")
    for _ in range(2):
        normal_store.land_normals(located.where(~early), store, "late")
    return rounded(normal_store.stored_normals(spark, store), "baseline_temp", "baseline_precip")


@query
def baseline_keys(spark, folder):
    return rounded(tables.keyed_baselines(_normals(spark, folder)), "temperature", "precipitation")


@query
def baseline_stats(spark, folder):
    result = B.normals_statistics(_normals(spark, folder))
    return rounded(result, *[c for c in result.columns if c not in ("normals", "places")])


@query
def baseline_by_month(spark, folder):
    return rounded(B.normals_by_month(_normals(spark, folder)), "baseline_temp", "baseline_precip")


@query
def baseline_exact(spark, folder):
    normals = materialize(_normals(spark, folder), "normals")
    result = B.exact_baseline(views.requests(spark, folder), normals, stored=True)
    return rounded(result, "baseline_temp", "baseline_precip")


@query
def baseline_nearest(spark, folder):
    normals = materialize(_normals(spark, folder), "normals")
    result = N.nearest_baseline(views.requests(spark, folder), normals)
    return rounded(result, "baseline_temp", "baseline_precip", "distance")


@query
def baseline_lookup(spark, folder):
    normals = materialize(_normals(spark, folder), "normals")
    asked = materialize(scenario.expand_months(views.requests(spark, folder)), "requests")
    result = B.lookup_baseline(asked, normals, stored=True)
    return rounded(result, "baseline_temp", "baseline_precip", "distance")


# Quality


@query
def null_profile(spark, folder):
    return rounded(P.missing_profile(views.dirty(spark, folder)).drop("position"), "percent")


@query
def top_missing(spark, folder):
    return rounded(P.top_missing(views.dirty(spark, folder), 2), "percent")


@query
def inf_profile(spark, folder):
    return P.infinity_profile(views.dirty(spark, folder)).drop("position")


@query
def column_table(spark, folder):
    return P.column_table(views.dirty(spark, folder))


@query
def dup_profile(spark, folder):
    return rounded(P.duplicate_profile(views.dirty(spark, folder)), "percent")


@query
def dataset_summary(spark, folder):
    return P.dataset_summary(views.series(spark, folder))


_STATISTICS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@query
def describe(spark, folder):
    frame = materialize(views.series(spark, folder), "series")
    return rounded(P.describe(frame, PARAMETERS), *_STATISTICS)


@query
def describe_selected(spark, folder):
    frame = materialize(views.series(spark, folder), "series")
    return rounded(P.describe(frame, PARAMETERS, gather_rows=300), *_STATISTICS)


@query
def describe_times(spark, folder):
    return P.describe_times(views.unique_dirty(spark, folder).select("time"))


@query
def validate(spark, folder):
    return P.validation_report(views.dirty(spark, folder))


# Missing values


@query
def fill_mean(spark, folder):
    return rounded(M.fill_missing(views.series_gaps(spark, folder), "mean"), "T2M", "RH2M")


@query
def fill_median(spark, folder):
    return rounded(M.fill_missing(views.unique_dirty(spark, folder), "median"), "RH2M")


@query
def fill_mode(spark, folder):
    return M.fill_missing(views.unique_dirty(spark, folder), "mode")


@query
def fill_ffill(spark, folder):
    return M.fill_missing(views.unique_dirty(spark, folder), "forward_fill", ["event_id"])


@query
def fill_interp_all(spark, folder):
    result = M.fill_missing(views.unique_dirty(spark, folder), "interpolate", ["event_id"])
    return rounded(result, "T2M", "RH2M")


@query
def fill_interp_group(spark, folder):
    result = O.interpolate(views.unique_dirty(spark, folder), ["T2M", "RH2M"], ["location_id"], ["time", "event_id"])
    return rounded(C.nan_to_null(result), "T2M", "RH2M")


@query
def fill_interp_cut(spark, folder):
    result = O.interpolate(views.unique_dirty(spark, folder), ["T2M", "RH2M"], ["location_id"], ["time", "event_id"],
                           O.BLOCK_ROWS)
    return rounded(C.nan_to_null(result), "T2M", "RH2M")


@query
def fill_drop(spark, folder):
    return M.fill_missing(views.unique_dirty(spark, folder), "drop")


@query
def fill_smart(spark, folder):
    result = M.fill_missing(views.unique_dirty(spark, folder), "smart", ["event_id"])
    return rounded(result, "T2M", "RH2M")


# Infinities, duplicates, format


@query
def inf_replace(spark, folder):
    return rounded(I.handle_infinite(views.dirty(spark, folder), "replace"), "T2M")


@query
def inf_drop(spark, folder):
    return I.handle_infinite(views.dirty(spark, folder), "drop")


@query
def inf_clip(spark, folder):
    return I.handle_infinite(views.dirty(spark, folder), "clip")


@query
def dedup_all(spark, folder):
    return D.remove_duplicates(views.dirty(spark, folder))


@query
def dedup_first(spark, folder):
    return D.remove_duplicates(views.dirty(spark, folder), ["location_id", "season"], "first", ["time", "event_id"])


@query
def dedup_last(spark, folder):
    return D.remove_duplicates(views.dirty(spark, folder), ["location_id", "season"], "last", ["time", "event_id"])


@query
def dedup_none(spark, folder):
    return D.remove_duplicates(views.dirty(spark, folder), None, False)


@query
def standardize(spark, folder):
    return Z.standardize_format(views.derived_dirty(spark, folder))


# Outliers


_CHECKED = ["RH2M", "PRECTOTCORR"]


@query
def outlier_iqr(spark, folder):
    found = U.detect_outliers(views.unique_dirty(spark, folder), "iqr", 1.5, _CHECKED)
    return rounded(U.outlier_frame(spark, found), "percent", "lower_bound", "upper_bound")


@query
def outlier_z(spark, folder):
    found = U.detect_outliers(views.unique_dirty(spark, folder), "zscore", 3.0, _CHECKED)
    return rounded(U.outlier_frame(spark, found).select("column", "count", "percent"), "percent")


@query
def top_outliers(spark, folder):
    found = U.detect_outliers(views.unique_dirty(spark, folder), "iqr", 1.5, _CHECKED)
    return U.top_outliers(spark, found, 1).select("column", "count")


@query
def outlier_flags(spark, folder):
    frame = views.unique_dirty(spark, folder).select("event_id", *_CHECKED)
    return U.flag_outliers(frame, U.detect_outliers(frame, "iqr", 1.5, _CHECKED))


@query
def treat_clip(spark, folder):
    frame = views.unique_dirty(spark, folder).select("event_id", *_CHECKED)
    result = U.treat_outliers(frame, "clip", U.detect_outliers(frame, "iqr", 3.0, _CHECKED))
    return rounded(result, *_CHECKED)


@query
def treat_remove(spark, folder):
    frame = views.unique_dirty(spark, folder).select("event_id", *_CHECKED)
    return U.treat_outliers(frame, "remove", U.detect_outliers(frame, "iqr", 3.0, _CHECKED))


@query
def treat_winsorize(spark, folder):
    frame = views.unique_dirty(spark, folder).select("event_id", *_CHECKED)
    return U.winsorize(frame, _CHECKED, gather_rows=200)


@query
def treat_log(spark, folder):
    frame = views.unique_dirty(spark, folder).select("event_id", *_CHECKED)
    found = U.detect_outliers(frame, "iqr", 1.5, _CHECKED)
    result = U.treat_outliers(frame, "log_transform", found, logged=["PRECTOTCORR"])
    return rounded(result, "PRECTOTCORR_log")


# Scaling, encoding, the whole cleaning run


def _scaled(frame: DataFrame, method: str) -> DataFrame:
    scaled, _ = S.scale_features(frame.select("location_id", "time", *PARAMETERS), method)
    return rounded(scaled, *PARAMETERS)


@query
def scale_standard(spark, folder):
    return _scaled(views.series(spark, folder), "standard")


@query
def scale_minmax(spark, folder):
    return _scaled(views.series(spark, folder), "minmax")


@query
def scale_robust(spark, folder):
    return _scaled(materialize(views.series(spark, folder), "series"), "robust")


@query
def scale_apply(spark, folder):
    frame = views.series(spark, folder).select("location_id", "time", *PARAMETERS)
    saved = scratch_path(spark, "artifacts")
    artifacts.save_artifacts(spark, artifacts.Fitted(S.fit_scaler(A.in_period(frame, PERIOD))), saved)
    return rounded(artifacts.load_artifacts(spark, saved).scaler.apply(frame), *PARAMETERS)


def _texts(spark, folder) -> DataFrame:
    return Z.standardize_format(views.unique_dirty(spark, folder).select("event_id", "season"))


@query
def onehot(spark, folder):
    frame = _texts(spark, folder)
    return E.apply_onehot(frame, E.fit_categories(frame, ["season"]))


@query
def onehot_apply(spark, folder):
    fitted = E.fit_categories(_texts(spark, folder), ["season"])
    batch = _texts(spark, folder).where(F.col("season") != "click")
    return E.apply_onehot(batch, fitted)


@query
def onehot_many(spark, folder):
    """A column with more categories than a table can have columns."""
    frame = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_name")
    categories = materialize(E.fit_categories(frame, ["c_name"]), "categories")
    vector = F.col("c_name_onehot")
    return E.apply_onehot(frame, categories, "vector").select(
        "c_custkey", vector["size"].alias("size"), F.coalesce(F.get(vector["indices"], 0), F.lit(-1)).alias("index"))


@query
def label_encode(spark, folder):
    frame = _texts(spark, folder)
    return E.apply_labels(frame, E.fit_categories(frame, ["season"]))


@query
def label_encode_many(spark, folder):
    """One category per customer name: beyond the constants, codes come by a join."""
    frame = views.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    categories = materialize(E.fit_categories(frame), "categories")
    return E.apply_labels(frame, categories)


@query
def clean_all(spark, folder):
    """The whole training run, with profile, validation and stored artifacts."""
    return rounded(_cleaned(spark, folder)[0], *_CLEANED)


_CLEANED = ["event_id", "T2M", "RH2M", "PRECTOTCORR", "season"]


def _cleaned(spark, folder) -> tuple[DataFrame, str]:
    models = scratch_path(spark, "models")
    cleaned, _ = cleaning.clean(views.dirty(spark, folder), order_by=["event_id"], artifacts_folder=models)
    return cleaned, models


@query
def clean_apply(spark, folder):
    """Inference: the encoder and scaler of an earlier run are read back and applied."""
    fitted = artifacts.load_artifacts(spark, _cleaned(spark, folder)[1])
    applied, _ = cleaning.clean(views.dirty(spark, folder), fitted, order_by=["event_id"], with_report=False)
    return rounded(applied, *_CLEANED)


@query
def clean_report(spark, folder):
    """The stored report of a training run, one row per figure."""
    report = artifacts.load_artifacts(spark, _cleaned(spark, folder)[1]).report
    quality, final = report["quality"], report["validation"]
    rows = [("missing", c, float(x["count"])) for c, x in quality["missing_values"].items()]
    rows += [("infinite", c, float(x)) for c, x in quality["inf_values"].items()]
    rows += [("duplicates", "all", float(quality["duplicates"]["count"]))]
    rows += [("validation", name, float(final[name])) for name in (
        "total_rows", "total_columns", "missing_values", "duplicate_rows", "infinite_values", "passed")]
    rows += [("deviation", c, float(x["std"])) for c, x in final["statistics"].items() if c in _CLEANED]
    return rounded(spark.createDataFrame(rows, "section string, item string, value double"), "value")


# Scenarios


@query
def range_check(spark, folder):
    asked = views.requests(spark, folder).select(
        "request_id", (F.col("latitude") * 1.2).alias("latitude"), (F.col("longitude") * 1.05).alias("longitude"),
        F.when(F.col("request_id") % 17 == 0, 13).otherwise(F.col("month")).alias("month"),
        (10 + F.col("request_id") % 60).cast("int").alias("months_back"))
    return scenario.check_ranges(asked).select("request_id", "valid", "reason")


@query
def scenario_months(spark, folder):
    return scenario.expand_months(views.requests(spark, folder)).select("request_id", "year", "month")


_ESTIMATES = ["T2M", "T2M_MAX", "T2M_MIN", "PRECTOTCORR", "RH2M", "ALLSKY_SFC_SW_DWN", "QV2M"]


@query
def scenario_zone(spark, folder):
    result = scenario.estimate_climate(views.requests(spark, folder).drop("months"))
    return rounded(result.select("request_id", *_ESTIMATES), *_ESTIMATES)


@query
def scenario_baseline(spark, folder):
    result = scenario.estimate_climate(
        views.requests(spark, folder).drop("months"), materialize(_normals(spark, folder), "normals"), stored=True)
    return rounded(result.select("request_id", "estimated_from", *_ESTIMATES), *_ESTIMATES)


def _scenarios(spark, folder) -> DataFrame:
    asked = scenario.expand_months(views.requests(spark, folder))
    return scenario.scenario_features(asked, materialize(_normals(spark, folder), "normals"), stored=True)


@query
def scenario_features(spark, folder):
    result = scenario.feature_matrix(_scenarios(spark, folder), ["request_id", "year", "month"])
    return rounded(result, *[c for c in FEATURES if not c.startswith("season_")])


def _predicted(spark, folder) -> DataFrame:
    """A closed-form anomaly per scenario, so that the values can be checked."""
    frame = _scenarios(spark, folder).withColumns({
        "T2M_anom_predicted": (F.col("request_id") % 7 - 3) / F.lit(20.0),
        "PRECTOTCORR_anom_predicted": (F.col("request_id") % 11 - 5) * F.lit(30.0),
    })
    return scenario.predicted_values(frame)


@query
def predict_value(spark, folder):
    result = _predicted(spark, folder).select(
        "request_id", "year", "month", "baseline_temp", "baseline_precip", "predicted_temp", "predicted_precip")
    return rounded(result, "baseline_temp", "baseline_precip", "predicted_temp", "predicted_precip")


@query
def labels(spark, folder):
    frame = _predicted(spark, folder)
    names = ("T2M_anom_predicted", "PRECTOTCORR_anom_predicted")
    frame = scenario.three_way_labels(scenario.two_way_labels(frame, *names), *names)
    return frame.select("request_id", "year", "month", "temperature_label", "precipitation_label",
                        "temperature_status", "precipitation_status")


@query
def prediction_records(spark, folder):
    records = scenario.prediction_records(_predicted(spark, folder))
    return rounded(
        records.select(
            "location.latitude", "location.longitude", "date.year", "date.month", "date.month_name",
            F.col("predictions.temperature").alias("temperature"),
            F.col("predictions.precipitation").alias("precipitation"),
            F.col("interpretation.temperature").alias("temperature_label")),
        "temperature", "precipitation")


# Scoring and evaluation


def _windows(spark, folder) -> DataFrame:
    return views.series(spark, folder).withColumnRenamed("time", "date").withColumns(
        {"year": F.year("date"), "month": F.month("date")})


def _scored(spark, folder) -> DataFrame:
    return scoring.score_windows(_windows(spark, folder), ["location_id"], scoring.damped_anomaly())


def _judged(spark, folder) -> DataFrame:
    frame = X.deviation_from_mean(views.series(spark, folder), ["location_id"])
    return scoring.prediction_errors(scoring.damped_anomaly()(frame))


_SCORED = ["temperature_anomaly", "precipitation_anomaly", "actual_temperature", "actual_precipitation"]


@query
def score_closed_form(spark, folder):
    return rounded(_scored(spark, folder), *_SCORED)


@query
def prediction_errors(spark, folder):
    result = _judged(spark, folder).select("location_id", "time", "T2M_error", "PRECTOTCORR_error")
    return rounded(result, "T2M_error", "PRECTOTCORR_error")


@query
def metrics(spark, folder):
    return rounded(V.regression_metrics(_judged(spark, folder)), "mae", "rmse", "r2")


@query
def overall_loss(spark, folder):
    return rounded(V.overall_loss(_judged(spark, folder)), "loss", "mae", "rmse")


@query
def prediction_summary(spark, folder):
    result = scoring.prediction_summary(_scored(spark, folder), ["location_id"])
    return rounded(result, *[c for c in result.columns if "anomaly" in c])


@query
def error_histogram(spark, folder):
    errors = views.unique_dirty(spark, folder).select((F.col("PRECTOTCORR") - 10).alias("error"))
    return rounded(V.error_histogram(errors, "error"), "low", "high")


@query
def error_histogram_saved(spark, folder):
    """Both errors of stored predictions, their ranges and means observed while they are written."""
    columns = [f"{t}_error" for t in ("T2M", "PRECTOTCORR")]
    errors = rounded(_judged(spark, folder), *columns)
    saved, seen = materialize_observed(errors, "predictions", V.error_metrics(columns))
    found = [V.error_histogram(saved, c, seen=seen).withColumns(
        {"column": F.lit(c), "mean_error": F.lit(seen[f"mean of {c}"])}) for c in columns]
    return rounded(found[0].unionByName(found[1]), "low", "high", "mean_error")


@query
def last_three(spark, folder):
    result = scoring.latest_rows(_scored(spark, folder), ["location_id"], ["date"], 3)
    return rounded(result, *_SCORED)


@query
def alerts(spark, folder):
    return rounded(scoring.alerts(_scored(spark, folder)), *_SCORED)


@query
def response_records(spark, folder):
    records = scoring.response_records(_scored(spark, folder), ["location_id"], most=120)
    first, last = F.col("predictions")[0]["date"], F.element_at("predictions", -1)["date"]
    total = F.aggregate("predictions", F.lit(0.0), lambda s, p: s + p["actual_temperature"])
    listed = records.select("*", F.size("predictions").alias("listed"), first.alias("first_date"), last.alias("last_date"),
                            total.alias("actual_total")).drop("predictions")
    return rounded(listed, "actual_total", *[c for c in listed.columns if "_anomaly_" in c])


@query
def score_stream(spark, folder):
    """Lands the series as packed responses, scores them as a stream and reads the sink."""
    parsed = responses.parse_text(views.responses(spark, folder), "response")
    inbox, sink, mark = (scratch_path(spark, n) for n in ("landing", "scored", "stream"))
    parsed.write.json(inbox)
    landing.start_scoring(spark, inbox, sink, mark, scoring.damped_anomaly(), files_per_trigger=4,
                          packed=True).awaitTermination()
    return rounded(landing.read_scored(spark, sink).drop("batch_id"), *_SCORED)


@query
def score_pieces(spark, folder):
    """Lands every third month of each window in another file, and collects, closes and scores the windows as a stream."""
    parsed, seen = materialize_observed(responses.parse_text(views.responses(spark, folder), "response"), "windows",
                                        [F.count(F.lit(1)).alias("windows")])
    files = max(8, -(-seen["windows"] // 100_000))  # what one trigger takes, or larger files than that would be
    by_parameter = F.col("properties.parameter")

    def third(k: int):
        some = F.transform_values(by_parameter, lambda _, months: F.map_filter(
            months, lambda period, _: F.substr(period, F.lit(5), F.lit(2)).cast("int") % 3 == k))
        return F.struct(some.alias("parameter"))

    whole = F.size(F.filter(F.map_keys(F.map_values(by_parameter)[0]), lambda p: ~F.endswith(p, F.lit("13"))))
    inbox, sink, mark = (scratch_path(spark, n) for n in ("pieces", "scored", "stream"))
    for k in range(3):
        landed = F.to_timestamp(F.lit(f"2024-01-01 0{k}:00:00"))
        parsed.select("location_id", "request", whole.alias("months"), landed.alias("landed_at"),
                      third(k).alias("properties")).coalesce(files).write.mode("append").json(inbox)
    pieces.start_scoring_pieces(spark, inbox, sink, mark, scoring.damped_anomaly(), files_per_trigger=8).awaitTermination()
    return rounded(landing.read_scored(spark, sink).drop("batch_id"), *_SCORED)


def _placed_windows(spark, folder) -> DataFrame:
    return responses.with_coordinates(_windows(spark, folder), views.locations(spark, folder))


def _model_rows(spark, folder) -> DataFrame:
    """Windows with all features, split by an arithmetic of place and month that SQL can state as well."""
    place = (F.col("location_id") * 7 + F.col("year") * 13 + F.col("month") * 3) % 20 / 20
    rows = scoring.window_features(_placed_windows(spark, folder), ["location_id"])
    return materialize(scoring.split_rows(rows, ["location_id", "date"], place=place), "model-rows")


def _line_model(rows: DataFrame) -> scoring.AnomalyModel:
    """With one feature the fit is the regression line."""
    return scoring.fit_anomaly_model(rows.where("part = 'train'"), "linear", features=["T2M"])


@query
def score_model(spark, folder):
    rows = _model_rows(spark, folder)
    scored = scoring.prediction_errors(_line_model(rows).predict(rows))
    numbers = [*TARGETS, *[f"{t}_predicted" for t in TARGETS], "T2M_error", "PRECTOTCORR_error"]
    return rounded(scored.select("location_id", "date", "part", *numbers), *numbers)


@query
def predict_windows(spark, folder):
    """Trailing windows through features, scaler and fitted model."""
    model = _line_model(_model_rows(spark, folder))
    return rounded(scoring.score_windows(_placed_windows(spark, folder), ["location_id"], model.predict), *_SCORED)


@query
def model_metrics(spark, folder):
    """Boosted trees with a validation part, on targets that are steps of one feature, so that they are met."""
    steps = {"T2M_anom": F.when(F.col("month") <= 6, 1.0).otherwise(3.0),
             "PRECTOTCORR_anom": F.when(F.col("month") <= 3, -2.0).otherwise(0.5)}
    rows = _model_rows(spark, folder).withColumns(steps).withColumn("held", F.col("part") == "validation")
    model = scoring.fit_anomaly_model(rows.where("part <> 'test'"), "gbt", features=["month"], validation="held")
    return rounded(V.regression_metrics(model.predict(rows.where("part = 'test'"))), "mae", "rmse", "r2", places=4)


def _joint_model(rows: DataFrame):
    known = rows.where("part <> 'test'").withColumn("held", F.col("part") == "validation")
    return scoring.fit_joint_model(known, validation="held")


@query
def score_network(spark, folder):
    """All 18 scaled features to both targets by one network."""
    rows = _model_rows(spark, folder)
    scored = scoring.prediction_errors(_joint_model(rows).predict(rows))
    numbers = [*TARGETS, *[f"{t}_predicted" for t in TARGETS], "T2M_error", "PRECTOTCORR_error"]
    return rounded(scored.select("location_id", "date", "part", *numbers), *numbers)


@query
def network_metrics(spark, folder):
    rows = _model_rows(spark, folder)
    judged = _joint_model(rows).predict(rows.where("part = 'test'"))
    return rounded(V.regression_metrics(judged), "mae", "rmse", "r2", places=4)


@query
def predict_network(spark, folder):
    """Trailing windows through all 18 features and the fitted network, with the nested answers' summaries."""
    model = _joint_model(_model_rows(spark, folder))
    return rounded(scoring.score_windows(_placed_windows(spark, folder), ["location_id"], model.predict), *_SCORED)
