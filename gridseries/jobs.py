"""Batch jobs: ``python -m gridseries.jobs <job> --help``. Paths may be on any file system Spark reads."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.baselines import lookup_baseline, monthly_normals, normals_by_month, normals_statistics
from gridseries.operators.evaluate import overall_loss, regression_metrics
from gridseries.operators.joins import missing_locations
from gridseries.operators.profile import column_table, dataset_summary, describe, describe_times
from gridseries.plans.cleaning import clean
from gridseries.plans.master import master_dataset
from gridseries.plans.scenario import assert_ranges, expand_months, predicted_values, prediction_records, scenario_features
from gridseries.plans.scoring import fit_anomaly_model, fit_joint_model, load_model, prediction_errors, split_rows
from gridseries.schemas import CLIMATE, MASTER, SCENARIO
from gridseries.session import build_session, path_exists, scratch_removed
from gridseries.sources import grids, manifests, responses, tables
from gridseries.streaming.landing import start_scoring

GRID_FILES = {"global": "locations_global_10deg.csv", "india": "locations_india_2deg.csv",
              "cities": "locations_major_cities.csv"}
TEST_LOCATIONS = 3


def choose_grid(spark: SparkSession, grid: str) -> DataFrame:
    if grid == "global":
        return grids.global_grid(spark)
    if grid == "india":
        return grids.india_grid(spark)
    if grid == "cities":
        return grids.city_locations(spark)
    raise ValueError(f"unknown grid: {grid}")


def acquire(spark: SparkSession, data: str, grid: str = "cities", start: int = 2010, end: int = 2024,
            test: bool = False, max_locations: int | None = None, packed: bool = False) -> DataFrame | None:
    """Write the grid and its request manifest; once responses have landed, the raw and master tables.

    A downloader outside Spark fetches the manifest's URLs into ``<data>/raw``. Gives the master table,
    or None while nothing has landed.
    """
    places = choose_grid(spark, grid)
    tables.write_csv(places, f"{data}/{GRID_FILES[grid]}")
    limit = TEST_LOCATIONS if test else max_locations
    wanted = grids.first_locations(places, limit) if limit else places
    manifest = manifests.monthly_manifest(wanted, start, end, whole_degrees=grid != "cities")
    tables.write_csv(manifests.with_landing_name(manifest, start, end), f"{data}/manifest_{grid}_{start}_{end}.csv")
    landing = f"{data}/raw"
    if not path_exists(spark, landing):
        return None
    read = responses.read_packed if packed else responses.read_landing
    rows = responses.monthly_rows(read(spark, landing)).drop("request")
    raw = responses.with_coordinates(rows, wanted).select(*CLIMATE.fieldNames())
    raw_path = f"{data}/climate_data_{grid}_{start}_{end}"
    if not tables.write_unless_empty(raw, raw_path):
        return None
    stored = tables.read_table(spark, raw_path)
    failed = missing_locations(wanted, stored)
    tables.write_csv(failed, f"{data}/failed_{grid}_{start}_{end}.csv")
    master = master_dataset(stored, wanted, add_anomalies=False)
    master_path = f"{data}/climate_master_{grid}_{start}_{end}"
    tables.write_master(master, master_path)
    return tables.read_table(spark, master_path).select(*MASTER.fieldNames())


def clean_table(spark: SparkSession, input_path: str, output_path: str | None = None,
                scale_method: str = "standard", outlier_method: str = "clip", handle_outliers: bool = True,
                models: str = "models", order_by: list[str] | None = None) -> DataFrame:
    """Train a cleaning run on a master table; writes the result, its statistics and the fitted tables."""
    frame = tables.read_table(spark, input_path, MASTER)
    cleaned, _ = clean(frame, None, scale_method, handle_outliers, outlier_method, order_by, models)
    target = output_path or tables.cleaned_path(input_path)
    tables.write_table(cleaned, target)
    stored = tables.read_table(spark, target, cleaned.schema)
    base = target.removesuffix(".csv")
    tables.write_csv(column_table(stored), f"{base}_columns.csv")
    tables.write_csv(describe(stored), f"{base}_summary.csv")
    tables.write_csv(describe_times(stored), f"{base}_times.csv")
    return stored


def make_baselines(spark: SparkSession, inputs: list[str], output: str) -> DataFrame:
    frame = tables.read_baseline_input(spark, inputs, MASTER)
    tables.write_baselines(monthly_normals(frame), output, f"{output.removesuffix('.csv')}_json")
    return tables.read_baselines(spark, output)


def predict_scenario(spark: SparkSession, lat: float, lon: float, year: int, month: int, months: int,
                     model_folder: str, baselines: str | None = None) -> DataFrame:
    request = spark.createDataFrame([(lat, lon, year, month, months)], SCENARIO)
    return predict_requests(spark, request, model_folder, baselines)


def predict_requests(spark: SparkSession, requests: DataFrame, model_folder: str,
                     baselines: str | None = None) -> DataFrame:
    """Predicted values for a table of requests (latitude, longitude, year, month, months)."""
    normals = tables.read_baselines(spark, baselines) if baselines else None
    asked = expand_months(assert_ranges(requests))
    frame = scenario_features(asked, normals, stored=True)
    return predicted_values(load_model(spark, model_folder).predict(frame))


def train(spark: SparkSession, input_path: str, model_folder: str, kind: str = "network") -> DataFrame:
    """Fit on 70 % of a model-ready table; gives the metrics on the test part."""
    rows = split_rows(spark.read.parquet(input_path), ["location_id", "time"])
    known = rows.where("part <> 'test'").withColumn("_held", F.col("part") == "validation")
    if kind == "network":
        model = fit_joint_model(known, validation="_held")
    else:
        model = fit_anomaly_model(known, kind, validation="_held")
    model.save(spark, model_folder)
    return regression_metrics(model.predict(rows.where("part = 'test'")))


def score_table(spark: SparkSession, input_path: str, model_folder: str, output: str) -> DataFrame:
    """Predictions and errors for a model-ready table; gives metrics and writes all rows."""
    scored = prediction_errors(load_model(spark, model_folder).predict(spark.read.parquet(input_path)))
    tables.write_table(scored, output)
    return spark.read.parquet(output)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gridseries")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("acquire")
    job.add_argument("--data", default="data")
    job.add_argument("--grid", choices=list(GRID_FILES), default="cities")
    job.add_argument("--start", type=int, default=2010)
    job.add_argument("--end", type=int, default=2024)
    job.add_argument("--test", action="store_true")
    job.add_argument("--max-locations", type=int)
    job.add_argument("--packed", action="store_true")

    job = jobs.add_parser("clean")
    job.add_argument("--input", required=True)
    job.add_argument("--output")
    job.add_argument("--scale-method", choices=["standard", "minmax", "robust"], default="standard")
    job.add_argument("--outlier-method", choices=["clip", "remove", "winsorize", "log_transform"], default="clip")
    job.add_argument("--no-handle-outliers", action="store_true")
    job.add_argument("--models", default="models")
    job.add_argument("--order-by", nargs="*")

    job = jobs.add_parser("baselines")
    job.add_argument("--calculate", action="store_true")
    job.add_argument("--test", action="store_true")
    job.add_argument("--input", nargs="*", default=[])
    job.add_argument("--output", required=True)
    job.add_argument("--lat", type=float)
    job.add_argument("--lon", type=float)
    job.add_argument("--month", type=int)

    job = jobs.add_parser("scenario")
    for name, kind in (("--lat", float), ("--lon", float), ("--year", int), ("--month", int)):
        job.add_argument(name, type=kind, required=True)
    job.add_argument("--months", type=int, default=1)
    job.add_argument("--model", required=True)
    job.add_argument("--baselines")

    job = jobs.add_parser("train")
    job.add_argument("--input", required=True)
    job.add_argument("--model", required=True)
    job.add_argument("--kind", choices=["linear", "gbt", "network"], default="network")

    job = jobs.add_parser("score")
    job.add_argument("--input", required=True)
    job.add_argument("--model", required=True)
    job.add_argument("--output", required=True)

    job = jobs.add_parser("stream")
    job.add_argument("--landing", required=True)
    job.add_argument("--model", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--alerts")
    job.add_argument("--packed", action="store_true")
    job.add_argument("--forever", action="store_true")

    options = parser.parse_args(arguments)
    spark = build_session()
    with scratch_removed(spark):
        run(spark, options)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.job == "acquire":
        master = acquire(spark, options.data, options.grid, options.start, options.end, options.test,
                         options.max_locations, options.packed)
        if master is not None:
            dataset_summary(master).show(truncate=False)
    elif options.job == "clean":
        clean_table(spark, options.input, options.output, options.scale_method, options.outlier_method,
                    not options.no_handle_outliers, options.models, options.order_by).show(5)
    elif options.job == "baselines":
        if options.calculate or not options.test:
            normals = make_baselines(spark, options.input, options.output)
            normals_statistics(normals).show()
            normals_by_month(normals).orderBy("month").show()
        if options.test:
            if None in (options.lat, options.lon, options.month):
                raise SystemExit("a lookup needs --lat, --lon and --month")
            point = spark.createDataFrame(
                [(options.lat, options.lon, options.month)], "latitude double, longitude double, month int")
            lookup_baseline(point, tables.read_baselines(spark, options.output), stored=True).show()
    elif options.job == "scenario":
        predicted = predict_scenario(spark, options.lat, options.lon, options.year, options.month, options.months,
                                     options.model, options.baselines)
        prediction_records(predicted).orderBy("date.year", "date.month").show(options.months, truncate=False)
    elif options.job == "train":
        train(spark, options.input, options.model, options.kind).show()
    elif options.job == "score":
        scored = score_table(spark, options.input, options.model, options.output)
        regression_metrics(scored).show()
        overall_loss(scored).show()
    elif options.job == "stream":
        start_scoring(spark, options.landing, options.output, options.checkpoint,
                      load_model(spark, options.model).predict, options.alerts, packed=options.packed,
                      once=not options.forever).awaitTermination()


if __name__ == "__main__":
    main()
