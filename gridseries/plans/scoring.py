"""Fit and apply a two-target anomaly model, and score landed windows request by request."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridseries.operators.features import (
    cyclical_month, deviation_from_mean, measured_features, relative_year_norm, season_dummies, transformed_features)
from gridseries.operators.network import Network, Training, fit_network
from gridseries.operators.scaling import Scaler, fit_scaler
from gridseries.schemas import FEATURES, TARGETS
from gridseries.session import path_exists, remove_path

REGRESSORS = {"linear": LinearRegression, "gbt": GBTRegressor}


@dataclass
class AnomalyModel:
    """A feature scaler and one fitted regressor per target; weights are plain Spark ML models."""

    scaler: Scaler
    regressors: dict[str, Transformer]
    features: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``<target>_predicted``; rows with a missing feature get NULL. Map-only."""
        scaled = self.scaler.expressions()
        names = {c: f"_x{i}" for i, c in enumerate(self.features)}
        frame = df.withColumns({names[c]: scaled.get(c, F.col(c).cast("double")) for c in self.features})
        complete = reduce(lambda a, b: a & b, [F.col(n).isNotNull() & ~F.isnan(n) for n in names.values()])
        # The assembler refuses NULLs: zeros stand in and the prediction is blanked below.
        frame = frame.withColumn("_complete", complete).fillna(0.0, list(names.values()))
        frame = VectorAssembler(
            inputCols=list(names.values()), outputCol="_features", handleInvalid="keep").transform(frame)
        for target, regressor in self.regressors.items():
            frame = regressor.transform(frame).withColumn(
                f"{target}_predicted", F.when(F.col("_complete"), F.col(f"_{target}")).cast("double")).drop(f"_{target}")
        return frame.drop(*names.values(), "_features", "_complete")

    def save(self, spark, folder: str) -> None:
        remove_path(spark, f"{folder}/network")  # a model of the other kind saved there before
        self.scaler.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/scaler")
        for target, regressor in self.regressors.items():
            PipelineModel([regressor]).write().overwrite().save(f"{folder}/{target}")

    @staticmethod
    def load(spark, folder: str, targets: list[str] = TARGETS, features: list[str] = FEATURES) -> AnomalyModel:
        scaler = Scaler.from_frame(spark.read.parquet(f"{folder}/scaler"))
        return AnomalyModel(
            scaler, {t: PipelineModel.load(f"{folder}/{t}").stages[0] for t in targets}, features)


def load_model(spark: SparkSession, folder: str, targets: list[str] = TARGETS,
               features: list[str] = FEATURES) -> AnomalyModel | Network:
    """A stored model of either kind."""
    if path_exists(spark, f"{folder}/network"):
        return Network.load(spark, folder)
    return AnomalyModel.load(spark, folder, targets, features)


def fit_joint_model(df: DataFrame, features: list[str] = FEATURES, targets: list[str] = TARGETS,
                    validation: str | None = None, how: Training = Training()) -> Network:
    """One network for all targets over all scaled features."""
    return fit_network(df, features, targets, validation, how)


def split_rows(df: DataFrame, keys: list[str], shares: tuple[float, float] = (0.70, 0.15),
               place: Column | None = None) -> DataFrame:
    """Add ``part``: train, validation or test, by ``place`` from 0 to 1, or a hash of the keys, the same in every run."""
    place = F.pmod(F.xxhash64(*keys), F.lit(10_000)) / 10_000 if place is None else place
    train, validation = shares
    return df.withColumn(
        "part", F.when(place < train, "train").when(place < train + validation, "validation").otherwise("test"))


def fit_anomaly_model(df: DataFrame, kind: str = "linear", features: list[str] = FEATURES,
                      targets: list[str] = TARGETS, validation: str | None = None, **options) -> AnomalyModel:
    """Scale the features and fit one regressor per target on the complete rows.

    ``validation`` names a boolean column: its rows do not train, they end the boosting where their loss stops falling.
    The scaler and a linear fit leave them out.
    """
    if kind not in REGRESSORS:
        raise ValueError(f"unknown regressor: {kind}")
    marked = df.select(*features, *targets, (F.col(validation) if validation else F.lit(False)).alias("_validation"))
    chosen = marked.dropna("any")
    scaler = fit_scaler(chosen.where("not _validation"), "standard", list(features))
    scaled = chosen.select(*[e.alias(c) for c, e in scaler.expressions().items()], *targets, "_validation")
    assembled = VectorAssembler(inputCols=list(features), outputCol="_features").transform(scaled)
    if validation and kind == "gbt":
        options["validationIndicatorCol"] = "_validation"
    else:
        assembled = assembled.where("not _validation")
    assembled = assembled.select("_features", *targets, "_validation").persist()
    try:
        regressors = {
            t: REGRESSORS[kind](featuresCol="_features", labelCol=t, predictionCol=f"_{t}", **options).fit(assembled)
            for t in targets
        }
    finally:
        assembled.unpersist()
    return AnomalyModel(scaler, regressors, list(features))


def prediction_errors(df: DataFrame, targets: list[str] = TARGETS) -> DataFrame:
    """``<parameter>_error``: actual minus predicted anomaly."""
    return df.withColumns({
        f"{t.removesuffix('_anom')}_error": F.col(t) - F.col(f"{t}_predicted") for t in targets})


def window_features(rows: DataFrame, request: list[str], scaler: Scaler | None = None) -> DataFrame:
    """Rows of trailing windows (date, year, month, parameters) with features and anomalies per request."""
    frame = season_dummies(cyclical_month(measured_features(rows, "scoring")), "quarter")
    frame = transformed_features(relative_year_norm(frame, request), scaler)
    return deviation_from_mean(frame, request)


def score_windows(rows: DataFrame, request: list[str], predict, scaler: Scaler | None = None) -> DataFrame:
    """One output row per month of each request; ``predict`` maps a frame to a frame with predictions."""
    scored = predict(window_features(rows, request, scaler))
    return scored.select(
        *request, F.date_format("date", "yyyy-MM").alias("date"),
        F.col("T2M_anom_predicted").alias("temperature_anomaly"),
        F.col("PRECTOTCORR_anom_predicted").alias("precipitation_anomaly"),
        F.col("T2M").alias("actual_temperature"),
        F.col("PRECTOTCORR").alias("actual_precipitation"))


def prediction_summary(scored: DataFrame, request: list[str],
                       columns: tuple[str, ...] = ("temperature_anomaly", "precipitation_anomaly")) -> DataFrame:
    """Mean, population deviation, minimum and maximum of each prediction, per request."""
    return scored.groupBy(*request).agg(*_summary(columns))


def _summary(columns: tuple[str, ...]) -> list[Column]:
    return [F.count(F.lit(1)).alias("samples"), *[agg(c).alias(f"{c}_{name}") for c in columns for name, agg in (
        ("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))]]


def response_records(scored: DataFrame, request: list[str], most: int = 60) -> DataFrame:
    """The nested answer per request: list and summary in one aggregate. A request over ``most`` months is an error.

    Months are counted before they are listed, and the list takes nothing of a request that is too long.
    """
    entry = F.struct("date", "temperature_anomaly", "precipitation_anomaly",
                     "actual_temperature", "actual_precipitation")
    summary = scored.groupBy(*request).agg(*_summary(("temperature_anomaly", "precipitation_anomaly")))
    too_long = F.raise_error(F.concat(F.lit(f"a request has more than {most} months: "), F.col("samples").cast("string")))
    checked = summary.withColumn("samples", F.when(F.col("samples") > most, too_long.cast("bigint")).otherwise(F.col("samples")))
    # The counted table carries the check: a row joins, and is listed, only once its request has passed.
    within = scored.alias("s").join(checked.alias("c"), [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in request])
    return within.groupBy(*[F.col(f"c.{c}").alias(c) for c in request], *[c for c in checked.columns if c not in request]).agg(
        F.array_sort(F.collect_list(entry)).alias("predictions")).select(
        *request, "predictions", *[c for c in checked.columns if c not in request])


def latest_rows(df: DataFrame, keys: list[str], order_by: list[str], count: int = 3) -> DataFrame:
    """The last rows per group; the rank filter cuts each group down before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_by])
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= count).drop("_rank")


def alerts(scored: DataFrame, column: str = "temperature_anomaly", threshold: float = 0.5) -> DataFrame:
    return scored.where(F.col(column) > threshold)


def damped_anomaly(weight: float = 0.5):
    """A closed-form stand-in for a fitted model: a fixed share of the request's own anomaly."""
    def predict(df: DataFrame) -> DataFrame:
        expressions: dict[str, Column] = {f"{t}_predicted": F.lit(weight) * F.col(t) for t in TARGETS}
        return df.withColumns(expressions)

    return predict
