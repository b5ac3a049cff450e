"""A dense network with several outputs, fitted by sums of gradients over the partitions of a table.

Every epoch is one pass: a task adds up loss and gradient of its rows for the weights it was sent, and sends one row of
fixed size. Rows of more than ``FAN_IN`` tasks are added in a tree before they reach the driver, which makes one Adam step. The
start is seeded and sums are added in order of the tasks, so a table cut in the same way gives the same weights.
Scoring is column arithmetic without Python.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.scaling import Scaler, fit_scaler
from gridseries.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # task functions need no copy of the package on executors

FAN_IN = 64
BLOCK_ROWS = 8192
BETA_1, BETA_2, TINY = 0.9, 0.999, 1e-8


@dataclass(frozen=True)
class Training:
    """How a network is fitted. It stops after ``patience`` epochs without a lower validation loss (training loss without such rows)."""

    hidden: tuple[int, ...] = (16,)
    epochs: int = 60
    rate: float = 0.03
    patience: int = 10
    seed: int = 7


@dataclass
class Network:
    """Scaled features through tanh layers to scaled targets; ``history`` has (training, validation) loss by epoch."""

    scaler: Scaler
    target_scaler: Scaler
    features: list[str]
    targets: list[str]
    layers: list[tuple[np.ndarray, np.ndarray]]
    history: list[tuple[float, float | None]] = field(default_factory=list)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``<target>_predicted``; rows with a missing feature get NULL. Map-only."""
        mark = "_"
        while any(c.lower().startswith((f"{mark}in", f"{mark}unit")) for c in df.columns):
            mark += "_"
        scaled = self.scaler.expressions()
        names = [f"{mark}in{i}" for i in range(len(self.features))]
        frame = df.withColumns({n: _known(scaled[c]) for n, c in zip(names, self.features, strict=True)})
        made = list(names)
        for k, (weights, biases) in enumerate(self.layers):
            sums = [_weighted(names, weights[:, j], biases[j]) for j in range(len(biases))]
            if k == len(self.layers) - 1:
                scales, centers = self.target_scaler.scales, self.target_scaler.centers
                frame = frame.withColumns({f"{t}_predicted": s * F.lit(scales[t]) + F.lit(centers[t])
                                           for t, s in zip(self.targets, sums, strict=True)})
            else:
                names = [f"{mark}unit{k}_{j}" for j in range(len(biases))]
                made += names
                frame = frame.withColumns({n: F.tanh(s) for n, s in zip(names, sums, strict=True)})
        return frame.drop(*made)

    def save(self, spark: SparkSession, folder: str) -> None:
        self.scaler.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/scaler")
        self.target_scaler.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/targets")
        rows = [(k, biases.tolist(), weights.tolist()) for k, (weights, biases) in enumerate(self.layers)]
        spark.createDataFrame(rows, "layer int, biases array<double>, weights array<array<double>>").coalesce(1).write.mode(
            "overwrite").parquet(f"{folder}/network")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Network:
        scaler, target_scaler = (Scaler.from_frame(spark.read.parquet(f"{folder}/{n}")) for n in ("scaler", "targets"))
        rows = sorted(spark.read.parquet(f"{folder}/network").collect(), key=lambda r: r["layer"])
        layers = [(np.array(r["weights"], float), np.array(r["biases"], float)) for r in rows]
        return Network(scaler, target_scaler, list(scaler.centers), list(target_scaler.centers), layers)


def _known(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def _weighted(names: list[str], weights: np.ndarray, bias: float) -> Column:
    total = F.lit(float(bias))
    for name, weight in zip(names, weights.tolist(), strict=True):
        total = total + F.col(name) * F.lit(weight)
    return total


def start_weights(sizes: list[int], seed: int) -> np.ndarray:
    """Seeded uniform weights in the range that keeps tanh units unsaturated, zero biases, as one flat array."""
    rng = np.random.default_rng(seed)
    parts = []
    for before, after in zip(sizes, sizes[1:], strict=False):
        limit = np.sqrt(6.0 / (before + after))
        parts += [rng.uniform(-limit, limit, before * after), np.zeros(after)]
    return np.concatenate(parts)


def in_layers(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for before, after in zip(sizes, sizes[1:], strict=False):
        weights = flat[at: at + before * after].reshape(before, after)
        at += before * after
        out.append((weights, flat[at: at + after]))
        at += after
    return out


def forward(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    """The values of all layers, the input first."""
    values = [x]
    for k, (weights, biases) in enumerate(layers):
        sums = values[-1] @ weights + biases
        values.append(np.tanh(sums) if k < len(layers) - 1 else sums)
    return values


def squared_error(flat: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of squared errors over rows and targets, and its gradient."""
    layers = in_layers(flat, sizes)
    values = forward(layers, x)
    away, parts = values[-1] - y, []
    loss, slope = float((away**2).sum()), 2 * away
    for k in range(len(layers) - 1, -1, -1):
        parts = [(values[k].T @ slope).ravel(), slope.sum(axis=0), *parts]
        if k:
            slope = (slope @ layers[k][0].T) * (1 - values[k] ** 2)
    return loss, np.concatenate(parts)


def _epoch(table: DataFrame, flat: np.ndarray, sizes: list[int], tasks: int) -> np.ndarray:
    """Training rows and loss, validation rows and loss, gradient: sums over the whole table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 + len(flat))
        for batch in batches:
            held = np.asarray(batch.column(2))
            x = np.asarray(batch.column(0).flatten()).reshape(-1, sizes[0])
            y = np.asarray(batch.column(1).flatten()).reshape(-1, sizes[-1])
            for at in range(0, len(held), BLOCK_ROWS):
                block = slice(at, at + BLOCK_ROWS)
                trains = ~held[block]
                if trains.any():
                    loss, gradient = squared_error(flat, sizes, x[block][trains], y[block][trains])
                    total += np.concatenate(([trains.sum(), loss, 0, 0], gradient))
                if not trains.all():
                    away = forward(in_layers(flat, sizes), x[block][~trains])[-1] - y[block][~trains]
                    total[2:4] += (~trains).sum(), (away**2).sum()
        yield pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))],
            ["seq", "sums"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(rows.sort_values("seq")["sums"].to_list()), axis=0)
        return pd.DataFrame({"seq": [int(key[0])], "sums": [total.tolist()]})

    sums = table.mapInArrow(run, "seq long, sums array<double>")
    while tasks > FAN_IN:
        sums = sums.withColumn("group", F.floor(F.col("seq") / FAN_IN)).groupBy("group").applyInPandas(
            add, "seq long, sums array<double>")
        tasks = -(-tasks // FAN_IN)
    rows = sorted(sums.collect(), key=lambda r: r["seq"])  # at most FAN_IN rows of fixed size
    return np.sum(np.array([r["sums"] for r in rows]), axis=0)


def fit_network(df: DataFrame, features: list[str], targets: list[str], validation: str | None = None,
                how: Training = Training()) -> Network:
    """Scale features and targets by the training rows and fit all targets jointly on the complete rows.

    ``validation`` names a boolean column: its rows do not train, they decide when to stop and which epoch's weights to keep.
    A table without a complete training row is an error.
    """
    marked = df.select(*[F.col(c).cast("double").alias(c) for c in [*features, *targets]],
                       F.coalesce(F.col(validation), F.lit(False)).alias("_held") if validation else F.lit(False).alias("_held"))
    complete = marked.dropna("any")
    trains = complete.where("not _held")
    both = fit_scaler(trains, "standard", [*features, *targets])
    if any(np.isnan(v) for v in both.centers.values()):
        raise ValueError("no complete rows to train on")
    scaler, target_scaler = (Scaler("standard", {c: both.centers[c] for c in some}, {c: both.scales[c] for c in some})
                             for some in (features, targets))
    scaled = {**scaler.expressions(), **target_scaler.expressions()}
    table = materialize(complete.select(F.array(*[scaled[c] for c in features]).alias("x"),
                                        F.array(*[scaled[c] for c in targets]).alias("y"), "_held"), "network-rows")
    tasks, sizes = table.rdd.getNumPartitions(), [len(features), *how.hidden, len(targets)]
    flat = start_weights(sizes, how.seed)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    best, best_loss, since, history = flat, np.inf, 0, []
    for epoch in range(1, how.epochs + 2):  # the last pass only measures
        sums = _epoch(table, flat, sizes, tasks)
        training = float(sums[1] / sums[0] / len(targets))
        held = float(sums[3] / sums[2] / len(targets)) if sums[2] else None
        history.append((training, held))
        judged = training if held is None else held
        if judged < best_loss:
            best, best_loss, since = flat, judged, 0
        else:
            since += 1
        if since >= how.patience or epoch > how.epochs:
            break
        gradient = sums[4:] / sums[0] / len(targets)
        first = BETA_1 * first + (1 - BETA_1) * gradient
        second = BETA_2 * second + (1 - BETA_2) * gradient**2
        flat = flat - how.rate * (first / (1 - BETA_1**epoch)) / (np.sqrt(second / (1 - BETA_2**epoch)) + TINY)
    return Network(scaler, target_scaler, list(features), list(targets), in_layers(best, sizes), history)
