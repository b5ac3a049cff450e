"""Score responses as they land, file by file, with a replay-safe sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridseries.plans.scoring import alerts, score_windows
from gridseries.schemas import PACKED_RESPONSE, RESPONSE
from gridseries.sources.responses import identify, window_rows

REQUEST = ["location_id", "request"]


def read_landing_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 10_000,
                        packed: bool = False) -> DataFrame:
    """New files of the landing folder; the limit bounds what one trigger takes, the rest waits.

    ``packed`` files hold JSON lines with ``location_id`` and ``request``; others hold one response each.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if packed:
        return reader.schema(PACKED_RESPONSE).json(path)
    return identify(reader.schema(RESPONSE).option("multiLine", True).json(path))


def score_batch(responses: DataFrame, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A response is a whole window of its location, so the aggregates of a batch need no older state."""
    return score_windows(window_rows(responses), REQUEST, predict)


def start_scoring(spark: SparkSession, landing: str, output: str, checkpoint: str,
                  predict: Callable[[DataFrame], DataFrame], alert_output: str | None = None,
                  alert_threshold: float = 0.5, files_per_trigger: int | None = 10_000,
                  packed: bool = False, once: bool = True) -> StreamingQuery:
    """Start the query. Each batch overwrites its own folder, so a replayed batch changes nothing.

    ``once`` takes what has landed and ends; otherwise the query runs on.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{output}/batch_id={batch_id}"
        score_batch(batch, predict).write.mode("overwrite").parquet(target)
        if alert_output:
            stored = batch.sparkSession.read.parquet(target)
            alerts(stored, threshold=alert_threshold).write.mode("overwrite").parquet(
                f"{alert_output}/batch_id={batch_id}")

    writer = (
        read_landing_stream(spark, landing, files_per_trigger, packed).writeStream
        .foreachBatch(write).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_scored(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output).withColumn("batch_id", F.col("batch_id").cast("bigint"))
