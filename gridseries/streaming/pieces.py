"""Windows whose months arrive in several responses: collected in state, closed when complete or late, then scored.

The months of a window are kept per (location, request) until all expected ones are there or the newest arrival is later than the
window's first one by ``patience``. A closed window leaves all its rows in one batch, so scoring needs no older state, and a split landing
gives the rows of an unsplit one. A month that arrives again keeps what came first and is filled where that was missing.
What comes for a window that is closed already is ignored until the deadline, at which the state is evicted; what arrives after
that opens the window anew. Pieces stamped more than ``patience`` before the newest one are too late and left out by the watermark.
State is at most one row per month of the windows of the last ``patience``.

A piece goes to the state as one row with arrays of its months and numbers, and a closed window leaves as one, so the state's
functions run once per window and batch, on plain values; months become rows before and after that natively.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterator

from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gridseries.functions.columns import is_annual, parse_period
from gridseries.plans.scoring import alerts, score_windows
from gridseries.schemas import PACKED_RESPONSE, WINDOW_PARAMETERS
from gridseries.sources.responses import periods_of, value_at
from gridseries.streaming.landing import REQUEST

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # state functions need no copy of the package on executors

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: One piece: some months of one window; ``months`` is how many the whole window has.
PIECE = T.StructType([*PACKED_RESPONSE.fields, T.StructField("months", T.IntegerType()),
                      T.StructField("landed_at", T.TimestampType())])
WIDTH, AT_ONCE = len(WINDOW_PARAMETERS), 10_000
VALUES = T.StructType([T.StructField(p, T.DoubleType()) for p in WINDOW_PARAMETERS])
#: A window as it leaves the state: its months in order, and the numbers of all of them, one after the other.
CLOSED = T.StructType([
    T.StructField("location_id", T.LongType()), T.StructField("request", T.StringType()),
    T.StructField("ats", T.ArrayType(T.IntegerType())), T.StructField("numbers", T.ArrayType(T.DoubleType())),
    T.StructField("complete", T.BooleanType())])
MONTH = T.StructType([T.StructField("at", T.IntegerType()), *VALUES.fields])  # ``at`` counts months from year 0
WINDOW = T.StructType([T.StructField("expected", T.IntegerType()), T.StructField("deadline", T.LongType()),
                       T.StructField("closed", T.BooleanType()), T.StructField("months", T.ArrayType(MONTH))])


class WindowCollector(StatefulProcessor):
    """One value of state per window: its months, how many it expects, its deadline and whether it has been given out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", WINDOW)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.window.get() if self.window.exists() else None
        expected, deadline, closed, held = known or (0, None, False, [])
        if closed:
            return
        months = {m[0]: list(m[1:]) for m in held}
        for some in itertools.batched(rows, AT_ONCE):
            for r in sorted(some, key=lambda r: (r.landed is None, r.landed or 0)):
                if deadline is None:
                    deadline = int(r.landed)  # the watermark stays behind by the patience
                    self.handle.registerTimer(deadline)
                expected = max(expected, int(r.months))
                for at, values in zip(r.ats, itertools.batched(r.numbers, WIDTH), strict=True):
                    known = months.get(int(at))
                    months[at] = values if known is None else [
                        a if a is not None else b for a, b in zip(known, values, strict=True)]
        closed = len(months) >= expected
        if closed:
            yield _window(key, months, True)
        self.window.update((expected, deadline, closed, [] if closed else [(at, *v) for at, v in months.items()]))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.window.get() if self.window.exists() else None
        self.window.clear()
        if known and not known[2]:
            yield _window(key, {m[0]: m[1:] for m in known[3]}, False)

    def close(self) -> None:
        pass


def _window(key: tuple, months: dict[int, list], complete: bool) -> Row:
    ats = sorted(months)
    return Row(location_id=key[0], request=key[1], ats=ats, numbers=[v for at in ats for v in months[at]], complete=complete)


def _months(pieces: DataFrame) -> DataFrame:
    """One row per piece that has months: ``ats`` counts them from year 0, ``numbers`` has the values of each in turn."""
    by_parameter = F.col("properties.parameter")

    def count(period: Column) -> Column:
        first = parse_period(period)
        return (F.year(first) * 12 + F.month(first) - 1).cast("int")

    def values(period: Column) -> Column:
        return F.array(*[value_at(by_parameter, p, period).cast("double") for p in WINDOW_PARAMETERS])

    found = pieces.withColumn("periods", F.filter(periods_of(by_parameter), lambda p: ~is_annual(p))).where(F.size("periods") > 0)
    return found.select(*REQUEST, "months", "landed_at", F.unix_millis("landed_at").alias("landed"),
                        F.transform("periods", count).alias("ats"), F.flatten(F.transform("periods", values)).alias("numbers"))


def closed_windows(pieces: DataFrame, patience: str = "1 day") -> DataFrame:
    """Rows of the windows that close, from a stream of pieces."""
    closed = _months(pieces.withWatermark("landed_at", patience)).groupBy(*REQUEST).transformWithState(
        WindowCollector(), CLOSED, "Append", "EventTime")
    at = F.col("at")
    return closed.select(*REQUEST, "numbers", "complete", F.posexplode("ats").alias("place", "at")).select(
        *REQUEST, F.make_date(F.floor(at / 12).cast("int"), at % 12 + 1, F.lit(1)).cast("timestamp").alias("date"),
        *[F.get("numbers", F.col("place") * WIDTH + k).alias(p) for k, p in enumerate(WINDOW_PARAMETERS)], "complete")


def read_pieces(spark: SparkSession, path: str, files_per_trigger: int | None = 10_000) -> DataFrame:
    reader = spark.readStream.schema(PIECE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def start_scoring_pieces(spark: SparkSession, landing: str, output: str, checkpoint: str,
                         predict: Callable[[DataFrame], DataFrame], alert_output: str | None = None,
                         alert_threshold: float = 0.5, patience: str = "1 day", files_per_trigger: int | None = 10_000,
                         once: bool = True) -> StreamingQuery:
    """Start the query. Each batch overwrites its own folder, so a replayed batch changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{output}/batch_id={batch_id}"
        # Scoring reads the rows several times; each reading of the batch itself would run the state's functions again.
        windows = batch.withColumns({"year": F.year("date"), "month": F.month("date")}).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            score_windows(windows, [*REQUEST, "complete"], predict).write.mode("overwrite").parquet(target)
        finally:
            windows.unpersist()
        if alert_output:
            stored = batch.sparkSession.read.parquet(target)
            alerts(stored, threshold=alert_threshold).write.mode("overwrite").parquet(f"{alert_output}/batch_id={batch_id}")

    setting = "spark.sql.streaming.stateStore.providerClass"  # keyed state with timers needs this store
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, PROVIDER)
    try:
        writer = closed_windows(read_pieces(spark, landing, files_per_trigger), patience).writeStream.foreachBatch(
            write).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
