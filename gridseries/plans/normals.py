"""Monthly normals over landings: stored states per month, so that a landing recomputes the months it holds and no others.

The store is a folder. ``states/<name>`` holds the merged states of one month, in a folder that is never written again, and
``manifest`` says, by version, which folder each month has and which landings are in it. A landing writes new folders for
its months first and the next version last: a run that dies in between leaves folders that nothing names, and can be
repeated. A landing that a month has already is left out of that month, so replays change nothing. Landings of
one store come one after another.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.baselines import merged_states, normal_states, normals_of
from gridseries.session import materialize, path_exists, remove_path

MANIFEST = "version bigint, month int, folder string, landings array<string>"


def _manifest(spark: SparkSession, store: str) -> tuple[int, dict[int, tuple[str, list[str]]]]:
    """The newest version: folder and landings by month, so twelve rows at most."""
    path = f"{store}/manifest"
    if not path_exists(spark, path):
        return 0, {}
    versions = spark.read.schema(MANIFEST).parquet(path)
    newest = versions.agg(F.max("version")).first()[0] or 0
    rows = versions.where(F.col("version") == newest).collect()
    return newest, {r["month"]: (r["folder"], list(r["landings"])) for r in rows}


def land_normals(landed: DataFrame, store: str, landing: str, order_by: list[str] | None = None) -> list[int]:
    """Add the rows of a landing; gives the months that changed. Rows without month, place or time of order count for nothing.

    The columns of ``order_by`` (time by default) must be the same for all landings of a store.
    """
    spark = landed.sparkSession
    version, months = _manifest(spark, store)
    states = materialize(normal_states(landed, order_by), "states")
    found = sorted(r["month"] for r in states.select("month").distinct().collect())  # twelve at most
    fresh = [m for m in found if landing not in months.get(m, ("", []))[1]]
    if not fresh:
        return []
    states = states.where(F.col("month").isin(fresh))
    known = [months[m][0] for m in fresh if m in months]
    if known:
        earlier = spark.read.schema(states.schema).parquet(*[f"{store}/states/{name}" for name in known])
        states = merged_states(states.unionByName(earlier))
    written = uuid.uuid4().hex
    # One job writes all changed months; ``part`` is the month once more, as the folder's name.
    states.withColumn("part", F.col("month")).write.partitionBy("part").parquet(f"{store}/states/{written}")
    for m in fresh:
        months[m] = (f"{written}/part={m}", [*months.get(m, ("", []))[1], landing])
    rows = [(version + 1, m, folder, names) for m, (folder, names) in sorted(months.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{store}/manifest")
    return fresh


def stored_states(spark: SparkSession, store: str, months: list[int] | None = None) -> DataFrame:
    """The states of all months, or of those named: only their folders are listed and read."""
    _, known = _manifest(spark, store)
    folders = [f"{store}/states/{folder}" for m, (folder, _) in sorted(known.items()) if months is None or m in months]
    if not folders:
        raise FileNotFoundError(f"{store} has no states of these months")
    return spark.read.parquet(*folders)


def stored_normals(spark: SparkSession, store: str, months: list[int] | None = None) -> DataFrame:
    return normals_of(stored_states(spark, store, months))


def remove_replaced(spark: SparkSession, store: str) -> int:
    """Delete the month folders of earlier versions that the newest one does not name; frames that read them end."""
    _, months = _manifest(spark, store)
    kept = {folder for folder, _ in months.values()}
    named = spark.read.schema(MANIFEST).parquet(f"{store}/manifest").select("folder").distinct().collect()
    old = [r["folder"] for r in named
           if r["folder"] not in kept and path_exists(spark, f"{store}/states/{r['folder']}")]
    for folder in old:
        remove_path(spark, f"{store}/states/{folder}")
    return len(old)
