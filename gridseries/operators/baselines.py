"""Monthly normals by place, their summaries and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.operators.joins import coordinate_keys, lookup_join
from gridseries.operators.nearest import nearest_baseline
from gridseries.schemas import require_columns

KEYS = ["lat_rounded", "lon_rounded", "month"]
MEASURES = ["T2M", "PRECTOTCORR"]


def monthly_normals(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Mean temperature and precipitation by rounded place and month.

    The unrounded coordinates of the first row in ``order_by`` order (time by default) are kept.
    """
    return normals_of(normal_states(df, order_by))


def normal_states(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Sums, counts and first order value by exact place and month: what normals are made of, and what adds up."""
    if "month" not in df.columns and "time" in df.columns:
        df = df.withColumn("month", F.month("time"))
    require_columns(df.columns, ["latitude", "longitude", "month", "T2M", "PRECTOTCORR"])
    order = order_by or (["time"] if "time" in df.columns else [])
    keyed = df.withColumns(coordinate_keys(F.col("latitude"), F.col("longitude"))).dropna(subset=KEYS)
    # By exact place first: sums, counts and one order column stay in hash tables there, and choosing
    # the first place then works on the few places that share a rounded one.
    first_seen = [F.min(F.struct(*order) if len(order) > 1 else order[0]).alias("_seen")] if order else []
    return keyed.groupBy(*KEYS, "latitude", "longitude").agg(
        *[f(c).alias(f"_{n}_{c}") for c in MEASURES for n, f in (("sum", F.sum), ("count", F.count))],
        *first_seen)


def merged_states(states: DataFrame) -> DataFrame:
    """One state by exact place and month out of those of several tables."""
    seen = [F.min("_seen").alias("_seen")] if "_seen" in states.columns else []
    return states.groupBy(*KEYS, "latitude", "longitude").agg(
        *[F.sum(f"_{n}_{c}").alias(f"_{n}_{c}") for c in MEASURES for n in ("sum", "count")], *seen)


def normals_of(states: DataFrame) -> DataFrame:
    """The normals of merged states."""
    first = F.struct(*(["_seen"] if "_seen" in states.columns else []), "latitude", "longitude")

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_count_{c}"))

    return (
        states.groupBy(*KEYS)
        .agg(mean("T2M").alias("baseline_temp"), mean("PRECTOTCORR").alias("baseline_precip"),
             F.min_by(F.struct("latitude", "longitude"), first).alias("_place"))
        .select(*KEYS, "baseline_temp", "baseline_precip", "_place.latitude", "_place.longitude")
    )


def normals_statistics(baselines: DataFrame) -> DataFrame:
    """One row: extremes and means of both normals, rows and distinct places."""
    aggregates = []
    for name in ("temp", "precip"):
        aggregates += [
            F.min(f"baseline_{name}").alias(f"{name}_min"),
            F.max(f"baseline_{name}").alias(f"{name}_max"),
            F.avg(f"baseline_{name}").alias(f"{name}_mean"),
        ]
    # Places first, then all of them: both stages combine before the shuffle.
    return baselines.agg(
        *aggregates,
        F.count(F.lit(1)).alias("normals"),
        F.countDistinct("lat_rounded", "lon_rounded").alias("places"))


def normals_by_month(baselines: DataFrame) -> DataFrame:
    """Mean of the normals over all places, each place weighing the same."""
    return baselines.groupBy("month").agg(
        F.avg("baseline_temp").alias("baseline_temp"), F.avg("baseline_precip").alias("baseline_precip"))


def exact_baseline(requests: DataFrame, baselines: DataFrame, stored: bool = False) -> DataFrame:
    """Left join on rounded coordinates and month; ``stored`` tables are measured for a broadcast."""
    return _with_exact(requests, baselines, stored).drop("_hit")


def _with_exact(requests: DataFrame, baselines: DataFrame, stored: bool) -> DataFrame:
    normals = baselines.select(*KEYS, "baseline_temp", "baseline_precip", F.lit(True).alias("_hit"))
    keyed = requests.withColumns(coordinate_keys(F.col("latitude"), F.col("longitude")))
    joined = lookup_join(keyed, normals, KEYS) if stored else keyed.join(normals, KEYS, "left")
    return joined.drop("lat_rounded", "lon_rounded")


def lookup_baseline(requests: DataFrame, baselines: DataFrame, stored: bool = False) -> DataFrame:
    """The exact normal, else the nearest of the same month with its ``distance`` (0 when exact).

    ``matched`` says which: exact, nearest or none.
    """
    exact = _with_exact(requests, baselines, stored)
    found = exact.where("_hit").drop("_hit").withColumns({"distance": F.lit(0.0), "matched": F.lit("exact")})
    open_requests = exact.where(F.col("_hit").isNull()).drop("_hit", "baseline_temp", "baseline_precip")
    others = nearest_baseline(open_requests, baselines).drop("nearest_lat", "nearest_lon")
    others = others.withColumn("matched", F.when(F.col("distance").isNull(), "none").otherwise("nearest"))
    return found.unionByName(others)
