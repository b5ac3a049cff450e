"""Nearest baseline of the same month, by distance in degrees, without pairing everything.

Baseline coordinates lie on a lattice of 0.01 degrees, so cells of 0.16, 2.56 and 40.96 degrees hold at
most 256 children each: a pyramid of bounded lists. A request walks down from the coarse cells and keeps
only children whose box could hold the nearest point. All bounds are computed with the arithmetic of the
distance itself and prune only what is strictly farther, so the result is exact, ties included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Cell edges in hundredths of a degree, fine to coarse.
EDGES = (16, 256, 4096)

# The point of a request and its key. The key is text, which spells every double apart and, unlike the
# doubles themselves, keeps one hash partitioning through all steps.
_POINT = ["_lat", "_lon", "_month"]
_KEY = "_key"


def _keyed(requests: DataFrame) -> DataFrame:
    point = {
        "_lat": F.col("latitude").cast("double"),
        "_lon": F.col("longitude").cast("double"),
        "_month": F.col("month").cast("int"),
    }
    return requests.withColumns(point).withColumn(
        _KEY, F.concat(*[c for p in _POINT for c in (F.col(p).cast("string"), F.lit("|"))]))


def nearest_baseline(requests: DataFrame, baselines: DataFrame) -> DataFrame:
    """Add ``nearest_lat, nearest_lon, distance, baseline_temp, baseline_precip`` to every request.

    Requests need ``latitude, longitude, month``. Of equally near points the one with the smaller
    (lat, lon) wins; a month without baselines gives NULLs.
    """
    keyed = _keyed(requests)
    asked = (
        keyed.where(F.col(_KEY).isNotNull()).groupBy(_KEY)
        .agg(*[F.min(p).alias(p) for p in _POINT])
    )
    found = _search(asked, _pyramid(baselines))
    return keyed.drop(*_POINT).join(found, [_KEY], "left").drop(_KEY)


def _pyramid(baselines: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The coarse cells per month, and per level (coarse to fine) the children of each cell."""
    lat, lon = F.col("lat_rounded"), F.col("lon_rounded")
    off = (F.abs(lat * 100 - F.rint(lat * 100)) > 1e-6) | (F.abs(lon * 100 - F.rint(lon * 100)) > 1e-6)
    off = off | (F.abs(lat) > 90) | (F.abs(lon) > 360)
    place = F.concat(F.lit("a baseline is off the lattice of 0.01 degrees or the globe: "), lat.cast("string"),
                     F.lit(", "), lon.cast("string"))
    # The lists below are bounded because of this.
    points = baselines.select(
        F.col("month").cast("int").alias("_month"),
        F.when(off, F.raise_error(place).cast("double")).otherwise(lat).alias("lat"), lon.alias("lon"),
        F.rint(F.col("lat_rounded") * 100).cast("long").alias("i"),
        F.rint(F.col("lon_rounded") * 100).cast("long").alias("j"), "baseline_temp", "baseline_precip",
    ).dropna(subset=["_month", "lat", "lon"])

    def cell(edge: int) -> Column:
        return F.struct(F.floor(F.col("i") / edge).alias("i"), F.floor(F.col("j") / edge).alias("j"))

    leaves = (
        points.groupBy("_month", cell(EDGES[0]).alias("cell"))
        .agg(F.collect_set(F.struct("lat", "lon", "baseline_temp", "baseline_precip")).alias("children"),
             F.min("lat").alias("south"), F.max("lat").alias("north"),
             F.min("lon").alias("west"), F.max("lon").alias("east"))
    )
    levels = [leaves.select("_month", "cell", "children")]
    boxes = leaves.drop("children")
    for fine, coarse in zip(EDGES, EDGES[1:]):
        ratio = coarse // fine
        parent = F.struct(
            F.floor(F.col("cell.i") / ratio).alias("i"), F.floor(F.col("cell.j") / ratio).alias("j"))
        grouped = (
            boxes.groupBy("_month", parent.alias("parent"))
            .agg(F.collect_list(F.struct("cell", "south", "north", "west", "east")).alias("children"),
                 F.min("south").alias("south"), F.max("north").alias("north"),
                 F.min("west").alias("west"), F.max("east").alias("east"))
            .withColumnRenamed("parent", "cell")
        )
        levels.append(grouped.select("_month", "cell", "children"))
        boxes = grouped.drop("children")
    roots = boxes.groupBy("_month").agg(
        F.collect_list(F.struct("cell", "south", "north", "west", "east")).alias("children"))
    return roots, levels[::-1]


def _search(asked: DataFrame, pyramid: tuple[DataFrame, list[DataFrame]]) -> DataFrame:
    """Walk down with ``_reach``, a distance within which each request surely has a point.

    Boxes beyond the reach go before any shuffle; the boxes that are left shorten the reach.
    """
    roots, levels = pyramid
    per_request = Window.partitionBy(_KEY)
    carried = [_KEY, *_POINT, "_reach"]
    # Twelve months of some fifty coarse cells. The first reach is a grouped minimum that stays in the
    # partitions of the requests, so no box is sorted or shuffled for it.
    coarse = asked.join(F.broadcast(roots), "_month").withColumn("box", F.explode("children"))
    first_reach = coarse.groupBy(_KEY).agg(F.min(_surely_within(F.col("box"))).alias("_reach"))
    boxes = (
        asked.join(first_reach, _KEY).join(F.broadcast(roots), "_month")
        .select(*carried, F.explode("children").alias("box"))
        .where(_at_least(F.col("box")) <= F.col("_reach"))
    )
    for depth, level in enumerate(levels):
        cells = boxes.select(*carried, F.col("box.cell").alias("cell"))
        if depth == 0:
            # At most twelve times fifty cells of 256 boxes of about 50 bytes.
            joined = cells.join(F.broadcast(level), ["_month", "cell"])
        else:
            joined = cells.join(level, ["_month", "cell"])
        children = joined.select(*carried, F.explode("children").alias("box"))
        if depth < len(levels) - 1:
            near = children.where(_at_least(F.col("box")) <= F.col("_reach"))
            shortest = F.min(_surely_within(F.col("box"))).over(per_request)
            boxes = (
                near.withColumn("_reach", F.least("_reach", shortest))
                .where(_at_least(F.col("box")) <= F.col("_reach"))
            )
    distance = _distance(F.col("_lat") - F.col("box.lat"), F.col("_lon") - F.col("box.lon"))
    best = (
        children.select(_KEY, "_reach", F.struct(
            distance.alias("distance"), F.col("box.lat").alias("lat"), F.col("box.lon").alias("lon"),
            F.col("box.baseline_temp").alias("temp"), F.col("box.baseline_precip").alias("precip")).alias("point"))
        .where(F.col("point.distance") <= F.col("_reach"))
        .groupBy(_KEY).agg(F.min("point").alias("best"))
    )
    return best.select(
        _KEY, F.col("best.lat").alias("nearest_lat"), F.col("best.lon").alias("nearest_lon"),
        F.col("best.distance").alias("distance"), F.col("best.temp").alias("baseline_temp"),
        F.col("best.precip").alias("baseline_precip"))


def _distance(dy: Column, dx: Column) -> Column:
    return F.sqrt(dy * dy + dx * dx)


def _at_least(box: Column) -> Column:
    """No point of the box is nearer than this."""
    lat, lon, zero = F.col("_lat"), F.col("_lon"), F.lit(0.0)
    return _distance(F.greatest(box["south"] - lat, lat - box["north"], zero),
                     F.greatest(box["west"] - lon, lon - box["east"], zero))


def _surely_within(box: Column) -> Column:
    """Some point of the box is at most this far: each edge of a tight box touches a point."""
    south, north = F.abs(F.col("_lat") - box["south"]), F.abs(F.col("_lat") - box["north"])
    west, east = F.abs(F.col("_lon") - box["west"]), F.abs(F.col("_lon") - box["east"])
    return F.least(_distance(F.least(south, north), F.greatest(west, east)),
                   _distance(F.greatest(south, north), F.least(west, east)))
