"""Exact quantiles, order statistics, nearest lookup and joins against brute force."""

import numpy as np
import pandas as pd
import pytest

from gridseries.operators import joins, nearest, quantiles
from gridseries.operators.baselines import lookup_baseline, monthly_normals
from gridseries.operators.outliers import winsorize

SHARES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.951, 1.0]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(1)
    n = 12_001
    pdf = pd.DataFrame({
        "a": rng.normal(size=n),
        "b": np.where(rng.random(n) < 0.4, 3.0, rng.integers(0, 9, n)),  # one value holds a third of the rows
        "c": rng.exponential(size=n)})
    pdf.loc[rng.random(n) < 0.1, "c"] = np.nan
    pdf["d"] = np.nan
    return pdf


@pytest.mark.parametrize("options", [{}, {"gather_rows": 40}, {"gather_rows": 5}])
def test_quantiles(spark, values, options):
    table = spark.createDataFrame(values).repartition(6)
    got = quantiles.quantiles(table, list("abcd"), SHARES, **options)
    for c in "abc":
        np.testing.assert_allclose(got[c], values[c].quantile(SHARES), rtol=1e-13)
    assert got["d"] == [None] * len(SHARES)


def test_approximate_quantiles_are_actual_values(spark, values):
    got = quantiles.quantiles(spark.createDataFrame(values), ["a"], [0.5], exact=False)["a"][0]
    assert got in set(values.a) and abs(got - values.a.median()) < 0.02


def test_winsorize_positions(spark):
    table = spark.createDataFrame([(i, float(i)) for i in range(1, 21)], "i int, y double")
    got = winsorize(table, ["y"]).orderBy("i").toPandas().y.tolist()
    assert got == [2.0] + [float(i) for i in range(2, 20)] + [19.0]


@pytest.mark.parametrize("span", [(-90, 90, -180, 180), (20, 21, 70, 71)])
def test_nearest_is_exact(spark, span):
    rng = np.random.default_rng(3)
    south, north, west, east = span
    places = pd.DataFrame({
        "lat_rounded": np.round(rng.uniform(south, north, 600), 2) + 0.0,
        "lon_rounded": np.round(rng.uniform(west, east, 600), 2) + 0.0,
        "month": rng.integers(1, 4, 600).astype("int32")}).drop_duplicates()
    places["baseline_temp"] = np.arange(len(places), dtype=float)
    places["baseline_precip"] = 1.0
    asked = pd.DataFrame({
        "rid": range(300), "latitude": np.round(rng.uniform(-90, 90, 300), 1),
        "longitude": np.round(rng.uniform(-180, 180, 300), 1), "month": rng.integers(1, 5, 300).astype("int32")})
    asked.loc[100:200, ["latitude", "longitude"]] = [20.5, 70.5]  # a third of the requests at one point
    got = nearest.nearest_baseline(spark.createDataFrame(asked), spark.createDataFrame(places))
    got = got.toPandas().set_index("rid")
    assert len(got) == 300
    for q in asked.itertuples():
        same = places[places.month == q.month].sort_values(["lat_rounded", "lon_rounded"])
        found = got.loc[q.rid]
        if same.empty:
            assert np.isnan(found.distance)
            continue
        distance = ((q.latitude - same.lat_rounded) ** 2 + (q.longitude - same.lon_rounded) ** 2) ** 0.5
        best = distance.to_numpy().argmin()
        assert found.distance == distance.iloc[best]
        assert found.baseline_temp == same.baseline_temp.iloc[best]


def test_nearest_tie_takes_the_smaller_place(spark):
    places = spark.createDataFrame(
        [(10.0, 20.0, 1, 1.0, 0.0), (10.0, 22.0, 1, 2.0, 0.0)],
        "lat_rounded double, lon_rounded double, month int, baseline_temp double, baseline_precip double")
    asked = spark.createDataFrame([(10.0, 21.0, 1)], "latitude double, longitude double, month int")
    assert nearest.nearest_baseline(asked, places).first()["baseline_temp"] == 1.0


def test_baselines_off_the_lattice_are_refused(spark):
    asked = spark.createDataFrame([(10.0, 21.0, 1)], "latitude double, longitude double, month int")
    for lat, lon in ((10.001, 20.0), (91.0, 20.0)):
        places = spark.createDataFrame(
            [(lat, lon, 1, 1.0, 0.0)], "lat_rounded double, lon_rounded double, month int, baseline_temp double, baseline_precip double")
        with pytest.raises(Exception, match="lattice"):
            nearest.nearest_baseline(asked, places).collect()


def test_lookup_prefers_the_exact_place_and_meets_negative_zero(spark):
    facts = spark.createDataFrame(
        [(-0.001, 5.0, 1, 10.0, 1.0), (0.002, 5.0, 1, 20.0, 3.0), (50.0, 6.0, 2, 7.0, 2.0), (None, 6.0, 2, 7.0, 2.0)],
        "latitude double, longitude double, month int, T2M double, PRECTOTCORR double")
    normals = monthly_normals(facts)
    assert normals.count() == 2  # both sides of the equator share a key, the missing place has none
    asked = spark.createDataFrame(
        [(1, 0.0, 5.0, 1), (2, 40.0, 6.0, 2), (3, 0.0, 0.0, 9)], "id int, latitude double, longitude double, month int")
    got = {r["id"]: r for r in lookup_baseline(asked, normals).collect()}
    assert (got[1]["matched"], got[1]["baseline_temp"], got[1]["distance"]) == ("exact", 15.0, 0.0)
    assert (got[2]["matched"], got[2]["baseline_temp"], got[2]["distance"]) == ("nearest", 7.0, 10.0)
    assert (got[3]["matched"], got[3]["baseline_temp"]) == ("none", None)


def test_lookup_join_same_with_and_without_broadcast(spark):
    fact = spark.range(1000).selectExpr("case when id % 3 = 0 then 1 else id end as k", "id as v")
    dim = spark.range(900).selectExpr("id as k", "concat('n', id) as name")
    broadcast = joins.lookup_join(fact, dim, ["k"])
    shuffled = joins.lookup_join(fact, dim, ["k"], limit=0)
    key = lambda r: (r["k"], r["v"])
    assert sorted(broadcast.collect(), key=key) == sorted(shuffled.collect(), key=key)
    assert shuffled.count() == 1000


def test_nested_columns_count_for_a_broadcast(spark):
    dim = spark.range(10).selectExpr("id as k", "sequence(0, 2000) as a", "map('x', repeat('y', 2000)) as m")
    assert not joins.fits_broadcast(dim, 50_000) and joins.fits_broadcast(dim, 500_000)


def test_one_hot_key_is_joined_without_copies_of_the_lookup_table(spark):
    fact = spark.range(0, 4000, 1, 8).selectExpr("if(id % 10 = 0, id, 7) as k", "id as v")
    dim = spark.range(4000).selectExpr("id as k", "id * 2 as w")
    joined = joins.lookup_join(fact, dim, ["k"], limit=0)
    assert joined.where("w = k * 2").count() == 4000
    assert "Generate" not in joined._jdf.queryExecution().toString()
