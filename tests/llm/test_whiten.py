"""Whitening against eigenvectors of the covariance, and the bidiagonal solver against LAPACK."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import queries, whiten

RNG = np.random.default_rng(3)
TURN = np.linalg.qr(RNG.standard_normal((40, 40)))[0]
MATRICES = {
    "one": RNG.standard_normal((5, 1)), "two": RNG.standard_normal((9, 2)), "plain": RNG.standard_normal((300, 40)),
    "graded": RNG.standard_normal((300, 40)) * np.logspace(0, -6, 40), "equal": np.eye(40) * 3,
    "clusters": np.repeat([5, 4, 3, 1.0], 10)[:, None] * TURN, "close": (1 + 1e-9 * RNG.standard_normal(40))[:, None] * TURN,
    "rank": RNG.standard_normal((300, 9)) @ RNG.standard_normal((9, 40)), "few": RNG.standard_normal((6, 40)),
    "zero": np.zeros((4, 7)), "large": RNG.standard_normal((50, 8)) * 1e150, "tiny": RNG.standard_normal((50, 8)) * 1e-140,
}


@pytest.mark.parametrize("name", MATRICES)
def test_values_and_vectors(name):
    r = whiten._triangle(MATRICES[name])
    values, vectors = whiten.singular_directions(r)
    expected = np.linalg.svd(r, compute_uv=False)
    real = expected > 1e-13 * expected[0]
    assert np.allclose(np.sqrt(values[real]), expected[real], rtol=1e-13 * max(1, np.ptp(np.log10(expected[real])) ** 4 if
                                                                              real.any() else 1), atol=0)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    if expected[0]:
        scaled = r / expected[0]
        assert np.abs(scaled.T @ (scaled @ vectors) - vectors * (values / expected[0] / expected[0])).max() < 1e-13


def test_bidiagonal_keeps_the_matrix():
    r = whiten._triangle(MATRICES["plain"])
    diagonal, above, v = whiten.bidiagonal(r)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(v @ b.T @ b @ v.T, r.T @ r, atol=1e-11)


def plain(vectors):
    """Count, deviations, whitened values and shares by eigenvectors."""
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = (n * fitted - sums) / n
    e, w = np.linalg.eigh(centred.T @ centred / n)
    e, w = e[::-1][:16], w[:, ::-1][:, :16]
    away = n * x - sums
    return n, (away**2).sum(axis=1), (away / n) @ w / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def test_query(spark, small):
    source = spark.read.parquet(f"{small}/embeddings.parquet").toPandas().sort_values("vec_id")
    n, deviations, white, shares = plain(np.stack(source["embedding"]))
    found = queries.op12_whitening(spark, small).toPandas().sort_values(["vec_id", "component"])
    assert len(found) == 16 * len(source) and set(found["n"]) == {n}
    assert found["deviation"].tolist() == np.repeat(deviations, 16).tolist()
    got = found["whitened"].to_numpy().reshape(-1, 16)
    assert np.abs(got * np.sign((got * white).sum(axis=0)) - white).max() < 1e-9
    assert np.allclose(found["explained"].to_numpy().reshape(-1, 16), shares, rtol=1e-10)
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-10


def test_awkward_rows_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(whiten, "FAN_IN", 2)
    monkeypatch.setattr(whiten, "BLOCK_ROWS", 7)
    good = RNG.standard_normal((200, 5)).astype(np.float32)
    good[:90] = good[0]  # a hot vector
    good[:, 4] = 0.25  # no variance
    data = [(i, v.tolist()) for i, v in enumerate(good)]
    data += [(None, good[3].tolist()), (500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0]), (503, [math.nan] * 5),
             (504, [math.inf] * 5), (505, [1.0] * 4), (506, [1e30] * 5), (507, good[5].tolist()), (507, good[5].tolist())]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumns(
        {"x": F.lit(1), "row": F.lit(2), "whitened": F.lit(3), "state": F.lit(4), "entries": F.lit(5)}).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several tasks, so that states are merged
    try:
        found = whiten.whiten(table).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    kept = [d for d in data if d[0] is None or d[0] < 500 or d[0] == 507]
    assert len(found) == 5 * len(kept) and found["vec_id"].isna().sum() == 5
    n, deviations, white, shares = plain(np.array([d[1] for d in kept], np.float32)[:, :4])
    assert set(found["n"]) == {n} and found[found["component"] == 5]["whitened"].isna().all()
    own = {d[0]: w for d, w in zip(kept, deviations.tolist(), strict=True)}
    assert all(own[int(v)] == d for v, d in zip(found["vec_id"], found["deviation"], strict=True) if v == v)
    assert np.allclose(found.groupby("component")["explained"].first()[:4], shares, rtol=1e-9)
    assert found["identity_error"].iloc[0] < 1e-10
    points = whiten.points(table)
    wide = whiten.whitened(points, whiten.fit(whiten.fit_list(points)), 2)
    assert {len(r["whitened"]) for r in wide.collect()} == {2} and "state" in wide.schema["row"].dataType.names


def test_empty_single_and_huge(spark):
    kind = "vec_id long, embedding array<double>"
    assert whiten.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, None)], kind)).count() == 0
    one = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0])], kind)).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    far = [[-1e13, 0.0], [1e13, 0.5], [0.0, 1e13]]
    huge = whiten.whiten(spark.createDataFrame(list(enumerate(far)), kind)).collect()
    assert {r["deviation"] for r in huge} == {None}  # beyond a long
    assert all(math.isfinite(r["whitened"]) for r in huge) and huge[0]["identity_error"] < 1e-10
