"""The jointly fitted network against a plain version over one array."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridseries import jobs
from gridseries.operators import network
from gridseries.plans import catalogue, scoring
from gridseries.schemas import FEATURES, TARGETS


def plain(x, y, held, how):
    """The same fit on whole arrays: means and deviations, forward and backward by hand, Adam, early stop."""
    x, y = (a.copy() for a in (x, y))
    for a in (x, y):
        spread = a[~held].std(axis=0)
        a -= a[~held].mean(axis=0)
        a /= np.where(spread < 1e-14, 1.0, spread)
    rng = np.random.default_rng(how.seed)
    a1, a2 = np.sqrt(6 / (x.shape[1] + how.hidden[0])), np.sqrt(6 / (how.hidden[0] + 2))
    w = [rng.uniform(-a1, a1, (x.shape[1], how.hidden[0])), np.zeros(how.hidden[0]),
         rng.uniform(-a2, a2, (how.hidden[0], 2)), np.zeros(2)]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    best, least, since, history = w, np.inf, 0, []
    for epoch in range(1, how.epochs + 2):
        h = np.tanh(x @ w[0] + w[1])
        e = h @ w[2] + w[3] - y
        loss, judged = (e[~held] ** 2).mean(), (e[held] ** 2).mean() if held.any() else None
        history.append((loss, judged))
        judged = loss if judged is None else judged
        since = 0 if judged < least else since + 1
        if judged < least:
            best, least = w, judged
        if since >= how.patience or epoch > how.epochs:
            break
        d = 2 * e[~held] / e[~held].size
        back = (d @ w[2].T) * (1 - h[~held] ** 2)
        g = [x[~held].T @ back, back.sum(0), h[~held].T @ d, d.sum(0)]
        m = [0.9 * a + 0.1 * b for a, b in zip(m, g, strict=True)]
        v = [0.999 * a + 0.001 * b**2 for a, b in zip(v, g, strict=True)]
        w = [p - how.rate * (a / (1 - 0.9**epoch)) / (np.sqrt(b / (1 - 0.999**epoch)) + 1e-8)
             for p, a, b in zip(w, m, v, strict=True)]
    return best, history


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(900, len(FEATURES))), columns=FEATURES)
    pdf["season_Fall"] = 1.0  # does not vary
    pdf["T2M_anom"] = np.sin(pdf.T2M_transformed) - 0.5 * pdf.latitude * pdf.month_sin + 3
    pdf["PRECTOTCORR_anom"] = 40 * np.tanh(pdf.precip_log + pdf.longitude)
    pdf["held"] = np.arange(900) % 5 == 0
    return pdf


@pytest.mark.parametrize("how", [network.Training(epochs=25), network.Training((9,), 40, 0.3, 3, 1)])
@pytest.mark.parametrize("parts", [1, 7])
def test_weights_are_those_of_the_plain_version(spark, rows, how, parts, monkeypatch):
    monkeypatch.setattr(network, "FAN_IN", 3)
    monkeypatch.setattr(network, "BLOCK_ROWS", 50)
    model = scoring.fit_joint_model(spark.createDataFrame(rows).repartition(parts), validation="held", how=how)
    best, history = plain(rows[FEATURES].to_numpy(), rows[TARGETS].to_numpy(), rows["held"].to_numpy(), how)
    assert np.array([h for h in model.history]) == pytest.approx(np.array(history), rel=1e-7)
    for found, expected in zip([p for layer in model.layers for p in layer], best, strict=True):
        assert found == pytest.approx(expected, rel=1e-6, abs=1e-8)
    assert len(history) < how.epochs if how.patience == 3 else len(history) == how.epochs + 1


def test_without_validation_and_with_gaps(spark, rows):
    gaps = rows.drop(columns="held").copy()
    gaps.loc[::9, "latitude"] = np.nan
    gaps.loc[5, "T2M_anom"] = np.nan
    frame = spark.createDataFrame(gaps).withColumns({c: F.nanvl(c, F.lit(None)) for c in ("latitude", "T2M_anom")})
    model = scoring.fit_joint_model(frame, how=network.Training(epochs=8))
    whole = gaps.dropna()
    expected = plain(whole[FEATURES].to_numpy(), whole[TARGETS].to_numpy(), np.zeros(len(whole), bool), network.Training(epochs=8))
    assert [h[0] for h in model.history] == pytest.approx([h[0] for h in expected[1]], rel=1e-7)
    assert all(h[1] is None for h in model.history)
    scored = model.predict(frame.withColumn("_in0", F.lit("kept")))
    assert scored.filter("latitude is null and T2M_anom_predicted is not null").count() == 0
    assert scored.filter("latitude is not null and PRECTOTCORR_anom_predicted is null").count() == 0
    assert scored.filter("_in0 = 'kept'").count() == 900
    with pytest.raises(ValueError, match="no complete rows"):
        scoring.fit_joint_model(frame.withColumn("longitude", F.lit(None).cast("double")))


def test_predictions_are_the_network_s_after_saving(spark, rows, tmp_path):
    frame = spark.createDataFrame(rows)
    model = scoring.fit_joint_model(frame, validation="held", how=network.Training((8, 5), 12))
    model.save(spark, str(tmp_path))
    loaded = scoring.load_model(spark, str(tmp_path))
    assert loaded.features == FEATURES and loaded.targets == TARGETS
    got = loaded.predict(frame).select(*FEATURES, *[f"{t}_predicted" for t in TARGETS]).toPandas()
    x = (got[FEATURES] - pd.Series(model.scaler.centers)) / pd.Series(model.scaler.scales)
    y = network.forward(model.layers, x[FEATURES].to_numpy())[-1]
    for i, t in enumerate(TARGETS):
        expected = y[:, i] * model.target_scaler.scales[t] + model.target_scaler.centers[t]
        assert got[f"{t}_predicted"].to_numpy() == pytest.approx(expected, rel=1e-12, abs=1e-12)
    scoring.fit_anomaly_model(frame, "linear").save(spark, str(tmp_path))
    assert isinstance(scoring.load_model(spark, str(tmp_path)), scoring.AnomalyModel)


def test_job_trains_the_network(spark, rows, tmp_path):
    stored = rows.drop(columns="held").assign(location_id=range(900), time=pd.Timestamp("2020-01-01"))
    spark.createDataFrame(stored).write.parquet(str(tmp_path / "ready"))
    metrics = jobs.train(spark, str(tmp_path / "ready"), str(tmp_path / "model")).toPandas().set_index("target")
    assert metrics.r2["PRECTOTCORR_anom"] > 0.5
    scored = jobs.score_table(spark, str(tmp_path / "ready"), str(tmp_path / "model"), str(tmp_path / "scored"))
    assert scored.where("T2M_error is null").count() == 0


def test_queries_fit_all_features(spark, small):
    rows = catalogue._model_rows(spark, small).toPandas()
    known = rows[rows["part"] != "test"].dropna(subset=[*FEATURES, *TARGETS])
    best, _ = plain(known[FEATURES].to_numpy(float), known[TARGETS].to_numpy(float), (known["part"] == "validation").to_numpy(),
                    network.Training())
    trained = known[known["part"] == "train"]
    x = rows[FEATURES].to_numpy(float)
    centre, spread = trained[FEATURES].mean().to_numpy(), trained[FEATURES].std(ddof=0).to_numpy()
    y = np.tanh((x - centre) / np.where(spread < 1e-14, 1, spread) @ best[0] + best[1]) @ best[2] + best[3]
    y = y * trained[TARGETS].std(ddof=0).to_numpy() + trained[TARGETS].mean().to_numpy()
    expected = {(r.location_id, r.date): v for r, v in zip(rows.itertuples(), y, strict=True)}
    got = catalogue.score_network(spark, small).toPandas()
    assert len(got) == len(rows)
    for r in got.itertuples():
        assert (r.T2M_anom_predicted, r.PRECTOTCORR_anom_predicted) == pytest.approx(tuple(expected[r.location_id, r.date]),
                                                                                     rel=1e-4, abs=1e-4, nan_ok=True)
    assert set(catalogue.network_metrics(spark, small).toPandas()["target"]) == set(TARGETS)
