"""Normals from stored landings against normals of all rows at once."""

import datetime as dt

import pytest

from gridseries.operators.baselines import monthly_normals
from gridseries.plans import normals

SCHEMA = "latitude double, longitude double, time timestamp, T2M double, PRECTOTCORR double"


def rows(year, months, places=4):
    found = []
    for p in range(places):
        for m in months:
            value = None if (p + m + year) % 7 == 0 else float(p * 10 + m + year % 5)
            # Places 0 and 1 share a rounded one.
            found.append((10.0 + p // 2 + p % 2 * 0.001, 20.0, dt.datetime(year, m, 1), value, float(m)))
    return found


def table(frame):
    return {(r["lat_rounded"], r["month"]): (
        None if r["baseline_temp"] is None else round(r["baseline_temp"], 9), round(r["baseline_precip"], 9),
        r["latitude"]) for r in frame.collect()}


@pytest.fixture()
def landings(spark):
    parts = {"a": rows(2001, range(1, 13)), "b": rows(2000, [2, 3]), "c": rows(2002, [3, 12])}
    return {name: spark.createDataFrame(found, SCHEMA) for name, found in parts.items()}


def test_landings_add_up(spark, tmp_path, landings):
    store = str(tmp_path / "store")
    changed = [normals.land_normals(frame, store, name) for name, frame in landings.items()]
    assert changed == [list(range(1, 13)), [2, 3], [3, 12]]
    whole = landings["a"].unionByName(landings["b"]).unionByName(landings["c"])
    expected = table(monthly_normals(whole))
    assert table(normals.stored_normals(spark, store)) == expected
    assert table(normals.stored_normals(spark, store, [3])) == {k: v for k, v in expected.items() if k[1] == 3}


def test_other_months_stay_untouched(spark, tmp_path, landings):
    store = str(tmp_path / "store")
    normals.land_normals(landings["a"], store, "a")
    before = set(normals.stored_states(spark, store).inputFiles())
    normals.land_normals(landings["b"], store, "b")
    after = set(normals.stored_states(spark, store).inputFiles())
    assert {f.rsplit("part=", 1)[1].split("/")[0] for f in before - after} == {"2", "3"}


def test_replays_and_interrupted_landings(spark, tmp_path, landings, monkeypatch):
    store = str(tmp_path / "store")
    normals.land_normals(landings["a"], store, "a")
    expected = table(normals.stored_normals(spark, store))
    assert normals.land_normals(landings["a"], store, "a") == []
    assert table(normals.stored_normals(spark, store)) == expected
    # The driver dies after the states are written and before the manifest names them.
    with monkeypatch.context() as broken:
        broken.setattr(normals, "MANIFEST", "no schema")
        broken.setattr(normals, "_manifest", lambda *_: (1, {}))
        with pytest.raises(Exception):
            normals.land_normals(landings["b"], store, "b")
    assert table(normals.stored_normals(spark, store)) == expected
    assert normals.land_normals(landings["b"], store, "b") == [2, 3]
    assert table(normals.stored_normals(spark, store)) == table(
        monthly_normals(landings["a"].unionByName(landings["b"])))


def test_replaced_folders_go(spark, tmp_path, landings):
    store = str(tmp_path / "store")
    for name, frame in landings.items():
        normals.land_normals(frame, store, name)
    expected = table(normals.stored_normals(spark, store))
    assert normals.remove_replaced(spark, store) == 4
    assert normals.remove_replaced(spark, store) == 0
    assert table(normals.stored_normals(spark, store)) == expected


def test_nothing_landed(spark, tmp_path, landings):
    store = str(tmp_path / "store")
    assert normals.land_normals(landings["a"].limit(0), store, "none") == []
    with pytest.raises(FileNotFoundError):
        normals.stored_normals(spark, store)
