"""Windows that land in pieces: the rows of a split landing are those of an unsplit one."""

import datetime as dt
import json
import random

import pytest

from gridseries.plans import scoring
from gridseries.schemas import WINDOW_PARAMETERS
from gridseries.streaming import pieces

START = dt.datetime(2024, 1, 1)


def periods(months):
    return [f"{2020 + i // 12}{i % 12 + 1:02d}" for i in range(months)]


def piece(location, some, months, hours, scale=1.0, parameters=WINDOW_PARAMETERS):
    parameter = {p: {d: scale * (int(d[:4]) - 2019) * (k + int(d[4:])) for d in some} for k, p in enumerate(parameters)}
    landed = (START + dt.timedelta(hours=hours)).isoformat() + "Z"
    return {"location_id": location, "request": "w", "months": months, "landed_at": landed,
            "properties": {"parameter": parameter}}


class Inbox:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        (folder / "inbox").mkdir()

    def land(self, *found):
        self.files += 1
        (self.folder / "inbox" / f"p{self.files:03d}.json").write_text("\n".join(map(json.dumps, found)))

    def run(self, files=1):
        pieces.start_scoring_pieces(self.spark, str(self.folder / "inbox"), str(self.folder / "out"), str(self.folder / "mark"),
                                    scoring.damped_anomaly(), str(self.folder / "warn"), files_per_trigger=files).awaitTermination()
        rows = self.spark.read.parquet(str(self.folder / "out")).drop("batch_id").collect()
        return sorted(tuple(r) for r in rows)


def test_split_landing_gives_the_rows_of_an_unsplit_one(spark, tmp_path):
    (tmp_path / "whole").mkdir(), (tmp_path / "split").mkdir()
    whole, split = Inbox(spark, tmp_path / "whole"), Inbox(spark, tmp_path / "split")
    rng, every = random.Random(3), periods(14)
    cut = []
    for location in (1, 2, 3):
        whole.land(piece(location, every, 14, 0, location))
        order = rng.sample(every, 14)
        cut += [piece(location, order[a:b], 14, h, location) for h, (a, b) in enumerate(((0, 5), (5, 6), (6, 14)))]
    cut += [piece(2, every[:3], 14, 1, 2), piece(1, every, 14, 3, 99.0)]  # months again, and a window again that is closed
    rng.shuffle(cut)
    cut.sort(key=lambda p: p["landed_at"])
    for p in cut[:7]:
        split.land(p)
    part = split.run()
    for p in cut[7:]:
        split.land(p)
    rows = split.run(2)
    assert len(rows) == 42 and set(part) <= set(rows)
    expected = whole.run()
    assert rows == expected and all(r[2] for r in rows)
    assert split.run() == rows  # nothing new
    assert spark.read.parquet(str(tmp_path / "split" / "warn")).where("temperature_anomaly <= 0.5").count() == 0


def test_state_runs_once_per_window_and_batch(spark, tmp_path):
    """Scoring reads the rows of a batch several times; the state's functions once ran again each time, on a row per month."""
    inbox = Inbox(spark, tmp_path)
    every = periods(12)
    inbox.land(*[piece(i, every, 12, 0) for i in range(6)], piece(0, every[:3], 12, 0))
    query = pieces.start_scoring_pieces(spark, str(inbox.folder / "inbox"), str(inbox.folder / "out"),
                                        str(inbox.folder / "mark"), scoring.damped_anomaly())
    query.awaitTermination()
    assert spark.read.parquet(str(inbox.folder / "out")).count() == 72
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in map(lambda p: json.loads(p.json), query.recentProgress)) == 6
    shuffled = pieces._months(pieces.read_pieces(spark, str(inbox.folder / "inbox")))
    assert shuffled.isStreaming and "explode" not in shuffled._jdf.queryExecution().analyzed().toString().lower()


def test_pieces_without_months_change_nothing(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    every = periods(12)
    empty = piece(1, [], 99, 0)
    inbox.land(empty, empty | {"properties": None}, empty | {"properties": {"parameter": None}}, piece(1, ["202013"], 99, 0),
               piece(1, every[:6] + ["202013"], 12, 1), piece(2, [], 0, 1))
    assert inbox.run() == []
    inbox.land(piece(1, every[6:], 12, 2))
    rows = inbox.run()
    assert [(r[0], r[2], r[3]) for r in rows] == [(1, True, f"2020-{m:02d}") for m in range(1, 13)]


def test_late_windows_close_incomplete_and_state_goes(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    every = periods(12)
    inbox.land(piece(1, every[:7], 12, 0), piece(2, every, 12, 0))
    assert {r[0] for r in inbox.run()} == {2}
    inbox.land(piece(3, every, 12, 30))  # a day later: the first window is late
    rows = inbox.run()
    assert {(r[0], r[2]) for r in rows} == {(1, False), (2, True), (3, True)} and sum(r[0] == 1 for r in rows) == 7
    state = spark.read.format("statestore").option("stateVarName", "window").load(str(tmp_path / "mark"))
    assert [r["key"]["location_id"] for r in state.collect()] == [3]
    inbox.land(piece(1, every[7:], 12, 31))
    inbox.land(piece(4, every[:1], 12, 90))
    rows = inbox.run()
    assert sum(r[0] == 1 for r in rows) == 12 and not any(r[2] for r in rows if r[0] == 1)


def test_a_month_keeps_what_came_first_and_is_filled(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    every = periods(12)
    inbox.land(piece(1, every[:11], 12, 0, 1.0, WINDOW_PARAMETERS[:3]))
    assert inbox.run() == []
    inbox.land(piece(1, every, 12, 1, 2.0))
    rows = inbox.run()
    by = {r[3]: r for r in rows}
    assert by["2020-01"][6] == 1.0 and by["2020-12"][6] == 24.0  # T2M of the first and of the second piece
    assert by["2020-01"][7] == pytest.approx(2.0 * 4)  # rain was missing in the first
