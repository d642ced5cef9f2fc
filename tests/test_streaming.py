"""The hourly score of a stream: any order within the delay gives the rows of the batch score."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acuity import rules
from acuity.operators.grid import STAY, Signal
from acuity.plans.scoring import score
from acuity.streaming import hourly
from checks.event_tables import with_arrivals
from tests.conftest import rows_of

COLUMNS = [STAY, "hr", *hourly.SCORES, "SOFA_24hours"]
#: measure -> values, those of a band's bound, between two bands and of no band among them
VALUES = {
    "MeanBP_min": [60, 70, 80],
    "GCS_min": [3, 6, 9, 9.5, 10, 14, 15],
    "bilirubin_max": [0.5, 1.2, 6, 12],
    "creatinine_max": [0.5, 1.2, 3.5, 5],
    "platelet_min": [10, 20, 49.5, 100, 150],
    "PaO2FiO2Ratio_novent": [50, 299, 300, 400],
    "PaO2FiO2Ratio_vent": [50, 100, 199, 200],
    "rate_norepinephrine": [0.1, 0.11],
    "rate_epinephrine": [0.05, 0.5],
    "rate_dobutamine": [1, 2],
    "rate_dopamine": [1, 5, 5.5, 16],
    "urineoutput": [0, 5, 120, 300],
}


def some(spark, seed, n=260):
    """Stays of many kinds, and measurements on and off their hours."""
    rng = random.Random(seed)
    stays = spark.createDataFrame(
        [(1, "40", 60 * 70), (2, "> 89", 60 * 9 + 1), (3, "", 900), (4, "50", -60 * 30), (5, "50", -60), (6, "50", None), (7, "50", 60 * 55), (8, "9", 0)],
        f"{STAY} long, age string, unitdischargeoffset int",
    )
    rows = []
    for _ in range(n):
        row = {STAY: rng.choice([1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]), "m": rng.choice([None, *[rng.randint(-2000, 4600) for _ in range(30)]])}
        for measure in rng.sample(sorted(VALUES), rng.randint(0, 2)):
            row[measure] = float(rng.choice(VALUES[measure]))
        rows.append(tuple(row.get(c) for c in (STAY, "m", *VALUES)))
    table = spark.createDataFrame(rows, f"{STAY} long, m int, {', '.join(f'{c} double' for c in VALUES)}")
    return stays, [Signal(table, "m", [(c, F.col(c), how) for c, how in hourly.MEASURES.items()])]


def replay(spark, batches, tmp_path, delay="12 hours"):
    """Each frame arrives by itself; (all rows, the number of rows after each, rows dropped as late)."""
    counts, dropped = [], 0
    for batch in batches:
        batch.write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in")
        sink = hourly.hourly_scores(stream, delay).writeStream.option("checkpointLocation", f"{tmp_path}/state")
        run = sink.trigger(availableNow=True).start(f"{tmp_path}/out")
        run.awaitTermination()
        dropped += sum(op["numRowsDroppedByWatermark"] for p in run.recentProgress for op in p["stateOperators"])
        counts.append(spark.read.schema(hourly._OUT).parquet(f"{tmp_path}/out").count())
    return spark.read.parquet(f"{tmp_path}/out"), counts, dropped


def split(rows, arrivals):
    rows = rows.cache()
    return [rows.where(F.col("arrival") == i).drop("arrival") for i in range(arrivals)]


@pytest.mark.parametrize("arrivals", [1, 3])
def test_a_replay_out_of_order_equals_the_batch(spark, tmp_path, arrivals):
    stays, signals = some(spark, arrivals)
    got, counts, dropped = replay(spark, split(with_arrivals(hourly.records(stays, signals), arrivals), arrivals), tmp_path)
    want = rows_of(score(stays, signals), *COLUMNS)
    assert rows_of(got, *COLUMNS) == want and dropped == 0
    assert {r[0] for r in want} == {1, 2, 7, 8}
    # hours don't wait for their stay's end
    assert counts == sorted(counts) and (arrivals == 1 or 0 < counts[1] < counts[2])


def record(spark, *rows):
    """Records given as dicts; the time is that of the minute unless told."""
    data = [tuple(r.get(c) for c in (STAY, "minute", *hourly.MEASURES, "opens", "last")) for r in rows]
    times = [r.get("at", r.get("minute")) for r in rows]
    df = spark.createDataFrame([(*d, t) for d, t in zip(data, times, strict=True)], f"{hourly.RECORD}, t long")
    return df.withColumn("at", F.timestamp_seconds(F.lit(10**9) + F.col("t") * 60)).drop("t")


def test_late_records_are_dropped_and_counted(spark, tmp_path):
    opened = {STAY: 1, "minute": -1440, "opens": 1.0}
    low, far = {STAY: 1, "minute": 30, "GCS_min": 3.0}, {STAY: 1, "minute": 60 * 30, "GCS_min": 10.0}
    late, in_time = {STAY: 1, "minute": 90, "MeanBP_min": 50.0}, {STAY: 1, "minute": 60 * 29, "platelet_min": 10.0}
    beat = {"at": 60 * 200}
    batches = [record(spark, opened, low, far), record(spark, late, in_time), record(spark, {STAY: 1, "minute": 60 * 32, "last": 32.0}, beat)]
    got, counts, dropped = replay(spark, batches, tmp_path, "2 hours")
    rows = {r.hr: r for r in got.collect()}
    assert dropped == 1 and sorted(rows) == list(range(33)) and got.count() == 33
    # hours that ended before the watermark were given at once, silent ones too
    assert counts[0] == 28
    assert all(r.cardiovascular_24hours == 0 for r in rows.values())
    assert [rows[h].cns_24hours for h in (0, 1, 24, 25, 29, 30, 32)] == [0, 4, 4, 0, 0, 2, 2]
    assert [rows[h].coagulation_24hours for h in (28, 29)] == [0, 4] and rows[30].SOFA_24hours == 6


def test_stays_that_never_open_or_have_no_id_give_nothing(spark, tmp_path):
    batch = record(
        spark,
        {STAY: 5, "minute": 30, "GCS_min": 3.0},
        {STAY: None, "minute": 30, "GCS_min": 3.0},
        {STAY: 6, "minute": None, "at": 5, "GCS_min": 3.0},
        {STAY: 6, "minute": 40, "at": None, "GCS_min": 3.0},
        {STAY: 6, "minute": -1440, "opens": 1.0},
        {STAY: 6, "minute": 60, "last": 1.0},
        {"at": 9000},
    )
    got, _, _ = replay(spark, [batch], tmp_path)
    assert rows_of(got, *COLUMNS) == [(6, h, 0, 0, 0, 0, 0, 0, 0) for h in (0, 1)]


def test_an_empty_stream(spark, tmp_path):
    got, counts, _ = replay(spark, [record(spark, {"at": 1}).where("false")], tmp_path)
    assert counts == [0] and got.count() == 0


def test_what_is_held_of_a_stay_is_bounded():
    hours = hourly._Hours(None, 0)
    for at in range(0, 5000, 50):
        minutes = range(60 * at, 60 * (at + 50), 7)
        pdf = pd.DataFrame({"minute": list(minutes), **{m: 1.0 for m in hourly.MEASURES}, "opens": 1.0, "last": float("nan")})
        hours.add(pdf)
        out = hours.scores(at + 40)
        assert list(out["hr"])[-1] == at + 40 and len(hours.rows) <= 2 * rules.ROLLING_HOURS + 10
        hours = hourly._Hours(hours.as_state(), 0)


class Held:
    """A state as Spark holds it."""

    exists, now, held, wake = False, 0, None, None

    def getCurrentWatermarkMs(self):
        return self.now

    @property
    def get(self):
        return self.held

    def update(self, held):
        self.exists, self.held = True, held

    def setTimeoutTimestamp(self, at):
        self.wake = at


def test_a_batch_of_a_stay_is_one_column_in_and_one_row_out():
    """What a stay costs in a batch is columns converted, not rows."""

    def record(minute, **values):
        return np.array([{"minute": minute, "at_ms": 60_000 * minute, **values}.get(f, np.nan) for f in hourly._FIELDS])

    state = Held()
    first = pd.DataFrame({"record": [record(-1440, opens=1.0), record(30, GCS_min=3.0), record(60 * 50, urineoutput=9.0)]})
    assert list(hourly._advance((1,), [first], state)) == []
    state.now = hourly.HOUR_MS * 41
    (out,) = hourly._advance((1,), [], state)
    assert list(out.columns) == [STAY, "first", "points"] and len(out) == 1 and (out[STAY][0], out["first"][0]) == (1, 0)
    points = out["points"][0].reshape(-1, len(hourly.SCORES) + 1)
    cns = hourly.SCORES.index("cns_24hours")
    assert points[:, cns].tolist() == [0] + [4] * 24 + [0] * 16 and points[:, -1].tolist() == points[:, cns].tolist()
    assert state.wake > state.now
