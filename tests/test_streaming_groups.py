"""Groups of stays in a stream: the rows are those of single stays, and of the batch score."""

import random

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as job
from acuity.operators.grid import STAY
from acuity.plans.scoring import score
from acuity.streaming import hourly
from checks.event_tables import with_arrivals
from tests import test_streaming
from tests.conftest import SF_DIR, rows_of
from tests.test_streaming import COLUMNS, VALUES, some, split


class Held(test_streaming.Held):
    def remove(self):
        self.exists, self.held, self.wake = False, None, None


@pytest.mark.parametrize("groups", [None, 1, 3])
def test_any_number_of_groups_equals_the_batch(spark, tmp_path, groups):
    stays, signals = some(spark, 7)
    held = []
    for batch in split(with_arrivals(hourly.records(stays, signals), 2), 2):
        batch.write.mode("append").parquet(f"{tmp_path}/in")
        stream = hourly.hourly_scores(spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in"), groups=groups)
        sink = stream.writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True)
        run = sink.start(f"{tmp_path}/out")
        run.awaitTermination()
        held += [op["numRowsTotal"] for p in run.recentProgress for op in p["stateOperators"]]
    got = rows_of(spark.read.parquet(f"{tmp_path}/out"), *COLUMNS)
    assert got == rows_of(score(stays, signals), *COLUMNS) and got
    # the state function is called for groups, not for stays, of which there are nine; none is held at the end
    assert (max(held) > 3) if groups is None else (max(held) <= groups) and held[-1] == 0


@pytest.mark.parametrize(("seed", "at_once"), [(seed, at_once) for seed in range(8) for at_once in (1, 100, 250_000)])
def test_a_group_gives_in_each_batch_what_its_stays_give_one_by_one(monkeypatch, seed, at_once):
    monkeypatch.setattr(hourly, "_AT_ONCE", at_once)
    rng = random.Random(seed)
    # ids that are no doubles too, and hours that begin at any time
    zeros = {s: rng.choice([0, 18_000_017, -(10**9)]) for s in (1, 2, 3, -7, 2**60 + 1, 2**60 + 2)}
    alone, group, now = {s: Held() for s in zeros}, Held(), 0
    for _ in range(12):
        records = []
        for stay in rng.choices(sorted(zeros), k=rng.choice([0, 1, 5, 60])):
            row = dict.fromkeys([*hourly.MEASURES, *hourly._MARKS], np.nan)
            row |= {m: float(rng.choice(VALUES[m])) for m in rng.sample(sorted(VALUES), rng.randint(0, 3))}
            row |= {STAY: stay, "minute": rng.randint(-2000, 9000), "opens": rng.choice([1.0, *[np.nan] * 6])}
            row |= {"last": rng.choice([-5.0, 0.0, 60.0, 100.0, *[np.nan] * 60]), "zero": zeros[stay]}
            records.append(row | {"at_ms": zeros[stay] + 60_000 * row["minute"]})
        want, got = [], []
        for stay, state in alone.items():
            own = [np.array([r[f] for f in hourly._FIELDS]) for r in records if r[STAY] == stay]
            state.now = group.now = now
            if own or (state.exists and state.wake < now):
                for out in hourly._advance((stay,), [pd.DataFrame({"record": own})] if own else [], state):
                    points = out["points"][0].reshape(-1, len(hourly._POINTS)).tolist()
                    want += [(stay, int(out["first"][0]) + k, *p) for k, p in enumerate(points)]
        if records or (group.exists and group.wake < now):
            halves = [pd.DataFrame(records[: len(records) // 2]), pd.DataFrame(records[len(records) // 2 :])]
            for out in hourly._advance_group((0,), halves, group):
                for stay, first, packed in out[[STAY, "first", "packed"]].itertuples(index=False):
                    for k, bits in enumerate(packed.tolist()):
                        points = [bits >> (hourly._BITS * i) & (2**hourly._BITS - 1) for i in range(len(hourly.SCORES))]
                        got.append((stay, first + k, *points, sum(points)))
        assert sorted(got) == sorted(want)
        assert set(hourly._Group(group.held).stays["stay"]) == {s for s, state in alone.items() if state.exists}
        now += rng.choice([0, 1, 10, 30, 50]) * hourly.HOUR_MS + rng.choice([0, 5])


def test_a_group_holds_known_values_only():
    group = hourly._Group(None)
    n = 1000
    row = {m: np.nan for m in (*hourly.MEASURES, *hourly._MARKS)}
    group.add(pd.DataFrame({STAY: np.arange(n) % 50, "minute": np.arange(n) * 60, "zero": 0, **row, "GCS_min": 3.0}))
    again = hourly._Group(group.as_state())
    assert np.array_equal(again.cells, group.cells, equal_nan=True) and np.array_equal(again.of, group.of)
    assert sum(map(len, group.as_state())) < n * 8 * 3 + 50 * 64


def test_records_are_worked_out_once(spark, monkeypatch):
    """What the arrivals look at first is a written table."""
    seen = []

    def look(records, arrivals):
        seen.append(records)
        raise InterruptedError

    monkeypatch.setattr(job.ev, "with_arrivals", look)
    with pytest.raises(InterruptedError):
        job.queries()["streamed_sofa"](spark, SF_DIR)
    files = seen[0].inputFiles()
    assert files and all("/records_" in f for f in files)
