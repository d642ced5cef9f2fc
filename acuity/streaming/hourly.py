"""The hourly score of a stream of measurements."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from acuity import rules
from acuity.operators.grid import STAY, Signal, cohort, measured
from acuity.session import share_code

HOUR_MS = 3_600_000
#: hours before the one to score whose values count: a day of urine for each hour of a day
_REACH = 2 * (rules.ROLLING_HOURS - 1)

# --- the records of a stream ---------------------------------------------------
#: measure -> the way it is reduced to its hour
MEASURES = {
    "MeanBP_min": "min",
    "GCS_min": "min",
    "bilirubin_max": "max",
    "creatinine_max": "max",
    "platelet_min": "min",
    "PaO2FiO2Ratio_novent": "min",
    "PaO2FiO2Ratio_vent": "min",
    "rate_norepinephrine": "max",
    "rate_epinephrine": "max",
    "rate_dobutamine": "max",
    "rate_dopamine": "max",
    "urineoutput": "sum",
}
_MARKS = ("opens", "last")
#: columns of a record but for its time
RECORD = f"{STAY} long, minute long, {', '.join(f'{m} double' for m in (*MEASURES, *_MARKS))}"
SCORES = [f"{organ}_{rules.ROLLING_HOURS}hours" for organ in rules.ORGANS]
_POINTS = [*SCORES, f"SOFA_{rules.ROLLING_HOURS}hours"]
_OUT = f"{STAY} long, hr int, {', '.join(f'{s} int' for s in _POINTS)}"
#: what the state function takes of a record, as one array, and gives, the points of its hours in a row; a column more costs
#: time for each stay and batch, whatever it holds
_FIELDS = ["minute", *MEASURES, *_MARKS, "at_ms"]
_HOURS = f"{STAY} long, first int, points array<int>"
_STATE = "zero long, opened boolean, last int, next int, hours array<int>, cells array<double>"
#: groups that share out the stays of a stream; a stream that holds a million stays at once has about a thousand in each
GROUPS = 1024
#: what is held of a group: its stays, and for each hour of one that has values the place of its stay, the hour, a bit for each
#: measure that is known, and the known values, measure by measure
_HELD = np.dtype([("stay", "i8"), ("zero", "i8"), ("opened", "?"), ("last", "f8"), ("next", "i8")])
_GROUP_STATE = "stays binary, of binary, hours binary, known binary, cells binary"
#: the organs' points of an hour come back in one whole number, so many bits each
_BITS = max(rules.ORGAN_LEVELS).bit_length()
_GROUP_HOURS = f"{STAY} long, first int, packed array<int>"
#: records that are taken in, and hours that are scored, at once
_AT_ONCE = 250_000


def stay_records(stays: DataFrame) -> DataFrame:
    """The records that open a stay, at the begin of its grid, and close it, in its last hour."""
    span = cohort(stays).where(F.col("los_icu_hours") >= -rules.GRID_LEAD_HOURS)
    span = span.groupBy(STAY).agg(F.max("los_icu_hours").alias("end"))
    opens = span.select(STAY, F.lit(-60 * rules.GRID_LEAD_HOURS).cast("long").alias("minute"), F.lit(1.0).alias("opens"))
    closes = span.select(STAY, (F.col("end") * 60).cast("long").alias("minute"), F.col("end").cast("double").alias("last"))
    return opens.unionByName(closes, allowMissingColumns=True)


def records(stays: DataFrame, signals: Sequence[Signal]) -> DataFrame:
    """Measurements and stays as the records that :func:`hourly_scores` takes, but for their time."""
    rows = measured(signals).drop("hr").unionByName(stay_records(stays), allowMissingColumns=True)
    return rows.select(STAY, F.col("minute").cast("long").alias("minute"), *MEASURES, *_MARKS)


def _below(x: np.ndarray, bands) -> list[tuple]:
    return [(x < limit, score) for limit, score in bands]


def _points_of(bands: Sequence[tuple]) -> np.ndarray:
    return np.max([np.where(holds, score, 0) for holds, score in bands], axis=0)


def _organs(values: Mapping[str, np.ndarray], urine_day: np.ndarray) -> list[np.ndarray]:
    """Points of each organ per hour, zero where nothing is known; the worst of the rules that hold."""

    def at_least(x, bands):
        return [(x >= limit, score) for limit, score in bands]

    gcs, dopamine = values["GCS_min"], values["rate_dopamine"]
    strong = [values["rate_epinephrine"], values["rate_norepinephrine"]]
    found = {
        "respiration": _below(values["PaO2FiO2Ratio_vent"], rules.PF_VENT_BELOW)
        + _below(values["PaO2FiO2Ratio_novent"], rules.PF_NOVENT_BELOW),
        "coagulation": _below(values["platelet_min"], rules.PLATELETS_BELOW),
        "liver": at_least(values["bilirubin_max"], rules.BILIRUBIN_FROM),
        "cardiovascular": [(dopamine > limit, score) for limit, score in rules.DOPAMINE_ABOVE]
        + [(rate > rules.CATECHOLAMINE_LIMIT, 4) for rate in strong]
        + [(rate <= rules.CATECHOLAMINE_LIMIT, 3) for rate in strong]
        + [(values["rate_dobutamine"] > 0, 2)]
        + _below(values["MeanBP_min"], rules.MAP_BELOW),
        "cns": _below(gcs, rules.GCS_BELOW)
        + [((gcs >= low) & (gcs <= high), score) for low, high, score in rules.GCS_BETWEEN],
        "renal": at_least(values["creatinine_max"], rules.CREATININE_FROM) + _below(urine_day, rules.URINE_BELOW),
    }
    return [_points_of(found[organ]) for organ in rules.ORGANS]


def _last_hours(x: np.ndarray, reduce) -> np.ndarray:
    """Values of hours, along the last axis, over the last day of them; the first ones see what there is."""
    nothing = np.zeros((*x.shape[:-1], rules.ROLLING_HOURS - 1), x.dtype)
    days = np.lib.stride_tricks.sliding_window_view(np.concatenate((nothing, x), axis=-1), rules.ROLLING_HOURS, axis=-1)
    return reduce(days, axis=-1)


def _urine_day(x: np.ndarray) -> np.ndarray:
    known = ~np.isnan(x)
    return np.where(_last_hours(known, np.any), _last_hours(np.where(known, x, 0.0), np.sum), np.nan)


def _worst_day(points: np.ndarray) -> np.ndarray:
    """The worst points of the last day for each hour, along the last axis, from those of 1, 2, 4, ... hours."""
    worst, reach = points.copy(), 1
    while reach < rules.ROLLING_HOURS:
        step = min(reach, rules.ROLLING_HOURS - reach)
        # a longer stretch is two that may overlap
        worst[..., step:] = np.maximum(worst[..., step:], worst[..., :-step])
        reach += step
    return worst


class _Hours:
    """What is held of a stay: a row of reduced values for each hour that can still count."""

    def __init__(self, held: tuple | None, zero: int):
        self.zero, self.opened, self.last, self.next, hours, cells = held or (zero, False, None, 0, [], [])
        self.rows = np.array(hours, np.int64)
        self.cells = np.array(cells, np.float64).reshape(len(hours), len(MEASURES))

    def add(self, pdf: pd.DataFrame) -> None:
        """Records of one micro-batch; of an hour they meet what is there."""
        self.opened = bool(self.opened or (pdf["opens"] == 1).any())
        if pdf["last"].notna().any():
            self.last = int(np.nanmax([pdf["last"].max(), np.nan if self.last is None else self.last]))
        hr = np.ceil(pdf["minute"].to_numpy(np.float64) / 60).astype(np.int64)
        # what lies before the grid, and hours scored already, count no more
        on_grid = hr >= max(-rules.GRID_LEAD_HOURS, self.next - _REACH)
        values = pdf[list(MEASURES)].to_numpy(np.float64)
        some = on_grid & ~np.isnan(values).all(axis=1)
        rows, at = np.unique(np.concatenate((self.rows, hr[some])), return_inverse=True)
        values = np.concatenate((self.cells, values[some]))
        cells = np.full((len(rows), len(MEASURES)), np.nan)
        for j, how in enumerate(MEASURES.values()):
            known = ~np.isnan(values[:, j])
            start = {"min": np.inf, "max": -np.inf, "sum": 0.0}[how]
            cells[at[known], j] = start
            {"min": np.fmin, "max": np.fmax, "sum": np.add}[how].at(cells[:, j], at[known], values[known, j])
        self.rows, self.cells = rows, cells

    def scores(self, until: int) -> pd.DataFrame:
        """Scores of the hours from the next one to ``until``, which then are done with."""
        first = max(-rules.GRID_LEAD_HOURS, self.next - _REACH)
        dense = np.full((until - first + 1, len(MEASURES)), np.nan)
        held = (self.rows >= first) & (self.rows <= until)
        dense[self.rows[held] - first] = self.cells[held]
        values = dict(zip(MEASURES, dense.T, strict=True))
        organs = _organs(values, _urine_day(values["urineoutput"]))
        # points are no less than zero, which is what stands before the first hour
        worst = _last_hours(np.array(organs, np.int32), np.max)[:, self.next - first :]
        hours = np.arange(self.next, until + 1, dtype=np.int32)
        out = pd.DataFrame(np.vstack((hours, worst, worst.sum(axis=0, dtype=np.int32))).T, columns=["hr", *_POINTS])
        self.next = until + 1
        kept = self.rows >= self.next - _REACH
        self.rows, self.cells = self.rows[kept], self.cells[kept]
        return out

    def as_state(self) -> tuple:
        return (self.zero, self.opened, self.last, self.next, self.rows.tolist(), self.cells.ravel().tolist())


class _Group:
    """What is held of the stays of a group, in arrays: a row for each stay, and one for each hour that can still count."""

    def __init__(self, held: tuple | None):
        stays, of, hours, bits, values = held or (b"",) * 5
        self.stays = np.frombuffer(stays, _HELD).copy()
        #: of each hour with values: the place of its stay, the hour, and the values, a row for each measure
        self.of, self.hours = np.frombuffer(of, np.int32).astype(np.int64), np.frombuffer(hours, np.int64)
        self.cells = np.full((len(MEASURES), len(self.of)), np.nan)
        known = np.unpackbits(np.frombuffer(bits, np.uint8), count=self.cells.size).astype(bool)
        self.cells[known.reshape(self.cells.shape)] = np.frombuffer(values, np.float64)

    def add(self, pdf: pd.DataFrame) -> None:
        """Records of any stays of the group; of an hour they meet what is there."""
        old = len(self.stays)
        came = pdf[STAY].to_numpy(np.int64)
        ids, first, at = np.unique(np.concatenate((self.stays["stay"], came)), return_index=True, return_inverse=True)
        at_old, at = at[:old], at[old:]
        stays = np.zeros(len(ids), _HELD)
        stays["stay"], stays["last"] = ids, np.nan
        # a stay's hours count from where its first record says
        stays["zero"] = np.concatenate((self.stays["zero"], pdf["zero"].to_numpy(np.int64)))[first]
        stays[at_old] = self.stays
        stays["opened"][at[pdf["opens"].to_numpy(np.float64) == 1]] = True
        last = stays["last"].copy()
        np.fmax.at(last, at, pdf["last"].to_numpy(np.float64))
        stays["last"] = last

        hr = -(-pdf["minute"].to_numpy(np.int64) // 60)
        values = [pdf[m].to_numpy(np.float64) for m in MEASURES]
        known = [~np.isnan(v) for v in values]
        # what lies before the grid, and hours scored already, count no more
        some = (hr >= self._from(stays)[at]) & np.any(known, axis=0)
        of, hours = np.concatenate((at_old[self.of], at[some])), np.concatenate((self.hours, hr[some]))
        order = np.lexsort((hours, of))
        of, hours = of[order], hours[order]
        begins = np.ones(len(of), bool)
        begins[1:] = (of[1:] != of[:-1]) | (hours[1:] != hours[:-1])
        cell = np.empty(len(of), np.int64)
        cell[order] = np.cumsum(begins) - 1
        held, came = cell[: len(self.of)], cell[len(self.of) :]
        cells = np.full((len(MEASURES), int(begins.sum())), np.nan)
        cells[:, held] = self.cells
        for row, v, k, how in zip(cells, values, known, MEASURES.values(), strict=True):
            told = k[some]
            to, v = came[told], v[some][told]
            if how == "sum":
                row[to] = np.where(np.isnan(row[to]), 0.0, row[to])
            {"min": np.fmin, "max": np.fmax, "sum": np.add}[how].at(row, to, v)
        self.stays, self.of, self.hours, self.cells = stays, of[begins], hours[begins], cells

    @staticmethod
    def _from(stays: np.ndarray) -> np.ndarray:
        """The first hour of each stay that can still count."""
        return np.maximum(-rules.GRID_LEAD_HOURS, stays["next"] - _REACH)

    def _ended(self, now: int) -> np.ndarray:
        """The last hour of each stay that ended before the watermark."""
        return -(-(now - self.stays["zero"]) // HOUR_MS) - 1

    def scores(self, now: int) -> Iterator[pd.DataFrame]:
        """Scores of the hours that the watermark has passed, a row for each stay with any; they then are done with."""
        until = np.fmin(self._ended(now), self.stays["last"]).astype(np.int64)
        due = np.flatnonzero(self.stays["opened"] & (until >= self.stays["next"]))
        width = until - self._from(self.stays) + rules.ROLLING_HOURS
        block = np.cumsum(width[due]) // _AT_ONCE
        for some in np.split(due, np.flatnonzero(np.diff(block)) + 1):
            if len(some):
                yield self._score(some, until[some], width[some])

    def _score(self, some: np.ndarray, until: np.ndarray, width: np.ndarray) -> pd.DataFrame:
        """Scores of these stays up to these hours. Their hours lie one after the other, each stay's after a day less an hour
        of nothing, so that no last day reaches into the stay before."""
        lead = rules.ROLLING_HOURS - 1
        ends = np.cumsum(width)
        zero = np.zeros(len(self.stays), np.int64)  # where hour 0 of a stay lies
        zero[some] = ends - 1 - until
        ready = np.full(len(self.stays), np.iinfo(np.int64).min)
        ready[some] = until
        counts = (self.hours <= ready[self.of]) & (self.hours >= self._from(self.stays)[self.of])
        place = zero[self.of[counts]] + self.hours[counts]
        cells = dict(zip(MEASURES, self.cells[:, counts], strict=True))

        urine = np.full(ends[-1], np.nan)
        urine[place] = cells["urineoutput"]
        urine_day = _urine_day(urine)
        points = np.zeros((len(rules.ORGANS), ends[-1]), np.int8)
        points[rules.ORGANS.index("renal")] = _points_of(_below(urine_day, rules.URINE_BELOW))
        points[:, place] = _organs(cells, urine_day[place])
        blank = np.arange(lead) + (ends - width)[:, None]
        points[:, blank.ravel()] = 0
        worst = _worst_day(points)

        first = self.stays["next"][some]
        told = until + 1 - first
        upto = np.cumsum(told)
        hour = np.arange(upto[-1]) + np.repeat(ends - upto, told)
        packed = sum(row.astype(np.int32) << (_BITS * i) for i, row in enumerate(worst))[hour]
        runs = [packed[end - n : end] for n, end in zip(told.tolist(), upto.tolist(), strict=True)]
        self.stays["next"][some] = until + 1
        return pd.DataFrame({STAY: self.stays["stay"][some], "first": first.astype(np.int32), "packed": pd.Series(runs, dtype=object)})

    def settle(self, now: int) -> int | None:
        """Let go of stays and hours that are done with; the time of the next hour to end, None where no stay is left."""
        stays = self.stays
        latest = np.where(np.isnan(stays["last"]), 0, stays["last"]).astype(np.int64)
        np.maximum.at(latest, self.of, self.hours)
        # a stay that never opens is given up when all its hours have ended
        past = np.where(stays["opened"], stays["next"] > stays["last"], self._ended(now) >= latest)
        wake = stays["zero"] + np.where(stays["opened"], stays["next"], latest) * HOUR_MS
        kept = ~past[self.of] & (self.hours >= self._from(stays)[self.of])
        self.of = (np.cumsum(~past) - 1)[self.of[kept]]
        self.hours, self.cells = self.hours[kept], self.cells[:, kept]
        self.stays = stays[~past]
        return None if past.all() else int(max(wake[~past].min(), now + 1))

    def as_state(self) -> tuple:
        known = ~np.isnan(self.cells)
        held = (self.stays, self.of.astype(np.int32), self.hours, np.packbits(known), self.cells[known])
        return tuple(a.tobytes() for a in held)


def _advance_group(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """:func:`_advance` for all stays of a group at once: what a call costs besides its rows is shared by them."""
    (number,) = key
    parts, rows = [], 0
    group = _Group(state.get if state.exists else None)
    for pdf in batches:
        if number < 0 or not len(pdf):
            continue
        parts.append(pdf)
        rows += len(pdf)
        if rows >= _AT_ONCE:
            group.add(pd.concat(parts, ignore_index=True))
            parts, rows = [], 0
    if parts:
        group.add(pd.concat(parts, ignore_index=True))
    if number < 0:
        return
    now = state.getCurrentWatermarkMs()
    yield from group.scores(now)
    wake = group.settle(now)
    if wake is None:
        if state.exists:
            state.remove()
        return
    state.update(group.as_state())
    state.setTimeoutTimestamp(wake)


def _advance(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Take in a stay's records, score the hours that the watermark has passed, and wait for the next."""
    (stay,) = key
    parts = [record for p in batches for record in p["record"]]
    if stay is None or stay != stay:
        return
    now = state.getCurrentWatermarkMs()
    pdf = pd.DataFrame(np.array(parts, np.float64), columns=_FIELDS) if parts else None
    zero = int(pdf["at_ms"].iloc[0] - 60_000 * pdf["minute"].iloc[0]) if pdf is not None else 0
    hours = _Hours(state.get if state.exists else None, zero)
    if pdf is not None:
        hours.add(pdf)
    ended = -(-(now - hours.zero) // HOUR_MS) - 1  # the last hour that ended before the watermark
    until = ended if hours.last is None else min(ended, hours.last)
    if hours.opened and until >= hours.next:
        first = hours.next
        points = hours.scores(int(until))[_POINTS].to_numpy(np.int32)
        yield pd.DataFrame({STAY: [stay], "first": [first], "points": [points.ravel()]})
    past = hours.last is not None and hours.next > hours.last
    if not hours.opened:
        # a stay that never opens is given up when all its hours have ended
        latest = max([hours.last or 0, *hours.rows.tolist()])
        past, wake = ended >= latest, latest
    else:
        wake = hours.next
    if past:
        if state.exists:
            state.remove()
        return
    state.update(hours.as_state())
    state.setTimeoutTimestamp(int(max(hours.zero + wake * HOUR_MS, now + 1)))


def hourly_scores(
    stream: DataFrame, delay: str = "12 hours", time_col: str = "at", groups: int | None = GROUPS
) -> DataFrame:
    """(stay, hr, the worst of each organ in the last 24 hours, their sum) as a stream of finished hours.

    ``stream`` has the columns of :func:`records` and the time of each record in ``time_col``. An hour of a
    stay is given once, in append mode, when the watermark, ``delay`` behind the latest record of all
    stays, has passed its end; so records may come in any order within the delay and in any
    parting into batches, and the rows are those of the batch score. Later ones are dropped, and
    Spark counts them (``numRowsDroppedByWatermark``).

    The state of a stay holds one row of reduced values for each hour that can still count: two days,
    the delay, and what is ahead. It is removed when the last hour has been given. A stay is scored from
    the record that opens it, and hours go on without records until the one that closes it; a stay without an
    opening record gives nothing. Records without a time or minute are left out. One without a stay
    only moves the clock: a heartbeat ends the hours of stays that have gone silent.

    Stays are dealt into so many ``groups``, whose state is one array each: a call of the state function costs
    milliseconds, whatever it holds, and serves all stays of a group. A group's state is read and written whole. With
    ``groups=None`` each stay has a call and a state of its own, for streams whose batches meet only a few of the stays. A checkpoint
    goes on only with the ``groups`` it began with; one from before there were groups, with None.
    """
    share_code(stream.sparkSession)
    told = F.col(STAY).isNull() | F.col("minute").isNotNull()
    rows = stream.where(F.col(time_col).isNotNull() & told).withWatermark(time_col, delay)
    minute, at_ms = F.coalesce("minute", F.lit(0)).cast("long"), F.unix_millis(time_col)
    if groups is None:
        values = {**{m: F.col(m) for m in (*MEASURES, *_MARKS)}, "minute": minute, "at_ms": at_ms}
        # whole numbers below 2^53 are exact as doubles
        record = F.array(*[values[name].cast("double") for name in _FIELDS])
        rows = rows.select(STAY, record.alias("record"), time_col)
        hours = rows.groupBy(STAY).applyInPandasWithState(_advance, _HOURS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
        width = len(_POINTS)
        ahead = F.sequence(F.lit(0), (F.size("points") / width).cast("int") - 1)
        each = hours.select(STAY, "first", "points", F.explode(ahead).alias("k"))
        points = [F.col("points")[F.col("k") * width + i] for i in range(width)]
    else:
        number = F.pmod(F.xxhash64(F.col(STAY).cast("long")), F.lit(groups)).cast("int")
        rows = rows.select(
            # records without a stay are a group of their own, as pandas has no whole numbers with gaps
            F.when(F.col(STAY).isNull(), -1).otherwise(number).alias("group"),
            F.coalesce(F.col(STAY).cast("long"), F.lit(0)).alias(STAY),
            minute.alias("minute"),
            (at_ms - 60_000 * minute).alias("zero"),
            *[F.col(name).cast("double").alias(name) for name in (*MEASURES, *_MARKS)],
            time_col,
        )
        hours = rows.groupBy("group").applyInPandasWithState(
            _advance_group, _GROUP_HOURS, _GROUP_STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
        each = hours.select(STAY, "first", F.posexplode("packed").alias("k", "packed"))
        organs = [F.shiftright("packed", _BITS * i).bitwiseAND(F.lit((1 << _BITS) - 1)) for i in range(len(SCORES))]
        points = [*organs, sum(organs[1:], organs[0])]
    points = [point.alias(name) for point, name in zip(points, _POINTS, strict=True)]
    return each.select(STAY, (F.col("first") + F.col("k")).cast("int").alias("hr"), *points)
