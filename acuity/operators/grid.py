"""Cohort, hour grid and hourly bucketing of irregular measurements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acuity import rules
from acuity.functions import hour_of, strict_or_lenient_number

STAY = "patientunitstayid"


def cohort(stays: DataFrame, strict: bool = False) -> DataFrame:
    """Stays with a recorded age, and their length in started hours."""
    age = F.when(F.col("age") == rules.AGE_CAP_LABEL, rules.AGE_CAP_VALUE).otherwise(F.col("age"))
    return stays.where(F.col("age") != "").select(
        STAY,
        F.ceil(F.col("unitdischargeoffset") / 60).cast("int").alias("los_icu_hours"),
        strict_or_lenient_number(age, strict).alias("age"),
    )


#: hourly rows that a task makes, on average
HOURS_IN_A_TASK = 100_000
#: a grid of more tasks than this gives each more hours instead, up to so many times as many
_ENOUGH_TASKS, _LARGER = 96, 5
#: where a grid notes the number of its partitions
_NOTE = "grid_partitions"


def grid_partitions(stays: DataFrame, lead_hours: int = rules.GRID_LEAD_HOURS) -> int:
    """Tasks that the grid of these stays asks for, from one small aggregate over them.

    A few bytes per stay become hundreds of rows, which adaptive execution can't know when it
    merges small partitions; so the number comes from the hours of the stays, not from the
    cores of the moment. Each task, and each bucket of the tables that are laid out like the grid, costs
    something by itself, so the tasks of a large grid are larger before they are more.
    """
    hours = F.greatest(F.col("los_icu_hours") + lead_hours + 1, F.lit(0)).cast("long")
    (total,) = cohort(stays).agg(F.sum(hours)).first()
    tasks = -(-(total or 0) // HOURS_IN_A_TASK)
    return max(1, min(tasks, max(_ENOUGH_TASKS, -(-tasks // _LARGER))))


def by_stay(df: DataFrame, partitions: int) -> DataFrame:
    """One layout by stay for the grid and what is put on it."""
    return df.repartition(partitions, STAY)


def hour_grid(
    stays: DataFrame, lead_hours: int = rules.GRID_LEAD_HOURS, partitions: int | None = None
) -> DataFrame:
    """A row per stay and hour, from ``lead_hours`` before admission to discharge.

    Copies of a stay are merged where they meet, before they grow; the longest counts. One
    shuffle serves both. ``partitions`` is the number of tasks that make the grid, by default
    :func:`grid_partitions`; the column ``hr`` carries it for :func:`hourly_panel`.
    """
    partitions = partitions or grid_partitions(stays, lead_hours)
    last = F.col("los_icu_hours")
    kept = cohort(stays).where(last >= -lead_hours)
    longest = by_stay(kept, partitions).groupBy(STAY).agg(F.max("los_icu_hours").alias("los_icu_hours"))
    hours = longest.select(STAY, F.explode(F.sequence(F.lit(-lead_hours), last)).alias("hr"))
    return hours.withMetadata("hr", {_NOTE: partitions})


def bucket_hourly(df: DataFrame, offset: str, aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates per stay and hour of an irregular series."""
    return (
        df.where(F.col(offset).isNotNull())
        .groupBy(STAY, hour_of(F.col(offset)).alias("hr"))
        .agg(*[a.alias(name) for name, a in aggregates.items()])
    )


@dataclass(frozen=True)
class Signal:
    """Measurements of one table: (output, value, reducer) triples on one time column.

    ``in_place``: the rows lie by stay in as many partitions as the grid has, as those of a
    bucketed table, and are few for each minute of a stay.
    """

    table: DataFrame
    offset: str
    measures: Sequence[tuple[str, Column, str]]
    in_place: bool = False


REDUCERS = {"min": F.min, "max": F.max, "sum": F.sum}


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def measured(signals: Sequence[Signal]) -> DataFrame:
    """The measurements of all signals under each other, with the minute and the hour of each."""
    return _stack(
        [
            signal.table.where(F.col(signal.offset).isNotNull()).select(
                STAY,
                F.col(signal.offset).alias("minute"),
                hour_of(F.col(signal.offset)).alias("hr"),
                *[value.cast("double").alias(name) for name, value, _ in signal.measures],
            )
            for signal in signals
        ]
    )


def hourly_panel(grid: DataFrame, signals: Sequence[Signal]) -> DataFrame:
    """The grid with every signal reduced to its hour, NULL where there is no data.

    The measurements of all signals are stacked and reduced by one aggregation, so they
    share one shuffle of rows already reduced on the map side, spread by stay and hour.
    What is left, at most a row per hour, moves to the grid's layout by stay and is
    stacked with it. The grid itself, made where its stay lies, is never shuffled, and
    windows over a stay can follow without a shuffle. Signals that lie like the grid are
    reduced where they are.
    """
    measures = [m for s in signals for m in s.measures]
    partitions = grid.schema["hr"].metadata[_NOTE]

    def hourly(some: Sequence[Signal]) -> DataFrame:
        reduced = [REDUCERS[how](name).alias(name) for signal in some for name, _, how in signal.measures]
        return measured(some).groupBy(STAY, "hr").agg(*reduced)

    moved = [signal for signal in signals if not signal.in_place]
    there = [hourly([signal]) for signal in signals if signal.in_place]
    parts = [by_stay(hourly(moved), partitions)] if moved else []
    return (
        _stack([grid.withMetadata("hr", {}).withColumn("on_grid", F.lit(True)), *parts, *there])
        .groupBy(STAY, "hr")
        .agg(F.max("on_grid").alias("on_grid"), *[F.max(name).alias(name) for name, _, _ in measures])
        .where("on_grid")
        .drop("on_grid")
    )
