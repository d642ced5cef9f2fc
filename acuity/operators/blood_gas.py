"""Oxygenation ratio, split by whether the patient was ventilated at that minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAY = "patientunitstayid"


def _in_interval(
    rows: DataFrame,
    intervals: DataFrame,
    start: str,
    end: str,
    lowest: tuple[str, ...] = (),
    buckets: int = 0,
) -> DataFrame:
    """One row per (stay, minute) of ``rows``: its lowest values and ``inside``.

    A minute lies in some closed interval of its stay when the latest end among the
    intervals begun by then has not passed: one running maximum, no pairing of minutes
    with intervals, which may overlap. Rows and intervals are stacked and reduced to a
    row per minute before the window, so that a stay's series is bounded by its length.
    Intervals that lie by stay in ``buckets`` partitions stay there; the reduced rows come to them.
    """
    begun = intervals.where(F.col(start).isNotNull()).select(
        STAY, F.col(start).cast("long").alias("minute"), F.col(end).alias("until")
    )
    asked = rows.where(F.col("minute").isNotNull())
    if buckets:
        first = asked.groupBy(STAY, "minute").agg(*[F.min(c).alias(c) for c in lowest])
        asked = first.repartition(buckets, STAY)
    series = (
        asked.select(STAY, "minute", *lowest, F.lit(True).alias("asked"))
        .unionByName(begun, allowMissingColumns=True)
        .groupBy(STAY, "minute")
        .agg(
            F.max("asked").alias("asked"),
            F.max("until").alias("until"),
            *[F.min(c).alias(c) for c in lowest],
        )
    )
    so_far = (
        Window.partitionBy(STAY)
        .orderBy("minute")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    latest_end = F.max("until").over(so_far)
    return (
        series.select(
            STAY,
            "minute",
            *lowest,
            "asked",
            F.coalesce(latest_end >= F.col("minute"), F.lit(False)).alias("inside"),
        )
        .where("asked")
        .drop("asked")
    )


def pf_readings(bg: DataFrame) -> DataFrame:
    """Rounded PaO2/FiO2 of every complete blood gas; no ratio at zero FiO2."""
    return bg.where(F.col("pao2").isNotNull() & F.col("fio2").isNotNull()).select(
        STAY, "chartoffset", F.round(F.try_divide("pao2", "fio2"), 0).alias("pao2fio2ratio")
    )


def _split(ratio: Column, inside: Column) -> list[Column]:
    return [
        F.when(~inside, ratio).alias("PaO2FiO2Ratio_novent"),
        F.when(inside, ratio).alias("PaO2FiO2Ratio_vent"),
    ]


def pf_ratio(bg: DataFrame, episodes: DataFrame) -> DataFrame:
    """One row per blood gas, its ratio in the column of its ventilation state."""
    readings = pf_readings(bg).withColumn("minute", F.col("chartoffset").cast("long"))
    inside = _in_interval(readings, episodes, "starttime", "endtime")
    return readings.join(inside, [STAY, "minute"], "left").select(
        STAY,
        "chartoffset",
        *_split(F.col("pao2fio2ratio"), F.coalesce("inside", F.lit(False))),
    )


def pf_ratio_min(bg: DataFrame, episodes: DataFrame, buckets: int = 0) -> DataFrame:
    """Lowest ratio per (stay, minute); enough for hourly minima and free of row joins.

    The state depends on the minute alone, so taking the minimum first is exact. Episodes of a table with
    ``buckets`` by stay are not shuffled.
    """
    readings = pf_readings(bg).withColumn("minute", F.col("chartoffset").cast("long"))
    minutes = _in_interval(readings, episodes, "starttime", "endtime", ("pao2fio2ratio",), buckets)
    return minutes.select(
        STAY,
        F.col("minute").cast("int").alias("chartoffset"),
        *_split(F.col("pao2fio2ratio"), F.col("inside")),
    )
