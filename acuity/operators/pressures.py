"""Blood pressure from four sources, the best usable reading per minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acuity import rules

MEASURES = ("sbp", "dbp", "map")


def _reading(rank: int, systolic: str, diastolic: str, mean: str) -> list[Column]:
    names = ("sbp", "dbp", "mean")
    columns = [F.col(c).alias(n) for c, n in zip((systolic, diastolic, mean), names)]
    return [F.lit(rank).alias("rank"), *columns]


def pressure_readings(vital: DataFrame, aperiodic: DataFrame, periodic: DataFrame) -> DataFrame:
    """All readings as (stay, minute, rank, sbp, dbp, map).

    Rank 1 is the monitored invasive line, 2 the charted invasive, 3 the monitored
    cuff, 4 the charted cuff. The charted table holds two of them and is read once.
    The emptiness check of the monitored cuff looks at the systolic value twice and
    never at the diastolic one, so a diastolic value alone is not a reading there.
    """
    key, offset = "patientunitstayid", "observationoffset"
    charted = F.array(
        F.struct(*_reading(2, "ibp_systolic", "ibp_diastolic", "ibp_mean")),
        F.struct(*_reading(4, "nibp_systolic", "nibp_diastolic", "nibp_mean")),
    )
    cuff = _reading(3, "noninvasivesystolic", "noninvasivediastolic", "noninvasivemean")
    line = _reading(1, "systemicsystolic", "systemicdiastolic", "systemicmean")
    readings = (
        vital.select(key, F.col("chartoffset").alias(offset), F.inline(charted))
        .unionByName(aperiodic.select(key, offset, *cuff))
        .unionByName(periodic.select(key, offset, *line))
    )
    s, d, m = F.col("sbp"), F.col("dbp"), F.col("mean")
    zero = F.lit(0)
    second = F.when(F.col("rank") == 3, s).otherwise(d)
    has_data = F.coalesce(s, zero) + F.coalesce(second, zero) + F.coalesce(m, zero) != 0
    mean = F.round(F.coalesce(m, d + (s - d) / 3), 0)
    return readings.where(has_data).select(key, offset, "rank", "sbp", "dbp", mean.alias("map"))


def coalesce_pressures(vital: DataFrame, aperiodic: DataFrame, periodic: DataFrame) -> DataFrame:
    """Each measure from the best source in range, one row per (stay, minute) charted.

    Equal ranks give the smallest value. All buffers are doubles, so this is one
    hash aggregation with a map-side step and a single shuffle.
    """

    def best(measure: str) -> Column:
        value = F.col(measure)
        usable = (value > 0) & (value < rules.PRESSURE_LIMITS[measure])
        by_rank = [F.min(F.when(usable & (F.col("rank") == r), value)) for r in (1, 2, 3, 4)]
        return F.coalesce(*by_rank).alias(measure)

    return (
        pressure_readings(vital, aperiodic, periodic)
        .groupBy("patientunitstayid", "observationoffset")
        .agg(*[best(m) for m in MEASURES])
    )


def plausible_map() -> Column:
    """The mean pressure where it can be one, else NULL."""
    value = F.col("map")
    return F.when((value > 0) & (value < rules.PRESSURE_LIMITS["map"]), value)


def map_min(pressures: DataFrame) -> DataFrame:
    """Lowest plausible mean pressure per (stay, minute)."""
    return (
        pressures.where(plausible_map().isNotNull())
        .groupBy("patientunitstayid", F.col("observationoffset").alias("chartoffset"))
        .agg(F.min("map").alias("MeanBP_min"))
    )
