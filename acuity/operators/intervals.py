"""Which interval a point lies in, by an equi-join on bins of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.operators.blood_gas import pf_readings

STAY = "patientunitstayid"
#: minutes of a bin: a day
BIN = 1440


def with_intervals(
    rows: DataFrame, intervals: DataFrame, at: str, start: str = "starttime", end: str = "endtime", width: int = BIN
) -> DataFrame:
    """``rows`` with the columns ``start`` and ``end`` of each closed interval of their stay that holds ``at``.

    A row in several intervals comes back once for each, one in none once with NULLs; intervals that are
    given twice count twice. An interval without a start or an end holds nothing.

    Intervals are cut at the bounds of bins, a row falls into one bin, and the two meet by an equi-join on
    (stay, bin) with the exact bounds as what is left to test. So a pair is met once, a
    stay's rows are spread over its bins, and Spark can split a bin that is still too large. An interval makes
    a row for each bin between the first and the last minute of ``rows``, however far it reaches.
    """
    bin_of = F.floor(F.col(at) / width)
    # the bins that hold rows, worked out where the plan runs
    first, last = (rows.agg(how(bin_of)).scalar() for how in (F.min, F.max))
    low = F.greatest(F.floor(F.col(start) / width), first)
    high = F.least(F.floor(F.col(end) / width), last)
    cut = (
        intervals.where(F.col(start) <= F.col(end))
        .select(F.col(STAY).alias("its_stay"), start, end, low.alias("low"), high.alias("high"))
        .where(F.col("low") <= F.col("high"))
        .select("its_stay", start, end, F.explode(F.sequence("low", "high")).alias("its_bin"))
    )
    meet = (F.col(STAY) == F.col("its_stay")) & (F.col("bin") == F.col("its_bin")) & F.col(at).between(F.col(start), F.col(end))
    return rows.withColumn("bin", bin_of).join(cut, meet, "left").drop("its_stay", "its_bin", "bin")


def gas_episodes(bg: DataFrame, episodes: DataFrame) -> DataFrame:
    """One row per complete blood gas and ventilation episode around it, or one with NULLs.

    ``minutes_in`` is how long the episode has lasted by then.
    """
    found = with_intervals(pf_readings(bg), episodes, "chartoffset")
    return found.withColumn("minutes_in", F.col("chartoffset") - F.col("starttime"))
