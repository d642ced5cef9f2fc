"""Repair of implausible admission and discharge weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity import rules


def clean_weights(stays: DataFrame) -> DataFrame:
    """One repaired weight pair per stay.

    Both weights known and positive: the admission/discharge ratio tells a shifted
    decimal point. One of them unknown: taken as it is. Anything else (a known
    weight that is not positive next to a known partner) is no weight record.
    """
    adm, dis = F.col("admissionweight"), F.col("dischargeweight")
    comparable = (adm > 0) & (dis > 0)
    ratio = F.round(F.try_divide(adm, dis), 2)
    low = comparable & (ratio <= rules.WEIGHT_RATIO_LOW)
    high = comparable & (ratio > rules.WEIGHT_RATIO_HIGH)

    repaired_adm = (
        F.when(low & (adm <= 1), adm * 100)
        .when(low & (adm <= 20), adm * 10)
        .when(high & (adm >= 300), adm / 10)
        .otherwise(adm)
    )
    repaired_dis = (
        F.when(low & (dis >= 300), dis / 10)
        .when(high & (dis <= 20), F.lit(None))
        .otherwise(dis)
    )
    swapped = F.col("patientunitstayid").isin(*rules.WEIGHT_SWAP_STAYS)
    return (
        stays.where(comparable | adm.isNull() | dis.isNull())
        .select(
            "patientunitstayid",
            repaired_adm.alias("admissionweight"),
            repaired_dis.alias("dischargeweight"),
        )
        .select(
            "patientunitstayid",
            F.when(swapped, dis)
            .when(adm >= rules.WEIGHT_MIN_KG, adm)
            .alias("admissionweight"),
            "dischargeweight",
        )
        .distinct()
    )


def dosing_weights(weights: DataFrame) -> DataFrame:
    """The weight a dose is divided by: admission, else discharge."""
    return weights.select(
        "patientunitstayid",
        F.coalesce("admissionweight", "dischargeweight").alias("weight"),
    )
