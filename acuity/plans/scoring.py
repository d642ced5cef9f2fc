"""The whole score, from input tables to every output table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity import contracts, rules
from acuity.operators.blood_gas import pf_ratio_min
from acuity.operators.grid import Signal, hour_grid, hourly_panel
from acuity.operators.infusions import drug_table, infusion_rejects, long_table, vasoactive_rates
from acuity.operators.pressures import coalesce_pressures, plausible_map
from acuity.operators.scores import organ_points, total_score
from acuity.operators.ventilation import episodes, vent_events
from acuity.operators.weights import clean_weights

_DOSES = ("norepinephrine", "epinephrine", "dobutamine", "dopamine")

Keep = Callable[[str, DataFrame], DataFrame]


def score_signals(
    bg: DataFrame,
    scores: DataFrame,
    labs: DataFrame,
    urine: DataFrame,
    pressures: DataFrame,
    ventilation: DataFrame,
    rates: DataFrame | Mapping[str, DataFrame],
    buckets: int = 0,
) -> list[Signal]:
    """Every measurement of the score, with the way it is reduced to its hour.

    With ``buckets``, the pressures, the episodes and the doses, a table for each drug, are tables with
    so many buckets by stay, which the grid has then, too.
    """

    def positive_rate(drug: str):
        name = f"rate_{drug}"
        return name, F.when((F.col("drug") == drug) & (F.col("rate") > 0), F.col("rate")), "max"

    return [
        # the table has a row per minute, whose minimum needs no aggregation of its own
        Signal(pressures, "observationoffset", [("MeanBP_min", plausible_map(), "min")], bool(buckets)),
        Signal(scores, "chartoffset", [("GCS_min", F.col("gcs"), "min")]),
        Signal(
            labs,
            "chartoffset",
            [
                ("bilirubin_max", F.col("bilirubin"), "max"),
                ("creatinine_max", F.col("creatinine"), "max"),
                ("platelet_min", F.col("platelets"), "min"),
            ],
        ),
        Signal(
            pf_ratio_min(bg, ventilation, buckets),
            "chartoffset",
            [
                ("PaO2FiO2Ratio_novent", F.col("PaO2FiO2Ratio_novent"), "min"),
                ("PaO2FiO2Ratio_vent", F.col("PaO2FiO2Ratio_vent"), "min"),
            ],
            bool(buckets),
        ),
        *(
            [Signal(rates[d], "infusionoffset", [positive_rate(d)], True) for d in _DOSES]
            if buckets
            else [Signal(rates, "infusionoffset", [positive_rate(d) for d in _DOSES])]
        ),
        Signal(urine, "chartoffset", [("urineoutput", F.col("urineoutput"), "sum")]),
    ]


def score(stays: DataFrame, signals: list[Signal], partitions: int | None = None) -> DataFrame:
    return total_score(organ_points(hourly_panel(hour_grid(stays, partitions=partitions), signals)))


def run(
    inputs: Mapping[str, DataFrame],
    mode: str = "reference",
    strict: bool = False,
    keep: Keep | None = None,
    share: Callable[[DataFrame], DataFrame] = lambda df: df,
    buckets: int = 0,
) -> dict[str, DataFrame]:
    """All output tables, with what they leave out and what breaks a contract.

    ``infusion_rejects`` has the infusion rows whose rate text is no number,
    ``contract_violations`` the number of rows that break each rule of the inputs, ``quarantine`` those rows.
    ``mode`` is the way episodes are built, ``strict`` refuses rates that are no number.
    ``keep`` is called on each table in dependency order and returns what the later
    ones read; a sink passes its writer, so that a table is worked out once. ``share`` is
    called on the dose rates, of which four tables are written. With ``buckets`` the tables that
    ``keep`` returns have so many buckets by stay, and the score reads them where they lie.
    """
    t = contracts.conform_all(inputs)
    buckets = buckets if keep else 0
    out: dict[str, DataFrame] = {}

    def table(name: str, df: DataFrame) -> DataFrame:
        out[name] = keep(name, df) if keep else df
        return out[name]

    table("contract_violations", contracts.violations(t))
    table("quarantine", contracts.quarantine(t))
    table("infusion_rejects", infusion_rejects(t["infusiondrug"]))
    weights = table("weight", clean_weights(t["icustay_detail"]))
    rates = share(
        vasoactive_rates(t["infusiondrug"], t["medication"], weights, rules.DRUGS, strict)
    )
    drugs = [table(drug.name, drug_table(rates, drug.name)) for drug in rules.DRUGS]
    if keep:
        # the written tables stand for the plan that made them
        written = dict(zip([d.name for d in rules.DRUGS], drugs, strict=True))
        long = {name: long_table(df, name) for name, df in written.items()}
        rates = long if buckets else reduce(DataFrame.unionByName, long.values())
    pressures = table(
        "blood_pressure",
        coalesce_pressures(t["pivoted_vital"], t["vitalaperiodic"], t["vitalperiodic"]),
    )
    ventilation = table(
        "ventilation", episodes(vent_events(t["careplangeneral"], t["icustay_detail"]), mode)
    )
    signals = score_signals(
        t["pivoted_bg"],
        t["pivoted_score"],
        t["pivoted_lab"],
        t["pivoted_uo"],
        pressures,
        ventilation,
        rates,
        buckets,
    )
    table("sofa", score(t["icustay_detail"], signals, buckets or None))
    return out
