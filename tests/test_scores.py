import random

import pytest
from pyspark.sql import functions as F

from acuity import rules
from acuity.operators import scores
from tests.conftest import rows_of

COLUMNS = (
    "MeanBP_min", "GCS_min", "bilirubin_max", "creatinine_max", "platelet_min",
    "PaO2FiO2Ratio_novent", "PaO2FiO2Ratio_vent",
    "rate_norepinephrine", "rate_epinephrine", "rate_dobutamine", "rate_dopamine", "urineoutput",
)


@pytest.fixture
def panel(spark):
    def build(rows):
        schema = "patientunitstayid long, hr int, " + ", ".join(f"{c} double" for c in COLUMNS)
        data = [
            (stay, hr, *[None if v.get(c) is None else float(v[c]) for c in COLUMNS])
            for stay, hr, v in rows
        ]
        return spark.createDataFrame(data, schema)

    return build


def scored(panel, organ, cases):
    """Points of each case, every case a stay of one hour."""
    df = scores.organ_points(panel([(i, 0, case) for i, case in enumerate(cases)]))
    return [p for _, p in rows_of(df, "patientunitstayid", organ)]


@pytest.mark.parametrize(
    "organ, column, values, want",
    [
        ("coagulation", "platelet_min", [19.9, 20, 49, 50, 99, 100, 149, 150, None], [4, 3, 3, 2, 2, 1, 1, 0, None]),
        ("liver", "bilirubin_max", [1.1, 1.2, 2, 6, 12, None], [0, 1, 2, 3, 4, None]),
        ("cns", "GCS_min", [15, 14, 13, 12, 10, 9, 6, 5, None, 9.5], [0, 1, 1, 2, 2, 3, 3, 4, None, 0]),
        ("renal", "creatinine_max", [1.1, 1.2, 1.9, 2, 3.4, 3.5, 4.9, 5, None], [0, 1, 1, 2, 2, 3, 3, 4, None]),
        ("renal", "urineoutput", [199, 200, 499, 500, None], [4, 3, 3, 0, None]),
        ("cardiovascular", "MeanBP_min", [69, 70, None], [1, 0, None]),
        ("cardiovascular", "rate_norepinephrine", [0.1, 0.11], [3, 4]),
        ("cardiovascular", "rate_epinephrine", [0.05, 0.2], [3, 4]),
        ("cardiovascular", "rate_dobutamine", [1, 0], [2, 0]),
        ("cardiovascular", "rate_dopamine", [0, 5, 5.1, 15, 15.1], [0, 2, 3, 3, 4]),
        ("respiration", "PaO2FiO2Ratio_vent", [99, 100, 199, 200, 250, None], [4, 3, 3, 0, 0, None]),
        ("respiration", "PaO2FiO2Ratio_novent", [90, 299, 300, 399, 400], [2, 2, 1, 1, 0]),
    ],
)
def test_bands(panel, organ, column, values, want):
    assert scored(panel, organ, [{column: v} for v in values]) == want


def test_bands_of_several_inputs(panel):
    respiration = [
        {"PaO2FiO2Ratio_vent": 150, "PaO2FiO2Ratio_novent": 90},
        {"PaO2FiO2Ratio_vent": 250, "PaO2FiO2Ratio_novent": 350},
    ]
    assert scored(panel, "respiration", respiration) == [3, 1]
    renal = [{"creatinine_max": 3.5, "urineoutput": 150}, {"creatinine_max": 1.0, "urineoutput": 450}]
    assert scored(panel, "renal", renal) == [4, 3]
    cardiovascular = [{"MeanBP_min": 60, "rate_dobutamine": 2}, {"rate_dopamine": 3, "rate_epinephrine": 0.1}]
    assert scored(panel, "cardiovascular", cardiovascular) == [2, 3]


def test_urine_is_summed_over_a_day(panel):
    df = panel([(1, hr, {"urineoutput": 20 if hr < 30 else None}) for hr in range(60)])
    found = rows_of(scores.organ_points(df), "hr", "renal")
    # 20 an hour: below 200 for nine hours, below 500 always
    assert [p for _, p in found[:10]] == [4] * 9 + [3]
    # the last data leave the day at hour 53
    assert [p for _, p in found[52:55]] == [4, None, None]


def test_rolling_worst_lasts_a_day(panel):
    df = panel([(1, hr, {"platelet_min": 10 if hr == 0 else None}) for hr in range(30)])
    found = rows_of(scores.total_score(scores.organ_points(df)), "hr", "coagulation_24hours", "SOFA_24hours")
    assert found == [(hr, 4 if hr < 24 else 0, 4 if hr < 24 else 0) for hr in range(30)]


def test_hours_before_admission_feed_the_windows_only(panel):
    df = panel([(1, hr, {"platelet_min": 10 if hr == -5 else None}) for hr in range(-24, 30)])
    found = rows_of(scores.total_score(scores.organ_points(df)), "hr", "SOFA_24hours")
    assert found == [(hr, 4 if hr < 19 else 0) for hr in range(30)]


def test_total_is_the_sum_of_the_worst(panel):
    worst = {
        "MeanBP_min": 50, "rate_norepinephrine": 1, "GCS_min": 3, "bilirubin_max": 20, "creatinine_max": 9,
        "platelet_min": 5, "PaO2FiO2Ratio_vent": 50,
    }
    df = scores.total_score(scores.organ_points(panel([(1, 0, worst), (1, 1, {})])))
    assert rows_of(df, "hr", "SOFA_24hours") == [(0, 24), (1, 24)]


def test_rolling_worst_of_other_columns_and_hours(spark):
    df = spark.createDataFrame([(1, h, float(h % 5)) for h in range(12)], "patientunitstayid long, hr int, x double")
    found = rows_of(scores.rolling_worst(df, ["x"], 3), "hr", "x_3hours")
    assert found == [(h, float(max(i % 5 for i in range(max(0, h - 2), h + 1)))) for h in range(12)]


def test_output_columns(panel):
    df = scores.total_score(scores.organ_points(panel([(1, 0, {})])))
    assert df.columns == [
        "patientunitstayid", "hr", *COLUMNS, *rules.ORGANS, *[f"{o}_24hours" for o in rules.ORGANS], "SOFA_24hours",
    ]
    assert df.select(F.col("SOFA_24hours")).first()[0] == 0


def test_levels_give_the_same_as_looking_at_every_hour(spark):
    rng = random.Random(2)
    data = [
        (stay, hr, *[rng.choice([None, None, None, 0, 1, 2, 3, 4]) for _ in range(2)])
        for stay in range(1, 8)
        for hr in range(-24, 60)
    ]
    df = spark.createDataFrame(data, "patientunitstayid long, hr int, a int, b int")
    plain = scores.rolling_worst(df, ["a", "b"], 6)
    levels = scores.rolling_worst(df, ["a", "b"], 6, rules.ORGAN_LEVELS)
    assert levels.columns == plain.columns
    assert rows_of(levels) == rows_of(plain)


def test_many_columns_and_hours_left_out(spark):
    """More columns than a word of bits holds, with hours missing and levels from below zero points up."""
    rng = random.Random(5)
    names = [f"c{i}" for i in range(17)]
    data = [
        (stay, hr, *[rng.choice([None, None, 0, 1, 2, 3, 4]) for _ in names])
        for stay in (1, 2, None)
        for hr in sorted(rng.sample(range(-24, 60), 40))
    ]
    df = spark.createDataFrame(data, f"patientunitstayid long, hr int, {', '.join(f'{n} int' for n in names)}")
    found = scores.rolling_worst(df, names, 6, rules.ORGAN_LEVELS)
    want = [
        (stay, hr, *[max([0, *[r[i] or 0 for r in data if r[0] == stay and hr - 6 < r[1] <= hr]]) for i in range(2, 2 + len(names))])
        for stay, hr, *_ in data
    ]
    key = ("patientunitstayid", "hr")
    assert rows_of(found, *key, *[f"{n}_6hours" for n in names]) == sorted(want, key=lambda r: tuple((v is not None, v) for v in r))
    assert found.columns == [*df.columns, *[f"{n}_6hours" for n in names]]


def test_the_worst_of_all_organs_takes_one_aggregate(panel):
    """A window for the day of urine and one for the bits of all organs, not one value for each organ and level."""
    text = scores.total_score(scores.organ_points(panel([(1, 0, {})])))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum(line.count("windowspecdefinition") for line in windows) == 2
