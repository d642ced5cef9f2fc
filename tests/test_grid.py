import random

import pytest
from pyspark.sql import functions as F

from acuity.functions import hour_of
from acuity.operators import grid
from tests.conftest import rows_of


def stays(table, rows):
    return table(
        "icustay_detail",
        [{"patientunitstayid": s, "age": a, "unitdischargeoffset": o} for s, a, o in rows],
    )


def test_hours_hold_their_end_not_their_start(spark):
    offsets = {0: 0, 1: 1, 60: 1, 61: 2, -30: 0, -59: 0, -60: -1, -61: -1}
    df = spark.createDataFrame([(o,) for o in offsets], "off int")
    assert dict(df.select("off", hour_of(F.col("off"))).collect()) == offsets


def test_every_minute_lies_in_its_hour(spark):
    df = spark.range(-20000, 20000).select(F.col("id").cast("int").alias("off"))
    hr = hour_of(F.col("off"))
    assert df.where(~((60 * (hr - 1) < F.col("off")) & (F.col("off") <= 60 * hr))).count() == 0


def test_grid_spans_a_day_before_to_discharge(table):
    df = grid.hour_grid(stays(table, [(1, "60", 61)]))
    assert [h for _, h in rows_of(df)] == list(range(-24, 3))


@pytest.mark.parametrize("discharge, hours", [(None, 0), (-1440, 1), (-1441, 1), (-1500, 0), (0, 25)])
def test_grid_of_odd_stays(table, discharge, hours):
    assert grid.hour_grid(stays(table, [(1, "60", discharge)])).count() == hours


def test_cohort_needs_a_recorded_age(table):
    df = stays(table, [(1, "", 60), (2, None, 60), (3, "> 89", 60), (4, "45", 61), (5, "n/a", 60)])
    assert rows_of(grid.cohort(df)) == [(3, 1, 91.4), (4, 2, 45.0), (5, 1, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        grid.cohort(df, strict=True).collect()


def test_panel_matches_pairing_every_hour_with_every_row(table):
    rng = random.Random(3)
    labs = [
        {"patientunitstayid": rng.randint(1, 4), "chartoffset": rng.randint(-1600, 400),
         "platelets": rng.choice([None, 10.0, 60.0, 300.0]), "bilirubin": rng.choice([None, 1.0, 7.0])}
        for _ in range(300)
    ]
    urine = [
        {"patientunitstayid": rng.randint(1, 4), "chartoffset": rng.randint(-1600, 400), "urineoutput": 5.0}
        for _ in range(100)
    ]
    frame = grid.hour_grid(stays(table, [(1, "60", 180), (2, "60", 300), (3, "60", -120)]))
    panel = grid.hourly_panel(
        frame,
        [
            grid.Signal(
                table("pivoted_lab", labs),
                "chartoffset",
                [("low", F.col("platelets"), "min"), ("high", F.col("bilirubin"), "max")],
            ),
            grid.Signal(table("pivoted_uo", urine), "chartoffset", [("sum", F.col("urineoutput"), "sum")]),
        ],
    )

    def reduced(rows, stay, hr, column, how):
        values = [
            r[column]
            for r in rows
            if r["patientunitstayid"] == stay and 60 * (hr - 1) < r["chartoffset"] <= 60 * hr
            and r[column] is not None
        ]
        return how(values) if values else None

    want = [
        (stay, hr, reduced(labs, stay, hr, "platelets", min), reduced(labs, stay, hr, "bilirubin", max),
         reduced(urine, stay, hr, "urineoutput", sum))
        for stay, last in ((1, 3), (2, 5), (3, -2))
        for hr in range(-24, last + 1)
    ]
    assert rows_of(panel, "patientunitstayid", "hr", "low", "high", "sum") == want


def test_bucket_hourly(table):
    labs = table(
        "pivoted_lab",
        [{"patientunitstayid": 1, "chartoffset": o, "platelets": float(o or 0)} for o in (0, 1, 60, 61, None)],
    )
    df = grid.bucket_hourly(labs, "chartoffset", {"low": F.min("platelets"), "n": F.count("*")})
    assert rows_of(df) == [(1, 0, 0.0, 1), (1, 1, 1.0, 2), (1, 2, 61.0, 1)]
