"""Rolling values by change points, grid sizes and rows that break a contract."""

import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from acuity import contracts
from acuity.operators import grid, scores
from checks.event_tables import clinical_inputs
from tests.conftest import SF_DIR, rows_of
from tests.test_plans import plan
from tests.test_scratch import ROOT


@pytest.fixture
def stays(spark):
    data = [(1, "40", 60 * 60), (2, "41", 60 * 3), (2, "41", 60 * 30), (3, "", 600), (4, "50", -60 * 24), (5, "50", -60 * 30), (6, "> 89", 6000), (7, "50", None)]
    return spark.createDataFrame(data, "patientunitstayid long, age string, unitdischargeoffset int")


@pytest.mark.parametrize("hours", [1, 3, 24])
def test_by_change_equals_the_grid(spark, stays, hours):
    """Values on and off the grid, gaps longer and shorter than a day, hours without a value in a row with data."""
    rng = random.Random(hours)
    values = {(rng.randint(1, 9), rng.randint(-40, 130)): (rng.choice([None, 0, 1, 2, 3, 4]), rng.choice([None, 0.1, 7.25])) for _ in range(120)}
    df = spark.createDataFrame([(s, h, p, u) for (s, h), (p, u) in values.items()], "patientunitstayid long, hr int, p int, u double")
    got = scores.by_change(df, stays, worst=["p"], total=["u"], hours=hours)
    w = scores.last_hours(hours)
    dense = grid.hour_grid(stays).join(df, ["patientunitstayid", "hr"], "left")
    want = dense.select("*", F.coalesce(F.max("p").over(w), F.lit(0)).alias(f"p_{hours}hours"), F.sum("u").over(w).alias(f"u_{hours}hours"))
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_by_change_shuffles_values_not_hours(spark, stays):
    """One exchange, below the step that makes the hours."""
    df = spark.createDataFrame([(1, 5, 2)], "patientunitstayid long, hr int, p int")
    wide = stays.withColumn("unitdischargeoffset", F.lit(60 * 100_000))
    lines = plan(scores.by_change(df, wide, worst=["p"], partitions=3)).splitlines()
    made = next(i for i, line in enumerate(lines) if "explode(sequence(hr" in line)
    assert not any("Exchange" in line for line in lines[:made])
    assert sum("REPARTITION_BY_NUM" in line for line in lines) == 1


def test_the_grid_is_sized_by_its_stays(spark, stays):
    hours = grid.hour_grid(stays).count()
    assert grid.grid_partitions(stays) == 1 and hours == sum(24 + 1 + h for h in (60, 30, 100)) + 1
    many = spark.range(5000).select(F.col("id").alias("patientunitstayid"), F.lit("40").alias("age"), F.lit(60 * 100).alias("unitdischargeoffset"))
    want = -(-5000 * 125 // grid.HOURS_IN_A_TASK)
    made = grid.hour_grid(many)
    assert grid.grid_partitions(many) == want and f", {want})" in plan(made)
    signal = grid.Signal(spark.createDataFrame([(1, 5, 2.0)], "patientunitstayid long, at int, x double"), "at", [("x", F.col("x"), "max")])
    panel = grid.hourly_panel(made, [signal])
    assert plan(panel).count("REPARTITION_BY_NUM") == 2 and not panel.schema["hr"].metadata
    assert panel.count() == 5000 * 125


@pytest.mark.parametrize(("tasks", "want"), [(1, 1), (95, 95), (96, 96), (300, 96), (480, 96), (481, 97), (5000, 1000)])
def test_a_large_grid_has_larger_tasks_before_more(spark, tasks, want):
    """Hours of a few long stays; the number is worked out from the stays alone."""
    hours = tasks * grid.HOURS_IN_A_TASK // 5
    stays = spark.range(5).select(F.col("id").alias("patientunitstayid"), F.lit("40").alias("age"), F.lit(60 * (hours - 25)).alias("unitdischargeoffset"))
    assert grid.grid_partitions(stays) == want


def test_few_cores_do_not_make_few_tasks(tmp_path):
    """The number of tasks is that of the stays' hours, whatever the cores at the moment."""
    code = """
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.default.parallelism", "2").config("spark.ui.enabled", "false").getOrCreate()
from acuity.operators import grid
stays = spark.range(40000).select(F.col("id").alias("patientunitstayid"), F.lit("40").alias("age"), F.lit(60 * 100).alias("unitdischargeoffset"))
print(grid.hour_grid(stays).rdd.getNumPartitions())
spark.stop()
"""
    run = subprocess.run([sys.executable, "-c", code], env={**__import__("os").environ, "PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=300)
    assert run.stdout.strip().splitlines()[-1] == "50", run.stderr[-2000:]


def test_quarantined_rows(spark, table):
    inputs = {
        "pivoted_bg": table("pivoted_bg", [{"patientunitstayid": s, "chartoffset": o, "pao2": 80.0, "fio2": f} for s, o, f in [(1, 5, 0.4), (None, None, 40.0), (2, None, 0.0), (3, 6, None)]]),
        "icustay_detail": table("icustay_detail", [{"patientunitstayid": s} for s in (1, 1, 2, None, None)]),
        "infusiondrug": table("infusiondrug", [{"infusiondrugid": i, "patientunitstayid": s, "infusionoffset": 3} for i, s in [(7, 1), (7, None), (8, 1), (None, 2)]]),
        "medication": table("medication", [{"patientunitstayid": None, "drugstartoffset": 4}]),
    }
    got = contracts.quarantine(inputs)
    assert rows_of(got) == sorted(
        [
            ("pivoted_bg", None, None, None, "patientunitstayid is null, chartoffset is null, fio2 is no fraction"),
            ("pivoted_bg", 2, None, None, "chartoffset is null, fio2 is no fraction"),
            ("icustay_detail", 1, None, None, "patientunitstayid is repeated"),
            ("icustay_detail", 1, None, None, "patientunitstayid is repeated"),
            ("icustay_detail", None, None, None, "patientunitstayid is null"),
            ("icustay_detail", None, None, None, "patientunitstayid is null"),
            ("infusiondrug", 1, 7, 3, "infusiondrugid is repeated"),
            ("infusiondrug", None, 7, 3, "patientunitstayid is null, infusiondrugid is repeated"),
            ("infusiondrug", 2, None, 3, "infusiondrugid is null"),
            ("medication", None, None, 4, "patientunitstayid is null"),
        ],
        key=lambda r: tuple((v is not None, v) for v in r),
    )


def test_counts_are_those_of_the_rows(spark):
    """A rule's count is the number of its rows; of repeated ids, those too many."""
    inputs = clinical_inputs(spark, SF_DIR)
    counted = {(r.table, r.rule): r["rows"] for r in contracts.violations(inputs).collect() if "repeated" not in r.rule and r["rows"]}
    rows = contracts.quarantine(inputs).select("table", F.explode(F.split("rules", ", ")).alias("rule")).where("rule not like '%repeated%'")
    assert counted and {(r.table, r.rule): r["count"] for r in rows.groupBy("table", "rule").count().collect()} == counted
