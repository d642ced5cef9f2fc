"""Outputs bucketed by stay, which the score reads where they lie."""

import pytest
from pyspark.sql import functions as F

from acuity import rules
from acuity.operators.grid import STAY, Signal, hour_grid, hourly_panel
from acuity.plans.scoring import run
from acuity.sources.tables import build, replace_table
from checks.event_tables import clinical_inputs
from tests.conftest import SF_DIR, rows_of
from tests.test_plans import plan

BUCKETS = 6


@pytest.fixture(scope="module")
def inputs(spark):
    return {n: df.cache() for n, df in clinical_inputs(spark, SF_DIR).items()}


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/db'")
    yield "bucketed"
    spark.sql("DROP DATABASE bucketed CASCADE")


@pytest.fixture
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def above(text: str, wanted: str) -> list[list[str]]:
    """For each node of a plan that has the text, the nodes it is below of."""
    lines = [line for line in text.splitlines() if line.strip(" :+-|")]
    depth = [len(line) - len(line.lstrip(" :+-|")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if wanted not in line:
            continue
        up, at = [], depth[i]
        for j in range(i - 1, -1, -1):
            if depth[j] < at:
                up.append(lines[j])
                at = depth[j]
        found.append(up)
    return found


@pytest.mark.parametrize("mode", ["reference", "islands"])
def test_the_score_reads_buckets_without_a_shuffle(spark, inputs, database, unbroadcast, mode):
    plans = {}

    def keep(name, df):
        plans[name] = plan(df)
        return replace_table(df, name, database, buckets=BUCKETS)

    got = run(inputs, mode, keep=keep, buckets=BUCKETS)
    scans = above(plans["sofa"], "Bucketed: true")
    # pressures, episodes and four drugs
    assert len(scans) == 2 + len(rules.DRUGS)
    assert not [line for up in scans for line in up if "Exchange" in line]
    want = run(inputs, mode)
    for name in ("sofa", "ventilation", "blood_pressure", "dopamine"):
        assert got[name].columns == want[name].columns
        assert rows_of(got[name]) == rows_of(want[name])


def test_a_bucketed_table_is_one_sorted_file_a_bucket(spark, inputs, database):
    built = build(inputs, database, buckets=BUCKETS, resume=True)
    for name in ("sofa", "blood_pressure"):
        files = built[name].select(F.input_file_name().alias("f"), STAY).distinct()
        assert files.select("f").distinct().count() <= BUCKETS
        assert files.count() == files.select(STAY).distinct().count()
        detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {database}.{name}__1").collect()}
        assert detail["Num Buckets"] == str(BUCKETS)
    # grouping by stay needs no shuffle either, nor does a join of two outputs
    both = built["sofa"].groupBy(STAY).count().join(built["blood_pressure"].groupBy(STAY).agg(F.min("map")), STAY)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Exchange" not in plan(both)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # up to date as it is; another number of buckets makes it anew
    again = build(inputs, database, buckets=BUCKETS, resume=True)
    assert again["sofa"].count() == built["sofa"].count() and not spark.catalog.tableExists(f"{database}.sofa__2")
    build(inputs, database, buckets=2, resume=True)
    assert spark.catalog.tableExists(f"{database}.sofa__2")


def test_buckets_need_a_database(inputs, tmp_path):
    with pytest.raises(ValueError, match="database"):
        build(inputs, path=str(tmp_path), buckets=2)


def test_signals_in_place_only(spark):
    """A panel whose signals all lie like the grid; a stay that the grid doesn't have, hours without data."""
    stays = spark.createDataFrame([(1, "40", 120), (2, "41", 60)], f"{STAY} long, age string, unitdischargeoffset int")
    rows = spark.createDataFrame([(1, 30, 2.0), (1, 45, 1.0), (2, 61, 9.0), (3, 5, 1.0), (None, 5, 1.0), (1, None, 0.0)], f"{STAY} long, m int, x double")
    signal = Signal(rows.repartition(3, STAY), "m", [("x", F.col("x"), "min")], in_place=True)
    panel = hourly_panel(hour_grid(stays, partitions=3), [signal])
    assert rows_of(panel.where("x is not null")) == [(1, 1, 1.0)] and panel.count() == 27 + 26
    assert plan(panel).count("Exchange") == 2
