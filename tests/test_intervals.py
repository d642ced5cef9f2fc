import random

import pytest
from pyspark.sql import functions as F

from acuity.operators.intervals import gas_episodes, with_intervals
from tests.conftest import rows_of
from tests.test_plans import plan

ROWS = "patientunitstayid long, chartoffset int, x int"
SPANS = "patientunitstayid long, starttime int, endtime int"


def pairs(rows, spans):
    out = []
    for stay, at, x in rows:
        found = [(a, b) for s, a, b in spans if stay is not None and s == stay and None not in (a, b, at) and a <= at <= b]
        out += [(stay, at, x, a, b) for a, b in found] or [(stay, at, x, None, None)]
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("width", [1, 7, 60, 1440])
def test_every_interval_of_a_point_is_returned(spark, width):
    """Overlapping, touching, repeated, reversed and open intervals; points on bounds, repeated, without a time."""
    rng = random.Random(width)
    rows = [(rng.randint(1, 5), rng.choice([None, rng.randint(-90, 200)]), i % 7) for i in range(300)] + [(None, 5, 0)]
    rows += rows[:20]
    spans = []
    for _ in range(40):
        start = rng.choice([None, rng.randint(-100, 190)])
        spans.append((rng.randint(1, 6), start, None if start is None else rng.choice([None, start - 2, start, start + rng.randint(1, 150)])))
    spans += [(1, 0, 10), (1, 10, 20), (2, -(2**31), 2**31 - 1), (None, 0, 9)] + spans[:5]
    df = with_intervals(spark.createDataFrame(rows, ROWS), spark.createDataFrame(spans, SPANS), "chartoffset", width=width)
    assert df.columns == ["patientunitstayid", "chartoffset", "x", "starttime", "endtime"]
    assert rows_of(df) == pairs(rows, spans)


def test_empty_sides(spark):
    rows, spans = spark.createDataFrame([(1, 5, 0)], ROWS), spark.createDataFrame([(1, 0, 9)], SPANS)
    assert with_intervals(rows.where("false"), spans, "chartoffset").collect() == []
    assert rows_of(with_intervals(rows, spans.where("false"), "chartoffset")) == [(1, 5, 0, None, None)]


def test_the_join_is_on_stay_and_bin(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(with_intervals(spark.createDataFrame([(1, 5, 0)], ROWS), spark.createDataFrame([(1, 0, 9)], SPANS), "chartoffset"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text
    (join,) = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert "patientunitstayid" in join and "bin" in join and "LeftOuter" in join


def test_a_hot_stay_is_spread_over_its_bins(spark):
    """A third of all rows in one stay: no task holds them together."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("patientunitstayid"),
        (F.col("id") % 50_000).cast("int").alias("chartoffset"), F.lit(0).alias("x"),
    )
    spans = spark.createDataFrame([(1, a, a + 700) for a in range(0, 50_000, 1000)], SPANS)
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        df = with_intervals(rows, spans, "chartoffset")
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert df.count() == 60_000 and max(sizes) < 3 * 60_000 / 32
        assert df.where("starttime is not null").count() == rows.where("patientunitstayid = 1 and chartoffset % 1000 <= 700").count()
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_gas_episodes(spark, table):
    gases = table("pivoted_bg", [{"patientunitstayid": 1, "chartoffset": o, "pao2": p, "fio2": f} for o, p, f in [(9, 80.0, 0.4), (10, 80.0, 0.4), (15, 80.0, 0.0), (20, None, 0.4)]])
    spans = spark.createDataFrame([(1, 10, 20), (1, 5, 10)], SPANS)
    assert rows_of(gas_episodes(gases, spans)) == [(1, 9, 200.0, 5, 10, 4), (1, 10, 200.0, 5, 10, 5), (1, 10, 200.0, 10, 20, 0), (1, 15, None, 10, 20, 5)]
