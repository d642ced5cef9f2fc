"""Outputs that are replaced as a whole, taken up again after a failure, or refreshed by stay."""

import os

import pytest
from pyspark.sql import functions as F

from acuity.plans.scoring import run
from acuity.sources import tables, versions
from acuity.sources.tables import build, read_table, refresh, replace_table
from checks.event_tables import clinical_inputs
from tests.conftest import SF_DIR, rows_of


@pytest.fixture(scope="module")
def inputs(spark):
    return {n: df.cache() for n, df in clinical_inputs(spark, SF_DIR).items()}


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE versioned LOCATION '{tmp_path}/db'")
    yield "versioned"
    spark.sql("DROP DATABASE versioned CASCADE")


def failing(spark, rows=1000, at=900):
    """A frame whose write fails after some rows."""
    return spark.range(0, rows, 1, 4).select(
        F.when(F.col("id") < at, F.col("id")).otherwise(F.raise_error(F.lit("half way")).cast("long")).alias("patientunitstayid")
    )


def where(kind, tmp_path, request):
    return {"path": str(tmp_path)} if kind == "path" else {"database": request.getfixturevalue("database")}


@pytest.mark.parametrize("kind", ["path", "database"])
def test_a_write_that_fails_half_way_leaves_the_old_table(spark, tmp_path, request, kind):
    place = where(kind, tmp_path, request)
    old = spark.range(10).toDF("patientunitstayid")
    replace_table(old, "weight", **place)
    with pytest.raises(Exception, match="half way"):
        replace_table(failing(spark), "weight", **place)
    assert rows_of(read_table(spark, "weight", **place)) == rows_of(old)
    replace_table(old.where("patientunitstayid < 3"), "weight", **place)
    assert read_table(spark, "weight", **place).count() == 3


@pytest.mark.parametrize("kind", ["path", "database"])
def test_a_reader_goes_on_while_the_table_is_replaced(spark, tmp_path, request, kind):
    place = where(kind, tmp_path, request)
    replace_table(spark.range(10).toDF("patientunitstayid"), "weight", **place)
    reader = read_table(spark, "weight", **place)
    # a table is replaced by what is read from it, under another schema
    replace_table(reader.where("patientunitstayid > 4").withColumn("more", F.lit(1)), "weight", **place)
    assert reader.count() == 10 and reader.columns == ["patientunitstayid"]
    assert read_table(spark, "weight", **place).columns == ["patientunitstayid", "more"]
    assert read_table(spark, "weight", **place).count() == 5


def test_old_versions_go(spark, tmp_path):
    for n in range(1, 6):
        replace_table(spark.range(n).toDF("patientunitstayid"), "weight", path=str(tmp_path))
    root = f"{tmp_path}/weight"
    assert versions.commits(spark, root) == [4, 5]
    assert len(os.listdir(f"{root}/data")) == versions.KEPT
    assert read_table(spark, "weight", path=str(tmp_path)).count() == 5


def test_old_versions_go_in_a_database(spark, database):
    spark.range(7).write.saveAsTable(f"{database}.weight")  # a plain table of the older layout
    for n in range(1, 4):
        replace_table(spark.range(n).toDF("patientunitstayid"), "weight", database=database)
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()} == {"weight", "weight__2", "weight__3"}
    assert spark.table(f"{database}.weight").count() == 3


def test_a_commit_that_is_not_whole_is_passed_over(spark, tmp_path):
    root = f"{tmp_path}/t"
    first = versions.publish(spark.range(3), root)
    with open(f"{root}/commits/{first.number + 1:012d}.json", "w") as f:
        f.write('{"made_from": "", "sch')
    assert versions.current(spark, root) == first and versions.read(spark, root).count() == 3
    later = versions.publish(spark.range(4), root)
    assert later.number == first.number + 2 and versions.read(spark, root).count() == 4


def test_of_two_writers_one_fails(spark, tmp_path):
    root = f"{tmp_path}/t"
    first = versions.publish(spark.range(3), root)
    other = versions.Version(first.number, "other", first.schema, first.parts)
    with pytest.raises(Exception, match="exist"):
        versions.commit(spark, root, other)
    assert versions.current(spark, root).made_from == ""


def test_no_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_table(spark, "weight", path=str(tmp_path))


class Stopped(Exception):
    pass


@pytest.mark.parametrize("kind", ["path", "database"])
def test_a_build_that_died_goes_on(spark, inputs, tmp_path, request, monkeypatch, kind):
    """The build is killed after the third table; the next one makes the rest only."""
    place = where(kind, tmp_path, request)
    made = []
    real = tables.replace_table

    def counted(df, name, *rest):
        if len(made) == 3 and stop:
            raise Stopped
        made.append(name)
        return real(df, name, *rest)

    monkeypatch.setattr(tables, "replace_table", counted)
    stop = True
    with pytest.raises(Stopped):
        build(inputs, resume=True, **place)
    assert made == ["contract_violations", "quarantine", "infusion_rejects"]
    stop = False
    out = build(inputs, resume=True, **place)
    assert made == list(out) and len(set(made)) == len(made) == len(tables.NEEDS)
    made.clear()
    assert rows_of(build(inputs, resume=True, **place)["sofa"]) == rows_of(run(inputs)["sofa"]) and made == []
    # a changed input makes its own tables anew
    fewer = inputs | {"careplangeneral": inputs["careplangeneral"].where("patientunitstayid % 2 = 0")}
    out = build(fewer, resume=True, **place)
    assert made == ["contract_violations", "quarantine", "ventilation", "sofa"]
    assert rows_of(out["ventilation"]) == rows_of(run(fewer)["ventilation"])
    made.clear()
    build(fewer, resume=True, mode="islands", input_versions=dict.fromkeys(inputs, "snapshot 7"), **place)
    assert made == list(tables.NEEDS)


def changed(inputs):
    """Other rows for some stays: inserts, updates, deletes, and a stay without a number."""
    stay = F.col("patientunitstayid")
    some = inputs["icustay_detail"].select("patientunitstayid").distinct().orderBy("patientunitstayid").limit(6).collect()
    a, b, c, d, e, _ = [r[0] for r in some]
    out = {n: df.where(stay != a) for n, df in inputs.items()}  # gone everywhere
    out["pivoted_score"] = out["pivoted_score"].withColumn("gcs", F.when(stay == b, F.lit(3.0)).otherwise(F.col("gcs")))
    out["careplangeneral"] = out["careplangeneral"].where(stay != c)
    for name in ("icustay_detail", "pivoted_lab", "infusiondrug"):  # a new stay
        out[name] = out[name].unionByName(inputs[name].where(stay == d).withColumn("patientunitstayid", F.lit(10**9).cast("long")))
    out["pivoted_uo"] = out["pivoted_uo"].unionAll(out["pivoted_uo"].where(stay == e))  # a copy of each row
    lost = inputs["pivoted_uo"].limit(1).withColumn("patientunitstayid", F.lit(None).cast("long"))
    out["pivoted_uo"] = out["pivoted_uo"].unionByName(lost)
    return out


def test_a_refresh_equals_a_full_build(spark, inputs, tmp_path):
    path = str(tmp_path)
    first = refresh(inputs, path, buckets=16)
    direct = run(inputs)
    assert sorted(first) == sorted(direct)
    assert rows_of(first["sofa"]) == rows_of(direct["sofa"])
    after = changed(inputs)
    out = refresh(after, path, buckets=16)
    for name, df in run(after).items():
        assert out[name].columns == df.columns
        assert rows_of(out[name]) == rows_of(df), name
    # only the buckets of changed stays were written
    sofa = versions.current(spark, f"{path}/sofa")
    fresh = {b for b, p in sofa.parts.items() if p.startswith(f"data/{sofa.number:012d}-")}
    want = tables.changed_buckets(tables.stay_digests(after), tables.stay_digests(inputs), 16)
    assert fresh <= {str(b) for b in want} and 0 < len(want) <= 7
    # and nothing when nothing changed
    refresh(after, path, buckets=16)
    assert versions.current(spark, f"{path}/sofa") == sofa
    # back again
    back = refresh(inputs, path, buckets=16)
    assert rows_of(back["sofa"]) == rows_of(direct["sofa"]) and rows_of(back["ventilation"]) == rows_of(direct["ventilation"])


def test_a_refresh_works_out_changed_stays_only(spark, inputs, tmp_path, monkeypatch):
    """One bucket holds all stays: those that have not changed are copied, not worked out."""
    path = str(tmp_path)
    refresh(inputs, path, buckets=1)
    seen = {}
    real = tables.run

    def watched(part, *rest):
        seen.update({name: {r[0] for r in df.select("patientunitstayid").distinct().collect()} for name, df in part.items()})
        return real(part, *rest)

    monkeypatch.setattr(tables, "run", watched)
    after = changed(inputs)
    out = refresh(after, path, buckets=1)
    want = {r[0] for r in tables.changed_stays(tables.stay_digests(after), tables.stay_digests(inputs)).collect()}
    assert None in want and 0 < len(want) <= 7
    assert all(stays <= want for stays in seen.values()) and None in seen["pivoted_uo"] and 10**9 in seen["pivoted_lab"]
    for name, df in run(after).items():
        assert rows_of(out[name]) == rows_of(df), name


def test_a_refresh_that_died_is_made_again(spark, inputs, tmp_path, monkeypatch):
    path = str(tmp_path)
    refresh(inputs, path, buckets=4)
    after = changed(inputs)
    real = versions.publish

    def dies(df, root, *rest):
        if root.endswith("/ventilation"):
            raise Stopped
        return real(df, root, *rest)

    monkeypatch.setattr(versions, "publish", dies)
    with pytest.raises(Stopped):
        refresh(after, path, buckets=4)
    monkeypatch.setattr(versions, "publish", real)
    out = refresh(after, path, buckets=4)
    want = run(after)
    for name in ("weight", "ventilation", "sofa"):
        assert rows_of(out[name]) == rows_of(want[name])


def test_an_empty_bucket_has_no_folder(spark, tmp_path):
    root = f"{tmp_path}/t"
    rows = spark.range(40).toDF("patientunitstayid")
    versions.publish(rows, root, key="patientunitstayid", buckets=4)
    own = versions.bucket_of(F.col("patientunitstayid"), 4)
    versions.publish(rows.where("false"), root, key="patientunitstayid", buckets=4, changed=[2])
    assert rows_of(versions.read(spark, root)) == rows_of(rows.where(own != 2))
    assert sorted(versions.current(spark, root).parts) == ["0", "1", "3"]
    versions.publish(rows.where("false"), root, key="patientunitstayid", buckets=4)
    assert versions.read(spark, root).columns == ["patientunitstayid"] and versions.read(spark, root).count() == 0
