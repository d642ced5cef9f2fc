"""What the input tables must look like."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fixed values: input columns; a key must not be NULL ---------------------
INPUTS = {
    "infusiondrug": "infusiondrugid long, patientunitstayid long, infusionoffset int, drugname string,"
    " drugrate string, infusionrate string, drugamount string, volumeoffluid string, patientweight string",
    "medication": "patientunitstayid long, drugname string, dosage string, drugordercancelled string,"
    " drugstartoffset int, drugstopoffset int",
    "careplangeneral": "cplgeneralid long, patientunitstayid long, activeupondischarge boolean,"
    " cplitemoffset int, cplgroup string, cplitemvalue string",
    "vitalperiodic": "patientunitstayid long, observationoffset int, systemicsystolic double,"
    " systemicdiastolic double, systemicmean double",
    "vitalaperiodic": "patientunitstayid long, observationoffset int, noninvasivesystolic double,"
    " noninvasivediastolic double, noninvasivemean double",
    "pivoted_vital": "patientunitstayid long, chartoffset int, nibp_systolic double, nibp_diastolic double,"
    " nibp_mean double, ibp_systolic double, ibp_diastolic double, ibp_mean double",
    "icustay_detail": "patientunitstayid long, age string, unitdischargeoffset int, admissionweight double,"
    " dischargeweight double",
    "pivoted_bg": "patientunitstayid long, chartoffset int, pao2 double, fio2 double",
    "pivoted_score": "patientunitstayid long, chartoffset int, gcs double",
    "pivoted_lab": "patientunitstayid long, chartoffset int, bilirubin double, creatinine double,"
    " platelets double",
    "pivoted_uo": "patientunitstayid long, chartoffset int, urineoutput double",
}
KEYS = {
    "infusiondrug": ("infusiondrugid", "patientunitstayid"),
    "medication": ("patientunitstayid",),
    "careplangeneral": ("cplgeneralid", "patientunitstayid"),
    "vitalperiodic": ("patientunitstayid", "observationoffset"),
    "vitalaperiodic": ("patientunitstayid", "observationoffset"),
    "pivoted_vital": ("patientunitstayid", "chartoffset"),
    "icustay_detail": ("patientunitstayid",),
    "pivoted_bg": ("patientunitstayid", "chartoffset"),
    "pivoted_score": ("patientunitstayid", "chartoffset"),
    "pivoted_lab": ("patientunitstayid", "chartoffset"),
    "pivoted_uo": ("patientunitstayid", "chartoffset"),
}
# the time column of a table
OFFSETS = ("infusionoffset", "drugstartoffset", "cplitemoffset", "observationoffset", "chartoffset")
UNIQUE = {
    "infusiondrug": "infusiondrugid",
    "careplangeneral": "cplgeneralid",
    "icustay_detail": "patientunitstayid",
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(INPUTS[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """The contract's columns in its types; columns the score never reads are left out."""
    have = {c.lower() for c in df.columns}
    missing = [f.name for f in schema(table) if f.name.lower() not in have]
    if missing:
        raise ValueError(f"{table} lacks the columns {missing}")
    types = {f.name.lower(): f.dataType for f in df.schema}
    if [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema(table)]:
        return df
    return df.select(
        *[
            F.col(f.name).alias(f.name)
            if types[f.name.lower()] == f.dataType
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema(table)
        ]
    )


def conform_all(inputs: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    absent = [t for t in INPUTS if t not in inputs]
    if absent:
        raise ValueError(f"missing input tables {absent}")
    return {t: conform(inputs[t], t) for t in INPUTS}


def quarantine(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """(table, patientunitstayid, record_id, minute, rules) of each input row that breaks a rule.

    ``rules`` names all that the row breaks, comma-joined, from one scan of its table. Every row of
    an id that stands more than once breaks the rule on repeats; such ids come from one more scan
    of that column, reduced before it is shuffled. ``record_id`` and ``minute`` are NULL where a table
    has none.
    """
    found = []
    for table, df in inputs.items():
        broken = {f"{k} is null": F.col(k).isNull() for k in KEYS[table]}
        if table == "pivoted_bg":
            broken["fio2 is no fraction"] = ~((F.col("fio2") > 0) & (F.col("fio2") <= 1))
        if table in UNIQUE:
            key = UNIQUE[table]
            again = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("repeated")).agg(F.count("*").alias("rows"))
            df = df.join(again.where("rows > 1"), F.col(key) == F.col("repeated"), "left")
            broken[f"{key} is repeated"] = F.col("repeated").isNotNull()
        names = F.concat_ws(", ", *[F.when(rule, F.lit(name)) for name, rule in broken.items()])
        columns = {f.name for f in schema(table)}
        record = next((k for k in KEYS[table] if k not in ("patientunitstayid", *OFFSETS)), None)
        minute = next((c for c in OFFSETS if c in columns), None)
        found.append(
            df.select(
                F.lit(table).alias("table"),
                "patientunitstayid",
                (F.col(record) if record else F.lit(None)).cast("long").alias("record_id"),
                (F.col(minute) if minute else F.lit(None)).cast("int").alias("minute"),
                names.alias("rules"),
            ).where(F.col("rules") != "")
        )
    return reduce(DataFrame.unionByName, found)


def violations(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that break a contract, counted per table and rule; one pass per table.

    A row id or stay that should be unique is counted once for each copy too many.
    """
    counts = []
    for table, df in inputs.items():
        rules = {f"{k} is null": F.count(F.when(F.col(k).isNull(), 1)) for k in KEYS[table]}
        if table == "pivoted_bg":
            fraction = (F.col("fio2") > 0) & (F.col("fio2") <= 1)
            rules["fio2 is no fraction"] = F.count(F.when(~fraction, 1))
        if table in UNIQUE:
            key = UNIQUE[table]
            rules[f"{key} is repeated"] = F.count(key) - F.count_distinct(key)
        checked = df.agg(*[broken.alias(r) for r, broken in rules.items()])
        counts.append(
            checked.select(
                F.lit(table).alias("table"),
                F.inline(
                    F.array(
                        *[F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("rows")) for r in rules]
                    )
                ),
            )
        )
    return reduce(DataFrame.unionByName, counts)
