"""The clinical input tables laid over generic event and customer tables.

Every customer is a stay and every event of that id a record of the stay, in all
record tables at once. Labels, values and gaps come from integer arithmetic on the
ids, so that any SQL engine can derive the very same rows. Times of the infusion,
pressure and care-plan records are cut to half days, which gives many records at one
instant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOT = 720

# --- fixed values: labels by position ------------------------------------------
INFUSION_LABELS = (
    "Norepinephrine (mcg/min)",
    "Norepinephrine (mcg/kg/min)",
    "Norepinephrine (ml/hr)",
    "Norepinephrine ()",
    "Norepinephrine STD 4 mg Dextrose 5% 250 ml (mcg/min)",
    "Norepinephrine (mcg/hr)",
    "norepinephrine Volume (ml) (ml/hr)",
    "Norepinephrine",
    "Epinephrine (mcg/min)",
    "Epinephrine (ml/hr)",
    "Epinephrine ()",
    "Epinephrine",
    "EPINEPHrine(Adrenalin)STD 7 mg Sodium Chloride 0.9% 250 ml (mcg/min)",
    "Epinephrine (mcg/kg/min)",
    "Dopamine (mcg/kg/min)",
    "Dopamine (ml/hr)",
    "Dopamine ()",
    "Dopamine (mcg/kg/hr)",
    "dopamine (mcg/kg/min)",
    "DOPamine STD 400 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)",
    "Dobutamine (mcg/kg/min)",
    "DOBUTamine STD 500 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)",
    "Norepinephrine (mg/hr)",
    "Heparin (units/hr)",
    # units are known, but no rule lists these labels
    "Norepinephrine STD 9 mg Dextrose 5% 250 ml (mcg/min)",
    "Epinephrine drip (mcg/min)",
    "dopamine drip (mcg/kg/min)",
)
# blank labels occur in part of the stays; elsewhere another label stands there
BLANK_LABELS = {
    3: (2, 1, "Norepinephrine (mg/min)"),
    10: (3, 1, "Epinephrine (mg/hr)"),
    16: (3, 0, "dopamine (mcg/kg/min)"),
}
ORDER_NAMES = (
    "Epinephrine drip",
    "EPINEPHrine 8 MG in 250 mL NS",
    "Norepinephrine drip",
    "NOREPINEPHRINE 4 MG/250 ML NS",
    "Epinephrine HCl",
    "Norepinephrine in D5W",
    "NOREPINEPHRINE 4 MG IN 250 CC REPACKAGE Norepinephrine",
    "Heparin",
)
DOSAGES = ("16 MG", "8 MG", "4 MG", None)
RATE_TEXTS = {
    29: "OFF", 31: "", 37: "ERROR", 41: "UD", 43: "see note", 47: "50 mcg", 53: None,
    59: "2.5", 61: "0.03125", 67: "12.0625",
}
CAREPLAN_VALUES = (
    "Intubated/oral ETT",
    "Ventilated - with daily extubation evaluation",
    "Non-invasive ventilation",
    "Intubated/trach-acute",
    "Not intubated/normal airway",
    "Spontaneous - adequate",
    "Spontaneous - tenuous",
    "Ventilated - rapid wean/extubation",
    "",
)


def _pick(values, position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Events as (id, stay, minute from admission, half-day slot, type, value)."""
    start = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    minute = F.timestamp_diff("MINUTE", start, F.col("ts")).cast("int") - 1440
    return (
        spark.read.parquet(f"{folder}/events.parquet")
        .select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("stay"),
            minute.alias("off"),
            F.col("event_type").alias("kind"),
            "value",
        )
        .withColumn("slot", (F.floor(F.col("off") / SLOT) * SLOT).cast("int"))
    )


def stays(spark: SparkSession, folder: str) -> DataFrame:
    """A stay per customer, some twice; it ends with its last event, some earlier, some unknown."""
    last = observations(spark, folder).groupBy("stay").agg(F.max("off").alias("last"))
    key = F.col("c_custkey")
    case = key % 20
    plain = 41 + 2 * (key % 40)
    adm = (
        F.when(case.isin(0, 2), None)
        .when(case == 3, 0.0)
        .when(case == 5, 7.0)
        .when(case == 6, 0.7)
        .when(case == 7, 710.0)
        .when(case.isin(8, 9, 10), 71.0)
        .when(case == 11, 2.0)
        .when(case == 12, 1.9)
        .otherwise(plain.cast("double"))
    )
    dis = (
        F.when(case.isin(1, 2, 12), None)
        .when(case == 4, 0.0)
        .when(case.isin(5, 6, 7), 71.0)
        .when(case == 8, 710.0)
        .when(case == 9, 1200.0)
        .when(case == 10, 7.0)
        .when(case == 11, 2.1)
        .otherwise((plain + key % 5).cast("double"))
    )
    age = (
        F.when(key % 11 == 0, "")
        .when(key % 11 == 1, "> 89")
        .when(key % 11 == 2, None)
        .otherwise((20 + key % 60).cast("string"))
    )
    left_early = F.when(key % 5 == 0, 2880).otherwise(0)
    copies = F.sequence(F.lit(1), F.when(key % 97 == 0, 2).otherwise(1))
    return (
        spark.read.parquet(f"{folder}/customer.parquet")
        .join(last, key == F.col("stay"), "left")
        .select(
            key.alias("patientunitstayid"),
            age.alias("age"),
            (F.col("last") - left_early).cast("int").alias("unitdischargeoffset"),
            adm.alias("admissionweight"),
            dis.alias("dischargeweight"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


def infusions(obs: DataFrame) -> DataFrame:
    """Labels come from a lookup table, so that a filter on them is worked out on its few rows."""
    i, stay = F.col("id"), F.col("stay")
    names = [*INFUSION_LABELS, *[other for _, _, other in BLANK_LABELS.values()]]
    rows = ", ".join(f"({n}, '{name}')" for n, name in enumerate(names))
    labels = obs.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(position, drugname)")
    position = i % 27
    for k, (blank, (modulus, rest, _)) in enumerate(BLANK_LABELS.items(), len(INFUSION_LABELS)):
        position = F.when((i % 27 == blank) & (stay % modulus != rest), k).otherwise(position)
    rate = (2 * ((i * 7) % 300) + 1).cast("string")
    for modulus, text in RATE_TEXTS.items():
        rate = F.when(i % modulus == 0, F.lit(text)).otherwise(rate)
    return (
        obs.select(
            i.alias("infusiondrugid"),
            stay.alias("patientunitstayid"),
            F.when(i % 73 != 0, F.col("slot")).alias("infusionoffset"),
            position.cast("int").alias("position"),
            rate.alias("drugrate"),
            (i % 10).cast("string").alias("infusionrate"),
            (i % 3).cast("string").alias("drugamount"),
            F.lit("250").alias("volumeoffluid"),
            F.lit(None).cast("string").alias("patientweight"),
        )
        .join(labels, "position")
        .drop("position")
    )


def orders(obs: DataFrame) -> DataFrame:
    i = F.col("id")
    return obs.select(
        F.col("stay").alias("patientunitstayid"),
        _pick(ORDER_NAMES, i % 8).alias("drugname"),
        _pick(DOSAGES, i % 4).alias("dosage"),
        F.when(i % 5 == 0, "Yes").when(i % 7 == 0, None).otherwise("No").alias("drugordercancelled"),
        F.col("off").alias("drugstartoffset"),
        F.when(i % 23 != 0, F.col("off") + 720 + 1440 * (i % 3)).cast("int").alias("drugstopoffset"),
    )


def careplan(obs: DataFrame) -> DataFrame:
    i = F.col("id")
    turn = F.floor(i / 9) % 3
    return obs.select(
        i.alias("cplgeneralid"),
        F.col("stay").alias("patientunitstayid"),
        F.when(turn == 0, True).when(turn == 1, False).alias("activeupondischarge"),
        F.when(i % 19 != 0, F.col("slot")).alias("cplitemoffset"),
        F.when(i % 10 == 0, "Other").when(i % 2 == 1, "Airway").otherwise("Ventilation").alias("cplgroup"),
        _pick(CAREPLAN_VALUES, i % 9).alias("cplitemvalue"),
    )


def _pressure_values() -> tuple[Column, Column, Column]:
    i, v = F.col("id"), F.col("value")
    high = F.when(i % 9 == 0, v + 300).otherwise(v)
    gap, zero = i % 13 == 0, i % 17 == 0
    s = F.when(gap | (i % 10 == 0), None).when(zero, 0.0).otherwise(high)
    d = F.when(gap | (i % 11 == 0), None).when(zero, 0.0).otherwise(high / 2)
    m = F.when(gap | (i % 3 == 0), None).when(zero, 0.0).otherwise(v)
    return s, d, m


def periodic(obs: DataFrame) -> DataFrame:
    s, d, m = _pressure_values()
    return obs.where(F.col("kind").isin("view", "purchase")).select(
        F.col("stay").alias("patientunitstayid"),
        F.col("slot").alias("observationoffset"),
        s.alias("systemicsystolic"),
        d.alias("systemicdiastolic"),
        m.alias("systemicmean"),
    )


def aperiodic(obs: DataFrame) -> DataFrame:
    s, d, m = _pressure_values()
    return obs.where(F.col("kind") == "error").select(
        F.col("stay").alias("patientunitstayid"),
        F.col("slot").alias("observationoffset"),
        s.alias("noninvasivesystolic"),
        d.alias("noninvasivediastolic"),
        m.alias("noninvasivemean"),
    )


def vital(obs: DataFrame) -> DataFrame:
    s, d, m = _pressure_values()
    return obs.where(F.col("kind").isin("click", "signup")).select(
        F.col("stay").alias("patientunitstayid"),
        F.col("slot").alias("chartoffset"),
        s.alias("nibp_systolic"),
        d.alias("nibp_diastolic"),
        m.alias("nibp_mean"),
        F.when(F.col("kind") == "click", s + 1).alias("ibp_systolic"),
        F.when(F.col("kind") == "click", d).alias("ibp_diastolic"),
        F.when(F.col("kind") == "click", m).alias("ibp_mean"),
    )


def blood_gas(obs: DataFrame) -> DataFrame:
    i = F.col("id")
    return obs.select(
        F.col("stay").alias("patientunitstayid"),
        F.col("off").alias("chartoffset"),
        F.when(i % 12 != 0, F.col("value") + 40).alias("pao2"),
        F.when(i % 14 != 0, (21 + 10 * (i % 8)) / 100).alias("fio2"),
    )


def coma_scores(obs: DataFrame) -> DataFrame:
    i = F.col("id")
    return obs.select(
        F.col("stay").alias("patientunitstayid"),
        F.col("off").alias("chartoffset"),
        F.when(i % 4 != 0, (3 + i % 13).cast("double")).alias("gcs"),
    )


def labs(obs: DataFrame) -> DataFrame:
    i = F.col("id")
    return obs.select(
        F.col("stay").alias("patientunitstayid"),
        F.when(i % 71 != 0, F.col("off")).alias("chartoffset"),
        F.when(i % 3 == 0, (i * 7) % 150 / 10).alias("bilirubin"),
        F.when(i % 3 == 1, (i * 11) % 60 / 10).alias("creatinine"),
        F.when(i % 2 == 0, ((i * 13) % 400).cast("double")).alias("platelets"),
    )


def urine(obs: DataFrame) -> DataFrame:
    i = F.col("id")
    return obs.select(
        F.col("stay").alias("patientunitstayid"),
        F.col("off").alias("chartoffset"),
        F.when(i % 6 != 0, ((i * 17) % 400).cast("double")).alias("urineoutput"),
    )


def clinical_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every input table of the score."""
    obs = observations(spark, folder)
    return {
        "infusiondrug": infusions(obs),
        "medication": orders(obs),
        "careplangeneral": careplan(obs),
        "vitalperiodic": periodic(obs),
        "vitalaperiodic": aperiodic(obs),
        "pivoted_vital": vital(obs),
        "icustay_detail": stays(spark, folder),
        "pivoted_bg": blood_gas(obs),
        "pivoted_score": coma_scores(obs),
        "pivoted_lab": labs(obs),
        "pivoted_uo": urine(obs),
    }


def with_arrivals(records: DataFrame, arrivals: int, jitter: int = 720) -> DataFrame:
    """Records with a time, all stays beginning at once, and the arrival each comes with, up to ``jitter`` minutes out of order.

    The last arrival ends with a heartbeat a year later.
    """
    first, last = records.agg(F.min("minute"), F.max("minute")).first()
    first, last = first or 0, last or 0
    at = F.timestamp_seconds(F.lit(1_000_000_000) + F.col("minute") * 60)
    late = F.pmod(F.xxhash64(*records.columns), F.lit(jitter))
    part = F.floor((F.col("minute") + late - first) * arrivals / (last + jitter - first + 1))
    rows = records.select("*", at.alias("at"), F.least(part, F.lit(arrivals - 1)).cast("int").alias("arrival"))
    beat = records.sparkSession.range(1).select(
        F.timestamp_seconds(F.lit(1_000_000_000 + (last + 525_600) * 60)).alias("at"), F.lit(arrivals - 1).alias("arrival")
    )
    return rows.unionByName(beat, allowMissingColumns=True)


def earlier(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The inputs as they may have been before: some stays not yet there, some with other rows, some since removed."""
    stay = F.col("patientunitstayid")
    out = {name: df.where(F.coalesce(stay % 11 != 3, F.lit(True))) for name, df in inputs.items()}
    out["pivoted_score"] = out["pivoted_score"].withColumn("gcs", F.when(stay % 13 == 5, 3.0).otherwise(F.col("gcs")))
    out["careplangeneral"] = out["careplangeneral"].where(F.coalesce(stay % 17 != 2, F.lit(True)))
    for name in ("icustay_detail", "infusiondrug", "pivoted_lab"):
        since = inputs[name].where(stay % 19 == 1).withColumn("patientunitstayid", stay + 10_000_000)
        out[name] = out[name].unionByName(since)
    return out
