"""Queries over the given tables, with an independent SQL form of each."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from acuity import contracts, rules  # noqa: E402
from acuity.operators import blood_gas, grid, infusions, intervals, pressures, scores, ventilation, weights  # noqa: E402
from acuity.plans.scoring import run, score_signals  # noqa: E402
from acuity.session import scratch_path, shared_folder, stored, tune  # noqa: E402
from checks import event_tables as ev  # noqa: E402
from acuity.sources.tables import build, refresh  # noqa: E402
from acuity.streaming import hourly  # noqa: E402
from checks import oracles  # noqa: E402

try:
    from acuity.llm import registry as corpus  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("acuity.llm", "corpus_pipeline"):
        raise
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]
STAY = "patientunitstayid"
WORST = [f"{organ}_24hours" for organ in rules.ORGANS] + ["SOFA_24hours"]


# the output tables that hold records, and the form each is compared with
WRITTEN = oracles.WRITTEN


def _query(build_df: Callable[[SparkSession, str], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return build_df(tune(spark), folder)

    return query


def _labelled(spark: SparkSession, folder: str, full: bool) -> DataFrame:
    obs = ev.observations(spark, folder)
    parsed = infusions.parse_infusions(ev.infusions(obs))
    if not full:
        return infusions.impute_unit_labels(parsed)
    repaired = weights.clean_weights(ev.stays(spark, folder))
    return infusions.impute_unit_labels(parsed, rules.DRUGS, ev.orders(obs), repaired)


def _volume_rates(spark: SparkSession, folder: str) -> DataFrame:
    rates = infusions.normalise_rates(_labelled(spark, folder, full=True))
    volume = [label for d in rules.DRUGS for label in d.volume_labels]
    return rates.where(F.col("drugname").isin(*volume)).drop(*infusions.PASSED_THROUGH)


def _rates(drug: str) -> Query:
    rule = next(d for d in rules.DRUGS if d.name == drug)

    def query(spark: SparkSession, folder: str) -> DataFrame:
        obs = ev.observations(spark, folder)
        repaired = weights.clean_weights(ev.stays(spark, folder))
        rates = infusions.vasoactive_rates(ev.infusions(obs), ev.orders(obs), repaired, (rule,))
        return infusions.drug_table(rates, drug)

    return _query(query)


def _pressures(spark: SparkSession, folder: str) -> DataFrame:
    obs = ev.observations(spark, folder)
    return pressures.coalesce_pressures(ev.vital(obs), ev.aperiodic(obs), ev.periodic(obs))


def _vent(steps: int) -> Callable[[SparkSession, str], DataFrame]:
    """Care-plan events after the first so many steps."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        stays = ev.stays(spark, folder)
        df = ev.careplan(ev.observations(spark, folder))
        chain = [
            ventilation.classify_vent_events,
            ventilation.resolve_same_instant,
            ventilation.trim_leading_off,
            ventilation.close_open_tail,
            ventilation.settle_last_pair,
            lambda events: ventilation.close_at_discharge(events, stays),
        ]
        for step in chain[:steps]:
            df = step(df)
        return df

    return query


def _episodes(mode: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: ventilation.episodes(_vent(6)(spark, folder), mode)


def _pf(spark: SparkSession, folder: str) -> DataFrame:
    gases = ev.blood_gas(ev.observations(spark, folder))
    return blood_gas.pf_ratio(gases, _episodes("reference")(spark, folder))


def _signals(spark: SparkSession, folder: str) -> list[grid.Signal]:
    """All measurements of the score."""
    obs = ev.observations(spark, folder)
    rates = infusions.vasoactive_rates(ev.infusions(obs), ev.orders(obs), weights.clean_weights(ev.stays(spark, folder)))
    return score_signals(
        ev.blood_gas(obs),
        ev.coma_scores(obs),
        ev.labs(obs),
        ev.urine(obs),
        _pressures(spark, folder),
        _episodes("reference")(spark, folder),
        rates,
    )


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly panel of all measurements."""
    return grid.hourly_panel(grid.hour_grid(ev.stays(spark, folder)), _signals(spark, folder))


def _streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Replay all measurements out of order, in three arrivals that each go on from the checkpoint before."""
    place = scratch_path(spark, "stream")
    # written before the arrivals look for the first and the last record, or all would be worked out twice
    told = stored(hourly.records(ev.stays(spark, folder), _signals(spark, folder)), "records")
    rows = ev.with_arrivals(told, arrivals=3)
    rows.write.partitionBy("arrival").parquet(f"{place}/records")
    schema = rows.drop("arrival").schema
    for arrival in range(3):
        spark.read.schema(schema).parquet(f"{place}/records/arrival={arrival}").write.mode("append").parquet(f"{place}/arrived")
        scored = hourly.hourly_scores(spark.readStream.schema(schema).parquet(f"{place}/arrived"), delay="12 hours")
        sink = scored.writeStream.option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True)
        sink.start(f"{place}/scores").awaitTermination()
    return spark.read.parquet(f"{place}/scores")


def _bands(organ: str, *shown: str) -> Query:
    return _query(
        lambda spark, folder: scores.organ_points(_panel(spark, folder)).select(STAY, "hr", *shown, organ)
    )


def _lab_panel(spark: SparkSession, folder: str, *measures: tuple[str, str, str]) -> DataFrame:
    labs = ev.labs(ev.observations(spark, folder))
    signal = grid.Signal(labs, "chartoffset", [(name, F.col(c), how) for name, c, how in measures])
    return grid.hourly_panel(grid.hour_grid(ev.stays(spark, folder)), [signal])


def _platelet_points(spark: SparkSession, folder: str) -> DataFrame:
    panel = _lab_panel(spark, folder, ("platelet_min", "platelets", "min"))
    return panel.withColumn("coagulation", scores.coagulation())


def _liver_points(spark: SparkSession, folder: str) -> DataFrame:
    panel = _lab_panel(spark, folder, ("bilirubin_max", "bilirubin", "max"))
    return panel.withColumn("liver", scores.liver())


def _cns_points(spark: SparkSession, folder: str) -> DataFrame:
    coma = grid.Signal(
        ev.coma_scores(ev.observations(spark, folder)), "chartoffset", [("GCS_min", F.col("gcs"), "min")]
    )
    panel = grid.hourly_panel(grid.hour_grid(ev.stays(spark, folder)), [coma])
    return panel.withColumn("cns", scores.cns())


def _respiration_points(spark: SparkSession, folder: str) -> DataFrame:
    gases = ev.blood_gas(ev.observations(spark, folder))
    ratios = blood_gas.pf_ratio_min(gases, _episodes("reference")(spark, folder))
    names = ("PaO2FiO2Ratio_vent", "PaO2FiO2Ratio_novent")
    signal = grid.Signal(ratios, "chartoffset", [(n, F.col(n), "min") for n in names])
    panel = grid.hourly_panel(grid.hour_grid(ev.stays(spark, folder)), [signal])
    return panel.withColumn("respiration", scores.respiration())


def _renal_points(spark: SparkSession, folder: str) -> DataFrame:
    obs = ev.observations(spark, folder)
    signals = [
        grid.Signal(ev.labs(obs), "chartoffset", [("creatinine_max", F.col("creatinine"), "max")]),
        grid.Signal(ev.urine(obs), "chartoffset", [("urineoutput", F.col("urineoutput"), "sum")]),
    ]
    panel = scores.rolling_urine(grid.hourly_panel(grid.hour_grid(ev.stays(spark, folder)), signals))
    return panel.withColumn("renal", scores.renal(F.col("urine_24hours"))).drop("urineoutput")


def _urine(spark: SparkSession, folder: str) -> DataFrame:
    signal = grid.Signal(
        ev.urine(ev.observations(spark, folder)),
        "chartoffset",
        [("urineoutput", F.col("urineoutput"), "sum")],
    )
    return grid.hourly_panel(grid.hour_grid(ev.stays(spark, folder)), [signal])


def _platelet_bucket(spark: SparkSession, folder: str) -> DataFrame:
    labs = ev.labs(ev.observations(spark, folder)).where(F.col("platelets").isNotNull())
    return grid.bucket_hourly(labs, "chartoffset", {"platelet_min": F.min("platelets")})


_PLACES: dict[tuple[str, ...], str] = {}


def _place(spark: SparkSession, folder: str) -> str:
    """Where the output tables of a folder lie for the life of the application."""
    key = (spark.sparkContext.applicationId, shared_folder(spark), folder)
    if key not in _PLACES:
        _PLACES[key] = scratch_path(spark, "score_tables")
    return _PLACES[key]


def _written(table: str) -> Query:
    """Write the output tables that are not up to date, then read one back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return build(ev.clinical_inputs(spark, folder), path=_place(spark, folder), resume=True)[table]

    return query


def _bucketed(table: str) -> Query:
    """Write the output tables with buckets by stay to a database of their own, then read one back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        place = scratch_path(spark, "bucketed")
        database = os.path.basename(place)
        spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
        inputs = ev.clinical_inputs(spark, folder)
        buckets = max(8, grid.grid_partitions(inputs["icustay_detail"]))
        return build(inputs, database, buckets=buckets)[table]

    return query


def _refreshed(table: str) -> Query:
    """Write the tables of earlier inputs, bring them up to date by stay, then read one back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_path(spark, "refreshed")
        inputs = ev.clinical_inputs(spark, folder)
        refresh(ev.earlier(inputs), path)
        return refresh(inputs, path)[table]

    return query


def _exact_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Doses of all drugs as decimals, written out."""
    obs = ev.observations(spark, folder)
    repaired = weights.clean_weights(ev.stays(spark, folder))
    rates = infusions.vasoactive_rates(ev.infusions(obs), ev.orders(obs), repaired, exact=True)
    return rates.withColumn("rate", F.col("rate").cast("string")).drop(*infusions.PASSED_THROUGH)


def _gas_episodes(spark: SparkSession, folder: str) -> DataFrame:
    gases = ev.blood_gas(ev.observations(spark, folder))
    return intervals.gas_episodes(gases, _episodes("reference")(spark, folder))


def _hourly_labs(spark: SparkSession, folder: str) -> DataFrame:
    """Points of the hours that have platelets, without a grid."""
    labs = ev.labs(ev.observations(spark, folder)).where(F.col("platelets").isNotNull())
    hourly = grid.bucket_hourly(labs, "chartoffset", {"platelet_min": F.min("platelets")})
    return hourly.withColumn("coagulation", scores.coagulation())


def _hourly_urine(spark: SparkSession, folder: str) -> DataFrame:
    urine = ev.urine(ev.observations(spark, folder))
    return grid.bucket_hourly(urine, "chartoffset", {"urineoutput": F.sum(F.col("urineoutput").cast("double"))})


def _violations(spark: SparkSession, folder: str) -> DataFrame:
    """Contract checks of every input."""
    return contracts.violations(ev.clinical_inputs(spark, folder))


def _full(spark: SparkSession, folder: str) -> DataFrame:
    return run(ev.clinical_inputs(spark, folder))["sofa"]


def entry(spark: SparkSession) -> DataFrame:
    """The whole hourly score of the tables in ``$ENTRY_SF_DIR``, a smoke-test folder by default."""
    return _full(tune(spark), os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    def infusion_rows(spark: SparkSession, folder: str) -> DataFrame:
        return ev.infusions(ev.observations(spark, folder))

    plain = {
        "weight_repair": lambda s, f: weights.clean_weights(ev.stays(s, f)),
        "infusion_parse": lambda s, f: infusions.parse_infusions(infusion_rows(s, f)).drop(
            "drugrate", *infusions.PASSED_THROUGH
        ),
        "infusion_rejects": lambda s, f: infusions.infusion_rejects(infusion_rows(s, f)).select(
            "drug", "infusiondrugid", "drugname", "drugrate"
        ),
        "unit_locf_nocb": lambda s, f: _labelled(s, f, full=False).drop(
            "drugrate", "minute", *infusions.PASSED_THROUGH
        ),
        "volume_rate_by_order": _volume_rates,
        "pressure_coalesce": _pressures,
        "pressure_min": lambda s, f: pressures.map_min(_pressures(s, f)),
        "vent_classify": _vent(1),
        "vent_same_instant": _vent(2),
        "vent_trim": _vent(3),
        "vent_tail_close": _vent(4),
        "vent_last_pair": _vent(5),
        "vent_discharge_close": _vent(6),
        "vent_episodes_reference": _episodes("reference"),
        "vent_episodes_islands": _episodes("islands"),
        "cohort": lambda s, f: grid.cohort(ev.stays(s, f)),
        "hour_grid": lambda s, f: grid.hour_grid(ev.stays(s, f)),
        "hourly_min_bucket": _platelet_bucket,
        "hourly_urine": _urine,
        "pf_by_vent": _pf,
        "hourly_panel": _panel,
        "band_respiration": _respiration_points,
        "band_coagulation": _platelet_points,
        "band_liver": _liver_points,
        "band_cns": _cns_points,
        "renal_rolling_urine": _renal_points,
        "rolling_worst_24": lambda s, f: scores.rolling_worst(
            _platelet_points(s, f), ["coagulation"]
        ).drop("platelet_min"),
        "sofa_total": lambda s, f: scores.total_score(scores.organ_points(_panel(s, f))).select(
            STAY, "hr", *WORST
        ),
        "sofa_full": _full,
        "written_tables": lambda s, f: _written("sofa")(s, f).select(STAY, "hr", *WORST),
        "contract_violations": _violations,
        "contract_quarantine": lambda s, f: contracts.quarantine(ev.clinical_inputs(s, f)),
        "gas_episodes": _gas_episodes,
        "rate_exact": _exact_rates,
        "rolling_worst_by_change": lambda s, f: scores.by_change(_hourly_labs(s, f), ev.stays(s, f), worst=["coagulation"]),
        "rolling_urine_by_change": lambda s, f: scores.by_change(_hourly_urine(s, f), ev.stays(s, f), total=["urineoutput"]),
        "bucketed_sofa": _bucketed("sofa"),
        "streamed_sofa": _streamed,
        "refreshed_sofa": _refreshed("sofa"),
        "refreshed_ventilation": _refreshed("ventilation"),
    }
    found = {name: _query(q) for name, q in plain.items()}
    for drug in rules.DRUGS:
        found[f"rate_{drug.name}"] = _rates(drug.name)
    for table in WRITTEN:
        found[f"written_{table}"] = _query(_written(table))
    found["band_cardiovascular"] = _bands("cardiovascular", "MeanBP_min")
    return found | (corpus.queries() if corpus else {})


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | (corpus.oracle_sql() if corpus else {})
