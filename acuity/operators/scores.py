"""Organ points per hour, worst of the last day, and their total."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acuity import rules
from acuity.functions import case, points
from acuity.functions.expressions import above, at_least, below, between
from acuity.operators.grid import by_stay, cohort, grid_partitions

STAY = "patientunitstayid"
#: bits of a whole number that are used
_BITS = 60


def last_hours(hours: int = rules.ROLLING_HOURS):
    """The rows of the last hours; the grid has a row for each hour."""
    return Window.partitionBy(STAY).orderBy("hr").rowsBetween(1 - hours, Window.currentRow)


def _by_score(*groups: list[tuple[Column, int]]) -> list[tuple[Column, int]]:
    """Rules of several inputs, worst score first."""
    return sorted((rule for group in groups for rule in group), key=lambda rule: -rule[1])


def respiration() -> Column:
    vent, novent = F.col("PaO2FiO2Ratio_vent"), F.col("PaO2FiO2Ratio_novent")
    bands = _by_score(below(vent, rules.PF_VENT_BELOW), below(novent, rules.PF_NOVENT_BELOW))
    return points(bands, vent, novent)


def coagulation() -> Column:
    platelets = F.col("platelet_min")
    return points(below(platelets, rules.PLATELETS_BELOW), platelets)


def liver() -> Column:
    bilirubin = F.col("bilirubin_max")
    return points(at_least(bilirubin, rules.BILIRUBIN_FROM), bilirubin)


def cardiovascular() -> Column:
    pressure = F.col("MeanBP_min")
    dopamine, dobutamine = F.col("rate_dopamine"), F.col("rate_dobutamine")
    strong = [F.col("rate_epinephrine"), F.col("rate_norepinephrine")]
    limit = rules.CATECHOLAMINE_LIMIT
    bands = _by_score(
        above(dopamine, rules.DOPAMINE_ABOVE),
        [(rate > limit, 4) for rate in strong],
        [(rate <= limit, 3) for rate in strong],
        [(dobutamine > 0, 2)],
        below(pressure, rules.MAP_BELOW),
    )
    return points(bands, pressure, dopamine, dobutamine, *strong)


def cns() -> Column:
    gcs = F.col("GCS_min")
    return points(_by_score(below(gcs, rules.GCS_BELOW), between(gcs, rules.GCS_BETWEEN)), gcs)


def renal(urine_day: Column) -> Column:
    creatinine = F.col("creatinine_max")
    bands = _by_score(
        at_least(creatinine, rules.CREATININE_FROM), below(urine_day, rules.URINE_BELOW)
    )
    return points(bands, urine_day, creatinine)


def rolling_urine(panel: DataFrame) -> DataFrame:
    """Urine of the last day; the first hours of a stay sum up what there is."""
    return panel.withColumn("urine_24hours", F.sum("urineoutput").over(last_hours()))


def organ_points(panel: DataFrame) -> DataFrame:
    """The six organ scores of each hour."""
    return (
        rolling_urine(panel)
        .withColumns(
            {
                "respiration": respiration(),
                "coagulation": coagulation(),
                "liver": liver(),
                "cardiovascular": cardiovascular(),
                "cns": cns(),
                "renal": renal(F.col("urine_24hours")),
            }
        )
        .drop("urine_24hours")
    )


def rolling_worst(
    df: DataFrame,
    columns: Sequence[str] = rules.ORGANS,
    hours: int = rules.ROLLING_HOURS,
    levels: Sequence[int] | None = None,
) -> DataFrame:
    """Worst value of the last hours per column, zero where nothing is known.

    For columns that only take the given levels above zero, an hour sets a bit for the level each
    column reaches, and one aggregate collects the bits of the last hours of all columns. Hours
    may be missing.
    """
    if levels is None:
        w = last_hours(hours)
        return df.withColumns(
            {f"{c}_{hours}hours": F.coalesce(F.max(c).over(w), F.lit(0)) for c in columns}
        )
    levels = sorted(levels)
    recent = Window.partitionBy(STAY).orderBy("hr").rangeBetween(1 - hours, Window.currentRow)
    in_a_word = _BITS // len(levels)
    words = [columns[i : i + in_a_word] for i in range(0, len(columns), in_a_word)]

    def bit(at: int, k: int) -> int:
        return 1 << (at * len(levels) + k)

    def reached(column: str, at: int) -> Column:
        by_level = [(F.col(column) >= level, F.lit(bit(at, k)).cast("long")) for k, level in enumerate(levels)]
        return F.coalesce(case(reversed(by_level)), F.lit(0).cast("long"))

    def worst(word: str, at: int) -> Column:
        known = [F.when(F.col(word).bitwiseAND(F.lit(bit(at, k))) != 0, level) for k, level in enumerate(levels)]
        return F.coalesce(*reversed(known), F.lit(0))

    set_now = {
        f"reached_{n}": reduce(Column.bitwiseOR, [reached(c, at) for at, c in enumerate(word)]) for n, word in enumerate(words)
    }
    # worked out once for an hour, not for each hour that looks back on it
    marked = df.withColumns(set_now).withColumns({name: F.bit_or(name).over(recent) for name in set_now})
    found = {f"{c}_{hours}hours": worst(f"reached_{n}", at) for n, word in enumerate(words) for at, c in enumerate(word)}
    return marked.withColumns(found).drop(*set_now)


def by_change(
    values: DataFrame,
    stays: DataFrame,
    worst: Sequence[str] = (),
    total: Sequence[str] = (),
    hours: int = rules.ROLLING_HOURS,
    lead_hours: int = rules.GRID_LEAD_HOURS,
    partitions: int | None = None,
) -> DataFrame:
    """The rolling worst and sums of the last hours without a panel: a row per grid hour, made last.

    ``values`` has a row at most for each stay and hour with data. What the last hours hold changes only where a
    value comes in and where it goes out, ``hours`` later; between two changes it stays. So the sweep goes
    over these marks alone, and a stretch becomes hours where its stay lies, after the only shuffle.
    Rows are shuffled in proportion to values and stays, not to hours. Columns of ``worst`` get
    ``{c}_{hours}hours`` with zero where nothing is known, those of ``total`` their sum, NULL without any.
    """
    columns = [*worst, *total]
    span = cohort(stays).where(F.col("los_icu_hours") >= -lead_hours).groupBy(STAY).agg(F.max("los_icu_hours").alias("last"))
    on_grid = values.where(F.col("hr") >= -lead_hours).select(STAY, "hr", *columns)
    # the value stands for its hour, and in the rolling ones until it goes out
    after = on_grid.select(STAY, F.explode(F.array(F.col("hr") + 1, F.col("hr") + hours)).alias("hr"))
    begin = span.select(STAY, F.lit(-lead_hours).alias("hr"), "last")
    marks = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [begin, on_grid, after])
    marks = by_stay(marks, partitions or grid_partitions(stays, lead_hours))
    marks = marks.groupBy(STAY, "hr").agg(F.max("last").alias("last"), *[F.max(c).alias(c) for c in columns])
    in_order = Window.partitionBy(STAY).orderBy("hr")
    recent = in_order.rangeBetween(1 - hours, Window.currentRow)
    last = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = marks.select(
        STAY,
        "hr",
        *columns,
        *[F.coalesce(F.max(c).over(recent), F.lit(0)).alias(f"{c}_{hours}hours") for c in worst],
        *[F.sum(c).over(recent).alias(f"{c}_{hours}hours") for c in total],
        last.alias("last"),
        F.lead("hr").over(in_order).alias("next"),
    ).where(F.col("hr") <= F.col("last"))
    stretch = F.sequence("hr", F.least(F.coalesce(F.col("next") - 1, F.col("last")), F.col("last")))
    names = [c for c in swept.columns if c not in ("hr", "last", "next", STAY)]
    return swept.select(STAY, F.explode(stretch).alias("hr"), *names)


def total_score(scored: DataFrame) -> DataFrame:
    """Rolling worst per organ and their sum; hours before admission only feed the windows."""
    worst = rolling_worst(scored, levels=rules.ORGAN_LEVELS)
    first, *rest = [F.col(f"{organ}_{rules.ROLLING_HOURS}hours") for organ in rules.ORGANS]
    return worst.withColumn("SOFA_24hours", sum(rest, first)).where(F.col("hr") >= 0)
