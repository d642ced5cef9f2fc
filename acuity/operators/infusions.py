"""Vasoactive infusions: mixed labels and units to one dose rate in mcg/kg/min.

All drugs go through one plan, keyed by ``drug``. Facts that need the time order of
a stay (carried labels, orders in force) are worked out on one row per minute, which
the aggregation builds before the shuffle; the infusion rows themselves are shuffled
once, on (drug, stay, minute), to pick those facts up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acuity import rules
from acuity.functions import (
    DOSE,
    after_exclusions,
    billionths,
    case,
    exact_number,
    exact_quotient,
    like_any,
    minute_key,
    one_of,
    strict_or_lenient_number,
)
from acuity.operators.weights import dosing_weights
from acuity.rules import Concentration, DrugRule, Unit

MINUTE = ["drug", "patientunitstayid", "minute"]
PASSED_THROUGH = ("infusionrate", "drugamount", "volumeoffluid", "patientweight")
KEPT = ("infusiondrugid", "patientunitstayid", "infusionoffset", "drugname", "drugrate") + PASSED_THROUGH


def _by_drug(drugs: Sequence[DrugRule], expression) -> Column:
    """The expression of the row's own drug."""
    return F.coalesce(*[F.when(F.col("drug") == d.name, expression(d)) for d in drugs])


def _holds_for(drugs: Sequence[DrugRule], condition) -> Column:
    return reduce(or_, [(F.col("drug") == d.name) & condition(d) for d in drugs], F.lit(False))


def _selects(drug: DrugRule) -> Column:
    return like_any("drugname", drug.select_like) & after_exclusions(
        "drugrate", drug.drop_rates, drug.drop_rates_like
    )


def _per_drug(df: DataFrame, matches: Mapping[str, Column]) -> DataFrame:
    """The rows that match a drug, once for each drug they match, with ``drug``.

    A match is worked out where the names are made and nowhere else.
    """
    if len(matches) == 1:
        ((name, matched),) = matches.items()
        return df.where(matched).withColumn("drug", F.lit(name))
    names = F.array(*[F.when(matched, F.lit(name)) for name, matched in matches.items()])
    return df.withColumn("drug", F.explode(names)).where(F.col("drug").isNotNull())


def _selected(infusions: DataFrame, drugs: Sequence[DrugRule], strict: bool) -> DataFrame:
    """The rows of the drugs with the rate as a number.

    Drug and rate come out of one generator: filters on them stay above it, so that a row is matched
    once and only the text of a row that matches is read as a number.
    """

    def found(drug: DrugRule) -> Column:
        rate = strict_or_lenient_number(F.col("drugrate"), strict)
        return F.when(_selects(drug), F.struct(F.lit(drug.name).alias("drug"), rate.alias("rate")))

    matched = infusions.select(*KEPT, F.inline(F.array(*[found(d) for d in drugs])))
    return matched.where(F.col("drug").isNotNull()).select("drug", *KEPT, "rate")


def parse_infusions(
    infusions: DataFrame, drugs: Sequence[DrugRule] = rules.DRUGS, strict: bool = False
) -> DataFrame:
    """Rows of the wanted drugs with a numeric rate, one per row and drug it names."""
    return _selected(infusions, drugs, strict).where(F.col("rate").isNotNull())


def infusion_rejects(infusions: DataFrame, drugs: Sequence[DrugRule] = rules.DRUGS) -> DataFrame:
    """Rows of the wanted drugs whose rate text is no number."""
    return _selected(infusions, drugs, strict=False).where(F.col("rate").isNull()).drop("rate")


def _known_label(drug: DrugRule) -> Column:
    """Position of the label among the drug's known labels, NULL if it tells no unit."""
    labels = [(one_of("drugname", [label]), i) for i, label in enumerate(drug.known_labels)]
    others = [
        (like_any("drugname", [pattern]), drug.known_labels.index(label))
        for pattern, label in drug.known_like
    ]
    return case(labels + others)


def _order_kind(drug: DrugRule) -> Column:
    """Position of the order's concentration among those of the drug."""
    outcomes = drug.concentrations()
    pairs = []
    for rule in drug.possible_orders():
        named_so = one_of("drugname", rule.names)
        if rule.like:
            named_so = named_so | like_any("drugname", [rule.like])
        if rule.dosage:
            named_so = named_so & one_of("dosage", [rule.dosage])
        pairs.append((named_so, outcomes.index(rule.concentration)))
    return case([*pairs, (F.lit(True), outcomes.index(drug.volume_default))])


def _orders_in_time(orders: DataFrame, drugs: Sequence[DrugRule]) -> DataFrame:
    """Uncancelled orders as (drug, stay, minute of start, kind, end)."""
    drugs = [d for d in drugs if d.order_like]
    usable = orders.where(
        (F.col("drugordercancelled") == "No") & F.col("drugstartoffset").isNotNull()
    )
    named = {d.name: like_any("drugname", [d.order_like]) for d in drugs}
    return _per_drug(usable, named).select(
        "drug",
        "patientunitstayid",
        minute_key(F.col("drugstartoffset")).alias("minute"),
        _by_drug(drugs, _order_kind).alias("kind"),
        F.col("drugstopoffset").alias("stop"),
    )


def _minute_facts(
    parsed: DataFrame,
    drugs: Sequence[DrugRule],
    orders: DataFrame | None = None,
    weights: DataFrame | None = None,
) -> DataFrame:
    """What an infusion row has to know about its stay, one row per (drug, stay, minute).

    ``unit_gaps``  the stay has a blank label
    ``carried``    last known label up to this minute, else the first known one
    ``in_force``   per kind of order, whether one covers this minute
    ``weight``     dosing weight

    Several known labels in one minute: the highest row id counts for all its rows.
    The series of a stay has a row per minute at most, however many rows it has, so
    the windows below are bounded by its length in time.
    """
    known = _by_drug(drugs, _known_label)
    series = parsed.select(
        *MINUTE,
        "infusiondrugid",
        F.when(_holds_for(drugs, lambda d: like_any("drugname", d.fill_like)), known).alias(
            "known"
        ),
        _holds_for(drugs, lambda d: F.col("drugname") == d.blank_label).alias("blank"),
    )
    kinds = 0
    if orders is not None and any(d.order_like for d in drugs):
        kinds = max(len(d.concentrations()) for d in drugs if d.order_like)
        series = series.unionByName(_orders_in_time(orders, drugs), allowMissingColumns=True)

    facts = series.groupBy(*MINUTE).agg(
        F.max_by("known", F.when(F.col("known").isNotNull(), F.col("infusiondrugid"))).alias("known"),
        F.max("blank").alias("blank"),
        *[F.max(F.when(F.col("kind") == k, F.col("stop"))).alias(f"stop_{k}") for k in range(kinds)],
    )
    if weights is not None:
        facts = facts.join(dosing_weights(weights), "patientunitstayid", "left")

    stay = Window.partitionBy("patientunitstayid", "drug").orderBy("minute")
    so_far = stay.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = stay.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_known = F.min_by("known", F.when(F.col("known").isNotNull(), F.col("minute")))
    columns = [
        *MINUTE,
        F.coalesce(F.max("blank").over(whole), F.lit(False)).alias("unit_gaps"),
        F.coalesce(F.last("known", ignorenulls=True).over(so_far), first_known.over(whole)).alias(
            "carried"
        ),
    ]
    if kinds:
        # an order covers the minute if one that began by now ends no earlier
        latest_stops = [F.max(f"stop_{k}").over(so_far) for k in range(kinds)]
        columns.append(
            F.array(
                *[F.coalesce(s >= F.col("minute"), F.lit(False)) for s in latest_stops]
            ).alias("in_force")
        )
    if weights is not None:
        columns.append("weight")
    return facts.select(*columns)


def impute_unit_labels(
    parsed: DataFrame,
    drugs: Sequence[DrugRule] = rules.DRUGS,
    orders: DataFrame | None = None,
    weights: DataFrame | None = None,
    as_charted: Sequence[DrugRule] = (),
) -> DataFrame:
    """Replace ``drugname`` by the label that says the unit of the rate.

    In a stay with a blank label every row takes the label carried to it; in all
    others the row keeps its own. With ``orders`` and ``weights`` given, the rows
    also get the facts that dose conversion needs. Rows of the drugs ``as_charted``
    pass through as they are.
    """
    drugs = [d for d in drugs if d.imputed]
    name = F.col("drugname")
    imputed = one_of("drug", [d.name for d in drugs])
    passing = one_of("drug", [d.name for d in as_charted])
    rows = parsed.where(imputed | passing).withColumn("minute", minute_key(F.col("infusionoffset")))
    facts = _minute_facts(rows.where(imputed), drugs, orders, weights)
    carried = _by_drug(
        drugs,
        lambda d: case([(F.col("carried") == i, label) for i, label in enumerate(d.known_labels)]),
    )
    filled = F.col("unit_gaps") & _holds_for(drugs, lambda d: like_any("drugname", d.fill_like))
    kept = ~F.col("unit_gaps") & _holds_for(drugs, lambda d: like_any("drugname", d.keep_like))
    return (
        rows.join(facts, MINUTE, "left" if as_charted else "inner")
        .where(filled | kept | passing)
        .withColumn("drugname", F.when(F.col("unit_gaps"), carried).otherwise(name))
        .drop("unit_gaps", "carried")
    )


def label_rate(
    rate: Column, weight: Column, drugs: Sequence[DrugRule], divide=F.try_divide, one: int = 1
) -> Column:
    """Dose rate where the label names a dose unit, NULL where it does not.

    ``one`` is what stands for 1 in the rate and the weight, if they are whole numbers for an exact ``divide``.
    """

    def of_label(unit: Unit) -> Column:
        divisor = unit.denominator * weight if unit.by_weight else F.lit(unit.denominator * one)
        return divide(unit.numerator * rate, divisor)

    return _by_drug(
        drugs,
        lambda d: case(
            [(one_of("drugname", labels), of_label(rules.UNITS[unit])) for unit, labels in d.units]
        ),
    )


def volume_rate(rate: Column, weight: Column, fluid: Concentration, divide=F.try_divide) -> Column:
    """Dose rate of a pump speed in ml/hr at a known concentration."""
    if fluid.fixed is not None:
        return F.lit(float(fluid.fixed))
    if fluid.mg is None:
        return F.lit(None).cast("double")
    return divide(1000 * rate * fluid.mg, fluid.ml * 60 * weight)


def _volume_rates(rate: Column, weight: Column, drugs: Sequence[DrugRule], exact: bool = False) -> Column:
    """Dose rates of a ml/hr row at every concentration, and whether an order says so."""

    def both(fluid: Concentration) -> list[Column]:
        plain = volume_rate(rate, weight, fluid)
        if not exact:
            return [plain]
        return [plain, volume_rate(_charted_billionths(), billionths(weight), fluid, exact_quotient).cast(DOSE)]

    def of_drug(drug: DrugRule) -> Column:
        options = [
            (F.col("in_force")[k] if drug.order_like else F.lit(True), fluid)
            for k, fluid in enumerate(drug.concentrations())
        ]
        return F.array(
            *[_dose(valid, *both(fluid)) for valid, fluid in options]
        )

    return _by_drug(drugs, of_drug)


def _dose(valid: Column, rate: Column, exact: Column | None = None) -> Column:
    more = [] if exact is None else [exact.alias("exact")]
    return F.struct(rate.alias("dose"), valid.alias("valid"), *more)


def _charted_billionths() -> Column:
    return billionths(exact_number(F.col("drugrate"), strict=False))


def normalise_rates(
    labelled: DataFrame,
    drugs: Sequence[DrugRule] = rules.DRUGS,
    as_charted: Sequence[DrugRule] = (),
    exact: bool = False,
) -> DataFrame:
    """Dose rates in mcg/kg/min of rows from :func:`impute_unit_labels`.

    A label with a dose unit gives one rate. A ml/hr label gives one per distinct
    concentration of the orders in force. Rows with any other label have no dose.
    Equal doses and copies of a row count once, but rows of the drugs ``as_charted``
    have the rate they were charted with and keep their copies. With ``exact`` the rate
    is a decimal worked out from the charted text, rounded half away from zero.
    """
    drugs = [d for d in drugs if d.imputed]
    weight = F.coalesce(F.col("weight"), F.lit(float(rules.DEFAULT_WEIGHT_KG)))
    by_label = _holds_for(
        drugs, lambda d: one_of("drugname", [x for _, labels in d.units for x in labels])
    )
    by_volume = _holds_for(drugs, lambda d: one_of("drugname", d.volume_labels))
    own, known = [F.col("rate")], [label_rate(F.col("rate"), weight, drugs)]
    if exact:
        own.append(F.round(exact_number(F.col("drugrate"), strict=False), 4).cast(DOSE))
        known.append(label_rate(_charted_billionths(), billionths(weight), drugs, exact_quotient, 1_000_000_000))
    charted = one_of("drug", [d.name for d in as_charted])
    doses = (
        F.when(charted, F.array(_dose(F.lit(True), *own)))
        .when(by_label, F.array(_dose(F.lit(True), *known)))
        .when(by_volume, _volume_rates(F.col("rate"), weight, drugs, exact))
    )
    identity = ["drug", "infusiondrugid", "patientunitstayid", "infusionoffset", "minute", "drugname"]
    doses = (
        labelled.where(by_label | by_volume | charted)
        .select(*identity, *PASSED_THROUGH, F.inline(doses))
        .where("valid")
        .drop("valid")
    )
    # rows lie by (drug, stay, minute) already
    counted = doses.groupBy(*doses.columns).agg(F.count("*").alias("copies"))
    if as_charted:
        again = F.sequence(F.lit(1).cast("long"), F.when(charted, F.col("copies")).otherwise(F.lit(1).cast("long")))
        counted = counted.withColumn("copy", F.explode(again))
    rate = F.col("exact") if exact else F.round("dose", 4)
    return counted.select(*[c for c in identity if c != "minute"], rate.alias("rate"), *PASSED_THROUGH)


def vasoactive_rates(
    infusions: DataFrame,
    orders: DataFrame,
    weights: DataFrame,
    drugs: Sequence[DrugRule] = rules.DRUGS,
    strict: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Dose rates of all the drugs in one long table with a ``drug`` column.

    The infusions are read twice: for the rows, and for the minute series of a stay. With
    ``exact`` rates are decimals of four places instead of doubles; one that needs more than
    eleven digits before the point is NULL.
    """
    plain = [d for d in drugs if not d.imputed]
    imputed = [d for d in drugs if d.imputed]
    parsed = parse_infusions(infusions, drugs, strict)
    if imputed:
        return normalise_rates(
            impute_unit_labels(parsed, imputed, orders, weights, plain), imputed, plain, exact
        )
    # rates of these drugs are taken as charted
    return parsed.select(
        "drug",
        "infusiondrugid",
        "patientunitstayid",
        "infusionoffset",
        "drugname",
        (F.round(exact_number(F.col("drugrate"), strict), 4).cast(DOSE) if exact else F.round("rate", 4)).alias("rate"),
        *PASSED_THROUGH,
    )


def drug_table(rates: DataFrame, drug: str) -> DataFrame:
    """One drug's rows of the long table, the rate named after the drug."""
    return (
        rates.where(F.col("drug") == drug)
        .withColumnRenamed("rate", f"rate_{drug}")
        .drop("drug")
    )


def long_table(rates: DataFrame, drug: str) -> DataFrame:
    """A drug's table as rows of the long one."""
    return rates.withColumnRenamed(f"rate_{drug}", "rate").withColumn("drug", F.lit(drug))


def dobutamine(infusions: DataFrame, strict: bool = False) -> DataFrame:
    """Dobutamine needs neither weight nor orders."""
    plain = parse_infusions(infusions, (rules.DOBUTAMINE,), strict)
    return plain.select(
        "infusiondrugid",
        "patientunitstayid",
        "infusionoffset",
        "drugname",
        F.round("rate", 4).alias("rate_dobutamine"),
        *PASSED_THROUGH,
    )
