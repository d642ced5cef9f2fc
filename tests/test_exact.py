"""Doses as decimals: a half goes away from zero whatever its double would do."""

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from acuity import rules
from acuity.functions import exact_quotient
from acuity.operators import infusions as inf
from acuity.operators.weights import clean_weights
from tests.conftest import rows_of


def rounded(x: Fraction) -> Decimal:
    whole = (2 * abs(x.numerator) * 10_000 + x.denominator) // (2 * x.denominator)
    return Decimal(whole * (-1 if x < 0 else 1)).scaleb(-4)


def doses(table, rows, drugs, weight=80.0, exact=True):
    infusions = table("infusiondrug", [{"patientunitstayid": 1, "infusiondrugid": i, "infusionoffset": i, "drugname": n, "drugrate": r} for i, (n, r) in enumerate(rows)])
    stays = table("icustay_detail", [{"patientunitstayid": 1, "admissionweight": weight, "dischargeweight": weight}])
    df = inf.vasoactive_rates(infusions, table("medication", []), clean_weights(stays), drugs, exact=exact)
    return {i: rate for i, rate in rows_of(df, "infusiondrugid", "rate")}


def test_quotients_equal_fractions(spark):
    rng = random.Random(4)
    pairs = [(rng.randint(-(10**23), 10**23), rng.choice([-1, 1]) * rng.randint(10**10, 10**16)) for _ in range(500)]
    pairs += [(1, 20_000), (-1, 20_000), (3, 20_000), (0, 7), (5, 0), (10**23, 1), (10**24, 10**11)]
    df = spark.createDataFrame([(i, Decimal(a), Decimal(b)) for i, (a, b) in enumerate(pairs)], "i long, a decimal(27,0), b decimal(20,0)")
    got = {r.i: r.q for r in df.select("i", exact_quotient(F.col("a"), F.col("b")).alias("q")).collect()}
    assert got == {i: rounded(Fraction(a, b)) if b and abs(a) < 10**13 * abs(b) else None for i, (a, b) in enumerate(pairs)}


def test_doubles_and_decimals_differ(table):
    """Rates whose dose lies on a half: the double quotient falls below it now and then."""
    weight, texts = 68.3, []
    for k in range(3000):
        dose = Fraction(2 * k + 1, 20_000)
        rate = dose * Fraction(683, 10)  # mcg/min at this weight
        texts.append(str(Decimal(rate.numerator) / Decimal(rate.denominator)))
    rows = [("Norepinephrine (mcg/min)", t) for t in texts]
    exact, double = (doses(table, rows, (rules.NOREPINEPHRINE,), weight, how) for how in (True, False))
    want = {i: rounded(Fraction(Decimal(t)) / Fraction(683, 10)) for i, t in enumerate(texts)}
    assert exact == want
    wrong = [i for i in want if Decimal(repr(double[i])) != want[i]]
    assert wrong


def test_every_unit_and_a_pump_speed(table):
    texts = ("0.3", "-7.77775", "12345678901.123456789", "0", "123456789012")
    met = set()
    for drug in (rules.DOPAMINE, rules.NOREPINEPHRINE, rules.EPINEPHRINE):
        rows = [(unit, label, text) for unit, labels in drug.units for label in labels for text in texts]
        for i, rate in doses(table, [r[1:] for r in rows], (drug,), 57.35).items():
            unit, _, text = rows[i]
            u = rules.UNITS[unit]
            exact = Fraction(Decimal(text)) * u.numerator / u.denominator / (Fraction(5735, 100) if u.by_weight else 1)
            fits = abs(Decimal(text)) < 10**11 and abs(exact) < 10**13
            assert rate == (rounded(exact) if fits else None), (unit, text)
            met.add(unit)
    assert len(met) >= 6
    got = doses(table, [("Dopamine ()", "11"), ("Dopamine (ml/hr)", "5.5")], (rules.DOPAMINE,), 57.35)
    speed = Fraction(11, 2) * 1000 * 4 / (250 * 60) / Fraction(5735, 100)
    assert got == {0: rounded(2 * speed), 1: rounded(speed)}


def test_rates_as_charted(table):
    rows = [("Dobutamine ()", "2.00005"), ("Dobutamine ()", "2.00004999"), ("Dobutamine ()", "-2.00005"), ("Dobutamine ()", " 7 ")]
    got = doses(table, rows, (rules.DOBUTAMINE,))
    assert got == {i: Decimal(t.strip()).quantize(Decimal("0.0001"), ROUND_HALF_UP) for i, (_, t) in enumerate(rows)}
    together = doses(table, [*rows, ("Norepinephrine (mcg/kg/min)", "3.14159")], (rules.DOBUTAMINE, rules.NOREPINEPHRINE))
    assert together == got | {4: Decimal("3.1416")}
