import random

import pytest

from acuity import rules
from acuity.operators import infusions as inf
from acuity.operators.weights import clean_weights
from tests.conftest import rows_of

DOPAMINE, EPINEPHRINE, NOREPINEPHRINE = (rules.DOPAMINE,), (rules.EPINEPHRINE,), (rules.NOREPINEPHRINE,)


@pytest.fixture
def rates(table):
    """Dose rates as (id, label, rate) of infusions (stay, id, offset, label, rate)."""

    def run(rows, drugs, orders=(), weights=((1, 80.0), (2, 80.0)), **options):
        infusions = table(
            "infusiondrug",
            [
                dict(
                    zip(("patientunitstayid", "infusiondrugid", "infusionoffset", "drugname", "drugrate"), r)
                )
                for r in rows
            ],
        )
        medication = table(
            "medication",
            [
                dict(
                    zip(
                        ("patientunitstayid", "drugname", "dosage", "drugordercancelled",
                         "drugstartoffset", "drugstopoffset"),
                        r,
                    )
                )
                for r in orders
            ],
        )
        stays = table(
            "icustay_detail",
            [{"patientunitstayid": s, "admissionweight": w, "dischargeweight": w} for s, w in weights],
        )
        df = inf.vasoactive_rates(infusions, medication, clean_weights(stays), drugs, **options)
        return rows_of(df, "infusiondrugid", "drugname", "rate")

    return run


def test_blank_labels_take_the_label_carried_to_them(rates):
    rows = [
        (1, 1, 0, "Norepinephrine ()", "8"),
        (1, 2, 10, "Norepinephrine (mcg/min)", "8"),
        (1, 3, 20, "Norepinephrine ()", "8"),
        (1, 4, 30, "Norepinephrine (mcg/hr)", "8"),
        (1, 5, 40, "Norepinephrine (mg/hr)", "4.8"),
    ]
    assert rates(rows, NOREPINEPHRINE) == [
        (1, "Norepinephrine (mcg/min)", 0.1),
        (2, "Norepinephrine (mcg/min)", 0.1),
        (3, "Norepinephrine (mcg/min)", 0.1),
        (4, "Norepinephrine (mcg/min)", 0.1),
        (5, "Norepinephrine (mg/hr)", 1.0),
    ]


def test_rows_of_one_minute_share_the_label_of_the_highest_id(rates):
    rows = [
        (1, 1, 0, "Norepinephrine ()", "8"),
        (1, 2, 0, "Norepinephrine (mcg/min)", "8"),
        (1, 3, 0, "Norepinephrine (mcg/kg/min)", "8"),
    ]
    assert [r[1] for r in rates(rows, NOREPINEPHRINE)] == ["Norepinephrine (mcg/kg/min)"] * 3


def test_lower_case_norepinephrine_counts_as_volume(rates):
    rows = [
        (1, 1, 0, "Norepinephrine ()", "15"),
        (1, 2, 5, "norepinephrine Volume (ml) (ml/hr)", "15"),
    ]
    order = (1, "NOREPINEPHRINE 4 MG IN 250 CC REPACKAGE Norepinephrine", None, "No", 0, 10)
    assert rates(rows, NOREPINEPHRINE, [order]) == [
        (1, "Norepinephrine (ml/hr)", 0.05),
        (2, "Norepinephrine (ml/hr)", 0.05),
    ]


def test_dopamine_label_case_decides(rates):
    assert rates([(1, 1, 0, "Dopamine (mcg/kg/min)", "5")], DOPAMINE) == []
    assert rates([(1, 1, 0, "dopamine (mcg/kg/min)", "5")], DOPAMINE) == [(1, "dopamine (mcg/kg/min)", 5.0)]
    premix = "DOPamine STD 400 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)"
    assert rates([(1, 1, 0, premix, "5")], DOPAMINE) == []
    blank = [(1, 1, 0, "Dopamine ()", "3"), (1, 2, 1, "Dopamine (ml/hr)", "3"), (1, 3, 2, "dopamine (mcg/kg/min)", "5")]
    # 1000 * 3 * 4 / (250 * 60 * 80); the lower-case row has no part in a stay with gaps
    assert rates(blank, DOPAMINE) == [(1, "Dopamine (ml/hr)", 0.01), (2, "Dopamine (ml/hr)", 0.01)]


def test_epinephrine_gaps_yield_no_dose(rates):
    rows = [(1, 1, 0, "Epinephrine ()", "5"), (1, 2, 5, "Epinephrine (mcg/min)", "5")]
    assert rates(rows, EPINEPHRINE) == []


def test_epinephrine_bag_left_out_of_the_accepted_labels(rates):
    bag = "EPINEPHrine(Adrenalin)STD 4 mg Sodium Chloride 0.9% 250 ml (mcg/min)"
    accepted = {label for _, labels in rules.EPINEPHRINE.units for label in labels}
    assert bag not in accepted
    assert rates([(1, 1, 0, bag, "8")], EPINEPHRINE) == []


def test_orders_that_overlap_give_one_row(rates):
    row = [(1, 1, 10, "Epinephrine (ml/hr)", "15")]
    orders = [(1, "Epinephrine drip", None, "No", 0, 10), (1, "Epinephrine drip", None, "No", 10, 20)]
    assert rates(row, EPINEPHRINE, orders) == [(1, "Epinephrine (ml/hr)", 0.05)]


@pytest.mark.parametrize(
    "order",
    [
        (1, "Epinephrine drip", None, "Yes", 0, 20),
        (1, "Epinephrine drip", None, None, 0, 20),
        (1, "EPINEPHrine 8 MG in 250 mL NS", None, "No", 0, 20),
        (1, "Epinephrine drip", None, "No", 11, 20),
        (1, "Epinephrine drip", None, "No", 0, 9),
        (1, "Epinephrine drip", None, "No", 0, None),
        (2, "Epinephrine drip", None, "No", 0, 20),
    ],
)
def test_volume_rate_needs_an_order_in_force(rates, order):
    assert rates([(1, 1, 10, "Epinephrine (ml/hr)", "15")], EPINEPHRINE, [order]) == []


def test_norepinephrine_volume_without_known_concentration(rates):
    row = [(1, 1, 10, "Norepinephrine (ml/hr)", "15")]
    known = (1, "NOREPINEPHRINE 4 MG IN 250 CC REPACKAGE Norepinephrine", None, "No", 0, 20)
    unknown = (1, "Norepinephrine drip", None, "No", 0, 20)
    other_case = (1, "NOREPINEPHRINE 4 MG/250 ML NS", None, "No", 0, 20)
    assert rates(row, NOREPINEPHRINE, [unknown]) == [(1, "Norepinephrine (ml/hr)", None)]
    assert rates(row, NOREPINEPHRINE, [other_case]) == []
    assert rates(row, NOREPINEPHRINE, [known, unknown]) == [
        (1, "Norepinephrine (ml/hr)", None),
        (1, "Norepinephrine (ml/hr)", 0.05),
    ]


def test_unit_factors(rates):
    weight = [(1, 50.0)]
    cases = {
        "Norepinephrine (mcg/kg/min)": 6.0,
        "Norepinephrine (mcg/kg/hr)": 0.1,
        "Norepinephrine (mcg/hr)": 0.002,
        "Norepinephrine (mcg/min)": 0.12,
        "Norepinephrine (mg/hr)": 2.0,
        "Norepinephrine (mg/min)": 120.0,
        "Norepinephrine (mg/kg/min)": 6000.0,
        "Norepinephrine STD 32 mg Dextrose 5% 282 ml (mcg/min)": 0.12,
    }
    rows = [(1, i, i, label, "6") for i, label in enumerate(cases)]
    found = rates(rows, NOREPINEPHRINE, weights=weight)
    assert {label: rate for _, label, rate in found} == cases
    lower = [(1, 1, 0, "dopamine (mcg/kg/min)", "2")]
    assert rates(lower, DOPAMINE) == [(1, "dopamine (mcg/kg/min)", 2.0)]


def test_weight_defaults_to_eighty(rates):
    row = [(1, 1, 0, "Epinephrine (mcg/min)", "8")]
    assert rates(row, EPINEPHRINE, weights=[(2, 50.0)]) == [(1, "Epinephrine (mcg/min)", 0.1)]
    assert rates(row, EPINEPHRINE, weights=[(1, None)]) == [(1, "Epinephrine (mcg/min)", 0.1)]


def test_excluded_and_unreadable_rates(table, spark):
    texts = ["OFF", "", None, "abc", "1.5", "2e1", "NaN", " 7 "]
    infusions = table(
        "infusiondrug",
        [
            {"patientunitstayid": 1, "infusiondrugid": i, "drugname": "Dobutamine (mcg/kg/min)", "drugrate": t}
            for i, t in enumerate(texts)
        ],
    )
    assert rows_of(inf.dobutamine(infusions), "infusiondrugid", "rate_dobutamine") == [
        (4, 1.5), (5, 20.0), (7, 7.0),
    ]
    assert rows_of(inf.infusion_rejects(infusions), "infusiondrugid", "drugrate") == [
        (0, "OFF"), (3, "abc"), (6, "NaN"),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        inf.dobutamine(infusions, strict=True).collect()


def test_strict_mode_reads_wanted_rates_only(rates):
    rows = [
        (1, 1, 0, "dopamine (mcg/kg/min)", "OFF"),
        (1, 2, 0, "dopamine (mcg/kg/min)", "Time Correction"),
        (1, 3, 0, "Norepinephrine (mcg/kg/min)", "Documentation undone"),
        (1, 4, 0, "Epinephrine (mcg/kg/min)", "50 in mcg"),
        (1, 5, 0, "Heparin", "note"),
        (1, 6, 0, "Epinephrine (mcg/kg/min)", "2"),
    ]
    imputed = tuple(d for d in rules.DRUGS if d.imputed)
    assert rates(rows, imputed, strict=True) == [(6, "Epinephrine (mcg/kg/min)", 2.0)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rates([*rows, (1, 7, 0, "Epinephrine (mcg/kg/min)", "two")], imputed, strict=True)


def test_a_row_that_names_two_drugs_counts_for_both(rates):
    rows = [(1, 1, 0, "Dobutamine + dopamine", "3")]
    assert rates(rows, (rules.DOBUTAMINE,)) == [(1, "Dobutamine + dopamine", 3.0)]
    both = rates([(1, 1, 0, "Norepinephrine ()", "8"), (1, 2, 0, "Norepinephrine (mcg/min)", "8"),
                  (1, 3, 0, "Epinephrine (mcg/min)", "8")], rules.DRUGS)
    assert both == [
        (1, "Norepinephrine (mcg/min)", 0.1),
        (2, "Norepinephrine (mcg/min)", 0.1),
        (3, "Epinephrine (mcg/min)", 0.1),
    ]


def test_copies_count_once_for_converted_drugs(rates):
    row = (1, 1, 0, "Epinephrine (mcg/min)", "8")
    assert rates([row, row], EPINEPHRINE) == [(1, "Epinephrine (mcg/min)", 0.1)]
    plain = (1, 1, 0, "Dobutamine (mcg/kg/min)", "8")
    assert len(rates([plain, plain], (rules.DOBUTAMINE,))) == 2


def test_infusion_without_a_time_keeps_its_row(rates):
    rows = [(1, 1, None, "Epinephrine (mcg/min)", "8"), (1, 2, None, "Epinephrine (ml/hr)", "8")]
    orders = [(1, "Epinephrine drip", None, "No", -10, 20)]
    assert rates(rows, EPINEPHRINE, orders) == [(1, "Epinephrine (mcg/min)", 0.1)]


def test_carried_labels_match_a_plain_walk(rates):
    rng = random.Random(7)
    labels = ["Norepinephrine ()", "Norepinephrine (mcg/min)", "Norepinephrine (mg/hr)", "Norepinephrine (mcg/hr)",
              "Norepinephrine"]
    rows, ident = [], 0
    for stay in range(1, 30):
        for _ in range(rng.randint(1, 12)):
            ident += 1
            rows.append((stay, ident, rng.randint(0, 8), rng.choice(labels), "8"))
    known = {"Norepinephrine (mcg/min)", "Norepinephrine (mg/hr)", "Norepinephrine"}
    want = []
    for stay in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == stay]
        gaps = any(r[3] == "Norepinephrine ()" for r in mine)
        telling = sorted((r[2], r[1], r[3]) for r in mine if r[3] in known)
        for _, i, off, label, _ in mine:
            if gaps:
                before = [t for t in telling if t[0] <= off]
                after = [t for t in telling if t[0] > off]
                if before:
                    label = before[-1][2]
                elif after:
                    label = max(t for t in after if t[0] == after[0][0])[2]
                else:
                    label = None
            factor = {"Norepinephrine (mcg/min)": 0.1, "Norepinephrine (mg/hr)": 1.6667,
                      "Norepinephrine (mcg/hr)": 0.0017}.get(label)
            if factor is not None:
                want.append((i, label, factor))
    found = rates(rows, NOREPINEPHRINE, weights=[(s, 80.0) for s in range(1, 30)])
    assert found == sorted(want)
