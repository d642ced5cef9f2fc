"""What the pipeline leaves out is an output of it."""

import os

from acuity import contracts
from acuity.operators.ventilation import classify_vent_events, resolve_same_instant, trim_leading_off
from acuity.plans.scoring import run
from acuity.sources.tables import build
from checks.event_tables import clinical_inputs
from tests.conftest import SF_DIR, rows_of


def test_rejects_and_violations_are_outputs(spark, tmp_path):
    inputs = clinical_inputs(spark, SF_DIR)
    lazy, written = run(inputs), build(inputs, path=str(tmp_path))
    for name in ("infusion_rejects", "contract_violations"):
        assert rows_of(lazy[name]) == rows_of(written[name])
    assert written["infusion_rejects"].count() > 0
    assert {r.table for r in written["contract_violations"].collect()} == set(contracts.INPUTS)
    assert "vasoactive" not in os.listdir(tmp_path)


def test_rejected_and_parsed_rows_are_all_rows(spark):
    from acuity.operators import infusions as inf

    rows = clinical_inputs(spark, SF_DIR)["infusiondrug"]
    chosen = inf._selected(rows, inf.rules.DRUGS, False).count()
    assert inf.parse_infusions(rows).count() + inf.infusion_rejects(rows).count() == chosen


def record(i, stay, off, value, active=None):
    return {"cplgeneralid": i, "patientunitstayid": stay, "cplitemoffset": off, "cplgroup": "Airway", "cplitemvalue": value, "activeupondischarge": active}


def test_care_plan_records_without_a_time(table):
    on, off = "Intubated/oral ETT", "Spontaneous - tenuous"
    plan = table(
        "careplangeneral",
        [
            # starts on without a time: nothing is trimmed
            record(1, 1, None, on), record(2, 1, None, off), record(3, 1, -5, off), record(4, 1, 10, on),
            # starts off without a time: trimmed to the first on-row
            record(5, 2, None, off), record(6, 2, 3, off), record(7, 2, 8, on), record(8, 2, 9, off),
            # off only
            record(9, 3, None, off),
        ],
    )
    events = classify_vent_events(plan)
    assert events.count() == 9
    settled = resolve_same_instant(events)
    # an on-row without a time takes no off-row away
    assert [r[0] for r in rows_of(settled, "cplgeneralid")] == list(range(1, 10))
    assert [r[0] for r in rows_of(trim_leading_off(settled), "cplgeneralid")] == [1, 2, 3, 4, 7, 8]
