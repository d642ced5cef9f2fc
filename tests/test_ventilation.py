import random

import pytest

from acuity.operators import ventilation as vent
from tests.conftest import rows_of

ON, OFF = "Intubated/oral ETT", "Spontaneous - tenuous"


@pytest.fixture
def careplan(table):
    def build(rows):
        """Rows (stay, id, offset, text, active), group Airway."""
        return table(
            "careplangeneral",
            [
                {
                    "patientunitstayid": s,
                    "cplgeneralid": i,
                    "cplitemoffset": o,
                    "cplitemvalue": v,
                    "activeupondischarge": a,
                    "cplgroup": "Airway",
                }
                for s, i, o, v, a in rows
            ],
        )

    return build


@pytest.fixture
def stays(table):
    def build(discharge):
        return table(
            "icustay_detail",
            [{"patientunitstayid": s, "unitdischargeoffset": o} for s, o in discharge.items()],
        )

    return build


def intervals(careplan, stays, rows, discharge=None, mode="reference"):
    events = vent.vent_events(careplan(rows), stays(discharge or {1: 900}))
    return rows_of(vent.episodes(events, mode))


def sequence(*flags):
    return [(1, i, 10 * i if o is None else o, ON if f else OFF, None) for i, (o, f) in enumerate(flags)]


@pytest.mark.parametrize(
    "events, reference, islands",
    [
        ([(0, 1), (10, 0)], [(0, 10)], [(0, 10)]),
        ([(0, 1), (10, 1), (20, 0)], [(0, 10)], [(0, 20)]),
        ([(0, 1), (10, 1), (20, 1), (30, 0)], [(0, 10), (20, 30)], [(0, 30)]),
        (
            [(0, 1), (10, 1), (20, 0), (25, 0), (40, 1), (50, 0)],
            [(0, 10), (20, 40)],
            [(0, 20), (40, 50)],
        ),
        ([(0, 1), (10, 0), (20, 1), (30, 0)], [(0, 10), (20, 30)], [(0, 10), (20, 30)]),
    ],
)
def test_episode_modes(careplan, stays, events, reference, islands):
    rows = sequence(*events)
    assert intervals(careplan, stays, rows) == [(1, *i) for i in reference]
    assert intervals(careplan, stays, rows, mode="islands") == [(1, *i) for i in islands]


def test_unknown_mode_is_refused(careplan, stays):
    with pytest.raises(ValueError):
        intervals(careplan, stays, sequence((0, 1)), mode="other")


@pytest.mark.parametrize(
    "active, discharge, want",
    [(False, 900, [(1, 100, 160)]), (True, 900, [(1, 100, 900)]), (None, 900, []), (True, None, [])],
)
def test_open_tail(careplan, stays, active, discharge, want):
    rows = [(1, 1, 100, ON, active)]
    assert intervals(careplan, stays, rows, {1: discharge}) == want


def test_open_tail_without_a_stay_record(careplan, stays):
    assert intervals(careplan, stays, [(2, 1, 100, ON, True)], {1: 900}) == []


def test_discharge_before_the_last_record_moves_in_order(careplan, stays):
    rows = [(1, 1, 0, ON, None), (1, 2, 100, ON, True)]
    assert intervals(careplan, stays, rows, {1: 50}) == [(1, 0, 50)]


def test_leading_off_rows_and_never_ventilated_stays_go(careplan, stays):
    rows = [
        (1, 1, 0, OFF, None), (1, 2, 5, OFF, None), (1, 3, 10, ON, None), (1, 4, 20, OFF, None),
        (2, 5, 0, OFF, None), (2, 6, 9, OFF, True),
    ]
    events = vent.trim_leading_off(vent.resolve_same_instant(vent.classify_vent_events(careplan(rows))))
    assert rows_of(events, "cplgeneralid") == [(3,), (4,)]


def test_classification(table):
    rows = [
        ("Airway", "Intubated/nasal ETT", 1),
        ("Airway", "intubated/nasal ETT", 0),
        ("Ventilation", "Ventilated - chronic dependency", 1),
        ("Ventilation", "Ventilated - with no daily extubation trial", 1),
        ("Ventilation", "Ventilated - rapid wean/extubation", 0),
        ("Ventilation", "Non-invasive ventilation", 1),
        ("Airway", "Not intubated/normal airway", 0),
        ("Airway", "", None),
        ("Airway", None, None),
        ("Activity", "Intubated/nasal ETT", None),
    ]
    df = table(
        "careplangeneral",
        [
            {"cplgeneralid": i, "patientunitstayid": 1, "cplitemoffset": 0, "cplgroup": g, "cplitemvalue": v}
            for i, (g, v, _) in enumerate(rows)
        ],
    )
    found = rows_of(vent.classify_vent_events(df), "cplgeneralid", "vent_flag")
    assert found == [(i, flag) for i, (_, _, flag) in enumerate(rows) if flag is not None]


def test_same_instant(careplan):
    def settled(*rows):
        df = careplan([(1, i, 0, text, None) for i, text in rows])
        return rows_of(vent.resolve_same_instant(vent.classify_vent_events(df)), "cplgeneralid", "vent_flag")

    assert settled((1, ON), (2, "Non-invasive ventilation")) == [(1, 1)]
    assert settled((1, OFF), (2, "Spontaneous - adequate")) == [(1, 0)]
    assert settled((1, OFF), (2, OFF)) == [(2, 0)]
    assert settled((1, ON), (2, OFF)) == [(1, 1)]
    # one off-row goes, the other stays beside the on-row
    assert settled((1, ON), (2, OFF), (3, "Not intubated/normal airway")) == [(1, 1), (2, 0)]


def test_last_pair_is_settled_without_moving_episodes(careplan, stays):
    rows = [(1, 1, 0, ON, True), (1, 2, 10, OFF, True)]
    before = vent.close_open_tail(
        vent.trim_leading_off(vent.resolve_same_instant(vent.classify_vent_events(careplan(rows))))
    )
    after = vent.settle_last_pair(before)
    assert rows_of(after, "cplgeneralid", "activeupondischarge", "cplitemvalue") == [
        (1, True, ON),
        (2, False, "Spontaneous - adequate"),
    ]
    assert rows_of(vent.episodes(before)) == rows_of(vent.episodes(after)) == [(1, 0, 10)]


def walk(rows, discharge):
    """The rules row by row, for one stay."""
    instants = {}
    for ident, off, text, active in rows:
        instants.setdefault(off, {True: [], False: []})[text == ON].append((text, ident, active))
    events = []
    for off, found in instants.items():
        offs = sorted(found[False], key=lambda r: r[:2])
        if found[True]:
            offs = offs[1:]
            text, ident, active = min(found[True], key=lambda r: r[:2])
            events.append((off, 0, ident, True, active))
        if offs:
            text, ident, active = max(offs, key=lambda r: r[:2])
            events.append((off, 1, ident, False, active))
    events.sort(key=lambda e: e[:3])
    while events and not events[0][3]:
        events.pop(0)
    if not events:
        return [], []
    off, _, ident, on, active = events[-1]
    if on and active is False:
        events.append((off + 60, 1, ident, False, False))
    elif on and active and discharge is not None:
        events.append((discharge, 1, ident, False, False))
    events.sort(key=lambda e: e[:3])
    moments = set()
    for here, then in zip(events, events[1:]):
        if here[3]:
            moments |= {here[0], then[0]}
    moments = sorted(moments)
    pairs = [tuple(moments[i : i + 2]) for i in range(0, len(moments) - 1, 2)]
    runs, begun = [], None
    for off, _, _, on, _ in events:
        if on and begun is None:
            begun = off
        elif not on and begun is not None:
            runs.append((begun, off))
            begun = None
    return pairs, runs


def test_random_stays_match_a_plain_walk(careplan, stays):
    rng = random.Random(11)
    rows, discharge, pairs, runs, ident = [], {}, [], [], 0
    for stay in range(1, 80):
        mine = []
        for _ in range(rng.randint(1, 14)):
            ident += 1
            text = rng.choice([ON, ON, OFF, "Spontaneous - adequate", "Not intubated/normal airway"])
            mine.append((ident, 10 * rng.randint(0, 8), text, rng.choice([True, False, None])))
        discharge[stay] = rng.choice([35, 500, None])
        rows += [(stay, *r) for r in mine]
        p, r = walk(mine, discharge[stay])
        pairs += [(stay, *x) for x in p]
        runs += [(stay, *x) for x in r]
    assert intervals(careplan, stays, rows, discharge) == sorted(pairs)
    assert intervals(careplan, stays, rows, discharge, mode="islands") == sorted(runs)
