import random

from acuity.operators import blood_gas
from tests.conftest import rows_of


def test_split_by_ventilation(table, spark):
    gases = table(
        "pivoted_bg",
        [
            {"patientunitstayid": s, "chartoffset": o, "pao2": p, "fio2": f}
            for s, o, p, f in [
                (1, 9, 80.0, 0.4), (1, 10, 80.0, 0.4), (1, 20, 80.0, 0.4), (1, 21, 80.0, 0.4),
                (1, 15, None, 0.4), (1, 15, 80.0, None), (1, 15, 80.0, 0.0), (2, 15, 33.0, 0.21),
            ]
        ],
    )
    episodes = spark.createDataFrame([(1, 10, 20)], "patientunitstayid long, starttime int, endtime int")
    assert rows_of(blood_gas.pf_ratio(gases, episodes)) == [
        (1, 9, 200.0, None),
        (1, 10, None, 200.0),
        (1, 15, None, None),
        (1, 20, None, 200.0),
        (1, 21, 200.0, None),
        (2, 15, 157.0, None),
    ]


def test_any_intervals_match_pairing(table, spark):
    rng = random.Random(5)
    gases = [(rng.randint(1, 5), rng.randint(-50, 150), float(rng.randint(1, 20))) for _ in range(400)]
    spans = []
    for _ in range(25):
        start = rng.randint(-40, 140)
        spans.append((rng.randint(1, 4), start, rng.choice([None, start - 3, start, start + rng.randint(1, 30)])))
    bg = table(
        "pivoted_bg",
        [{"patientunitstayid": s, "chartoffset": o, "pao2": p, "fio2": 1.0} for s, o, p in gases],
    )
    episodes = spark.createDataFrame(spans, "patientunitstayid long, starttime int, endtime int")

    def inside(stay, off):
        return any(s == stay and e is not None and a <= off <= e for s, a, e in spans)

    want = sorted(
        ((s, o, *((None, p) if inside(s, o) else (p, None))) for s, o, p in gases),
        key=lambda r: tuple((v is not None, v) for v in r),
    )
    assert rows_of(blood_gas.pf_ratio(bg, episodes)) == want

    lowest = {}
    for s, o, p in gases:
        lowest[s, o] = min(p, lowest.get((s, o), p))
    want = sorted(
        ((s, o, *((None, p) if inside(s, o) else (p, None))) for (s, o), p in lowest.items()),
        key=lambda r: tuple((v is not None, v) for v in r),
    )
    assert rows_of(blood_gas.pf_ratio_min(bg, episodes)) == want
