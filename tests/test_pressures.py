from acuity.operators.pressures import coalesce_pressures, map_min
from tests.conftest import rows_of


def combined(table, vital=(), aperiodic=(), periodic=()):
    def named(columns, rows):
        return [dict(zip(("patientunitstayid", *columns), row)) for row in rows]

    return coalesce_pressures(
        table(
            "pivoted_vital",
            named(
                ("chartoffset", "nibp_systolic", "nibp_diastolic", "nibp_mean",
                 "ibp_systolic", "ibp_diastolic", "ibp_mean"),
                vital,
            ),
        ),
        table(
            "vitalaperiodic",
            named(
                ("observationoffset", "noninvasivesystolic", "noninvasivediastolic", "noninvasivemean"),
                aperiodic,
            ),
        ),
        table(
            "vitalperiodic",
            named(
                ("observationoffset", "systemicsystolic", "systemicdiastolic", "systemicmean"), periodic
            ),
        ),
    )


def test_each_measure_takes_its_own_best_source(table):
    df = combined(
        table,
        periodic=[(1, 10, 500.0, 60.0, None)],
        aperiodic=[(1, 10, 120.0, 70.0, 85.0)],
    )
    assert rows_of(df) == [(1, 10, 120.0, 60.0, 207.0)]


def test_rank_order_of_sources(table):
    vital = [(1, 10, 104.0, 54.0, 74.0, 102.0, 52.0, 72.0)]
    aperiodic = [(1, 10, 103.0, 53.0, 73.0)]
    periodic = [(1, 10, 101.0, 51.0, 71.0)]
    assert rows_of(combined(table, vital, aperiodic, periodic)) == [(1, 10, 101.0, 51.0, 71.0)]
    assert rows_of(combined(table, vital, aperiodic)) == [(1, 10, 102.0, 52.0, 72.0)]
    cuff_only = [(1, 10, 104.0, 54.0, 74.0)]
    assert rows_of(combined(table, cuff_only, aperiodic)) == [(1, 10, 103.0, 53.0, 73.0)]
    assert rows_of(combined(table, cuff_only)) == [(1, 10, 104.0, 54.0, 74.0)]


def test_diastolic_alone_is_no_monitored_cuff_reading(table):
    assert rows_of(combined(table, aperiodic=[(1, 20, None, 70.0, None)])) == []
    assert rows_of(combined(table, periodic=[(1, 20, None, 70.0, None)])) == [(1, 20, None, 70.0, None)]


def test_minute_without_usable_value_stays(table):
    assert rows_of(combined(table, periodic=[(1, 30, 450.0, None, None)])) == [(1, 30, None, None, None)]


def test_empty_and_cancelling_readings_are_dropped(table):
    df = combined(table, periodic=[(1, 1, None, None, None), (1, 2, 0.0, 0.0, 0.0), (1, 3, 50.0, -50.0, None)])
    assert rows_of(df) == []


def test_equal_rank_gives_the_smallest(table):
    df = combined(table, periodic=[(1, 5, 120.0, 80.0, 90.0), (1, 5, 110.0, 85.0, 95.0)])
    assert rows_of(df) == [(1, 5, 110.0, 80.0, 90.0)]


def test_map_min_drops_implausible(table):
    df = combined(table, periodic=[(1, 5, 120.0, 80.0, 90.0), (1, 6, 450.0, None, None)])
    assert rows_of(map_min(df)) == [(1, 5, 90.0)]
