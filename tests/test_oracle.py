"""Every query against its SQL form."""

import pytest

import __spark_entry__ as job
from checks import oracles
from checks.compare import compare, connect
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


NAMES = sorted(oracles.oracle_sql())


def test_every_query_has_a_sql_form():
    corpus = set(job.corpus.queries()) if job.corpus else set()
    assert set(job.queries()) - corpus == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql_form(spark, duck, name):
    same, note = compare(spark, duck, SF_DIR, name)
    assert same, note


def test_entry_has_rows(spark):
    assert job.entry(spark).limit(1).count() == 1
