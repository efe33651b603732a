"""Every named query against its SQL twin on the smallest test tables."""

import pathlib

import pytest

import __spark_entry__ as entry_module
import compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", list(entry_module.queries()))
def test_query(spark, duck, name):
    good, text = compare.compare(spark, duck, FOLDER, name)
    assert good, text


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
