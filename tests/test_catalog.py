"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from check import compare, sql_connection
from tallytide import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def con():
    return sql_connection(FOLDER)


def test_every_sql_belongs_to_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 3


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    result = compare(spark, FOLDER, name, con)
    assert result.startswith(("match", "rows only")) and result != "rows only (0)", result
