"""Every query of the library against its SQL, run by another engine on the same tables.

The queries on training text have tests of their own.
"""

from __future__ import annotations

import os
import sys

import pytest

from conftest import SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from oracle.sql import oracle  # noqa: E402
from tidemill.catalog import QUERIES  # noqa: E402

SQL = oracle()


@pytest.fixture(scope="module")
def con():
    return check.database(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    state, n, _, note = check.compare(spark, con, name, SMALL, QUERIES, SQL)
    assert state == "same" and n > 0, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["stt", "edt", "ar", "ch", "is_new", "vc", "uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]
    assert df.count() > 0
