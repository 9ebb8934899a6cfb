"""Every registered query against its SQL counterpart, at the smallest scale."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from testbed.catalog import QUERIES
from tests.compare import differences
from tests.conftest import SF_DIR

NAMES = list(QUERIES)  # those of the optional package have tests of their own


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees(spark, name):
    assert differences(spark, SF_DIR, queries()[name], oracle_sql()[name]) == []


def test_every_query_has_a_counterpart():
    assert set(NAMES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() == 30
    assert frame.columns[0] == "event_date"
