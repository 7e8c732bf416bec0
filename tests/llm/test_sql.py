"""The queries that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

import parity
import pytest

from demandgrid.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert parity.differences(QUERIES[name](spark, SF_DIR), parity.connect(SF_DIR), ORACLE[name]) is None
