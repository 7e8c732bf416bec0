"""Every catalogue query against DuckDB, and the driver's entry point."""

from __future__ import annotations

import parity
import pytest

import __spark_entry__ as driver
from demandgrid.plans.catalogue import QUERIES
from demandgrid.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {"train_evaluate", "grid_scores", "lookup_with_fallback"}


@pytest.fixture(scope="module")
def duck():
    return parity.connect(SF_DIR)


def test_only_model_scores_lack_an_oracle():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == ["day_of_week", "hour_of_day", "category", "items_count"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert parity.differences(driver.queries()[name](spark, SF_DIR), duck, driver.oracle_sql()[name]) is None


def test_fallback_answers_every_request_once(spark):
    rows = driver.queries()["lookup_with_fallback"](spark, SF_DIR).collect()
    assert len({r.request_id for r in rows}) == len(rows) == 2500
    assert all(r.prediction is not None for r in rows)
    assert {r.found for r in rows if r.request_id.startswith("event")} == {True}
    assert {r.found for r in rows if r.request_id.startswith("order")} == {False}


def test_grid_scores_cover_the_grid(spark):
    rows = driver.queries()["grid_scores"](spark, SF_DIR).collect()
    assert len(rows) == 7 * 24 * 5
    assert all(r.known_category and r.prediction is not None for r in rows)
