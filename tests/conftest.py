from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from demandgrid.session import build_session  # noqa: E402

ORDER_COLUMNS = "order_id bigint, order_dow int, order_hour_of_day int, days_since_prior_order double"
GOLDEN_ORDERS = [
    (1, 0, 9, None, 2, 0, 3),
    (2, 0, 9, 5.0, 1, None, 0),
    (3, 6, 23, 7.0, 0, 4, -2),
    (4, 3, 0, 1.0, 0, 0, 0),
]
GOLDEN_CUBE = {(0, 9, "eggs", 3), (0, 9, "milk", 3), (6, 23, "fresh fruits", 4)}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "demandgrid-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "2",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def golden_orders(spark):
    return spark.createDataFrame(GOLDEN_ORDERS, ORDER_COLUMNS + ", milk int, `fresh fruits` int, eggs int")


@pytest.fixture
def predictions(spark):
    rows = [(0, 9, "coffee", 4.25, "2024-01-01T00:00:00"), (5, 12, "milk", 7.5, "2024-01-02T00:00:00")]
    return spark.createDataFrame(
        rows, "day_of_week int, hour_of_day int, category string, prediction double, cached_at string"
    )


def tuples(df) -> set:
    return {tuple(r) for r in df.collect()}
