"""Generated orders against a plain-Python cube."""

from __future__ import annotations

from collections import Counter

from conftest import ORDER_COLUMNS, tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandgrid.functions.fields import CELL_KEYS
from demandgrid.operators.cube import cube_from_orders, cube_from_rows
from demandgrid.operators.reshape import wide_to_long
from demandgrid.streaming import CubeStore

CATEGORIES = ["milk", "fresh fruits", "x.y"]
count = st.none() | st.integers(-3, 5)
order = st.tuples(st.integers(0, 6), st.integers(0, 23), *[count] * len(CATEGORIES))
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def as_orders(spark, rows):
    columns = ORDER_COLUMNS + "".join(f", `{c}` int" for c in CATEGORIES)
    return spark.createDataFrame([(i, d, h, None, *counts) for i, (d, h, *counts) in enumerate(rows)], columns)


def expected_cube(rows) -> set:
    cells = Counter()
    for day, hour, *counts in rows:
        for category, n in zip(CATEGORIES, counts, strict=True):
            if n is not None and n > 0:
                cells[day, hour, category] += n
    return {(*key, n) for key, n in cells.items()}


@few
@given(rows=st.lists(order, max_size=25))
def test_cube_equals_counting(spark, rows):
    orders = as_orders(spark, rows)
    assert tuples(cube_from_orders(orders)) == expected_cube(rows)
    assert tuples(cube_from_rows(wide_to_long(orders)).select(*CELL_KEYS, "items_count")) == expected_cube(rows)


@settings(few, max_examples=3)
@given(rows=st.lists(order, min_size=1, max_size=20), data=st.data())
def test_incremental_equals_full_for_any_batching(spark, tmp_path_factory, rows, data):
    days = sorted({r[0] for r in rows})
    batch_of = {d: data.draw(st.integers(0, 2), label=f"batch of day {d}") for d in days}
    store = CubeStore(spark, str(tmp_path_factory.mktemp("store")))
    orders = as_orders(spark, rows).withColumn("day", F.col("order_dow"))
    for number, batch in enumerate(sorted(set(batch_of.values()))):
        arriving = [d for d in days if batch_of[d] == batch]
        store.commit(orders.where(F.col("day").isin(arriving)), number)
        if data.draw(st.booleans(), label="compact"):
            store.compact()
    assert tuples(store.cube()) == expected_cube(rows)
    assert sum(r.order_rows for r in store.day_report().collect()) == len(rows)
