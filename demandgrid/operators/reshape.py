"""From wide orders (one column per category) to long rows and cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.functions.fields import quoted

# The columns of a wide order that are not categories.
METADATA_COLUMNS = ["order_id", "order_dow", "order_hour_of_day", "days_since_prior_order"]

GRID_COLUMNS = ["day_of_week", "hour_of_day"]

# Name under which the number of source orders travels next to the categories.
ORDER_COUNT = "__orders"


def category_columns(orders: DataFrame) -> list[str]:
    """Every non-metadata column, in schema order; each must be numeric."""
    fields = [f for f in orders.schema.fields if f.name not in METADATA_COLUMNS]
    wrong = [f"{f.name} ({f.dataType.simpleString()})" for f in fields if not isinstance(f.dataType, T.NumericType)]
    if wrong:
        raise TypeError(f"category columns must be numeric: {', '.join(wrong)}")
    return [f.name for f in fields]


def _grid_columns():
    return [F.col("order_dow").alias("day_of_week"), F.col("order_hour_of_day").alias("hour_of_day")]


def wide_to_long(orders: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """One row per order and category with a strictly positive count, in one scan."""
    names = category_columns(orders) if categories is None else list(categories)
    # Unpivot wants at least one value column.
    values = [quoted(c) for c in names] or [F.lit(None).cast("bigint").alias(ORDER_COUNT)]
    return (
        orders.select(*_grid_columns(), *values)
        .unpivot(GRID_COLUMNS, [quoted(c) for c in names or [ORDER_COUNT]], "category", "items_count")
        .where(F.col("items_count") > 0)
    )


def _whole_count(orders: DataFrame, name: str):
    """A count as it is; one that is no whole number stops the job, also where a sum would hide it."""
    if isinstance(orders.schema[name].dataType, T.IntegralType):
        return quoted(name)
    problem = F.raise_error(F.concat(F.lit("not a whole number of items: "), quoted(name)))
    return F.when(quoted(name) % 1 != 0, problem).otherwise(quoted(name))


def _whole(cells: DataFrame, counts: str) -> DataFrame:
    """Counts as bigint; a count that is no whole number stops the job."""
    if isinstance(cells.schema[counts].dataType, T.LongType):
        return cells
    problem = F.raise_error(F.concat(F.lit("not a whole number of items: "), F.col(counts)))
    return cells.withColumn(counts, F.when(F.col(counts) % 1 != 0, problem).otherwise(F.col(counts).cast("bigint")))


def wide_to_cells(
    orders: DataFrame,
    categories: Sequence[str] | None = None,
    by: Sequence[str] = (),
    count_orders: bool = False,
) -> DataFrame:
    """Sum the positive counts of each (``by``, day, hour, category).

    The sums are taken while the rows are still wide and only the aggregated
    rows are unpivoted: an order stays one row instead of becoming one row per
    category, and the shuffle carries one wide row per task and (day, hour).
    A cell no order contributes to is absent. With ``count_orders`` each
    (``by``, day, hour) also gets a row with a null category holding the number
    of orders seen, positive counts or not.
    """
    names = category_columns(orders.drop(*by)) if categories is None else list(categories)
    positive = [F.sum(F.when(quoted(c) > 0, _whole_count(orders, c))).alias(c) for c in names]
    orders_seen = (F.count(F.lit(1)) if count_orders else F.lit(None).cast("bigint")).alias(ORDER_COUNT)
    keys = [*by, *GRID_COLUMNS]
    summed = orders.groupBy(*by, *_grid_columns()).agg(*positive, orders_seen)
    cells = summed.unpivot(keys, [quoted(c) for c in [*names, ORDER_COUNT]], "category", "items_count")
    return _whole(cells.where(F.col("items_count").isNotNull()), "items_count").withColumn(
        "category", F.when(F.col("category") != ORDER_COUNT, F.col("category"))
    )


def wide_to_cells_sparse(orders: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """``wide_to_cells`` for very many, mostly empty categories: (day, hour, category, items_count).

    An order becomes an array of (position, count) of its positive counts; these are
    exploded and summed by (day, hour, position), and the names come back at the end. The
    plan has two aggregated columns whatever the number of categories, where
    ``wide_to_cells`` has one for each.
    """
    names = category_columns(orders) if categories is None else list(categories)
    if not names:
        return wide_to_cells(orders, names)
    counts = F.array(*[_whole_count(orders, c).cast("bigint") for c in names])
    entries = F.transform(counts, lambda n, i: F.struct(i.alias("position"), n.alias("items_count")))
    long = orders.select(*_grid_columns(), F.inline(F.filter(entries, lambda e: e["items_count"] > 0)))
    cells = long.groupBy(*GRID_COLUMNS, "position").agg(F.sum("items_count").alias("items_count"))
    category = F.get(F.array(*[F.lit(c) for c in names]), F.col("position"))
    return cells.select(*GRID_COLUMNS, category.alias("category"), "items_count")


def category_coverage(orders: DataFrame) -> DataFrame:
    """Position and name of each category column and the orders that contain it."""
    names = category_columns(orders)
    counts = orders.agg(*[F.count_if(quoted(c) > 0).alias(c) for c in names])
    positions = F.create_map(*[F.lit(v) for i, c in enumerate(names) for v in (c, i)])
    return counts.unpivot([], [quoted(c) for c in names], "category", "orders_with_items").select(
        positions[F.col("category")].alias("position"), "category", "orders_with_items"
    )
