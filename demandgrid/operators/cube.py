"""Building, merging and summarising the (day, hour, category) cube."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.fields import CELL_KEYS, DAYS
from demandgrid.operators.reshape import wide_to_cells, wide_to_cells_sparse


def cube_from_orders(orders: DataFrame) -> DataFrame:
    """The cube of wide orders."""
    return wide_to_cells(orders).select(*CELL_KEYS, "items_count")


def cube_from_sparse_orders(orders: DataFrame) -> DataFrame:
    """The same cube by way of each order's positive counts; the faster one from a few hundred categories on."""
    return wide_to_cells_sparse(orders)


def cube_from_rows(rows: DataFrame) -> DataFrame:
    """The cube of long rows; map-side partial sums keep hot cells small in the shuffle."""
    return rows.where(F.col("items_count") > 0).groupBy(*CELL_KEYS).agg(F.sum("items_count").alias("items_count"))


def merge_cubes(*cubes: DataFrame) -> DataFrame:
    """Add up cubes cell by cell, matching columns by name."""
    together = reduce(lambda left, right: left.unionByName(right), cubes)
    return together.groupBy(*CELL_KEYS).agg(F.sum("items_count").alias("items_count"))


def sorted_cube(cube: DataFrame) -> DataFrame:
    return cube.orderBy(*CELL_KEYS)


def sample_rows(cube: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` cells in key order, so that the sample is reproducible."""
    return cube.orderBy(*CELL_KEYS).limit(n)


def cube_summary(cube: DataFrame) -> DataFrame:
    """Number of cells and distinct categories, days and hours, in one job."""
    return cube.agg(
        F.count(F.lit(1)).alias("combinations"),
        F.count_distinct("category").alias("categories"),
        F.count_distinct("day_of_week").alias("days"),
        F.count_distinct("hour_of_day").alias("hours"),
    )


def loaded_summary(counted: DataFrame) -> DataFrame:
    """``cube_summary`` plus the number of orders, from cells built with ``count_orders``."""
    is_cell = F.col("category").isNotNull()
    return counted.agg(
        F.count("category").alias("combinations"),
        F.count_distinct("category").alias("categories"),
        F.count_distinct(F.when(is_cell, F.col("day_of_week"))).alias("days"),
        F.count_distinct(F.when(is_cell, F.col("hour_of_day"))).alias("hours"),
        F.coalesce(F.sum(F.when(~is_cell, F.col("items_count"))), F.lit(0)).alias("orders_loaded"),
    )


def rows_per_day(rows: DataFrame, day: Column) -> DataFrame:
    """Row count of each day 0..6; a day without rows counts zero."""
    counts = rows.groupBy(day.alias("day_of_week")).agg(F.count(F.lit(1)).alias("rows"))
    days = rows.sparkSession.range(DAYS).select(F.col("id").cast("int").alias("day_of_week"))
    return days.join(counts, "day_of_week", "left").select(
        "day_of_week", F.coalesce("rows", F.lit(0)).alias("row_count")
    )


def distinct_days(rows: DataFrame, day: Column) -> DataFrame:
    return rows.select(day.alias("day")).distinct().orderBy("day")
