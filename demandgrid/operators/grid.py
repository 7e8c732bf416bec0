"""The grid of every (day, hour) for each category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.functions.fields import CELL_KEYS, DAYS, HOURS, normalize_category


def category_rows(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """An explicit category list as rows."""
    return spark.createDataFrame([(name,) for name in names], "category string")


def grid_categories(rows: DataFrame) -> DataFrame:
    """The distinct categories of ``rows`` in their normalised spelling."""
    return rows.select(normalize_category(F.col("category")).alias("category")).where("category is not null").distinct()


def demand_grid(categories: DataFrame) -> DataFrame:
    """The 168 (day, hour) cells of each category, generated from its own row."""
    days = F.sequence(F.lit(0), F.lit(DAYS - 1))
    hours = F.sequence(F.lit(0), F.lit(HOURS - 1))
    return (
        grid_categories(categories)
        .select(F.explode(days).alias("day_of_week"), "category")
        .select("day_of_week", F.explode(hours).alias("hour_of_day"), "category")
        .select(*CELL_KEYS)
    )
