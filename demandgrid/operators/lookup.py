"""Questions to a prediction table: by key, by pattern, top lists and statistics.

A prediction table holds ``day_of_week, hour_of_day, category`` (normalised, one
row per key), ``prediction`` and ``cached_at``. Joins carry no broadcast hint:
the table is read from Parquet, so the planner broadcasts it when its files are
below the broadcast threshold and otherwise shuffles, where adaptive execution
splits the partitions of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.functions.fields import CELL_KEYS, key_parts, normalize_category


def point_lookup(predictions: DataFrame, day: int, hour: int, category: str) -> DataFrame:
    """The row of one key, or no row; all three conditions reach the scan."""
    wanted = normalize_category(F.lit(category))
    return matching(predictions, day, hour).where(F.col("category") == wanted)


def key_lookup(predictions: DataFrame, key: str) -> DataFrame:
    """The row of a ``day:hour:category`` text of a stored table, or no row.

    The day prunes the folders; the key's bloom filter and bounds skip all row groups
    but those that may hold it, and the page index skips pages of these. A text that is
    no key has no row.
    """
    parts = key.split(":")
    day = int(parts[0]) if len(parts) == 3 and parts[0].isdecimal() else None
    return predictions.where(F.lit(False) if day is None else (F.col("day_of_week") == day) & (F.col("key") == key))


def batch_lookup(requests: DataFrame, predictions: DataFrame, found: str | None = None) -> DataFrame:
    """Every request once, its own columns untouched, with prediction and found flag.

    ``found`` names a boolean column of the table that says whether a row counts as
    found; without it every row does. A column ``prediction``, ``cached_at`` or ``found``
    of the requests gives way to the answer's.
    """
    served = predictions.select(
        F.col("day_of_week").alias("_day"),
        F.col("hour_of_day").alias("_hour"),
        F.col("category").alias("_category"),
        F.col("prediction").alias("_prediction"),
        F.col("cached_at").alias("_cached_at"),
        (F.lit(True) if found is None else F.col(found)).alias("_found"),
    )
    same_key = (
        (requests["day_of_week"] == served["_day"])
        & (requests["hour_of_day"] == served["_hour"])
        & (normalize_category(requests["category"]) == served["_category"])
    )
    return requests.join(served, same_key, "left").select(
        *[requests[c] for c in requests.columns if c not in ("prediction", "cached_at", "found")],
        F.col("_prediction").alias("prediction"),
        F.col("_cached_at").alias("cached_at"),
        F.coalesce("_found", F.lit(False)).alias("found"),
    )


def missing_cells(requests: DataFrame, predictions: DataFrame) -> DataFrame:
    """The distinct requested cells that the table does not hold.

    Duplicates collapse before the shuffle, so a hot request key costs one row.
    """
    asked = requests.select(
        "day_of_week", "hour_of_day", normalize_category(F.col("category")).alias("category")
    ).distinct()
    return asked.join(predictions.select(*CELL_KEYS), CELL_KEYS, "left_anti")


def key_requests(keys: DataFrame) -> DataFrame:
    """Requests from ``day:hour:category`` texts; malformed keys are dropped."""
    return keys.select("key", key_parts(F.col("key")).alias("p")).where("p is not null").select("key", "p.*")


def matching(predictions: DataFrame, day: int | None = None, hour: int | None = None) -> DataFrame:
    """The rows of an optional day and an optional hour."""
    if day is not None:
        predictions = predictions.where(F.col("day_of_week") == day)
    if hour is not None:
        predictions = predictions.where(F.col("hour_of_day") == hour)
    return predictions


def _best_first() -> list[Column]:
    return [F.desc("prediction"), *[F.asc(c) for c in CELL_KEYS]]


def top_predictions(predictions: DataFrame, n: int = 20, day: int | None = None, hour: int | None = None) -> DataFrame:
    """The ``n`` highest predictions over all matching rows; ties go by key."""
    return matching(predictions, day, hour).orderBy(*_best_first()).limit(n)


def top_predictions_per_day(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest predictions of each day.

    The rank filter becomes a per-task limit ahead of the shuffle, so a window
    partition receives at most ``n`` rows from each task.
    """
    ranked = F.row_number().over(Window.partitionBy("day_of_week").orderBy(*_best_first()))
    return predictions.withColumn("rank", ranked).where(F.col("rank") <= n)


def ranked_top(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The overall top list with its rank; the window sees the ``n`` kept rows only."""
    return top_predictions(predictions, n).withColumn("rank", F.row_number().over(Window.orderBy(*_best_first())))


def hit_rate(lookups: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Share of requests found, and whether it exceeds ``threshold``."""
    return lookups.agg(
        F.count(F.lit(1)).alias("probes"),
        F.count_if("found").alias("hits"),
        F.avg(F.col("found").cast("int")).alias("rate"),
    ).withColumn("accepted", F.coalesce(F.col("rate") > threshold, F.lit(False)))


def prediction_statistics(predictions: DataFrame) -> DataFrame:
    """Size, newest entry and exact number of categories, in one job."""
    return predictions.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.max("cached_at").alias("last_updated"),
        F.count_distinct("category").alias("categories_count"),
    )


def prediction_categories(predictions: DataFrame) -> DataFrame:
    """The exact sorted categories, one per row, however many there are."""
    return predictions.select("category").distinct().orderBy("category")


def prediction_metadata(predictions: DataFrame, model_version: str) -> DataFrame:
    """The one-row description of a prediction table."""
    span = lambda c: F.concat_ws("-", F.min(c), F.max(c))
    return predictions.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.max("cached_at").alias("last_updated"),
        F.lit(model_version).alias("model_version"),
        F.count_distinct("category").alias("categories_count"),
        span("day_of_week").alias("days_range"),
        span("hour_of_day").alias("hours_range"),
    )


def coverage(predictions: DataFrame, probes: DataFrame) -> DataFrame:
    """Validate a table: it holds rows, and this many of the probe keys are found."""
    held = predictions.select(F.lit(1).alias("held"), F.lit(0).alias("probe"), F.lit(0).alias("hit"))
    asked = batch_lookup(probes, predictions).select(
        F.lit(0).alias("held"), F.lit(1).alias("probe"), F.col("found").cast("int").alias("hit")
    )
    return held.unionByName(asked).agg(
        F.sum("held").alias("total_predictions"),
        F.sum("probe").alias("probes"),
        F.sum("hit").alias("hits"),
        (F.coalesce(F.sum("held"), F.lit(0)) > 0).alias("valid"),
    )
