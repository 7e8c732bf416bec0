"""Error of predictions and choice between candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(F.pow(prediction - label, F.lit(2.0))))


def best_candidate(candidates: DataFrame) -> DataFrame:
    """The lowest ``rmse``; on a tie the lowest ``position``; NaN and null never win."""
    valid = candidates.where(F.col("rmse").isNotNull() & ~F.isnan("rmse"))
    winner = F.min_by(F.struct("position", "candidate", "rmse"), F.struct("rmse", "position")).alias("winner")
    return valid.agg(winner).where("winner is not null").select("winner.*")
