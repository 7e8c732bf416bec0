"""Which days are available, which are processed, and whether two ledgers agree.

``available`` and every ledger have a ``day`` column; a ledger that knows the
batch each day came in also has ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unprocessed_days(available: DataFrame, ledger: DataFrame) -> DataFrame:
    return available.select("day").distinct().join(ledger.select("day"), "day", "left_anti").orderBy("day")


def day_states(available: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each day known to either side, with a flag for each side."""
    on_disk = available.select("day").distinct().withColumn("is_available", F.lit(True))
    done = ledger.select("day").distinct().withColumn("is_processed", F.lit(True))
    return on_disk.join(done, "day", "full").select(
        "day",
        F.coalesce("is_available", F.lit(False)).alias("is_available"),
        F.coalesce("is_processed", F.lit(False)).alias("is_processed"),
    )


def last_processed_day(ledger: DataFrame) -> DataFrame:
    """The day written last: days ascend within a batch, batches ascend in time."""
    return ledger.agg(F.max_by("day", F.struct("batch_id", "day")).alias("last_processed_day"))


def processing_status(available: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: how many days are available, processed and open, and the last one."""
    latest = ledger.groupBy("day").agg(F.max("batch_id").alias("batch_id"))
    states = available.select("day").distinct().withColumn("is_available", F.lit(True)).join(latest, "day", "full")
    done = F.col("batch_id").isNotNull()
    return states.agg(
        F.count_if("is_available").alias("available_days"),
        F.count_if(done).alias("processed_days"),
        F.count_if(F.col("is_available") & ~done).alias("unprocessed_days"),
        F.min(F.when(F.col("is_available") & ~done, F.col("day"))).alias("next_day"),
        F.max_by(F.when(done, F.col("day")), F.when(done, F.struct("batch_id", "day"))).alias("last_processed_day"),
    )


def ledger_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """Days only one of two ledgers holds; no row means that they agree."""
    left = first.select("day").distinct().withColumn("in_first", F.lit(True))
    right = second.select("day").distinct().withColumn("in_second", F.lit(True))
    return (
        left.join(right, "day", "full")
        .where(F.col("in_first").isNull() | F.col("in_second").isNull())
        .select("day", F.when(F.col("in_first"), F.lit("first")).otherwise(F.lit("second")).alias("only_in"))
    )
