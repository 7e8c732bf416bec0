"""Session defaults and the folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def build_session(app_name: str = "demandgrid", master: str | None = None, **conf: str) -> SparkSession:
    """Create or get a session.

    Adaptive execution does the size-dependent work: it merges small shuffle
    partitions, splits skewed join partitions, and turns a shuffled join into a
    broadcast one once the measured side is below the broadcast threshold.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below ``spark.checkpoint.dir``, or else below the warehouse folder.

    Both are folders that the driver and every executor reach.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_shared"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where a result feeds several later plans, so that its input is scanned
    once. The table survives the loss of executors, and its file sizes give the
    planner a measured size for later joins.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
