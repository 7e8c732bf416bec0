"""The batch jobs: full aggregation, training and prediction refresh."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.operators.cube import loaded_summary
from demandgrid.operators.reshape import wide_to_cells
from demandgrid.operators.scoring import PredictionStore, score_grid
from demandgrid.operators.training import Untrainable, load_model, save_model, train_candidates, training_rows
from demandgrid.session import materialize
from demandgrid.sources.files import CUBE_SCHEMA, read_orders_csv, write_cube
from demandgrid.streaming import CubeStore

log = logging.getLogger(__name__)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("candidate", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("failure", T.StringType()),
        T.StructField("is_selected", T.BooleanType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def full_aggregation(orders: DataFrame, output: str) -> DataFrame:
    """Write the cube of ``orders`` and describe it in one row.

    The orders are read once: their number is aggregated along with the cells.
    (An observed metric would count a recomputed partition twice.)
    """
    counted = materialize(wide_to_cells(orders, count_orders=True), "cells")
    write_cube(counted.where("category is not null").select(*CUBE_SCHEMA.names), output)
    return loaded_summary(counted)


def full_aggregation_csv(spark: SparkSession, pattern: str, output: str) -> DataFrame:
    """The same from day files, such as ``raw/*/orders_*.csv``."""
    return full_aggregation(read_orders_csv(spark, pattern), output)


class Retrainer:
    """Trains again when the cube has changed; usable as a commit hook or on a schedule.

    Models are kept per batch under ``models/batch_id=<n>``. Their metrics are
    written last, so a batch counts as trained only when its model is complete.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        empty = spark.createDataFrame([], METRICS_SCHEMA)
        empty.write.mode("ignore").partitionBy("batch_id").parquet(f"{self.root}/metrics")

    def metrics(self, spark: SparkSession) -> DataFrame:
        """The candidate table of every trained batch."""
        return spark.read.schema(METRICS_SCHEMA).parquet(f"{self.root}/metrics")

    def trained_through(self, spark: SparkSession) -> int | None:
        return self.metrics(spark).agg(F.max("batch_id")).first()[0]

    def model_path(self, batch_id: int) -> str:
        return f"{self.root}/models/batch_id={batch_id}"

    def __call__(self, store: CubeStore, batch_id: int | None = None) -> bool:
        """Train on the store's cube unless this batch has been trained; tell whether it did.

        A cube with too few rows to train on leaves the models as they are.
        """
        newest = store.committed_through()
        done = self.trained_through(store.spark)
        if newest is None or (done is not None and done >= newest):
            return False
        rows = training_rows(store.cube())
        if rows.isEmpty():
            return False
        try:
            trained = train_candidates(rows)
        except Untrainable:
            log.warning("the cube of batch %s has too few rows to train on", newest)
            return False
        save_model(trained.model, self.model_path(newest))
        trained.metrics.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/metrics/batch_id={newest}")
        return True


def train(cube: DataFrame, model_path: str) -> DataFrame:
    """Train on a cube, save the selected model, return the candidate table."""
    trained = train_candidates(training_rows(cube))
    save_model(trained.model, model_path)
    return trained.metrics


def refresh_predictions(
    categories: DataFrame, model_path: str, predictions: PredictionStore, model_version: str = "v1.0"
) -> DataFrame:
    """Score the full grid with a saved model into a new version; return its metadata row."""
    version = predictions.refresh(score_grid(categories, load_model(model_path)), model_version)
    return predictions.metadata().where(F.col("version") == version)


def refresh_if_retrained(store: CubeStore, retrainer: Retrainer, predictions: PredictionStore) -> bool:
    """Serve the newest trained model unless its predictions are the newest version already.

    The check looks at what is being served, so a refresh that was cut short is
    made up for by the next call.
    """
    trained = retrainer.trained_through(store.spark)
    served = predictions.metadata().agg(F.max_by("model_version", "version")).first()[0]
    wanted = f"batch-{trained}"
    if trained is None or served == wanted:
        return False
    refresh_predictions(store.cube(), retrainer.model_path(trained), predictions, wanted)
    return True
