"""Scoring requests with a model and keeping the scores as a versioned table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.functions.fields import CELL_KEYS, cell_key, iso_now, normalize_category, round_prediction
from demandgrid.operators.grid import demand_grid
from demandgrid.operators.lookup import batch_lookup, missing_cells, prediction_metadata
from demandgrid.operators.training import known_categories
from demandgrid.session import materialize
from demandgrid.sources.folders import claim, holds_file, numbers, remove

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("cached_at", T.StringType()),
        T.StructField("day_of_week", T.IntegerType()),
    ]
)
METADATA_SCHEMA = T.StructType(
    [
        T.StructField("total_predictions", T.LongType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("categories_count", T.LongType()),
        T.StructField("days_range", T.StringType()),
        T.StructField("hours_range", T.StringType()),
        T.StructField("version", T.IntegerType()),
    ]
)

#: Row groups of a size that one lookup may read, and a bloom filter by which those without its key are skipped.
FILE_OPTIONS = {
    "parquet.block.size": str(16 << 20),
    "parquet.bloom.filter.enabled#key": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def score(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Every request with its rounded prediction, and whether its category was trained on.

    A request without day, hour or category has no prediction.
    """
    typed = requests.select(
        *[c for c in requests.columns if c not in ("day_of_week", "hour_of_day")],
        F.col("day_of_week").cast("int").alias("day_of_week"),
        F.col("hour_of_day").cast("int").alias("hour_of_day"),
        normalize_category(F.col("category")).alias("category_clean"),
    )
    whole = F.col("day_of_week").isNotNull() & F.col("hour_of_day").isNotNull() & F.col("category_clean").isNotNull()
    scored = model.transform(typed.where(whole)).select(
        *requests.columns,
        round_prediction(F.col("prediction")).alias("prediction"),
        (F.col("category_indexed") < known_categories(model)).alias("known_category"),
    )
    blank = typed.where(~whole).select(
        *requests.columns, F.lit(None).cast("double").alias("prediction"), F.lit(False).alias("known_category")
    )
    return scored.unionByName(blank)


def score_grid(categories: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions for every (day, hour) of each category."""
    return score(demand_grid(categories), model)


def lookup_or_score(requests: DataFrame, predictions: DataFrame, model: PipelineModel) -> DataFrame:
    """Look requests up and let the model answer what the table lacks.

    The model sees each missing cell once, however many requests ask for it. The
    answers are written, so that their size is known when they join the requests
    like table rows. ``found`` tells table hits from scored misses.
    """
    missing = materialize(score(missing_cells(requests, predictions), model), "scored-misses")
    answers = predictions.select(*CELL_KEYS, "prediction", "cached_at", F.lit(True).alias("stored")).unionByName(
        missing.select(*CELL_KEYS, "prediction", F.lit(None).cast("string").alias("cached_at"), F.lit(False).alias("stored"))
    )
    return batch_lookup(requests, answers, found="stored")


class PredictionStore:
    """Complete, immutable versions of a prediction table.

    ``predictions/version=<n>/day_of_week=<d>/`` holds the rows, sorted by key so
    that a lookup skips most of each file, with a bloom filter of the keys in each row group; ``metadata/version=<n>/`` is written
    after them and makes the version visible. Readers use the newest version, so
    cells of an earlier category list do not linger. A refresh first claims its number
    by a file that only one can create, so two at a time write two versions.
    """

    def __init__(self, spark: SparkSession, root: str, file_options: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.file_options = FILE_OPTIONS | (file_options or {})
        empty = spark.createDataFrame([], METADATA_SCHEMA)
        empty.write.mode("ignore").partitionBy("version").parquet(f"{self.root}/metadata")

    def metadata(self) -> DataFrame:
        """One row per complete version."""
        return self.spark.read.schema(METADATA_SCHEMA).parquet(f"{self.root}/metadata")

    def latest(self) -> int | None:
        return self.metadata().agg(F.max("version")).first()[0]

    def refresh(self, scored: DataFrame, model_version: str = "v1.0") -> int:
        """Write scored cells as a new version and return its number."""
        version = self._claim()
        rows = scored.select(
            cell_key(*[F.col(c) for c in CELL_KEYS]).alias("key"),
            *CELL_KEYS,
            round_prediction(F.col("prediction")).alias("prediction"),
            iso_now().alias("cached_at"),
        )
        path = f"{self.root}/predictions/version={version}"
        (
            rows.hint("rebalance", F.col("day_of_week"))
            .sortWithinPartitions(*CELL_KEYS)
            .write.mode("overwrite")
            .options(**self.file_options)
            .partitionBy("day_of_week")
            .parquet(path)
        )
        described = prediction_metadata(self._version(version), model_version)
        described.write.mode("overwrite").parquet(f"{self.root}/metadata/version={version}")
        return version

    def _claim(self) -> int:
        """The next number that no other refresh has; a refresh that was cut short keeps its number, which no reader sees."""
        taken = numbers(self.spark, f"{self.root}/claims", "version")
        version = max([self.latest() or 0, *taken]) + 1
        while not claim(self.spark, f"{self.root}/claims/version={version}"):
            version += 1
        return version

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all versions older than the newest ``keep`` complete ones; return their numbers."""
        if keep < 1:
            raise ValueError("the newest version is needed")
        complete = [n for n in numbers(self.spark, f"{self.root}/metadata", "version") if holds_file(self.spark, f"{self.root}/metadata/version={n}")]
        old = [n for n in complete if n < complete[-keep:][0]] if complete else []
        for n in old:  # the metadata first: without it no reader begins on the version
            remove(self.spark, f"{self.root}/metadata/version={n}")
            remove(self.spark, f"{self.root}/predictions/version={n}")
        return old

    def _version(self, version: int) -> DataFrame:
        # only this version's folder is listed, however many there have been
        return self.spark.read.schema(PREDICTION_SCHEMA).parquet(f"{self.root}/predictions/version={version}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest complete one."""
        version = version or self.latest()
        if version is None:
            raise LookupError(f"no prediction table has been written to {self.root}")
        return self._version(version)
