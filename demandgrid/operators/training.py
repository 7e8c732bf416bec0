"""Regressors on the cube: cleaning, features, three candidates, selection."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.fields import DAYS, HOURS, in_train_split, normalize_category
from demandgrid.operators.metrics import best_candidate
from demandgrid.session import materialize

LABEL = "total_count"
TRAINING_KEYS = ["day_of_week", "hour_of_day", "category_clean"]

# Candidate parameters.
SEED = 42
FOREST_TREES = 20
TREE_DEPTH = 10
RIDGE = 0.1

CANDIDATE_SCHEMA = "position int, candidate string, rmse double, train_rows bigint, test_rows bigint, failure string"

log = logging.getLogger(__name__)


class Untrainable(RuntimeError):
    """No candidate could be trained on these rows."""


def training_rows(cube: DataFrame) -> DataFrame:
    """Typed, normalised cells; rows with a missing or unparsable field or no items are left out."""
    typed = cube.select(
        F.col("day_of_week").try_cast("int").alias("day_of_week"),
        F.col("hour_of_day").try_cast("int").alias("hour_of_day"),
        normalize_category(F.col("category")).alias("category_clean"),
        F.col("items_count").try_cast("double").alias(LABEL),
    )
    return typed.dropna().where(F.col(LABEL) > 0)


def training_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("category_clean").alias("unique_categories"),
        F.count_distinct("hour_of_day").alias("unique_hours"),
        F.count_distinct("day_of_week").alias("unique_days"),
    )


def with_split(rows: DataFrame) -> DataFrame:
    """Mark each row as training or test by its key."""
    return rows.withColumn("is_train", in_train_split(*[F.col(c) for c in TRAINING_KEYS]))


def feature_pipeline() -> Pipeline:
    """Day, hour and one-hot category. An unseen category becomes the zero vector."""
    return Pipeline(
        stages=[
            StringIndexer(
                inputCol="category_clean",
                outputCol="category_indexed",
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCol="category_indexed", outputCol="category_encoded"),
            VectorAssembler(inputCols=["day_of_week", "hour_of_day", "category_encoded"], outputCol="features"),
        ]
    )


def candidates() -> dict:
    """The regressors to compare, in order."""
    columns = {"featuresCol": "features", "labelCol": LABEL}
    return {
        "RandomForest": RandomForestRegressor(numTrees=FOREST_TREES, maxDepth=TREE_DEPTH, seed=SEED, **columns),
        "LinearRegression": LinearRegression(regParam=RIDGE, **columns),
        "DecisionTree": DecisionTreeRegressor(maxDepth=TREE_DEPTH, seed=SEED, **columns),
    }


def category_index(rows: DataFrame) -> DataFrame:
    """The index each category gets, computed by the fitted indexer."""
    indexer = feature_pipeline().getStages()[0].fit(rows)
    return indexer.transform(rows.select("category_clean").distinct()).select(
        "category_clean", F.col("category_indexed").cast("int").alias("category_index")
    )


def feature_values(rows: DataFrame) -> DataFrame:
    """The assembled features in long form: one row per cell and feature position."""
    features = feature_pipeline().fit(rows).transform(rows)
    return features.select(
        *TRAINING_KEYS, F.posexplode(vector_to_array("features")).alias("feature_position", "feature_value")
    )


def feature_entries(rows: DataFrame) -> DataFrame:
    """The assembled features in sparse long form: the day, the hour and the category's position.

    Three rows per cell whatever the number of categories, two for a category that the
    indexer does not know. They come from the index and value arrays of the assembled
    vector; day and hour are rows also where they are zero.
    """
    assembled = feature_pipeline().fit(rows).transform(rows)
    features = F.unwrap_udt(F.col("features"))
    values = features["values"]
    # a dense vector has no index array: its positions are counted
    positions = F.coalesce(features["indices"], F.sequence(F.lit(0), F.size(values) - 1))
    entries = F.arrays_zip(positions.alias("feature_position"), values.alias("feature_value"))
    grid = [F.struct(F.lit(i).alias("feature_position"), F.col(c).cast("double").alias("feature_value")) for i, c in enumerate(TRAINING_KEYS[:2])]
    encoded = assembled.select(*TRAINING_KEYS, entries.alias("entries"))
    hot = F.filter("entries", lambda e: (e["feature_position"] >= len(grid)) & (e["feature_value"] != 0))
    return encoded.select(*TRAINING_KEYS, F.inline(F.concat(F.array(*grid), hot)))


@dataclass
class TrainedModel:
    """The selected pipeline and the table that led to its choice."""

    name: str
    model: PipelineModel
    metrics: DataFrame


def train_candidates(rows: DataFrame) -> TrainedModel:
    """Fit every candidate on the training split and keep the lowest test RMSE.

    The feature stages are fitted once and the feature rows written once, in key
    order, so that each candidate reads the same rows in the same layout. Cells
    are the unit here: their number is 168 times the number of categories and
    does not grow with the orders behind them. A candidate that fails is listed
    with its failure and cannot win.
    """
    split = materialize(with_split(rows).orderBy(*TRAINING_KEYS), "training-rows")
    encoder = feature_pipeline().fit(split.where("is_train"))
    # sorted rows in range partitions keep their order through this narrow transform
    features = materialize(encoder.transform(split).select("features", LABEL, "is_train"), "training-features")
    train, test = features.where("is_train"), features.where("not is_train")
    sizes = features.agg(F.count_if("is_train"), F.count_if(~F.col("is_train"))).first()
    evaluator = RegressionEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="rmse")

    fitted, results = {}, []
    for position, (name, estimator) in enumerate(candidates().items()):
        error, failure = float("nan"), None
        try:
            fitted[name] = estimator.fit(train)
            error = evaluator.evaluate(fitted[name].transform(test))
        except Exception as problem:  # any failure of one candidate leaves the others in the running
            log.warning("candidate %s failed", name, exc_info=True)
            failure = f"{type(problem).__name__}: {problem}"
        results.append((position, name, error, sizes[0], sizes[1], failure))

    metrics = rows.sparkSession.createDataFrame(results, CANDIDATE_SCHEMA)
    winner = best_candidate(metrics).first()
    if winner is None:
        raise Untrainable(f"no candidate could be trained: {results}")
    name = winner["candidate"]
    model = PipelineModel(stages=[*encoder.stages, fitted[name]])
    return TrainedModel(name, model, metrics.withColumn("is_selected", F.col("candidate") == name))


def fit_estimator(rows: DataFrame, estimator) -> PipelineModel:
    """One regressor on all rows, behind the candidates' feature stages; usable wherever a model is.

    The estimator's feature and label columns become those of the candidates.
    """
    estimator = estimator.copy({estimator.featuresCol: "features", estimator.labelCol: LABEL})
    split = materialize(rows.orderBy(*TRAINING_KEYS), "training-rows")
    encoder = feature_pipeline().fit(split)
    return PipelineModel(stages=[*encoder.stages, estimator.fit(encoder.transform(split).select("features", LABEL))])


def fit_cell_tree(rows: DataFrame) -> PipelineModel:
    """A tree over the numbers of the cells that isolates each, so that it returns the counts it was given.

    Cells are numbered by category, day and hour. A trend along the numbers, steeper than
    the counts differ, is added before the fit and taken off the prediction: it halves the
    cells at each split. For cubes of some thousands of cells: each is a bin of the tree.
    """
    split = materialize(rows.orderBy(*TRAINING_KEYS), "training-rows")
    size = split.agg(F.count_distinct("category_clean").alias("categories"), F.max(LABEL).alias("largest")).first()
    trend = 2 * int(size.largest) + 1
    number = f"category_indexed * {DAYS * HOURS} + day_of_week * {HOURS} + hour_of_day"
    stages = [
        feature_pipeline().getStages()[0],
        SQLTransformer(statement=f"SELECT *, {number} AS cell_number FROM __THIS__"),
        VectorAssembler(inputCols=["cell_number"], outputCol="features"),
    ]
    encoder = Pipeline(stages=stages).fit(split)
    trended = encoder.transform(split).withColumn(LABEL, F.col(LABEL) + F.col("cell_number") * trend)
    tree = DecisionTreeRegressor(
        featuresCol="features", labelCol=LABEL, predictionCol="trended", maxDepth=30, maxBins=max(32, DAYS * HOURS * size.categories + 1), seed=SEED
    )
    untrend = SQLTransformer(statement=f"SELECT *, trended - cell_number * {trend} AS prediction FROM __THIS__")
    return PipelineModel(stages=[*encoder.stages, tree.fit(trended.select("features", LABEL)), untrend])


def least_squares() -> LinearRegression:
    """Ordinary least squares with an intercept for each category in place of a common one, solved by the normal equations."""
    return LinearRegression(regParam=0.0, fitIntercept=False, standardization=False, solver="normal")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def known_categories(model: PipelineModel) -> int:
    """How many categories the model was trained on; indices from here on are unseen."""
    indexer = next(stage for stage in model.stages if isinstance(stage, StringIndexerModel))
    return len(indexer.labels)


def mean_predictor(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean training count by category and hour, and by category alone."""
    train = with_split(rows).where("is_train")
    by_hour = train.groupBy("category_clean", "hour_of_day").agg(F.avg(LABEL).alias("hour_mean"))
    overall = train.groupBy("category_clean").agg(F.avg(LABEL).alias("category_mean"))
    return by_hour, overall


def back_off_means(cells: DataFrame, rows: DataFrame) -> DataFrame:
    """``cells`` with the training means of their category and hour, of their category, and of all.

    Where a mean has no training cell behind it, the next one stands in, so every cell
    has all three.
    """
    by_hour, overall = mean_predictor(rows)
    everything = with_split(rows).where("is_train").agg(F.avg(LABEL).alias("grand_mean"))
    joined = cells.join(by_hour, ["category_clean", "hour_of_day"], "left").join(overall, "category_clean", "left")
    means = joined.withColumn("grand_mean", everything.scalar())
    return means.withColumn("category_mean", F.coalesce("category_mean", "grand_mean")).withColumn(
        "hour_mean", F.coalesce("hour_mean", "category_mean")
    )


def score_with_means(requests: DataFrame, rows: DataFrame) -> DataFrame:
    """Score requests with the mean of their category and hour, else of their category.

    A deterministic stand-in for a model, for results that SQL can check.
    """
    by_hour, overall = mean_predictor(rows)
    return (
        requests.withColumn("category_clean", normalize_category(F.col("category")))
        .join(by_hour, ["category_clean", "hour_of_day"], "left")
        .join(overall, "category_clean", "left")
        .select(*requests.columns, F.coalesce("hour_mean", "category_mean").alias("prediction"))
    )


