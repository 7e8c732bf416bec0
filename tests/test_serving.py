from __future__ import annotations

import numpy as np
import pytest
from conftest import tuples
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from demandgrid.operators import lookup, scoring, training
from demandgrid.operators.cube import cube_from_rows
from demandgrid.operators.grid import category_rows, demand_grid
from demandgrid.plans import jobs
from demandgrid.sources.files import CUBE_SCHEMA
from demandgrid.sources.files import requests as typed_requests
from demandgrid.sources.relations import event_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return training.training_rows(cube_from_rows(event_rows(spark, SF_DIR)))


@pytest.fixture(scope="module")
def trained(rows):
    return training.train_candidates(rows)


def test_training_rows_drop_dirty_cells(spark):
    dirty = [("0", "9", "Fresh_Fruits ", "4"), ("x", "9", "a", "1"), ("0", "9", None, "1"), ("0", "9", "a", "0"), ("0", "9", "a", "-1")]
    table = spark.createDataFrame(dirty, "day_of_week string, hour_of_day string, category string, items_count string")
    assert tuples(training.training_rows(table)) == {(0, 9, "freshfruits", 4.0)}


def test_candidates_and_choice(trained):
    table = {r.candidate: r for r in trained.metrics.collect()}
    assert list(table) == ["RandomForest", "LinearRegression", "DecisionTree"]
    assert trained.name == min(table, key=lambda name: table[name].rmse)
    assert [name for name in table if table[name].is_selected] == [trained.name]
    assert all(r.failure is None for r in table.values())


def test_training_repeats_exactly(rows, trained):
    again = training.train_candidates(rows)
    assert tuples(again.metrics) == tuples(trained.metrics)


def test_failed_candidate_is_listed_and_loses(rows, monkeypatch):
    usable = training.candidates()
    broken = {"Broken": usable["DecisionTree"].copy().setMaxBins(2).setLabelCol("absent"), **{"DecisionTree": usable["DecisionTree"]}}
    monkeypatch.setattr(training, "candidates", lambda: broken)
    result = training.train_candidates(rows)
    assert result.name == "DecisionTree"
    failures = {r.candidate: r.failure for r in result.metrics.collect()}
    assert failures["DecisionTree"] is None and failures["Broken"] is not None


def test_linear_candidate_is_ridge_on_standardised_features(rows):
    """The fitted line against the closed form."""
    features = training.feature_pipeline().fit(rows).transform(rows)
    model = training.candidates()["LinearRegression"].fit(features)
    data = features.select(vector_to_array("features").alias("x"), training.LABEL).collect()
    x, y = np.array([r.x for r in data]), np.array([r[1] for r in data])
    scale = x.std(axis=0, ddof=1)
    label_scale = y.std(ddof=1)
    z = (x - x.mean(axis=0)) / scale
    v = (y - y.mean()) / label_scale
    n, k = z.shape
    weights = np.linalg.solve(z.T @ z / n + 0.1 / label_scale * np.eye(k), z.T @ v / n) * label_scale / scale
    # the solver is iterative, hence the tolerance
    assert model.coefficients.toArray() == pytest.approx(weights, rel=1e-3, abs=1e-5)


def test_saved_model_scores_alike_and_flags_unknown_categories(spark, trained, tmp_path):
    training.save_model(trained.model, f"{tmp_path}/model")
    loaded = training.load_model(f"{tmp_path}/model")
    requests = typed_requests(spark, [(0, 9, " Click"), (5, 12, "vi_ew"), ("1", "18", "coffee")])
    first, second = (scoring.score(requests, m).collect() for m in (trained.model, loaded))
    assert first == second
    assert [r.known_category for r in first] == [True, True, False]
    assert [r.category for r in first] == [" Click", "vi_ew", "coffee"]


def test_underscored_names_train_and_score_as_one(spark):
    cells = [(d, h, "fresh_fruits", 10 + h) for d in range(7) for h in range(24)]
    cells += [(d, h, "milk", 100 + h) for d in range(7) for h in range(24)]
    model = training.train_candidates(training.training_rows(spark.createDataFrame(cells, CUBE_SCHEMA))).model
    requests = typed_requests(spark, [(0, 9, "fresh_fruits"), (0, 9, "Fresh_Fruits ")])
    got = scoring.score(requests, model).collect()
    assert all(r.known_category for r in got) and got[0].prediction == got[1].prediction
    assert got[0].prediction == pytest.approx(19, abs=5)


def test_batch_lookup(spark, predictions):
    requests = spark.createDataFrame(
        [(1, 0, 9, " Coffee "), (2, 5, 12, "milk"), (3, 5, 13, "milk"), (4, None, 12, "milk"), (5, 5, 12, None)],
        "id int, day_of_week int, hour_of_day int, category string",
    )
    got = {r.id: r for r in lookup.batch_lookup(requests, predictions).collect()}
    assert [got[i].found for i in range(1, 6)] == [True, True, False, False, False]
    assert (got[1].prediction, got[1].category, got[1].cached_at) == (4.25, " Coffee ", "2024-01-01T00:00:00")
    assert got[3].prediction is None and got[3].cached_at is None
    rate = lookup.hit_rate(lookup.batch_lookup(requests.where("id <= 3"), predictions)).first()
    assert (rate.probes, rate.hits, rate.accepted) == (3, 2, False) and rate.rate == pytest.approx(2 / 3)
    checked = lookup.coverage(predictions, requests).first()
    assert tuple(checked) == (2, 5, 2, True)
    assert lookup.coverage(predictions.limit(0), requests).first().valid is False


def test_point_lookup_and_patterns(predictions):
    assert lookup.point_lookup(predictions, 0, 9, " COFFEE").first().prediction == 4.25
    assert lookup.point_lookup(predictions, 0, 9, "tea").isEmpty()
    for day, hour, count in ((None, None, 2), (0, None, 1), (None, 12, 1), (0, 12, 0)):
        assert lookup.matching(predictions, day, hour).count() == count


def test_top_lists_break_ties_by_key(spark):
    rows = [(d, h, "x", float(h % 3)) for d in range(2) for h in range(24)]
    table = spark.createDataFrame(rows, "day_of_week int, hour_of_day int, category string, prediction double")
    top = lookup.ranked_top(table, 20).orderBy("rank").collect()
    assert [r.rank for r in top] == list(range(1, 21))
    assert [(r.day_of_week, r.hour_of_day) for r in top[:9]] == [(0, h) for h in range(2, 24, 3)] + [(1, 2)]
    per_day = lookup.top_predictions_per_day(table, 3).orderBy("day_of_week", "rank").collect()
    assert [(r.day_of_week, r.hour_of_day) for r in per_day] == [(d, h) for d in (0, 1) for h in (2, 5, 8)]


def test_refresh_replaces_the_whole_table(spark, tmp_path):
    store = scoring.PredictionStore(spark, f"{tmp_path}/predictions")
    with pytest.raises(LookupError):
        store.read()
    first = demand_grid(category_rows(spark, ["milk", "tea"])).withColumn("prediction", F.lit(2.675))
    assert store.refresh(first) == 1
    assert store.refresh(first.where("category = 'tea'"), "v2.0") == 2
    assert store.read(1).count() == 336
    assert {r.category for r in lookup.prediction_categories(store.read()).collect()} == {"tea"}
    row = store.metadata().where("version = 2").first()
    assert (row.total_predictions, row.model_version, row.categories_count) == (168, "v2.0", 1)
    assert (row.days_range, row.hours_range) == ("0-6", "0-23")
    assert store.read().select("cached_at").distinct().count() == 1
    assert store.read().where("key = '0:9:tea'").first().prediction == 2.68


def test_fallback_scores_only_what_is_missing(spark, trained, tmp_path):
    store = scoring.PredictionStore(spark, f"{tmp_path}/predictions")
    grid = demand_grid(category_rows(spark, ["click"]))
    store.refresh(grid.withColumn("prediction", F.lit(-1.0)))
    requests = spark.createDataFrame(
        [(1, 0, 9, "Click "), (2, 0, 9, "view"), (3, 0, 9, "view "), (4, 0, 9, "coffee")],
        "id int, day_of_week int, hour_of_day int, category string",
    )
    got = {r.id: r for r in scoring.lookup_or_score(requests, store.read(), trained.model).collect()}
    assert [got[i].found for i in range(1, 5)] == [True, False, False, False]
    direct = {r.id: r.prediction for r in scoring.score(requests, trained.model).collect()}
    assert got[1].prediction == -1.0
    assert all(got[i].prediction == direct[i] for i in (2, 3, 4))


def test_train_and_refresh_jobs(spark, tmp_path):
    cube = cube_from_rows(event_rows(spark, SF_DIR))
    assert jobs.train(cube, f"{tmp_path}/model").count() == 3
    store = scoring.PredictionStore(spark, f"{tmp_path}/predictions")
    meta = jobs.refresh_predictions(cube, f"{tmp_path}/model", store).first()
    assert meta.total_predictions == 840 and meta.version == 1


def test_incomplete_requests_have_no_prediction(spark, trained):
    asked = spark.createDataFrame([(0, 9, "coffee"), (None, 9, "coffee"), (1, None, "tea"), (1, 1, None)], "day_of_week int, hour_of_day int, category string")
    rows = scoring.score(asked, trained.model).collect()
    assert len(rows) == 4 and sum(r.prediction is None for r in rows) == 3
