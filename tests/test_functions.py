from __future__ import annotations

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from demandgrid.functions import fields
from demandgrid.operators.metrics import best_candidate, rmse


def test_normalize_category(spark):
    names = ["Fresh_Fruits ", "  small ring", "Brand#1", None]
    got = spark.createDataFrame([(n,) for n in names], "c string").select("c", fields.normalize_category(F.col("c")))
    assert dict(got.collect()) == {
        "Fresh_Fruits ": "freshfruits",
        "  small ring": "small ring",
        "Brand#1": "brand1",
        None: None,
    }


def test_seasonal_count(spark):
    cases = [(10, 0, 8, 27), (7, 6, 18, 18), (11, 2, 12, 11), (5, 3, 3, 1), (3, 0, 23, 1), (1, 1, 5, 0), (9, 1, 6, 9), (9, 1, 22, 9)]
    rows = spark.createDataFrame(cases, "base bigint, d int, h int, expected bigint")
    got = rows.select("expected", fields.seasonal_count(F.col("base"), F.col("d"), F.col("h")).alias("got"))
    assert all(r.got == r.expected for r in got.collect())


@pytest.mark.parametrize(("value", "rounded"), [(2.675, 2.68), (0.125, 0.13), (1.0, 1.0)])
def test_rounding_is_half_up(spark, value, rounded):
    assert spark.range(1).select(fields.round_prediction(F.lit(value))).first()[0] == rounded


def test_key_split_requires_three_parts(spark):
    keys = spark.createDataFrame([("0:9:milk",), ("0:9",), ("0:9:a:b",), ("x:9:milk",)], "key string")
    got = {r.key: r.p for r in keys.select("key", fields.key_parts(F.col("key")).alias("p")).collect()}
    assert tuple(got["0:9:milk"]) == (0, 9, "milk")
    assert got["0:9"] is None and got["0:9:a:b"] is None
    assert tuple(got["x:9:milk"]) == (None, 9, "milk")


def test_day_label_outside_the_week_is_null(spark):
    got = spark.createDataFrame([(0,), (6,), (7,)], "d int").select("d", fields.day_label(F.col("d")))
    assert dict(got.collect()) == {0: "Sunday", 6: "Saturday", 7: None}


def test_json_roundtrip(spark, predictions):
    columns = [F.col(c) for c in ("prediction", "day_of_week", "hour_of_day", "category", "cached_at")]
    value = fields.prediction_json(*columns)
    text = predictions.where("day_of_week = 0").select(value).first()[0]
    assert text == (
        '{"prediction":4.25,"day_of_week":0,"hour_of_day":9,"category":"coffee","cached_at":"2024-01-01T00:00:00"}'
    )
    back = predictions.select(fields.parse_prediction(value).alias("r")).select("r.*")
    assert tuples(back.select(predictions.columns)) == tuples(predictions)


def test_report_lines(spark, predictions):
    at = [F.col(c) for c in ("day_of_week", "hour_of_day", "category", "prediction")]
    row = predictions.where("day_of_week = 0").select(
        fields.ranked_line(F.lit(1), *at), fields.ranked_day_line(F.lit(1), *at[1:]), fields.lookup_line(*at)
    ).first()
    assert row[0] == " 1. Day 0, Hour  9, coffee              :    4.3 items"
    assert row[1] == " 1. Hour  9, coffee              :    4.3 items"
    assert row[2] == "Sunday  9:00, coffee         :    4.3 items"


def test_best_candidate_keeps_the_earlier_of_equals_and_ignores_nan(spark):
    rows = [(0, "a", 2.0), (1, "b", 1.5), (2, "c", 1.5), (3, "d", float("nan")), (4, "e", None)]
    table = spark.createDataFrame(rows, "position int, candidate string, rmse double")
    assert best_candidate(table).first().candidate == "b"
    assert best_candidate(table.where("candidate in ('d', 'e')")).first() is None


def test_rmse(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "y double, p double")
    assert rows.agg(rmse(F.col("y"), F.col("p"))).first()[0] == pytest.approx(2.5**0.5)
