"""The physical plans that matter at scale."""

from __future__ import annotations

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from demandgrid.functions.fields import CELL_KEYS
from demandgrid.operators import lookup
from demandgrid.operators.cube import cube_from_orders, cube_from_rows
from demandgrid.operators.grid import category_rows, demand_grid
from demandgrid.operators.scoring import PredictionStore
from demandgrid.plans.catalogue import QUERIES
from demandgrid.session import shared_dir
from demandgrid.sources import files
from demandgrid.sources import relations as rel

SF_DIR = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
EAGER_SKEW_SPLIT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


def plan(df, executed: bool = False) -> str:
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_cube_scans_each_table_once_and_reads_only_its_columns(spark):
    text = plan(QUERIES["cube_full"](spark, SF_DIR))
    assert text.count("FileScan") == 3
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "Window" not in text


def test_cube_stays_in_one_scan_however_many_categories(spark):
    wide = spark.range(100).selectExpr(
        "id order_id", "cast(id % 7 as int) order_dow", "cast(id % 24 as int) order_hour_of_day",
        *[f"cast(id % {i + 2} as int) c{i}" for i in range(40)],
    )
    text = plan(cube_from_orders(wide))
    assert text.count("Range (") == 1 and text.count("Exchange") == 1 and "partial_sum" in text


def test_point_lookup_prunes_the_day_and_pushes_the_key(spark):
    store = PredictionStore(spark, shared_dir(spark, "predictions"))
    store.refresh(demand_grid(category_rows(spark, ["milk"])).withColumn("prediction", F.lit(1.0)))
    text = plan(lookup.point_lookup(store.read(), 5, 12, "Milk "))
    assert re.search(r"PartitionFilters: \[.*day_of_week.*= 5", text)
    assert re.search(r"PushedFilters: \[.*EqualTo\(hour_of_day,12\), EqualTo\(category,milk\)", text)


def test_lookup_broadcasts_a_small_table_and_splits_a_hot_key_otherwise(spark):
    store = PredictionStore(spark, shared_dir(spark, "predictions"))
    store.refresh(demand_grid(category_rows(spark, ["click", "view"])).withColumn("prediction", F.lit(1.0)))
    requests = spark.range(60_000).selectExpr(
        "id", "cast(if(id % 3 = 0, 0, id % 7) as int) day_of_week",
        "cast(if(id % 3 = 0, 9, id % 24) as int) hour_of_day", "if(id % 3 = 0, 'click', 'view') category",
    )
    assert "BroadcastHashJoin" in plan(lookup.batch_lookup(requests, store.read()), executed=True)
    with settings(spark, **SHUFFLED, **EAGER_SKEW_SPLIT):
        looked_up = lookup.batch_lookup(requests, store.read())
        assert looked_up.where("found").count() == 60_000
        assert "skew=true" in plan(looked_up, executed=True)


def test_a_hot_part_is_split(spark):
    """A third of all items are of one part; the shuffled join spreads them and the cube is unchanged."""
    rows = rel.lineitem_rows(spark, SF_DIR)
    expected = {tuple(r) for r in cube_from_rows(rows).collect()}
    names = rel.table(spark, SF_DIR, "part").select("p_partkey", F.col("p_name").alias("category"))
    hot = spark.range(60_000).selectExpr("if(id % 3 = 0, 1, id % 200) l_partkey", "id")
    with settings(spark, **SHUFFLED, **EAGER_SKEW_SPLIT):
        assert {tuple(r) for r in cube_from_rows(rel.lineitem_rows(spark, SF_DIR)).collect()} == expected
        joined = hot.join(names, F.col("l_partkey") == F.col("p_partkey"))
        assert "skew=true" in plan(joined, executed=True)
        assert joined.count() == 60_000


def test_top_per_day_limits_before_the_shuffle(spark):
    store = PredictionStore(spark, shared_dir(spark, "predictions"))
    store.refresh(demand_grid(category_rows(spark, ["milk"])).withColumn("prediction", F.col("hour_of_day") * 1.0))
    text = plan(lookup.top_predictions_per_day(store.read(), 3))
    assert re.search(r"WindowGroupLimit.*Partial", text)
    assert "TakeOrderedAndProject" in plan(lookup.top_predictions(store.read(), 3))


def test_a_day_with_most_rows_is_written_by_several_tasks(spark):
    # a split of a hot partition is as fine as the tasks that wrote it
    rows = spark.range(0, 200_000, 1, 8).selectExpr("id order_id", "cast(if(id % 10 < 9, 0, id % 7) as int) order_dow")
    root = shared_dir(spark, "split")
    with settings(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}):
        files.split_by_day(rows, root, F.col("order_dow"), "parquet")
    back = spark.read.parquet(root)
    assert back.count() == 200_000
    per_day = dict(back.select("day", "_metadata.file_path").distinct().groupBy("day").count().collect())
    assert per_day[0] > 3


@pytest.mark.parametrize("name", ["grid", "wide_orders", "batch_lookup", "missing_cells", "processing_status", "best_candidate"])
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_requested_cells_collapse_before_the_shuffle(spark):
    text = plan(lookup.missing_cells(rel.lookup_requests(spark, SF_DIR), cube_from_rows(rel.event_rows(spark, SF_DIR)).select(*CELL_KEYS)))
    assert text.count("HashAggregate") >= 4 and "LeftAnti" in text


@pytest.mark.parametrize("master", ["local[4]", "yarn"])
def test_shared_folder_does_not_depend_on_the_master(master):
    class Session:
        sparkContext = type("Context", (), {"master": master})

        def __init__(self, **conf):
            self.conf = conf

    assert shared_dir(Session(**{"spark.checkpoint.dir": "hdfs://n/c/"}), "x").startswith("hdfs://n/c/x-")
    assert shared_dir(Session(**{"spark.sql.warehouse.dir": "hdfs://n/w"}), "x").startswith("hdfs://n/w/_shared/x-")


def scanned_rows(df) -> int:
    """Rows that the scan of an executed plan handed on."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        node = node.executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def test_a_lookup_by_key_reads_one_row_group_of_one_day(spark):
    names = [f"category {i:05d}" for i in range(3000)]
    scored = demand_grid(category_rows(spark, names)).where("hour_of_day < 4").withColumn("prediction", F.lit(1.5))
    small = {"parquet.block.size": str(32 << 10), "parquet.block.row.count.limit": "1000", "parquet.page.row.count.limit": "500"}
    store = PredictionStore(spark, shared_dir(spark, "predictions"), small)
    with settings(spark, **{"spark.sql.shuffle.partitions": "1"}):
        store.refresh(scored)
    table = store.read()
    found = lookup.key_lookup(table, "3:2:category 01234")
    assert [(r.hour_of_day, r.category, r.prediction) for r in found.collect()] == [(2, "category 01234", 1.5)]
    assert re.search(r"PartitionFilters: \[.*day_of_week.*= 3", plan(found))
    assert 1 <= scanned_rows(found) <= 1000  # of 12,000 rows of the day
    # between two keys that are there: bounds include it, no bloom filter does
    assert scanned_rows(lookup.key_lookup(table, "3:2:category 01234x")) == 0
    assert lookup.key_lookup(table, "no key").count() == lookup.key_lookup(table, "x:2:category 01234").count() == 0
