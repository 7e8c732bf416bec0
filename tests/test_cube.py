from __future__ import annotations

import pytest
from conftest import GOLDEN_CUBE, ORDER_COLUMNS, tuples
from pyspark.sql import functions as F

from demandgrid.functions.fields import CELL_KEYS
from demandgrid.operators import cube as cubes
from demandgrid.operators.grid import category_rows, demand_grid
from demandgrid.operators.reshape import category_columns, category_coverage, wide_to_long
from demandgrid.plans.jobs import full_aggregation
from demandgrid.sources import files
from demandgrid.sources.relations import days_since_prior, wide_orders

SF_DIR = "/root/testdata/sf0.001"


def test_golden_cube(golden_orders):
    assert tuples(cubes.cube_from_orders(golden_orders)) == GOLDEN_CUBE


def test_both_plans_give_the_same_cube(spark):
    orders = wide_orders(spark, SF_DIR, with_prior=False)
    long_first = cubes.cube_from_rows(wide_to_long(orders))
    assert tuples(cubes.cube_from_orders(orders)) == tuples(long_first.select(*CELL_KEYS, "items_count"))


def test_null_and_zero_counts_are_alike(spark):
    orders = wide_orders(spark, SF_DIR, with_prior=False)
    assert tuples(cubes.cube_from_orders(orders.na.fill(0))) == tuples(cubes.cube_from_orders(orders))


def test_category_columns_keep_order_and_reject_text(golden_orders):
    assert category_columns(golden_orders) == ["milk", "fresh fruits", "eggs"]
    with pytest.raises(TypeError, match="note"):
        category_columns(golden_orders.withColumn("note", F.lit("x")))


def test_unusual_category_names(spark):
    orders = spark.createDataFrame([(1, 0, 9, None, 2, 3)], ORDER_COLUMNS + ", `a.b` int, `c``d` int")
    assert tuples(cubes.cube_from_orders(orders)) == {(0, 9, "a.b", 2), (0, 9, "c`d", 3)}
    assert tuples(category_coverage(orders)) == {(0, "a.b", 1), (1, "c`d", 1)}


def test_orders_without_categories_give_an_empty_cube(golden_orders):
    bare = golden_orders.drop("milk", "fresh fruits", "eggs")
    assert cubes.cube_from_orders(bare).count() == 0
    assert wide_to_long(bare).count() == 0


def test_counts_must_be_whole(spark):
    columns = ORDER_COLUMNS + ", milk double, eggs int"
    whole = spark.createDataFrame([(1, 0, 9, None, 2.0, 3)], columns)
    cube = cubes.cube_from_orders(whole)
    assert dict(cube.dtypes)["items_count"] == "bigint" and tuples(cube) == {(0, 9, "milk", 2), (0, 9, "eggs", 3)}
    with pytest.raises(Exception, match="not a whole number of items"):
        cubes.cube_from_orders(spark.createDataFrame([(1, 0, 9, None, 2.5, 3)], columns)).collect()


def test_rows_per_day_lists_empty_days(golden_orders):
    counts = dict(cubes.rows_per_day(golden_orders, F.col("order_dow")).collect())
    assert [counts[d] for d in range(7)] == [2, 0, 0, 1, 0, 0, 1]


def test_merge_adds_up_by_name(golden_orders):
    cube = cubes.cube_from_orders(golden_orders)
    doubled = cubes.merge_cubes(cube, cube.select("items_count", *CELL_KEYS))
    assert tuples(doubled) == {(*k, 2 * n) for *k, n in GOLDEN_CUBE}


def test_summary_counts_orders_that_add_no_cell(spark, golden_orders, tmp_path):
    row = full_aggregation(golden_orders, f"{tmp_path}/cube").first().asDict()
    assert row == {"combinations": 3, "categories": 3, "days": 2, "hours": 2, "orders_loaded": 4}
    assert tuples(files.read_cube(spark, f"{tmp_path}/cube")) == GOLDEN_CUBE


def test_csv_layouts(spark, golden_orders, tmp_path):
    hive, plain = f"{tmp_path}/hive", tmp_path / "plain"
    files.split_by_day(golden_orders, hive, F.col("order_dow"))
    for day, text in ((0, "1,0,9,,2,0,3\n2,0,9,5.0,1,,0\n"), (6, "3,6,23,7.0,0,4,-2\n"), (3, "4,3,0,1.0,0,0,0\n")):
        (plain / str(day)).mkdir(parents=True)
        header = "order_id,order_dow,order_hour_of_day,days_since_prior_order,milk,fresh fruits,eggs\n"
        (plain / str(day) / f"orders_{day}.csv").write_text(header + text)
    (plain / "notes").mkdir()
    (plain / "notes" / "x.csv").write_text("a\n1\n")
    schema = files.order_schema(golden_orders.columns)
    assert tuples(cubes.cube_from_orders(files.read_orders_csv(spark, f"{plain}/*/orders_*.csv"))) == GOLDEN_CUBE
    assert tuples(cubes.cube_from_orders(files.read_orders_csv(spark, f"{hive}/*/*.csv"))) == GOLDEN_CUBE
    assert tuples(cubes.cube_from_orders(files.read_orders_csv(spark, hive))) == GOLDEN_CUBE
    for root in (hive, str(plain)):
        assert [r.day for r in files.available_days(spark, root).collect()] == [0, 3, 6]
    assert files.read_day(spark, hive, 0, schema).count() == 2
    digits = files.read_plain_days(spark, str(plain), schema)
    assert dict(digits.groupBy("day").count().collect()) == {0: 2, 3: 1, 6: 1}
    assert tuples(cubes.cube_from_orders(digits.drop("day"))) == GOLDEN_CUBE


def test_unparsable_count_stops_the_read(spark, tmp_path):
    (tmp_path / "orders_0.csv").write_text("order_id,order_dow,order_hour_of_day,milk\n1,0,9,two\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_orders_csv(spark, f"{tmp_path}/orders_0.csv").collect()


def test_exported_cube_sorts_as_numbers(spark, tmp_path):
    cube = spark.createDataFrame([(0, 10, "a", 1), (0, 2, "a", 1)], files.CUBE_SCHEMA)
    files.export_cube_csv(cube, f"{tmp_path}/out")
    read = files.read_cube_csv(spark, f"{tmp_path}/out")
    assert read.dtypes == cube.dtypes
    assert [r.hour_of_day for r in cubes.sorted_cube(read).collect()] == [2, 10]


def test_cube_choice(spark, tmp_path):
    one, none, absent = f"{tmp_path}/one", f"{tmp_path}/none", f"{tmp_path}/absent"
    cube = spark.createDataFrame([(0, 10, "a", 1)], files.CUBE_SCHEMA)
    files.write_cube(cube, one)
    files.write_cube(cube.limit(0), none)
    assert files.choose_cube(spark, one, absent).first().source == "full"
    assert files.choose_cube(spark, none, one).first().source == "incremental"
    assert files.choose_cube(spark, absent, one).first().source == "incremental"
    with pytest.raises(FileNotFoundError):
        files.choose_cube(spark, absent, none)


@pytest.mark.parametrize(("names", "cells"), [([f"category {i}" for i in range(n)], 168 * n) for n in (15, 20, 32)])
def test_grid_size(spark, names, cells):
    grid = demand_grid(category_rows(spark, names))
    assert grid.count() == grid.distinct().count() == cells


def test_grid_merges_spellings(spark):
    assert demand_grid(category_rows(spark, ["Milk ", "milk", "m_ilk"])).count() == 168


def test_prior_order_of_a_hot_customer(spark):
    """Same-date orders and one customer with most orders, against a plain window."""
    orders = spark.range(600).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 7 + 2).alias("o_custkey"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(pmod(hash(id), 90) as int))").alias("o_orderdate"),
    )
    joined = orders.join(days_since_prior(orders), F.col("o_orderkey") == F.col("first_key"), "left")
    got = joined.select("o_orderkey", F.when(F.col("is_first"), F.col("days")).otherwise(F.lit(0)).alias("days"))
    expected = orders.selectExpr(
        "o_orderkey",
        "date_diff(o_orderdate, lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey)) days",
    )
    rows = {r.o_orderkey: r.days for r in expected.collect()}
    firsts = {r.o_orderkey for r in joined.where("is_first and days is null").collect()}
    assert {r.o_orderkey: (None if r.o_orderkey in firsts else r.days) for r in got.collect()} == rows
