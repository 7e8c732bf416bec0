from __future__ import annotations

import os
from itertools import permutations
from pathlib import Path

import pytest
from conftest import GOLDEN_CUBE, GOLDEN_ORDERS, ORDER_COLUMNS, tuples
from pyspark.sql import functions as F

from demandgrid.operators import days
from demandgrid.operators.reshape import wide_to_cells
from demandgrid.plans import jobs
from demandgrid.sources import files
from demandgrid.streaming import CubeStore, day_stream, fold_unprocessed_days, run_once


@pytest.fixture
def land(spark, golden_orders, tmp_path):
    """Land golden days as CSV and feed them; one call is one arrival."""
    landing = f"{tmp_path}/landing"
    schema = files.order_schema(golden_orders.columns)

    def arrive(store, *wanted, **kwargs):
        if wanted:
            rows = golden_orders.where(F.col("order_dow").isin(*wanted))
            files.split_by_day(rows, landing, F.col("order_dow"), mode="append")
        run_once(day_stream(spark, landing, schema), store, **kwargs)

    arrive.landing = landing
    return arrive


@pytest.mark.parametrize("arrivals", [[(0,), (3,), (6,)], [(6,), (0,), (3,)], [(0, 3, 6)]])
def test_any_arrival_order_gives_the_full_cube(spark, tmp_path, land, arrivals):
    store = CubeStore(spark, f"{tmp_path}/store")
    for arrival in arrivals:
        land(store, *arrival)
    assert tuples(store.cube()) == GOLDEN_CUBE
    batch_of = {day: i for i, arrival in enumerate(arrivals) for day in arrival}
    assert dict(store.processed_days().collect()) == batch_of
    status = store.status(files.available_days(spark, land.landing)).first()
    last = max(arrivals[-1])
    assert tuple(status) == (3, 3, 0, None, last)


def test_nothing_new_commits_nothing(spark, tmp_path, land):
    store = CubeStore(spark, f"{tmp_path}/store")
    land(store, 0)
    land(store)
    assert store.committed_through() == 0


def test_late_file_is_reported_and_not_counted(spark, tmp_path, land):
    store = CubeStore(spark, f"{tmp_path}/store")
    land(store, 0, 6)
    land(store, 0, 3)
    assert tuples(store.cube()) == GOLDEN_CUBE
    assert tuples(store.day_report()) == {(0, 2, 2), (6, 1, 0), (3, 1, 0)}
    assert dict(store.processed_days().collect()) == {0: 0, 6: 0, 3: 1}


def test_replay_and_compaction_change_nothing(spark, tmp_path, land, golden_orders):
    store = CubeStore(spark, f"{tmp_path}/store")
    batches = [golden_orders.where(F.col("order_dow") == d).withColumn("day", F.col("order_dow")) for d in (6, 0, 3)]
    for number, batch in enumerate(batches):
        store.commit(batch, number)
    for number in (1, 2, 0):
        store.commit(batches[number], number)
        assert tuples(store.cube()) == GOLDEN_CUBE
    assert store.compact() == 2 == store.snapshot_through()
    assert tuples(store.cube()) == GOLDEN_CUBE
    store.commit(golden_orders.where("order_dow = 0").withColumn("day", F.lit(7)), 3)
    grown = {(d, h, c, 2 * n if d == 0 else n) for d, h, c, n in GOLDEN_CUBE}
    assert tuples(store.cube()) == grown
    assert store.compact() == 3
    assert tuples(store.cube()) == grown


def test_batch_without_ledger_entry_is_invisible_until_repeated(spark, tmp_path, golden_orders, monkeypatch):
    store = CubeStore(spark, f"{tmp_path}/store")
    zero, six = (golden_orders.where(f"order_dow = {d}").withColumn("day", F.col("order_dow")) for d in (0, 6))
    store.commit(zero, 0)
    before = tuples(store.cube())
    store.commit(six, 1)
    complete = tuples(store.cube())
    # a second store whose batch 1 stopped after its delta
    torn = CubeStore(spark, f"{tmp_path}/torn")
    torn.commit(zero, 0)
    source, target = f"{store.root}/deltas/batch_id=1", f"{torn.root}/deltas/batch_id=1"
    spark.read.parquet(source).write.parquet(target)
    assert tuples(torn.cube()) == before
    torn.commit(six, 1)
    assert tuples(torn.cube()) == complete


def test_plain_folders_stream(spark, tmp_path, golden_orders):
    raw = tmp_path / "raw"
    header = "order_id,order_dow,order_hour_of_day,days_since_prior_order,milk,fresh fruits,eggs\n"
    for day, text in ((0, "1,0,9,,2,0,3\n2,0,9,5.0,1,,0\n"), (6, "3,6,23,7.0,0,4,-2\n"), (3, "4,3,0,1.0,0,0,0\n")):
        (raw / str(day)).mkdir(parents=True)
        (raw / str(day) / f"orders_{day}.csv").write_text(header + text)
    store = CubeStore(spark, f"{tmp_path}/store")
    run_once(day_stream(spark, str(raw), files.order_schema(golden_orders.columns), plain=True), store)
    assert tuples(store.cube()) == GOLDEN_CUBE
    assert {r.day for r in store.processed_days().collect()} == {0, 3, 6}


def test_days_with_their_own_columns(spark, tmp_path):
    raw, header = tmp_path / "raw", "order_id,order_dow,order_hour_of_day,days_since_prior_order"
    for day, columns, text in ((2, "milk,tea", "1,2,9,,2,1\n"), (0, "tea", "2,0,9,,4\n"), (10, "eggs", "3,2,9,,\n")):
        (raw / str(day)).mkdir(parents=True)
        (raw / str(day) / f"orders_{day}.csv").write_text(f"{header},{columns}\n{text}")
    store = CubeStore(spark, f"{tmp_path}/store")
    assert fold_unprocessed_days(spark, str(raw), store) == [0, 2, 10]
    assert fold_unprocessed_days(spark, str(raw), store) == []
    assert tuples(store.cube()) == {(2, 9, "milk", 2), (2, 9, "tea", 1), (0, 9, "tea", 4)}
    assert dict(store.processed_days().collect()) == {0: 0, 2: 1, 10: 2}
    (raw / "day=3").mkdir()
    (raw / "day=3" / "part.csv").write_text(f"{header},milk\n5,3,1,,7.0\n")
    assert fold_unprocessed_days(spark, str(raw), store, count_type="double") == [3]
    assert (3, 1, "milk", 7) in tuples(store.cube())


def test_failing_hook_is_raised_and_the_batch_survives(spark, tmp_path, land):
    store = CubeStore(spark, f"{tmp_path}/store")

    def fail(store, batch_id):
        raise RuntimeError("hook")

    with pytest.raises(Exception, match="hook"):
        land(store, 0, 3, 6, on_commit=fail)
    land(store)
    assert tuples(store.cube()) == GOLDEN_CUBE
    assert tuples(store.day_report()) == {(0, 2, 0), (6, 1, 0), (3, 1, 0)}


def test_retrainer_only_trains_on_change(spark, tmp_path, golden_orders):
    store = CubeStore(spark, f"{tmp_path}/store")
    retrain = jobs.Retrainer(spark, f"{tmp_path}/training")
    assert retrain(store) is False
    orders = spark.range(400).selectExpr(
        "id order_id", "cast(id % 7 as int) order_dow", "cast(id % 24 as int) order_hour_of_day",
        "cast(null as double) days_since_prior_order", "id % 5 + 1 milk", "id % 3 + 1 eggs", "cast(id % 7 as int) day",
    )
    store.commit(orders, 0)
    assert retrain(store) is True
    assert retrain(store) is False
    assert retrain.trained_through(spark) == 0
    assert retrain.metrics(spark).where("is_selected").count() == 1


def test_day_sets(spark):
    available = spark.createDataFrame([(1,), (2,), (5,)], "day int")
    ledger = spark.createDataFrame([(5, 0), (1, 1), (9, 1)], "day int, batch_id bigint")
    assert [r.day for r in days.unprocessed_days(available, ledger).collect()] == [2]
    assert days.last_processed_day(ledger).first()[0] == 9
    assert tuple(days.processing_status(available, ledger).first()) == (3, 3, 1, 2, 9)
    assert tuples(days.day_states(available, ledger)) == {
        (1, True, True),
        (2, True, False),
        (5, True, True),
        (9, False, True),
    }
    assert tuples(days.ledger_differences(available, ledger)) == {(2, "first"), (9, "second")}
    assert days.ledger_differences(ledger, ledger).isEmpty()


def test_last_day_is_the_last_written(spark):
    ledger = spark.createDataFrame([(6, 0), (0, 1), (3, 2)], "day int, batch_id bigint")
    for order in permutations(range(3)):
        rows = [ledger.collect()[i] for i in order]
        assert days.last_processed_day(spark.createDataFrame(rows, ledger.schema)).first()[0] == 3


def test_old_files_are_read_too(spark, tmp_path, land):
    store = CubeStore(spark, f"{tmp_path}/store")
    land(store, 0)
    files.split_by_day(golden(spark, 6), f"{tmp_path}/aside", F.col("order_dow"))
    for file in Path(f"{tmp_path}/aside/day=6").iterdir():
        os.utime(file, (0, 86_400 * 365))
    os.rename(f"{tmp_path}/aside/day=6", f"{land.landing}/day=6")
    land(store, 3)
    assert tuples(store.cube()) == GOLDEN_CUBE


def golden(spark, day):
    return spark.createDataFrame(GOLDEN_ORDERS, ORDER_COLUMNS + ", milk int, `fresh fruits` int, eggs int").where(F.col("order_dow") == day)


def test_feeders_do_not_hide_each_other(spark, tmp_path, land):
    store = CubeStore(spark, f"{tmp_path}/store")
    files.split_by_day(golden(spark, 0), f"{tmp_path}/folded", F.col("order_dow"))
    assert fold_unprocessed_days(spark, f"{tmp_path}/folded", store) == [0]
    land(store, 3, 6)  # the stream's first batch has number 0 as well
    assert tuples(store.cube()) == GOLDEN_CUBE and store.committed_through() == 1


def test_a_day_without_rows_is_committed_once(spark, tmp_path):
    store, folder = CubeStore(spark, f"{tmp_path}/store"), tmp_path / "raw" / "day=4"
    folder.mkdir(parents=True)
    (folder / "orders_4.csv").write_text("order_id,order_dow,order_hour_of_day,days_since_prior_order,milk\n")
    assert fold_unprocessed_days(spark, f"{tmp_path}/raw", store) == [4]
    assert fold_unprocessed_days(spark, f"{tmp_path}/raw", store) == []
    assert store.cube().count() == 0


def test_a_cube_without_rows_trains_nothing(spark, tmp_path, land):
    store, retrain = CubeStore(spark, f"{tmp_path}/store"), jobs.Retrainer(spark, f"{tmp_path}/training")
    land(store, 3, on_commit=retrain)  # day 3 has no positive count
    assert retrain.trained_through(spark) is None
    land(store, 0, on_commit=retrain)
    assert tuples(store.cube()) == {c for c in GOLDEN_CUBE if c[0] == 0}


def test_exported_categories_are_read_back_as_they_are(spark, tmp_path):
    names = ["milk", " milk", "milk ", "", "a,b", 'say "hi"', "back\\slash", '\\"', "\\N?"]
    cube = spark.createDataFrame([(0, 1, name, i) for i, name in enumerate(names)], files.CUBE_SCHEMA)
    files.export_cube_csv(cube, f"{tmp_path}/cube")
    assert tuples(files.read_cube_csv(spark, f"{tmp_path}/cube")) == tuples(cube)


def test_fractions_do_not_hide_in_a_sum(spark):
    orders = spark.createDataFrame([(1, 0, 9, None, 1.5), (2, 0, 9, None, 1.5)], ORDER_COLUMNS + ", milk double")
    with pytest.raises(Exception, match="whole number"):
        wide_to_cells(orders).collect()


def test_readers_open_few_deltas(spark, tmp_path):
    store, orders = CubeStore(spark, f"{tmp_path}/store"), golden(spark, 0)
    for number in range(5):
        store.commit(orders.withColumn("day", F.lit(number)), number)
        store.compact_if_due(every=2)
        assert store.committed_through() - (-1 if store.snapshot_through() is None else store.snapshot_through()) < 2
    assert tuples(store.cube()) == {(d, h, c, 5 * n) for d, h, c, n in GOLDEN_CUBE if d == 0}
