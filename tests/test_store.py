"""The store after very many commits, folding by header, supervision, and prediction versions."""

from __future__ import annotations

import shutil
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from conftest import GOLDEN_CUBE, ORDER_COLUMNS, tuples
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from demandgrid.operators import training
from demandgrid.operators.cube import cube_from_orders, cube_from_sparse_orders
from demandgrid.operators.reshape import wide_to_cells_sparse
from demandgrid.operators.scoring import PredictionStore
from demandgrid.sources import files, folders
from demandgrid.streaming import CubeStore, day_stream, fold_unprocessed_days, poll

HEADER = "order_id,order_dow,order_hour_of_day,days_since_prior_order"


def of_day(orders, day, number):
    return orders.where(F.col("order_dow") == day).withColumn("day", F.lit(number))


def folder_numbers(root, kind):
    return sorted(int(p.name.split("=")[1]) for p in Path(f"{root}/{kind}").iterdir() if "=" in p.name)


def test_after_a_thousand_commits_a_commit_opens_few_paths(spark, tmp_path, golden_orders):
    store = CubeStore(spark, f"{tmp_path}/store")
    store.commit(of_day(golden_orders, 0, 0), 0)
    for number in range(1, 1000):  # the same batch again and again, as if each had been committed
        for kind in ("ledger", "deltas"):
            shutil.copytree(f"{store.root}/{kind}/batch_id=0", f"{store.root}/{kind}/batch_id={number}")
    assert store.committed_through() == 999
    assert store.compact() == 999
    for number in (1000, 1001):
        store.commit(of_day(golden_orders, 6, number), number)
    assert store.committed_through() == 1001 and store.snapshot_through() == 999
    assert len(store.ledger().inputFiles()) <= 4 and len(store.cube().inputFiles()) <= 12
    assert store.ledger().count() == 1002
    before = tuples(store.cube())
    assert before == {(0, 9, "eggs", 3000), (0, 9, "milk", 3000), (6, 23, "fresh fruits", 8)}
    removed = store.expire(keep=1)
    assert removed["deltas"] == removed["ledger"] == 1000 and folder_numbers(store.root, "deltas") == [1000, 1001]
    assert tuples(store.cube()) == before and store.ledger().count() == 1002
    assert store.commit(of_day(golden_orders, 6, 1001), 1001) == 1001  # known from an entry
    assert store.commit(of_day(golden_orders, 3, 1002), 1002) == 1002


def test_expiry_keeps_what_kept_snapshots_need(spark, tmp_path, golden_orders):
    store = CubeStore(spark, f"{tmp_path}/store")
    assert store.expire() == {}
    for number, day in enumerate((0, 6, 3)):
        store.commit(of_day(golden_orders, day, day), number)
        store.compact()
    older = store._cube(1, 1)
    assert store.expire(keep=2)["snapshots"] == 1
    assert folder_numbers(store.root, "snapshots") == [1, 2] and folder_numbers(store.root, "deltas") == [2]
    assert tuples(older) == tuples(store.cube()) == GOLDEN_CUBE
    assert dict(store.processed_days().collect()) == {0: 0, 6: 1, 3: 2}
    assert store.expire(keep=2) == {k: 0 for k in ("snapshot_log", "snapshots", "folded_ledger", "deltas", "ledger")}
    assert store.commit(of_day(golden_orders, 0, 0), 0) == 0  # a repeated batch is known from the folded ledger
    with pytest.raises(ValueError, match="newest"):
        store.expire(keep=0)


def test_an_unfinished_snapshot_is_not_used(spark, tmp_path, golden_orders):
    store = CubeStore(spark, f"{tmp_path}/store")
    store.commit(of_day(golden_orders, 0, 0), 0)
    Path(f"{store.root}/snapshot_log/upto=0").mkdir(parents=True)
    assert store.snapshot_through() is None and store.cube().count() == 2
    assert store.compact() == 0 and store.cube().count() == 2


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_jobs_of_folding_go_with_headers_not_days(spark, tmp_path):
    counts = {}
    for days in (8, 30):
        raw, store = tmp_path / f"raw{days}", CubeStore(spark, f"{tmp_path}/store{days}")
        for day in range(days):
            (raw / str(day)).mkdir(parents=True)
            (raw / str(day) / "orders.csv").write_text(f"{HEADER},milk\n{day},{day % 7},9,,{day + 1}\n")
        counts[days] = jobs_of(spark, f"fold{days}", lambda raw=raw, store=store: fold_unprocessed_days(spark, str(raw), store))
        assert store.committed_through() == 0 and store.cube().agg(F.sum("items_count")).first()[0] == days * (days + 1) // 2
    assert counts[30] <= counts[8] + 2  # adaptive execution may take a job more; a batch for each day would take hundreds


def test_files_of_one_day_may_differ(spark, tmp_path):
    raw, store = tmp_path / "raw", CubeStore(spark, f"{tmp_path}/store")
    for day, name, columns, line in ((1, "a", "milk,tea", "1,1,9,,2,1"), (1, "b", "eggs", "2,1,9,,4"), (2, "a", "eggs", "3,2,9,,5"), (3, "a", "milk,tea", "4,3,9,,1,1")):
        (raw / str(day)).mkdir(parents=True, exist_ok=True)
        (raw / str(day) / f"{name}.csv").write_text(f"{HEADER},{columns}\n{line}\n")
    (raw / "4").mkdir()
    (raw / "4" / "empty.csv").write_text("")
    assert fold_unprocessed_days(spark, str(raw), store) == [1, 2, 3, 4]
    assert tuples(store.cube()) == {(1, 9, "milk", 2), (1, 9, "tea", 1), (1, 9, "eggs", 4), (2, 9, "eggs", 5), (3, 9, "milk", 1), (3, 9, "tea", 1)}
    assert dict(store.processed_days().collect()) == {1: 0, 2: 1, 3: 2, 4: 3}
    assert fold_unprocessed_days(spark, str(raw), store) == []


@pytest.mark.parametrize("failures", [1, 2])
def test_polling_is_restarted_once(spark, tmp_path, golden_orders, failures):
    landing, store, left = f"{tmp_path}/landing", CubeStore(spark, f"{tmp_path}/store"), [failures]

    def hook(store, batch_id):
        if left[0]:
            left[0] -= 1
            raise RuntimeError("hook")

    files.split_by_day(golden_orders, landing, F.col("order_dow"))
    days = day_stream(spark, landing, files.order_schema(golden_orders.columns))
    polling = poll(days, store, "1 second", hook, wait_seconds=0.1)
    try:
        if failures == 1:
            polling.process_all_available()
            assert polling.await_termination(timeout=0.5) is False
        else:
            with pytest.raises(StreamingQueryException, match="hook"):
                polling.process_all_available()
    finally:
        polling.stop()
    assert tuples(store.cube()) == GOLDEN_CUBE and store.committed_through() == 0


def test_two_refreshes_write_two_versions(spark, tmp_path, monkeypatch):
    store = PredictionStore(spark, f"{tmp_path}/predictions")
    rows = spark.createDataFrame([(0, 9, "milk", 1.0)], "day_of_week int, hour_of_day int, category string, prediction double")
    monkeypatch.setattr(store, "latest", lambda: None)  # both look before either has written
    with ThreadPoolExecutor(2) as pool:
        versions = sorted(pool.map(lambda n: store.refresh(rows.withColumn("prediction", F.lit(float(n)))), (1, 2)))
    assert versions == [1, 2]
    assert sorted(store.read(v).first().prediction for v in versions) == [1.0, 2.0]
    monkeypatch.undo()
    assert store.refresh(rows) == 3 and store.expire(keep=1) == [1, 2]
    assert store.latest() == 3 and store.read().count() == 1 and store.metadata().count() == 1
    assert not folders.holds_file(spark, f"{store.root}/predictions/version=1/day_of_week=0")


def test_plain_layout_is_written_and_read(spark, tmp_path, golden_orders):
    raw = f"{tmp_path}/raw"
    files.split_plain(golden_orders, raw, f"{tmp_path}/staging", F.col("order_dow"))
    assert {p.name for p in Path(raw).iterdir()} == {"0", "3", "6"}
    back = files.read_plain_days(spark, raw, files.order_schema(golden_orders.columns))
    assert tuples(cube_from_orders(back.drop("day"))) == GOLDEN_CUBE
    with pytest.raises(FileExistsError, match="0, 3, 6"):
        files.split_plain(golden_orders, raw, f"{tmp_path}/again", F.col("order_dow"))


def test_sparse_cube_is_the_cube(spark, golden_orders):
    assert tuples(cube_from_sparse_orders(golden_orders)) == GOLDEN_CUBE
    assert wide_to_cells_sparse(golden_orders.select("order_id", "order_dow", "order_hour_of_day")).count() == 0
    fractions = spark.createDataFrame([(1, 0, 9, None, 1.5), (2, 0, 9, None, 1.5)], ORDER_COLUMNS + ", milk double")
    with pytest.raises(Exception, match="whole number"):
        wide_to_cells_sparse(fractions).collect()
    many = spark.range(50).selectExpr("id order_id", "cast(id % 7 as int) order_dow", "cast(id % 24 as int) order_hour_of_day", *[f"(id + {i}) % {i + 2} as `c {i}`" for i in range(120)])
    assert tuples(cube_from_sparse_orders(many)) == tuples(cube_from_orders(many))


def test_entries_are_the_values_of_the_dense_rows(spark):
    cells = [(d, h, c, 1.0 + d) for d in (0, 3) for h in (0, 23) for c in ("milk", "eggs", "fresh fruits")]
    rows = spark.createDataFrame(cells, "day_of_week int, hour_of_day int, category_clean string, total_count double")
    entries = tuples(training.feature_entries(rows))
    dense = tuples(training.feature_values(rows))
    assert {e for e in entries if e[4] != 0} == {e for e in dense if e[4] != 0}
    assert len(entries) == 3 * len(cells) and entries <= dense


def test_back_off_reaches_every_cell(spark):
    rows = spark.createDataFrame([(d, h, c, 1.0 + h) for d in range(7) for h in range(3) for c in ("a", "b")], "day_of_week int, hour_of_day int, category_clean string, total_count double")
    cells = spark.createDataFrame([(0, 1, "a"), (0, 20, "a"), (0, 20, "never seen")], "day_of_week int, hour_of_day int, category_clean string")
    found = {(r.hour_of_day, r.category_clean): r for r in training.back_off_means(cells, rows).collect()}
    assert found[1, "a"].hour_mean == 2.0
    assert found[20, "a"].hour_mean == found[20, "a"].category_mean
    unseen = found[20, "never seen"]
    assert unseen.hour_mean == unseen.category_mean == unseen.grand_mean is not None


def test_cell_tree_returns_what_it_was_given(spark):
    # counts of which no split of day, hour and category has a gain
    rows = [(d, h, c, 1.0 + (d + h + len(c)) % 2) for d in range(2) for h in range(2) for c in ("a", "bb")]
    cells = spark.createDataFrame(rows, "day_of_week int, hour_of_day int, category_clean string, total_count double")
    model = training.fit_cell_tree(cells)
    assert model.transform(cells).where("prediction != total_count").count() == 0
