"""The checked queries, each a function of a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.functions import fields
from demandgrid.functions.fields import CELL_KEYS
from demandgrid.operators import cube as cubes
from demandgrid.operators import days, lookup, metrics, scoring, training
from demandgrid.operators.grid import demand_grid
from demandgrid.operators.reshape import category_coverage, wide_to_long
from demandgrid.plans import jobs
from demandgrid.session import materialize, shared_dir
from demandgrid.sources import files
from demandgrid.sources import relations as rel
from demandgrid.streaming import CubeStore, day_stream, fold_unprocessed_days, poll, run_once, start

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

PREDICTION = [*CELL_KEYS, "prediction"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- relations and full aggregation ---


@query
def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.wide_orders(spark, sf_dir)


@query
def cube_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.sorted_cube(cubes.cube_from_orders(rel.wide_orders(spark, sf_dir, with_prior=False)))


@query
def cube_full_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.cube_from_sparse_orders(rel.wide_orders(spark, sf_dir, with_prior=False))


@query
def cube_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.cube_from_rows(rel.event_rows(spark, sf_dir))


@query
def cube_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.cube_from_rows(rel.lineitem_rows(spark, sf_dir))


@query
def category_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_coverage(rel.wide_orders(spark, sf_dir))


@query
def wide_to_long_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_long(rel.wide_orders(spark, sf_dir, with_prior=False))


@query
def cube_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.cube_summary(cubes.cube_from_orders(rel.wide_orders(spark, sf_dir, with_prior=False)))


@query
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.sample_rows(cubes.cube_from_orders(rel.wide_orders(spark, sf_dir, with_prior=False)))


@query
def distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.distinct_days(rel.event_rows(spark, sf_dir), F.col("day_of_week"))


@query
def full_aggregation_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = shared_dir(spark, "raw")
    files.split_by_day(rel.wide_orders(spark, sf_dir), raw, F.col("order_dow"))
    return jobs.full_aggregation_csv(spark, f"{raw}/*/*.csv", shared_dir(spark, "cube"))


# --- files ---


@query
def day_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = rel.event_rows(spark, sf_dir).drop("day")
    root = shared_dir(spark, "split")
    files.split_by_day(events, root, F.col("day_of_week"), "parquet")
    return cubes.rows_per_day(files.read_days(spark, root, events.schema, "parquet"), F.col("day"))


@query
def single_day_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = rel.wide_orders(spark, sf_dir)
    root = shared_dir(spark, "split")
    files.split_by_day(orders, root, F.col("order_dow"))
    saturday = files.read_day(spark, root, 6, files.order_schema(orders.columns)).drop("day")
    return cubes.cube_from_orders(saturday)


@query
def plain_layout_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written to digit-named folders and read back from them."""
    orders = rel.wide_orders(spark, sf_dir)
    raw = shared_dir(spark, "raw")
    files.split_plain(orders, raw, shared_dir(spark, "staging"), F.col("order_dow"))
    return cubes.cube_from_orders(files.read_plain_days(spark, raw, files.order_schema(orders.columns)).drop("day"))


@query
def csv_roundtrip_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, out = shared_dir(spark, "raw"), shared_dir(spark, "export")
    files.split_by_day(rel.wide_orders(spark, sf_dir), raw, F.col("order_dow"))
    files.export_cube_csv(cubes.cube_from_orders(files.read_orders_csv(spark, f"{raw}/*/*.csv")), out)
    return files.read_cube_csv(spark, out)


@query
def cube_source_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No full cube has been written, so the incremental one is used."""
    incremental = shared_dir(spark, "cube")
    files.write_cube(cube_events(spark, sf_dir), incremental)
    return files.choose_cube(spark, shared_dir(spark, "cube"), incremental)


@query
def landed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.available_days(spark, _land_events(spark, sf_dir)[0], "parquet")


# --- ledgers ---


@query
def unprocessed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.unprocessed_days(rel.shipping_days(spark, sf_dir), rel.ordering_ledger(spark, sf_dir))


@query
def day_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.day_states(rel.shipping_days(spark, sf_dir), rel.ordering_ledger(spark, sf_dir))


@query
def processing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.processing_status(rel.shipping_days(spark, sf_dir), rel.ordering_ledger(spark, sf_dir))


@query
def last_processed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.last_processed_day(rel.ordering_ledger(spark, sf_dir))


@query
def ledger_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.ledger_differences(rel.ordering_ledger(spark, sf_dir), rel.shipping_days(spark, sf_dir))


# --- incremental cube ---


def _land_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Wide orders split by day of week and ready to arrive, and an empty landing folder."""
    orders = rel.wide_orders(spark, sf_dir)
    staged = shared_dir(spark, "staged")
    files.split_by_day(orders, staged, F.col("order_dow"), "parquet")
    return files.read_days(spark, staged, orders.schema, "parquet"), shared_dir(spark, "landing")


def _land_events(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Wide events landed by calendar day."""
    events = rel.wide_events(spark, sf_dir)
    landing = shared_dir(spark, "landing")
    files.split_by_day(events, landing, F.col("day"), "parquet")
    return landing, events


def _arrive(staged: DataFrame, landing: str, condition, fmt: str = "csv") -> None:
    staging = shared_dir(staged.sparkSession, "staging")
    files.land_days(staged.where(condition), landing, staging, F.col("day"), fmt)


def _three_arrivals(spark: SparkSession, sf_dir: str) -> tuple[CubeStore, DataFrame, str]:
    """All days, in three arrivals that are not in calendar order, each followed by a run."""
    staged, landing = _land_orders(spark, sf_dir)
    schema = files.order_schema([c for c in staged.columns if c != "day"])
    store = CubeStore(spark, shared_dir(spark, "store"))
    day = F.col("day")
    for arrival in (day.isin(6, 0), day == 3, day.isin(1, 2, 4, 5)):
        _arrive(staged, landing, arrival)
        run_once(day_stream(spark, landing, schema), store)
    return store, staged, landing


@query
def incremental_cube_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _three_arrivals(spark, sf_dir)[0].cube()


@query
def incremental_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _, _ = _three_arrivals(spark, sf_dir)
    store.compact()
    return store.cube()


@query
def incremental_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot after each of three batches, then all that only older ones need is removed and a day repeated."""
    staged, _ = _land_orders(spark, sf_dir)
    store, day = CubeStore(spark, shared_dir(spark, "store")), F.col("day")
    for number, arrival in enumerate((day.isin(6, 0), day == 3, day.isin(1, 2, 4, 5))):
        store.commit(staged.where(arrival), number)
        if number < 2:
            store.compact()
    store.expire(keep=1)
    store.commit(staged.where(day == 3), 1)
    return store.cube()


@query
def incremental_expired_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of days after its entries were folded and removed."""
    store, _, _ = _three_arrivals(spark, sf_dir)
    store.compact()
    store.expire(keep=1)
    return store.processed_days()


@query
def incremental_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, staged, _ = _three_arrivals(spark, sf_dir)
    first = store.ledger().where(F.col("batch_id") == 1).first()
    store.commit(staged.where(F.col("day") == 3), first.feeder_batch, first.feeder)
    return store.cube()


@query
def incremental_mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days folded one by one, the others by a stream whose batch numbers begin anew."""
    staged, folded = _land_orders(spark, sf_dir)
    schema = files.order_schema([c for c in staged.columns if c != "day"])
    store, landing = CubeStore(spark, shared_dir(spark, "store")), shared_dir(spark, "landing")
    _arrive(staged, folded, F.col("day").isin(1, 4))
    fold_unprocessed_days(spark, folded, store, count_type="double")
    _arrive(staged, landing, ~F.col("day").isin(1, 4))
    run_once(day_stream(spark, landing, schema), store)
    return store.cube()


@query
def incremental_torn_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch whose delta was written but not its ledger entry is rewritten, not counted twice."""
    staged, _ = _land_orders(spark, sf_dir)
    store = CubeStore(spark, shared_dir(spark, "store"))
    store.commit(staged.where(F.col("day") < 3), 0)
    torn = CubeStore(spark, shared_dir(spark, "store"))
    torn.commit(staged.where(F.col("day") < 3), 0)
    delta = spark.read.parquet(f"{torn.root}/deltas/batch_id=0")
    delta.write.parquet(f"{store.root}/deltas/batch_id=1")
    store.commit(staged.where(F.col("day") >= 3), 1)
    return store.cube()


@query
def incremental_no_new_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A further run finds nothing: the ledger keeps its days and batches."""
    store, staged, landing = _three_arrivals(spark, sf_dir)
    schema = files.order_schema([c for c in staged.columns if c != "day"])
    run_once(day_stream(spark, landing, schema), store)
    return store.processed_days()


@query
def incremental_folded_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day folders folded one by one, each read with its own header."""
    staged, landing = _land_orders(spark, sf_dir)
    store = CubeStore(spark, shared_dir(spark, "store"))
    _arrive(staged, landing, F.lit(True))
    fold_unprocessed_days(spark, landing, store, count_type="double")
    return store.cube()


@query
def incremental_folded_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose files have columns of their own: one batch for each set of columns."""
    staged, landing = _land_orders(spark, sf_dir)
    store, day = CubeStore(spark, shared_dir(spark, "store")), F.col("day")
    for part, days_of_part in enumerate(((0, 3), (1, 2, 5), (4, 6))):
        own = staged.where(day.isin(*days_of_part)).withColumn(f"ONLY {part}", F.lit(1.0))
        _arrive(own, landing, F.lit(True))
    fold_unprocessed_days(spark, landing, store, count_type="double")
    return store.cube().join(store.processed_days().toDF("day_of_week", "batch_id"), "day_of_week")


def _late_copy(spark: SparkSession, sf_dir: str) -> CubeStore:
    """After all days are in, day 0 arrives a second time."""
    staged, landing = _land_orders(spark, sf_dir)
    schema = files.order_schema([c for c in staged.columns if c != "day"])
    store = CubeStore(spark, shared_dir(spark, "store"))
    for arrival in (F.lit(True), F.col("day") == 0):
        _arrive(staged, landing, arrival)
        run_once(day_stream(spark, landing, schema), store)
    return store


@query
def late_day_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_copy(spark, sf_dir).cube()


@query
def late_day_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_copy(spark, sf_dir).day_report()


EARLY_DAYS, LATER_DAYS = "day <= 20240115", "day > 20240115"


@query
def incremental_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polling query picks up two arrivals of calendar days."""
    events = rel.wide_events(spark, sf_dir)
    landing, store = shared_dir(spark, "landing"), CubeStore(spark, shared_dir(spark, "store"))
    _arrive(events, landing, EARLY_DAYS, "parquet")
    polling = start(day_stream(spark, landing, events.schema, "parquet"), store, every="4 seconds")
    try:
        polling.processAllAvailable()
        _arrive(events, landing, LATER_DAYS, "parquet")
        polling.processAllAvailable()
    finally:
        polling.stop()
    return store.cube()


@query
def incremental_supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polling query whose first batch fails after its commit is started anew and counts nothing twice."""
    events = rel.wide_events(spark, sf_dir)
    landing, store = shared_dir(spark, "landing"), CubeStore(spark, shared_dir(spark, "store"))
    failures = ["once"]

    def fail_once(store: CubeStore, batch_id: int) -> None:
        if failures:
            raise RuntimeError(failures.pop())

    _arrive(events, landing, EARLY_DAYS, "parquet")
    polling = poll(day_stream(spark, landing, events.schema, "parquet"), store, "1 second", fail_once, wait_seconds=0.0)
    try:
        polling.process_all_available()
        _arrive(events, landing, LATER_DAYS, "parquet")
        polling.process_all_available()
    finally:
        polling.stop()
    return store.cube()


# --- training ---


def _event_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event cube as a written table, since training and scoring read it repeatedly."""
    return materialize(cube_events(spark, sf_dir), "cube")


@query
def normalize_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = rel.table(spark, sf_dir, "part")
    spellings = F.create_map(
        F.lit("name"), F.col("p_name"),
        F.lit("shouted"), F.concat(F.lit("  "), F.upper(F.translate("p_name", " ", "_")), F.lit(" ")),
        F.lit("brand"), F.col("p_brand"),
    )
    return part.select("p_partkey", F.explode(spellings).alias("spelling", "category")).withColumn(
        "category_clean", fields.normalize_category(F.col("category"))
    )


@query
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.training_rows(cube_lineitem(spark, sf_dir))


@query
def training_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.training_summary(training_rows(spark, sf_dir))


@query
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.with_split(training_rows(spark, sf_dir))


@query
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.category_index(training.training_rows(_event_cube(spark, sf_dir)))


@query
def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.feature_values(training.training_rows(_event_cube(spark, sf_dir)))


@query
def feature_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.feature_entries(training.training_rows(_event_cube(spark, sf_dir)))


@query
def feature_entries_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.feature_entries(materialize(training_rows(spark, sf_dir), "training-rows"))


@query
def rmse_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training.training_rows(_event_cube(spark, sf_dir))
    test = training.with_split(rows).where("not is_train").withColumnRenamed("category_clean", "category")
    scored = training.score_with_means(test, rows)
    rounded = fields.round_prediction(F.col("prediction"))
    return scored.agg(F.round(metrics.rmse(F.col(training.LABEL), rounded), 6).alias("rmse"))


@query
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three mean predictors compared on the test cells."""
    rows = training.training_rows(_event_cube(spark, sf_dir))
    by_hour, overall = training.mean_predictor(rows)
    everything = training.with_split(rows).where("is_train").agg(F.avg(training.LABEL).alias("grand_mean"))
    test = (
        training.with_split(rows)
        .where("not is_train")
        .join(by_hour, ["category_clean", "hour_of_day"])
        .join(overall, "category_clean")
        .withColumn("grand_mean", everything.scalar())
    )
    names = ["grand_mean", "category_mean", "hour_mean"]
    errors = test.agg(*[metrics.rmse(F.col(training.LABEL), F.col(c)).alias(c) for c in names])
    table = errors.unpivot([], names, "candidate", "rmse").select(
        F.array_position(F.array(*[F.lit(c) for c in names]), F.col("candidate")).cast("int").alias("position"),
        "candidate",
        "rmse",
    )
    return metrics.best_candidate(table).withColumn("rmse", F.round("rmse", 6))


@query
def back_off_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three mean predictors compared on all test cells; a mean that is missing is stood in for by the next."""
    rows = materialize(training.training_rows(cube_lineitem(spark, sf_dir)), "training-rows")
    test = training.back_off_means(training.with_split(rows).where("not is_train"), rows)
    names = ["grand_mean", "category_mean", "hour_mean"]
    errors = test.agg(
        F.count(F.lit(1)).alias("compared_cells"),
        *[F.round(metrics.rmse(F.col(training.LABEL), F.col(c)), 6).alias(c) for c in names],
    )
    table = errors.unpivot("compared_cells", names, "candidate", "rmse").select(
        F.array_position(F.array(*[F.lit(c) for c in names]), F.col("candidate")).cast("int").alias("position"),
        "candidate", "rmse", "compared_cells",
    )
    best = metrics.best_candidate(table).select(F.col("position").alias("best"))
    return table.join(best, F.lit(True)).select("candidate", "rmse", "compared_cells", (F.col("position") == F.col("best")).alias("is_selected"))


def _isolating_model(spark: SparkSession, sf_dir: str):
    """The event cube and a tree that returns the count of each of its cells."""
    cube = _event_cube(spark, sf_dir)
    return cube, training.fit_cell_tree(training.training_rows(cube))


@query
def isolating_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell scored by a saved and reloaded tree that isolates it: the score is its count."""
    cube, model = _isolating_model(spark, sf_dir)
    path = shared_dir(spark, "model")
    training.save_model(model, path)
    return scoring.score(cube.select(*CELL_KEYS), training.load_model(path))


@query
def least_squares_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell scored by ordinary least squares on day, hour and category."""
    cube = _event_cube(spark, sf_dir)
    model = training.fit_estimator(training.training_rows(cube), training.least_squares())
    return scoring.score(cube.select(*CELL_KEYS), model)


@query
def train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.train_candidates(training.training_rows(_event_cube(spark, sf_dir))).metrics


@query
def train_evaluate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the candidate table must fulfil: sizes of the split, no failure, the lowest error selected."""
    table = materialize(train_evaluate(spark, sf_dir), "candidates")
    best = table.agg(F.min_by("position", F.struct("rmse", "position"))).first()[0]
    return table.select(
        "position", "candidate", "train_rows", "test_rows", F.col("failure").isNotNull().alias("failed"),
        (F.col("is_selected") == (F.col("position") == F.lit(best))).alias("lowest_error_is_selected"),
    )


@query
def model_roundtrip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell scored by the trained and by the saved and reloaded model."""
    cube = _event_cube(spark, sf_dir)
    trained = training.train_candidates(training.training_rows(cube))
    path = shared_dir(spark, "model")
    training.save_model(trained.model, path)
    once = scoring.score(cube.select(*CELL_KEYS), trained.model)
    again = scoring.score(once.select(*CELL_KEYS, F.col("prediction").alias("before")), training.load_model(path))
    return again.select(*CELL_KEYS, "known_category", (F.col("before") == F.col("prediction")).alias("is_same"))


def _two_arrivals(spark: SparkSession, sf_dir: str, on_commit) -> CubeStore:
    """Event days in two arrivals with a hook on each commit, then a run without new days."""
    events = rel.wide_events(spark, sf_dir)
    landing, store = shared_dir(spark, "landing"), CubeStore(spark, shared_dir(spark, "store"))
    for arrival in (EARLY_DAYS, LATER_DAYS):
        _arrive(events, landing, arrival, "parquet")
        run_once(day_stream(spark, landing, events.schema, "parquet"), store, on_commit)
    run_once(day_stream(spark, landing, events.schema, "parquet"), store, on_commit)
    return store


@query
def retrain_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals train twice; a run without new days does not."""
    retrain = jobs.Retrainer(spark, shared_dir(spark, "training"))
    _two_arrivals(spark, sf_dir, retrain)
    return (
        retrain.metrics(spark)
        .groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("candidates"),
            F.count_if("is_selected").alias("selected"),
            F.max("train_rows").alias("train_rows"),
            F.max("test_rows").alias("test_rows"),
        )
    )


@query
def refresh_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each retrained model is served once, as a new version of the prediction table."""
    retrain = jobs.Retrainer(spark, shared_dir(spark, "training"))
    predictions = scoring.PredictionStore(spark, shared_dir(spark, "predictions"))

    def retrain_and_serve(store: CubeStore, batch_id: int) -> None:
        retrain(store, batch_id)
        jobs.refresh_if_retrained(store, retrain, predictions)

    jobs.refresh_if_retrained(_two_arrivals(spark, sf_dir, retrain_and_serve), retrain, predictions)
    return predictions.metadata().drop("last_updated")


# --- grid, scoring and serving ---


def stored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored prediction table of the event categories, scored with means."""
    cube = _event_cube(spark, sf_dir)
    store = scoring.PredictionStore(spark, shared_dir(spark, "predictions"))
    store.refresh(training.score_with_means(demand_grid(cube), training.training_rows(cube)))
    return store.read()


@query
def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand_grid(rel.event_rows(spark, sf_dir))


@query
def grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = _event_cube(spark, sf_dir)
    return scoring.score_grid(cube, training.train_candidates(training.training_rows(cube)).model)


@query
def grid_scores_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the grid is scored, with its category known to the model."""
    return grid_scores(spark, sf_dir).select(*CELL_KEYS, "known_category", F.col("prediction").isNotNull().alias("has_prediction"))


@query
def seasonal_adjustment(spark: SparkSession, sf_dir: str) -> DataFrame:
    adjusted = fields.seasonal_count(F.col("items_count"), F.col("day_of_week"), F.col("hour_of_day"))
    return cube_events(spark, sf_dir).withColumn("adjusted_count", adjusted)


@query
def prediction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_predictions(spark, sf_dir).select("key", *PREDICTION)


@query
def prediction_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = _event_cube(spark, sf_dir)
    store = scoring.PredictionStore(spark, shared_dir(spark, "predictions"))
    store.refresh(training.score_with_means(demand_grid(cube), training.training_rows(cube)))
    return store.metadata().drop("last_updated")


@query
def prediction_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.col(c) for c in ("prediction", "day_of_week", "hour_of_day", "category", "cached_at")]
    encoded = stored_predictions(spark, sf_dir).select("key", fields.prediction_json(*columns).alias("value"))
    decoded = encoded.select("key", fields.parse_prediction(F.col("value")).alias("r"))
    return decoded.select("key", "r.*").drop("cached_at")


@query
def key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.key_requests(stored_predictions(spark, sf_dir).select("key"))


@query
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.point_lookup(stored_predictions(spark, sf_dir), 0, 9, " Purchase").select(*PREDICTION)


@query
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.key_lookup(stored_predictions(spark, sf_dir), "0:9:purchase").select("key", *PREDICTION)


@query
def batch_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.batch_lookup(rel.lookup_requests(spark, sf_dir), stored_predictions(spark, sf_dir)).drop("cached_at")


@query
def missing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.missing_cells(rel.lookup_requests(spark, sf_dir), stored_predictions(spark, sf_dir))


@query
def lookup_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = _event_cube(spark, sf_dir)
    model = training.train_candidates(training.training_rows(cube)).model
    store = scoring.PredictionStore(spark, shared_dir(spark, "predictions"))
    store.refresh(scoring.score_grid(cube, model))
    return scoring.lookup_or_score(rel.lookup_requests(spark, sf_dir), store.read(), model).drop("cached_at")


@query
def lookup_with_fallback_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request is answered once, by the table or by the model."""
    answered = lookup_with_fallback(spark, sf_dir)
    return answered.select("request_id", *CELL_KEYS, "found", F.col("prediction").isNotNull().alias("has_prediction"))


@query
def lookup_with_fallback_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of even days are stored, the others scored by a tree that knows them; each cell is asked for twice."""
    cube, model = _isolating_model(spark, sf_dir)
    store = scoring.PredictionStore(spark, shared_dir(spark, "predictions"))
    store.refresh(scoring.score(cube.where("day_of_week % 2 = 0").select(*CELL_KEYS), model))
    twice = cube.select(*CELL_KEYS, F.explode(F.array(F.lit(1), F.lit(2))).alias("asked"), F.lit("mine").alias("cached_at"))
    answers = scoring.lookup_or_score(twice, store.read(), model)
    return answers.select(*CELL_KEYS, "asked", "prediction", "found", F.col("cached_at").isNotNull().alias("has_time"))


@query
def typed_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two requests typed in by hand against the stored table, one in another spelling, one that is not there."""
    asked = files.requests(spark, [(0, 9, " Purchase"), (6, 23, "no such category")])
    return lookup.batch_lookup(asked, stored_predictions(spark, sf_dir)).drop("cached_at")


@query
def prediction_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ISO time for all rows of a version."""
    rows = stored_predictions(spark, sf_dir)
    is_iso = F.try_to_timestamp(F.col("cached_at")).isNotNull() & F.col("cached_at").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T")
    return rows.agg(F.count_distinct("cached_at").alias("times"), F.min(is_iso).alias("all_iso"), F.count(F.lit(1)).alias("rows"))


@query
def pattern_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = stored_predictions(spark, sf_dir)
    patterns = {"0:9:*": (0, 9), "0:*:*": (0, None), "*:9:*": (None, 9), "*:*:*": (None, None)}
    parts = [
        lookup.matching(predictions, day, hour).select(F.lit(text).alias("pattern"), *PREDICTION)
        for text, (day, hour) in patterns.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def top_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.top_predictions(stored_predictions(spark, sf_dir)).select(*PREDICTION)


@query
def top_predictions_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.top_predictions_per_day(stored_predictions(spark, sf_dir)).select("rank", *PREDICTION)


@query
def labelled_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = fields.lookup_line(*[F.col(c) for c in PREDICTION]).alias("line")
    return lookup.batch_lookup(
        rel.lookup_requests(spark, sf_dir).withColumn("category", F.trim("category")), stored_predictions(spark, sf_dir)
    ).select("request_id", line)


@query
def ranked_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = lookup.ranked_top(stored_predictions(spark, sf_dir), 10)
    return top.select("rank", fields.ranked_line(F.col("rank"), *[F.col(c) for c in PREDICTION]).alias("line"))


@query
def ranked_day_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = lookup.top_predictions_per_day(stored_predictions(spark, sf_dir), 10)
    line = fields.ranked_day_line(*[F.col(c) for c in ("rank", "hour_of_day", "category", "prediction")])
    return top.select("day_of_week", "rank", line.alias("line"))


@query
def probe_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = rel.lookup_requests(spark, sf_dir).select(
        fields.cell_key(*[F.col(c) for c in CELL_KEYS]).alias("key")
    )
    probes = lookup.batch_lookup(lookup.key_requests(keys), stored_predictions(spark, sf_dir))
    return lookup.hit_rate(probes).withColumn("rate", F.round("rate", 6))


@query
def prediction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.prediction_statistics(stored_predictions(spark, sf_dir)).drop("last_updated")


@query
def prediction_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.prediction_categories(stored_predictions(spark, sf_dir))


@query
def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.coverage(stored_predictions(spark, sf_dir), rel.lookup_requests(spark, sf_dir))
