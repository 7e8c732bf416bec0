"""Streams that feed newly arrived day folders into a cube store."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from demandgrid.operators.days import unprocessed_days
from demandgrid.operators.reshape import METADATA_COLUMNS
from demandgrid.sources.files import CSV_OPTIONS, available_days, days_by_header, order_schema, path_day, read_days_of_headers, with_day
from demandgrid.streaming.store import CubeStore

OnCommit = Callable[[CubeStore, int], None]

MAX_FILE_AGE = "36500d"
RETRY_SECONDS = 5.0
RESTARTS = 1
FOLD = "fold"


def day_stream(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "csv", plain: bool = False) -> DataFrame:
    """Files below ``root`` as a stream of wide orders with their ``day``.

    ``plain`` reads digit-named folders instead of ``day=<d>`` ones. There is
    deliberately no cap on files per trigger: a day counts by the batch that
    first brings it, so a batch must not end in the middle of a day. For the
    same reason a day folder should be moved into place when it is complete.
    """
    # the age of a file says nothing about its day: an old file moved into place is read too
    reader = spark.readStream.format(fmt).option("pathGlobFilter", f"*.{fmt}").option("maxFileAge", MAX_FILE_AGE)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if not plain:
        return reader.schema(with_day(schema)).load(root)
    rows = reader.schema(schema).load(f"{root}/[0-9]*/")
    return rows.withColumn("day", path_day(F.col("_metadata.file_path"))).where("day is not null")


def start(
    days: DataFrame,
    store: CubeStore,
    on_commit: OnCommit | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start folding ``days`` into ``store``.

    Without ``every`` the query takes what has arrived and ends; a run that finds
    nothing new commits no batch. With ``every`` (say ``"4 seconds"``) it keeps
    polling; one query has one active batch, so runs never overlap. The offsets
    live in the store's folder: after a crash the unfinished batch is repeated
    with the same files and the same number.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        # the query's own id: another stream, or this one after the loss of its offsets, is another feeder
        feeder = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        number = store.commit(batch, batch_id, feeder)
        store.compact_if_due()
        if on_commit is not None:
            on_commit(store, number)

    writer = days.writeStream.foreachBatch(commit).option("checkpointLocation", f"{store.root}/offsets")
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def run_once(days: DataFrame, store: CubeStore, on_commit: OnCommit | None = None) -> None:
    """Fold in everything that has arrived and return; after a failure once more, then the error is raised."""
    try:
        start(days, store, on_commit).awaitTermination()
    except StreamingQueryException:
        time.sleep(RETRY_SECONDS)
        start(days, store, on_commit).awaitTermination()


class SupervisedPolling:
    """A polling query that is started anew ``restarts`` times after a failure; the next one is raised.

    A restarted query repeats the unfinished batch with the same files and the same
    number, so a failure after the commit counts nothing twice.
    """

    def __init__(
        self, days: DataFrame, store: CubeStore, every: str, on_commit: OnCommit | None = None,
        restarts: int = RESTARTS, wait_seconds: float = RETRY_SECONDS,
    ):
        self._start = lambda: start(days, store, on_commit, every)
        self.restarts_left = restarts
        self.wait_seconds = wait_seconds
        self.query = self._start()

    def _guarded(self, wait: Callable[[StreamingQuery], object]) -> object:
        while True:
            try:
                return wait(self.query)
            except StreamingQueryException:
                if self.restarts_left <= 0:
                    raise
                self.restarts_left -= 1
                time.sleep(self.wait_seconds)
                self.query = self._start()

    def await_termination(self, timeout: float | None = None) -> bool | None:
        """Wait for the end of the query, or ``timeout`` seconds of it without a failure."""
        return self._guarded(lambda query: query.awaitTermination(timeout))

    def process_all_available(self) -> None:
        """Wait until all that has arrived is in the store."""
        self._guarded(lambda query: query.processAllAvailable())

    def stop(self) -> None:
        self.query.stop()


def poll(days: DataFrame, store: CubeStore, every: str = "4 seconds", on_commit: OnCommit | None = None, **options) -> SupervisedPolling:
    """Keep folding in what arrives, under supervision."""
    return SupervisedPolling(days, store, every, on_commit, **options)


def fold_unprocessed_days(spark: SparkSession, root: str, store: CubeStore, count_type: str = "long") -> list[int]:
    """Fold in every CSV day folder the store has not seen; return the days.

    The scheduled alternative to a stream, for day files whose category columns
    differ. Days whose files have equal headers are one batch, read together, so the
    number of jobs goes with the number of different headers. Files of one day may
    differ too: a column that a file lacks counts as null. A day file without rows is
    committed with none. The same store may also be fed by streams: the ledger
    knows whose batch each entry is.
    """
    waiting = [row.day for row in unprocessed_days(available_days(spark, root), store.processed_days()).collect()]
    last = store.last_of(FOLD) if waiting else None
    for number, (days, headers) in enumerate(days_by_header(spark, root, waiting), 0 if last is None else last + 1):
        orders = read_days_of_headers(spark, headers, count_type)
        if orders is None:
            orders = spark.createDataFrame([], order_schema([*METADATA_COLUMNS, "day"], "integer"))
        store.commit(orders, number, FOLD, days)
        store.compact_if_due()
    return waiting
