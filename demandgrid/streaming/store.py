"""The incrementally kept cube: immutable deltas, a ledger, and snapshots.

Layout below the store's root::

    deltas/batch_id=<n>/     cells of one batch
    ledger/batch_id=<n>/     days of that batch; written last, so it commits the batch
    snapshots/upto=<n>/      the cube of all batches up to n
    folded_ledger/upto=<n>/  the ledger entries of all batches up to n, as one table
    snapshot_log/upto=<n>/   written after both, so it commits the snapshot

Nothing is overwritten that is also read. A batch without a ledger entry is not
visible, and repeating it rewrites its delta; a batch with an entry is complete, and
repeating it does nothing. Batches are numbered without gaps, so the entries after the
newest snapshot are found by their numbers: readers and commits open one folded ledger
and the entries after it, however many batches there have been. ``expire`` removes what
older snapshots alone need.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.operators.cube import merge_cubes
from demandgrid.operators.days import processing_status
from demandgrid.operators.reshape import wide_to_cells
from demandgrid.sources.files import CUBE_SCHEMA
from demandgrid.sources.folders import file_system, holds_file, numbers, remove

DELTA_SCHEMA = T.StructType(
    [T.StructField("day", T.IntegerType()), T.StructField("is_late", T.BooleanType()), *CUBE_SCHEMA.fields]
)
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("day", T.IntegerType()),
        T.StructField("order_rows", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("feeder", T.StringType()),
        T.StructField("feeder_batch", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
COMPACT_EVERY = 50
KEEP = 2  # snapshots kept: readers of the one before the newest are not cut off


class CubeStore:
    """A cube that grows by batches of days, each day counted once.

    A day belongs to the first batch that brings rows of it. Rows of that day in
    a later batch are kept in the deltas but marked late: they are reported and
    do not enter the cube.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        folder, system = file_system(spark, f"{self.root}/ledger")
        system.mkdirs(folder)

    def ledger(self) -> DataFrame:
        """One row per batch and day, with the rows counted and the rows that were late."""
        return self._ledger(self.spark, self.committed_through())

    def _ledger(self, session: SparkSession, through: int | None) -> DataFrame:
        """The folded ledger and the entries after it up to ``through``."""
        base, entries = self.snapshot_through(), []
        folded = f"{self.root}/folded_ledger/upto={base}"
        # a snapshot of an earlier version of this store has no folded ledger
        is_folded = base is not None and holds_file(self.spark, folded)
        if is_folded:
            entries.append(session.read.schema(LEDGER_SCHEMA).parquet(folded))
        first = base + 1 if is_folded else 0
        paths = [self._entry_path(n) for n in range(first, -1 if through is None else through + 1)]
        if paths:
            tail = session.read.schema(LEDGER_SCHEMA).option("basePath", f"{self.root}/ledger").parquet(*paths)
            entries.append(tail.select(*LEDGER_SCHEMA.names))
        return reduce(DataFrame.unionByName, entries) if entries else session.createDataFrame([], LEDGER_SCHEMA)

    def processed_days(self) -> DataFrame:
        """The committed days and the batch each came in; also the way to rebuild a lost ledger copy."""
        return self.ledger().where("order_rows > 0 or late_rows = 0").select("day", "batch_id")

    def committed_through(self) -> int | None:
        """The newest committed batch: entries are looked up one after the other from the newest snapshot on."""
        newest = self.snapshot_through()
        while holds_file(self.spark, self._entry_path(0 if newest is None else newest + 1)):
            newest = 0 if newest is None else newest + 1
        return newest

    def snapshot_through(self) -> int | None:
        """The newest batch covered by a complete snapshot."""
        for upto in reversed(numbers(self.spark, f"{self.root}/snapshot_log", "upto")):
            if holds_file(self.spark, f"{self.root}/snapshot_log/upto={upto}"):
                return upto
        return None

    def last_of(self, feeder: str) -> int | None:
        """The newest committed batch of a feeder, by the feeder's own number."""
        return self.ledger().where(F.col("feeder") == feeder).agg(F.max("feeder_batch")).first()[0]

    def commit(self, orders: DataFrame, feeder_batch: int, feeder: str = "default", days: Sequence[int] = ()) -> int:
        """Fold one batch of wide orders (with ``day``) in; safe to repeat; return its number in the store.

        A batch is known by its feeder and the feeder's number for it; the store
        numbers batches by itself, so feeders do not hide each other's. ``days``
        are committed even if the batch has no rows of them. One pass over the
        orders: they are aggregated before anything else happens, and the ledger
        is derived from the delta as written.
        """
        session = orders.sparkSession
        last = self.committed_through()
        ledger = self._ledger(session, last)
        own = (F.col("feeder") == feeder) & (F.col("feeder_batch") == feeder_batch)
        known = ledger.where(own).agg(F.max("batch_id")).first()[0]
        if known is not None:
            return known
        batch_id = 0 if last is None else last + 1
        earlier = (
            ledger.where("order_rows > 0 or late_rows = 0")
            .select("day")
            .distinct()
            .withColumn("is_late", F.lit(True))
        )
        cells = wide_to_cells(orders, by=["day"], count_orders=True)
        delta = cells.join(earlier, "day", "left").withColumn("is_late", F.coalesce("is_late", F.lit(False)))
        delta = delta.select(*[F.col(f.name).cast(f.dataType) for f in DELTA_SCHEMA.fields])
        path = self._delta_path(batch_id)
        delta.write.mode("overwrite").parquet(path)

        counts = session.read.schema(DELTA_SCHEMA).parquet(path).where("category is null").select("day", "is_late", "items_count")
        named = session.createDataFrame([(day, False, 0) for day in days], "day int, is_late boolean, items_count long")
        entry = counts.union(named).groupBy("day").agg(
            F.sum(F.when(F.col("is_late"), 0).otherwise(F.col("items_count"))).alias("order_rows"),
            F.sum(F.when(F.col("is_late"), F.col("items_count")).otherwise(0)).alias("late_rows"),
        )
        entry = entry.withColumns({"feeder": F.lit(feeder), "feeder_batch": F.lit(feeder_batch).cast("long")})
        # One row per day of the batch; a single file makes the commit one rename.
        entry.coalesce(1).write.mode("overwrite").parquet(self._entry_path(batch_id))
        return batch_id

    def _entry_path(self, batch_id: int) -> str:
        return f"{self.root}/ledger/batch_id={batch_id}"

    def _delta_path(self, batch_id: int) -> str:
        return f"{self.root}/deltas/batch_id={batch_id}"

    def cube(self) -> DataFrame:
        """The cube of every committed batch: newest snapshot plus the deltas after it."""
        return self._cube(self.snapshot_through(), self.committed_through())

    def _cube(self, base: int | None, through: int | None) -> DataFrame:
        read = self.spark.read
        first = 0 if base is None else base + 1
        paths = [self._delta_path(n) for n in range(first, -1 if through is None else through + 1)]
        parts = []
        if paths:
            deltas = read.schema(DELTA_SCHEMA).parquet(*paths)
            parts.append(deltas.where(~F.col("is_late") & F.col("category").isNotNull()))
        if base is not None:
            parts.append(read.schema(CUBE_SCHEMA).parquet(f"{self.root}/snapshots/upto={base}"))
        if not parts:
            return self.spark.createDataFrame([], CUBE_SCHEMA)
        return merge_cubes(*[part.select(*CUBE_SCHEMA.names) for part in parts])

    def compact_if_due(self, every: int = COMPACT_EVERY) -> None:
        """Compact once ``every`` batches have come in since the last snapshot, so that readers open no more deltas than that."""
        through, base = self.committed_through(), self.snapshot_through()
        if through is not None and through - (-1 if base is None else base) >= every:
            self.compact()

    def compact(self) -> int | None:
        """Write a snapshot of all committed batches; readers move over when it is complete."""
        base, through = self.snapshot_through(), self.committed_through()
        if through is None or through == base:
            return through
        path = f"{self.root}/snapshots/upto={through}"
        self._cube(base, through).write.mode("overwrite").parquet(path)
        ledger = self._ledger(self.spark, through).hint("rebalance")
        ledger.write.mode("overwrite").parquet(f"{self.root}/folded_ledger/upto={through}")
        cells = self.spark.read.schema(CUBE_SCHEMA).parquet(path).agg(F.count(F.lit(1)).alias("cells"))
        cells.write.mode("overwrite").parquet(f"{self.root}/snapshot_log/upto={through}")
        return through

    def expire(self, keep: int = KEEP) -> dict[str, int]:
        """Remove snapshots older than the newest ``keep``, and the batches that all kept ones cover.

        Returns how many folders of each kind went. Cube, ledger and all later commits
        stay as they are. Log entries go first, so that no reader begins on a snapshot
        that is being removed; a run that is cut short is made up for by the next.
        """
        if keep < 1:
            raise ValueError("the newest snapshot is needed")
        logged = numbers(self.spark, f"{self.root}/snapshot_log", "upto")
        complete = [n for n in logged if holds_file(self.spark, f"{self.root}/snapshot_log/upto={n}")]
        if not complete:
            return {}
        oldest = complete[-keep:][0]
        removed = {}
        for kind, label, covered in (
            ("snapshot_log", "upto", lambda n: n < oldest),
            ("snapshots", "upto", lambda n: n < oldest),
            ("folded_ledger", "upto", lambda n: n < oldest),
            ("deltas", "batch_id", lambda n: n <= oldest),
            ("ledger", "batch_id", lambda n: n <= oldest and holds_file(self.spark, f"{self.root}/folded_ledger/upto={oldest}")),
        ):
            old = [n for n in numbers(self.spark, f"{self.root}/{kind}", label) if covered(n)]
            for n in old:
                remove(self.spark, f"{self.root}/{kind}/{label}={n}")
            removed[kind] = len(old)
        return removed

    def day_report(self) -> DataFrame:
        """Rows counted and rows too late, per day."""
        return self.ledger().groupBy("day").agg(
            F.sum("order_rows").alias("order_rows"), F.sum("late_rows").alias("late_rows")
        )

    def status(self, available: DataFrame) -> DataFrame:
        """One row on available, processed and open days."""
        return processing_status(available, self.processed_days())
