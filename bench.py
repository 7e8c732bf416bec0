"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_RUNS the
timed runs per query (the median counts) after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.fields import CELL_KEYS, quoted
from demandgrid.operators.cube import cube_from_orders, cube_from_rows
from demandgrid.operators.lookup import batch_lookup, key_lookup, point_lookup, top_predictions_per_day
from demandgrid.operators.reshape import category_columns, wide_to_long
from demandgrid.operators.scoring import score
from demandgrid.operators.training import train_candidates, training_rows
from demandgrid.plans.catalogue import QUERIES, stored_predictions
from demandgrid.session import build_session, materialize, shared_dir
from demandgrid.sources.files import read_orders_csv, split_by_day
from demandgrid.sources.files import requests as typed_requests
from demandgrid.sources.relations import lookup_requests, wide_orders
from demandgrid.streaming import CubeStore

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "cube_full",
    "cube_lineitem",
    "cube_events",
    "wide_orders",
    "csv_roundtrip_cube",
    "processing_status",
    "incremental_cube_all_days",
    "train_evaluate",
    "prediction_table",
    "batch_lookup",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    action()
    seconds = []
    for _ in range(RUNS):
        begin = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - begin)
    return round(statistics.median(seconds), 3)


def branch_per_category(orders: DataFrame) -> DataFrame:
    """The naive plan the cube is compared with: one scan and aggregate per category."""

    def branch(name: str) -> DataFrame:
        rows = orders.select(
            F.col("order_dow").alias("day_of_week"),
            F.col("order_hour_of_day").alias("hour_of_day"),
            F.lit(name).alias("category"),
            quoted(name).alias("items_count"),
        ).where("items_count > 0")
        return rows.groupBy(*CELL_KEYS).agg(F.sum("items_count").alias("items_count"))

    return reduce(DataFrame.unionByName, [branch(c) for c in category_columns(orders)])


def main() -> None:
    spark = build_session(
        "demandgrid-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='bench-')}",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    times = {name: timed(lambda name=name: run(QUERIES[name](spark, SF_DIR))) for name in HEADLINE}

    # serving: the table and the model exist, only the answers are timed
    requests = lookup_requests(spark, SF_DIR)
    predictions = stored_predictions(spark, SF_DIR)
    times["batch_lookup_stored"] = timed(lambda: run(batch_lookup(requests, predictions)))
    times["point_lookup_stored"] = timed(lambda: run(point_lookup(predictions, 0, 9, "purchase")))
    times["key_lookup_stored"] = timed(lambda: run(key_lookup(predictions, "0:9:purchase")))
    times["top_per_day_stored"] = timed(lambda: run(top_predictions_per_day(predictions)))
    model = train_candidates(training_rows(QUERIES["cube_events"](spark, SF_DIR))).model
    times["score_requests"] = timed(lambda: run(score(requests, model)))
    asked = requests.count()
    single = typed_requests(spark, [(0, 9, "purchase")])
    times["score_single_request"] = timed(lambda: run(score(single, model)))

    # a commit by itself: the orders of one day are staged before the clock starts
    staged = materialize(wide_orders(spark, SF_DIR).where("order_dow = 0").withColumn("day", F.lit(0)), "bench-day")
    times["commit_one_day"] = timed(lambda: CubeStore(spark, shared_dir(spark, "bench-store")).commit(staged, 0))

    # the same cube by three plans, from Parquet and from day files in CSV
    orders = wide_orders(spark, SF_DIR)
    raw = shared_dir(spark, "bench-raw")
    split_by_day(orders, raw, F.col("order_dow"))
    plans = {}
    for source, rows in (("parquet", materialize(orders, "bench-orders")), ("csv", read_orders_csv(spark, f"{raw}/*/*.csv"))):
        plans[f"{source}_aggregate_then_unpivot"] = timed(lambda rows=rows: run(cube_from_orders(rows)))
        plans[f"{source}_unpivot_then_aggregate"] = timed(lambda rows=rows: run(cube_from_rows(wide_to_long(rows))))
        plans[f"{source}_branch_per_category"] = timed(lambda rows=rows: run(branch_per_category(rows)))

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
                "cube_plans": plans,
                "lookups_per_sec": round(asked / times["batch_lookup_stored"]),
                "scores_per_sec": round(asked / times["score_requests"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
