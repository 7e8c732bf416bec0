"""Order and demand relations derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandgrid.functions.fields import calendar_day, day_of_week, quoted

# The columns in use, declared so that no job is spent on inferring them.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, event_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as long rows of one item each."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id"),
        calendar_day(F.col("ts")).alias("day"),
        day_of_week(F.col("ts")).alias("day_of_week"),
        F.hour("ts").cast("int").alias("hour_of_day"),
        F.col("event_type").alias("category"),
        F.lit(1).cast("bigint").alias("items_count"),
    )


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as long rows: one category per part name.

    The join carries no hint. Part names are broadcast while the table is small;
    otherwise both sides shuffle on the part key and adaptive execution splits
    the partitions of parts that hold an outsized share of the items.
    """
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey"),
        day_of_week(F.col("l_shipdate")).alias("day_of_week"),
        (F.col("l_orderkey") % 24).cast("int").alias("hour_of_day"),
        F.col("l_quantity").cast("bigint").alias("items_count"),
    )
    names = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("category"))
    return items.join(names, F.col("l_partkey") == F.col("p_partkey")).select(
        "day_of_week", "hour_of_day", "category", "items_count"
    )


def distinct_names(rows: DataFrame, column: str) -> list[str]:
    """Distinct values that become columns, sorted: the schema of a wide relation, however many they are.

    A caller with an open-ended domain keeps its rows long and uses ``cube_from_rows``.
    """
    found = rows.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(row[0] for row in found)


def days_since_prior(orders: DataFrame) -> DataFrame:
    """Days from the customer's previous order, for orders that are not on the
    same date as an earlier one of that customer (those are zero days apart).

    Orders collapse to one row per customer and date before the window, so the
    rows of one customer are bounded by the number of dates, however many orders
    one customer holds.
    """
    dates = orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("order_date")).agg(
        F.min("o_orderkey").alias("first_key")
    )
    previous = F.lag("order_date").over(Window.partitionBy("o_custkey").orderBy("order_date"))
    return dates.select("first_key", F.date_diff("order_date", previous).alias("days"), F.lit(True).alias("is_first"))


def wide_orders(spark: SparkSession, sf_dir: str, with_prior: bool = True) -> DataFrame:
    """One row per order with a quantity column per part type, null where absent.

    Quantities are summed per order with one conditional sum per type, so order
    and items meet on a single shuffle by order key. ``with_prior=False`` leaves
    out ``days_since_prior_order``, which no cube needs and which costs a join.
    """
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    types = distinct_names(parts, "p_type")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("items")
    )
    per_order = (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(*[F.sum(F.when(F.col("p_type") == t, F.col("items"))).alias(t) for t in types])
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    metadata = [
        F.col("o_orderkey").alias("order_id"),
        day_of_week(F.col("o_orderdate")).alias("order_dow"),
        (F.col("o_orderkey") % 24).cast("int").alias("order_hour_of_day"),
    ]
    if with_prior:
        first = days_since_prior(orders)
        orders = orders.join(first, F.col("o_orderkey") == F.col("first_key"), "left")
        same_date = F.col("is_first").isNull()
        days = F.when(same_date, F.lit(0)).otherwise(F.col("days"))
        metadata.append(days.cast("double").alias("days_since_prior_order"))
    wide = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return wide.select(*metadata, *[quoted(t) for t in types])


def wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with a column per event type, and its calendar day."""
    events = event_rows(spark, sf_dir)
    types = distinct_names(events, "category")
    return events.select(
        F.col("event_id").alias("order_id"),
        F.col("day_of_week").alias("order_dow"),
        F.col("hour_of_day").alias("order_hour_of_day"),
        "day",
        *[F.when(F.col("category") == t, F.col("items_count")).alias(t) for t in types],
    )


def shipping_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar days on which anything was shipped."""
    return table(spark, sf_dir, "lineitem").select(calendar_day(F.col("l_shipdate")).alias("day")).distinct()


def ordering_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of the calendar days with orders; the lowest order key serves as batch."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(calendar_day(F.col("o_orderdate")).alias("day")).agg(F.min("o_orderkey").alias("batch_id"))


def lookup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of mixed spelling: every event, plus every order under its priority,
    a category no event has."""
    events = event_rows(spark, sf_dir).select(
        F.concat(F.lit("event-"), F.col("event_id")).alias("request_id"),
        "day_of_week",
        "hour_of_day",
        F.concat(F.lit(" "), F.initcap("category"), F.lit("  ")).alias("category"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order-"), F.col("o_orderkey")).alias("request_id"),
        day_of_week(F.col("o_orderdate")).alias("day_of_week"),
        (F.col("o_orderkey") % 24).cast("int").alias("hour_of_day"),
        F.col("o_orderpriority").alias("category"),
    )
    return events.unionByName(orders)
