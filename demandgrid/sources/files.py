"""Reading and writing orders and cubes as files.

Two folder layouts are understood: ``root/day=<d>/...`` (partition column) and
``root/<d>/...`` (plain digit-named folders, the day taken from the path).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.functions.fields import quoted
from demandgrid.operators.reshape import METADATA_COLUMNS
from demandgrid.sources.folders import data_files, file_system, first_file, first_line, holds_file, numbers

REQUEST_SCHEMA = "day_of_week int, hour_of_day int, category string"

CUBE_SCHEMA = T.StructType(
    [
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("items_count", T.LongType()),
    ]
)

DAY_FOLDER = re.compile("(?:day=)?([0-9]+)")
HEADER_READERS = 16  # files whose first lines are read at once

# A count that does not parse must stop the job: read leniently it would be lost.
CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST", "escape": '"'}
# Names keep their outer blanks, quotes and backslashes.
CSV_WRITE_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
# In a cube an empty category is not an absent one.
CSV_NULL = {"nullValue": "\\N"}


def order_schema(columns: Sequence[str], count_type: str = "long") -> T.StructType:
    """Types of a wide order file with these columns, in file order."""
    kinds = dict(zip(METADATA_COLUMNS, ("long", "integer", "integer", "double"), strict=True))
    schema = T.StructType()
    for name in columns:
        schema.add(name, kinds.get(name, count_type))
    return schema


def order_file_columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names from the header line; no row is read and no type is guessed."""
    columns = spark.read.option("header", "true").option("escape", '"').csv(path).columns
    absent = [c for c in METADATA_COLUMNS[:3] if c not in columns]
    if absent:
        raise ValueError(f"not an order file, missing {absent}: {path}")
    return [c for c in columns if c != "day"]


def read_orders_csv(spark: SparkSession, path: str, count_type: str = "long") -> DataFrame:
    """Wide orders from a path or glob, such as ``raw/*/orders_*.csv``.

    ``count_type="double"`` reads files whose counts are written like ``2.0``.
    """
    schema = order_schema(order_file_columns(spark, path), count_type)
    # a folder of the day=<d> layout would add its partition column as one more category
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path).select(*[quoted(c) for c in schema.names])


def requests(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Lookup or scoring requests typed in by hand, as (day, hour, category)."""
    return spark.createDataFrame([(int(d), int(h), str(c)) for d, h, c in rows], REQUEST_SCHEMA)


def path_day(path: Column) -> Column:
    """The day a file belongs to by the name of its folder; null when that is no number."""
    return F.regexp_extract(path, f"/{DAY_FOLDER.pattern}/[^/]+$", 1).try_cast("int")


def split_by_day(
    orders: DataFrame, root: str, day: Column, fmt: str = "csv", mode: str = "errorifexists"
) -> None:
    """Write one ``day=<d>`` folder per day that has rows.

    Rebalancing by day gives files of an even size: small days share a task, and
    a day that holds most of the rows is spread over several.
    """
    writer = orders.withColumn("day", day).hint("rebalance", F.col("day")).write.partitionBy("day").mode(mode)
    if fmt == "csv":
        writer = writer.options(**CSV_WRITE_OPTIONS)
    writer.format(fmt).save(root)


def split_plain(orders: DataFrame, root: str, staging: str, day: Column, fmt: str = "csv") -> None:
    """Write one digit-named ``<d>`` folder per day that has rows.

    The days are written to ``staging``, on the same file system, and each folder is
    renamed into place; a day that is there already stops the job before anything moves.
    """
    split_by_day(orders, staging, day, fmt)
    spark = orders.sparkSession
    target, system = file_system(spark, root)
    days = numbers(spark, staging, "day")
    present = [d for d in days if system.exists(file_system(spark, f"{root}/{d}")[0])]
    if present:
        raise FileExistsError(f"days {present} are in {root} already")
    system.mkdirs(target)
    for d in days:
        source, place = (file_system(spark, p)[0] for p in (f"{staging}/day={d}", f"{root}/{d}"))
        if not system.rename(source, place):
            raise OSError(f"could not move {source} to {place}")


def land_days(orders: DataFrame, root: str, staging: str, day: Column, fmt: str = "csv") -> None:
    """Land days below ``root`` so that a reader that polls it sees each new day whole.

    The days are written to ``staging``, on the same file system, and every day
    folder is renamed into place when all its files are complete. Files of a day
    that is there already are added to it one by one: they are late in any case.
    """
    split_by_day(orders, staging, day, fmt)
    spark = orders.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(root))
    for folder in system.listStatus(path(staging)):
        name = folder.getPath().getName()
        if not folder.isDirectory() or not DAY_FOLDER.fullmatch(name):
            continue
        moves = [(folder.getPath(), path(f"{root}/{name}"))]
        if system.exists(moves[0][1]):
            files = system.listStatus(folder.getPath())
            moves = [(f.getPath(), path(f"{root}/{name}/{f.getPath().getName()}")) for f in files]
        for source, target in moves:
            if not system.rename(source, target):
                raise OSError(f"could not move {source} to {target}")


def read_day(spark: SparkSession, root: str, day: int, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """One day's rows; the condition prunes the other folders."""
    return read_days(spark, root, schema, fmt).where(F.col("day") == day)


def read_days(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """All days of a ``day=<d>`` layout, with the ``day`` column."""
    reader = spark.read.schema(with_day(schema)).format(fmt)
    return (reader.options(**CSV_OPTIONS) if fmt == "csv" else reader).load(root)


def read_plain_days(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """All files of the digit-named folders below ``root``, with the ``day`` column."""
    reader = spark.read.schema(schema).format(fmt).option("pathGlobFilter", f"*.{fmt}")
    rows = (reader.options(**CSV_OPTIONS) if fmt == "csv" else reader).load(f"{root}/[0-9]*/")
    return rows.withColumn("day", path_day(F.col("_metadata.file_path"))).where("day is not null")


def available_days(spark: SparkSession, root: str, fmt: str = "csv") -> DataFrame:
    """Days whose folder holds at least one data file, ascending.

    Each day folder is listed up to its first data file, so the cost goes with
    the number of days and not with the files in them; no file is opened.
    """
    folder, system = file_system(spark, root)
    days = set()
    for entry in system.listStatus(folder):
        named = DAY_FOLDER.fullmatch(entry.getPath().getName())
        if named and entry.isDirectory() and first_file(system, entry.getPath(), f".{fmt}"):
            days.add(int(named[1]))
    return spark.createDataFrame([(day,) for day in sorted(days)], "day int")


def days_by_header(spark: SparkSession, root: str, days: Sequence[int]) -> list[tuple[list[int], dict[str, list[str]]]]:
    """Days whose CSV files have equal headers, and the files of each header among them.

    Only the first line of each file is read, without a job. Groups come in the order
    of their first day. A day without a line of text is in a group without files.
    """
    listed = [
        (day, file)
        for day in days
        for layout in (f"{root}/{day}", f"{root}/day={day}")
        if holds_file(spark, layout, ".csv")
        for file in data_files(spark, layout, ".csv")
    ]
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda entry: first_line(spark, entry[1]), listed))
    of_day: dict[int, dict[str, list[str]]] = {day: {} for day in days}
    for (day, file), line in zip(listed, lines, strict=True):
        if line:
            of_day[day].setdefault(line, []).append(file)
    groups: dict[frozenset[str], tuple[list[int], dict[str, list[str]]]] = {}
    for day in days:
        members, files = groups.setdefault(frozenset(of_day[day]), ([], {}))
        members.append(day)
        for line, paths in of_day[day].items():
            files.setdefault(line, []).extend(paths)
    return list(groups.values())


def read_days_of_headers(spark: SparkSession, headers: dict[str, list[str]], count_type: str = "long") -> DataFrame | None:
    """The orders of files grouped by header, with their ``day``; a column that a file lacks is null."""
    parts = []
    for paths in headers.values():
        schema = order_schema(order_file_columns(spark, paths[:1]), count_type)
        rows = spark.read.schema(schema).options(**CSV_OPTIONS).csv(paths).select(*[quoted(c) for c in schema.names], path_day(F.col("_metadata.file_path")).alias("day"))
        parts.append(rows)
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts) if parts else None


def with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*[f for f in schema.fields if f.name != "day"], T.StructField("day", T.IntegerType())])


def write_cube(cube: DataFrame, path: str) -> None:
    """Typed, parallel write in key order."""
    cube.orderBy("day_of_week", "hour_of_day", "category").write.mode("overwrite").parquet(path)


def read_cube(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CUBE_SCHEMA).parquet(path)


def export_cube_csv(cube: DataFrame, path: str) -> None:
    """The sorted cube as CSV with headers, for exchange; stored cubes use ``write_cube``.

    Part files follow key order. Adaptive execution merges small partitions, so a
    cube of ordinary size comes out as one file without forcing every cube
    through a single task.
    """
    ordered = cube.orderBy("day_of_week", "hour_of_day", "category")
    ordered.write.mode("overwrite").options(**CSV_WRITE_OPTIONS, **CSV_NULL).csv(path)


def read_cube_csv(spark: SparkSession, path: str) -> DataFrame:
    """An exported cube with its types restored, so that keys sort as numbers."""
    return spark.read.schema(CUBE_SCHEMA).options(**CSV_OPTIONS, **CSV_NULL).csv(path)


def _read_if_filled(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        cube = read_cube(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if cube.isEmpty() else cube


def choose_cube(spark: SparkSession, full_path: str, incremental_path: str) -> DataFrame:
    """The full cube if it has rows, else the incremental one, named in ``source``."""
    for source, path in (("full", full_path), ("incremental", incremental_path)):
        cube = _read_if_filled(spark, path)
        if cube is not None:
            return cube.withColumn("source", F.lit(source))
    raise FileNotFoundError(f"no cube with rows in {full_path} or {incremental_path}")
