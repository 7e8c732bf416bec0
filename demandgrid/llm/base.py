"""What the operators of this package share: tables, words, written intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.session import materialize, shared_dir
from demandgrid.sources.folders import remove

__all__ = ["WORD", "asc_key", "discard", "materialize", "shared_dir", "table", "thinned", "word_count"]

#: Bits by which rows are thinned out before a join: a broadcast of at most FILTER_BITS / 64 rows.
FILTER_BITS = 1 << 25

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as a long; null counts as the empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def asc_key(column: Column) -> list[Column]:
    """Sort keys for code-point order (the byte order of UTF-8), null last."""
    return [column.isNull(), column]


def thinned(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """``rows`` without most of those whose long key is not wanted; where very many are wanted, more others stay."""
    slot = lambda name: F.pmod(F.col(name), F.lit(FILTER_BITS))
    words = wanted.select(slot(wanted_key).alias("slot")).groupBy(F.floor(F.col("slot") / 64).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("__bits")
    )
    marked = rows.withColumn("__slot", slot(key)).withColumn("__word", F.floor(F.col("__slot") / 64))
    held = marked.join(F.broadcast(materialize(words, "filter-words")), "__word").where("shiftrightunsigned(__bits, cast(__slot % 64 as int)) & 1 = 1")
    return held.select(*rows.columns)


def discard(*tables: DataFrame) -> None:
    """Remove written intermediate tables, results of ``materialize``, that no later plan reads."""
    for written in tables:
        for folder in {file.rsplit("/", 1)[0] for file in written.inputFiles()}:
            remove(written.sparkSession, folder)
