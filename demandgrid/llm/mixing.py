"""Operator 3: mixing sources to target weights by capped water-filling.

A source's target is ``min(cap, level * weight)``, where the cap is ``max_epochs``
times its size and the one level makes the targets add up to all words. The level
is found by the filling itself: sources above their cap are clamped, what they
cannot take is reshared among the others by weight, until none is above.

A source is taken ``target / size`` times: whole repetitions of every document,
then one fractional repetition that covers a seeded sample. The sample is a prefix
of the documents in the order of a seeded digest, and the document at the cut gives
its first words only, so each source takes its target to the word. The order is cut
into 4,096 digest buckets per source: their sums find the cut, and only the bucket
at the cut is ordered row by row, so a source with a third of all rows is no hot group.

Defined results: a null text has size 0 and is taken 0 times; a null source is a
source like any other and comes last; equal digests are ordered by doc_id (null
first) and size; repeated rows count once each; an empty table gives an empty mix;
other columns of the input are kept by :func:`mix` and never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandgrid.llm.base import asc_key, materialize, table, word_count

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
REPETITION = "mix_repetition"


def _digest(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def _sized(docs: DataFrame, seed: str, *more: Column) -> DataFrame:
    """One narrow row per document: id, source, size and its place in the seeded order."""
    return docs.select(
        F.col("doc_id"), F.col("source").alias("source"), word_count(F.col("text")).alias("size"), _digest(seed).alias("u"), *more
    ).withColumn("bucket", F.substring("u", 1, 3))


def source_targets(sized: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """(source, weight, source_size, cap, target), the weights dealt in turn by code point.

    The rank is a distributed one: a range-partitioned sort, and the sizes of its
    parts added up, so that no task sees all sources.
    """
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    order = asc_key(F.col("source"))
    placed = materialize(
        totals.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "source-order",
    )
    part = F.shiftright("place", 33)
    parts = placed.groupBy(part.alias("part")).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = materialize(
        placed.withColumn("part", part).join(parts.withColumn("before", before), "part")
        .select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("cap")),
        "source-weights",
    )

    def spread(level: float | None) -> tuple[int, int, int]:
        """Words of the clamped sources, weight of the others, number of the clamped."""
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= F.col("cap")
        row = ranked.agg(
            F.sum(F.when(over, F.col("cap")).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.count_if(over)
        ).first()
        return int(row[0] or 0), int(row[1] or 0), int(row[2])

    total = int(ranked.agg(F.sum("source_size")).first()[0] or 0)
    capped, weight_left, clamped = spread(None)
    level = total / weight_left if weight_left else 0.0
    while weight_left:
        capped, weight_left, now = spread(level)
        if now == clamped or not weight_left:
            break
        clamped, level = now, (total - capped) / weight_left
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(float(level)))
    return ranked.withColumn("target", target)


def _plans(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole repetitions, the bucket with the cut, and the words left at that bucket."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio)
    wanted = targets.withColumn("whole", whole).withColumn("extra", F.round(F.col("target") - whole * F.col("source_size")).cast("long"))
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        buckets.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
        .join(wanted.select(F.col("source").alias("s"), "extra"), F.expr("source <=> s"))
        .where("ahead < extra").groupBy("s").agg(F.max_by(F.struct("bucket", "ahead"), "bucket").alias("cut"))
    )
    return wanted.join(cut, F.expr("source <=> s"), "left").select(
        F.col("source").alias("plan_source"), "source_size", "target", "whole",
        F.coalesce("cut.bucket", F.lit("")).alias("cut_bucket"), (F.col("extra") - F.coalesce("cut.ahead", F.lit(0))).alias("room"),
    )


def _assigned(docs: DataFrame, weights: Sequence[int], max_epochs: int, seed: str, *more: Column) -> DataFrame:
    sized = materialize(_sized(docs, seed), "sizes")
    plans = materialize(_plans(sized, source_targets(sized, weights, max_epochs)), "mix-plan")
    rows = (_sized(docs, seed, *more) if more else sized).join(plans, F.expr("source <=> plan_source"))
    done = rows.where("bucket != cut_bucket").withColumn("part", F.when(F.expr("bucket < cut_bucket"), F.col("size")).otherwise(0))
    ahead = Window.partitionBy("source").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("room") - F.coalesce(F.sum("size").over(ahead), F.lit(0))
    at_cut = rows.where("bucket = cut_bucket").withColumn("part", F.greatest(F.lit(0), F.least("size", left)).cast("long"))
    return done.unionByName(at_cut).withColumn("taken", (F.col("whole") * F.col("size") + F.col("part")).cast("long"))


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, whole, taken.

    ``whole`` is the number of full repetitions of every document of its source,
    ``taken`` the words taken of this document with repetitions.
    """
    return _assigned(docs, weights, max_epochs, seed).select("doc_id", "size", "source_size", "target", F.col("whole").cast("int").alias("whole"), "taken")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed rows: every repetition is a row with the columns of ``docs`` and ``mix_repetition``.

    A fractional repetition comes last and may be cut after a word. Together the
    rows hold as many words as ``docs``, so the result is no larger than the input.
    """
    kept = [c for c in docs.columns if c != REPETITION]
    rows = _assigned(docs, weights, max_epochs, seed, F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")).where("taken > 0")
    counts = F.concat(
        F.array_repeat(F.col("size"), F.col("whole").cast("int")),
        F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")),
    )
    each = rows.select("row", "size", F.posexplode(counts).alias(REPETITION, "words")).where("words > 0")
    pieces = F.regexp_extract_all(F.col("row.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(
        F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    )
    columns = [text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in kept]
    return each.select(*columns, REPETITION)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS u FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER) AS weight FROM sized GROUP BY source),
capped AS (SELECT *, source_size * 3 AS cap FROM sources),
levels(turn, clamped, level) AS (
  SELECT 0, CAST(0 AS BIGINT), CAST(sum(source_size) AS DOUBLE) / sum(weight) FROM capped
  UNION ALL
  SELECT turn + 1, n, CASE WHEN w > 0 THEN (total - c) / CAST(w AS DOUBLE) ELSE level END
  FROM (SELECT turn, level, clamped, (SELECT count(*) FROM capped WHERE weight * level >= cap) AS n,
          (SELECT coalesce(sum(cap), 0) FROM capped WHERE weight * level >= cap) AS c,
          (SELECT coalesce(sum(weight), 0) FROM capped WHERE weight * level < cap) AS w,
          (SELECT sum(source_size) FROM capped) AS total FROM levels)
  WHERE n <> clamped),
targets AS (SELECT *, least(CAST(cap AS DOUBLE), weight * (SELECT max_by(level, turn) FROM levels)) AS target FROM capped),
plans AS (SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS whole FROM targets),
wanted AS (SELECT *, CAST(round(target - whole * source_size) AS BIGINT) AS extra FROM plans),
placed AS (
  SELECT s.doc_id, s.size, w.source_size, w.target, w.whole, w.extra,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u, s.doc_id NULLS FIRST, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target, CAST(whole AS INTEGER) AS whole,
       CAST(whole * size + greatest(0, least(size, extra - ahead)) AS BIGINT) AS taken
FROM placed
"""
