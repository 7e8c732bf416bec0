"""Operator 13: resampling of documents towards a target distribution.

A document's features are the runs of ``least`` to ``most`` consecutive words, hashed to
``buckets``. The gain of a bucket is the logarithm of its smoothed share of the target's
features over that of the corpus, in thousandths, floored; a document's weight is the floored
mean of its features' gains. Weight plus a Gumbel variate drawn from the doc_id is its score,
so that the highest scores are a sample without replacement by importance.

* Weights. Counts of features are dense arrays per task, summed by bucket; all texts of both
  tables count. The gains are one array of ``buckets`` numbers, which every task holds: its
  size is a parameter, not a matter of the data. Words are found in UTF-8 by a byte table.
* Ranks. All documents long enough are sorted by a least-significant-digit radix sort over
  the bits of (score descending, doc_id, number of features) that differ at all. Every row
  has a position; a block is ``BLOCK`` positions. A pass counts each digit in each block,
  sums the counts before every (digit, block) to global offsets, and sends a row to the
  offset of its digit and block plus its place among the block's rows of that digit, so
  passes are stable. The last position is the rank. A pass is a written table of positions:
  a lost executor repeats its tasks of one pass, with the same positions.

Blocks bound every window, whatever the keys: a hot score or doc_id is spread over the
blocks like any other.

Defined results: a null or empty text has no features and weight 0; a null doc_id draws its
variate as the empty id and comes last among equal scores; repeated rows are documents of
their own with equal scores and consecutive ranks; rows equal in score, doc_id and number of
features are interchangeable; very long texts are counted whole; an empty ``docs`` gives an
empty result, and without target texts all targets' counts are zero; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize, table

LEAST = MOST = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
DIGIT = 11  # bits of a digit
BLOCK = 1 << 13  # rows of a block
FEATURES_HELD = 300_000  # buckets of features a task keeps at hand
FEATURES_AT_ONCE = 1 << 20
SIGN = -(1 << 63)

#: Bytes of no word become a blank, A to Z become lower case; bytes of other scripts stay.
_WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


class _Buckets(dict):
    """The bucket of a feature's bytes."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= FEATURES_HELD:
            self.clear()
        self[feature] = value = zlib.crc32(feature) % self.buckets
        return value


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def _n_features(words: list[bytes], least: int, most: int) -> int:
    return sum(max(0, len(words) - n + 1) for n in range(least, most + 1))


def _feature_buckets(words: list[bytes], least: int, most: int, buckets: _Buckets) -> Iterator[np.ndarray]:
    """The buckets of all runs, in arrays of bounded length."""
    for n in range(least, most + 1):
        for start in range(0, max(0, len(words) - n + 1), FEATURES_AT_ONCE):
            part = words[start : start + FEATURES_AT_ONCE + n - 1]
            runs = part if n == 1 else map(b" ".join, zip(*[part[i:] for i in range(n)], strict=False))
            yield np.fromiter(map(buckets.__getitem__, runs), np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch], least: int, most: int, buckets: int) -> Iterator[pa.RecordBatch]:
    counts, at_hand = np.zeros(buckets, np.int64), _Buckets(buckets)
    for batch in batches:
        found = [f for t in batch.column(0).cast(pa.binary()) for f in _feature_buckets(_words(t.as_py()), least, most, at_hand)]
        counts += np.bincount(np.concatenate([*found, np.empty(0, np.int64)]), minlength=buckets)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, least: int = LEAST, most: int = MOST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of ``text``; at most one row per task and bucket is shuffled."""
    counted = texts.select("text").mapInArrow(partial(_count_batches, least=least, most=most, buckets=buckets), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, least: int = LEAST, most: int = MOST, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket; at most ``buckets`` rows come to the driver from each table."""

    def dense(texts: DataFrame) -> np.ndarray:
        counts = np.zeros(buckets)
        for row in bucket_counts(texts, least, most, buckets).collect():
            counts[row.bucket] = row.n
        return counts

    s, t = dense(docs), dense(target)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _weight_batches(batches: Iterator[pa.RecordBatch], gain: np.ndarray, least: int, most: int) -> Iterator[pa.RecordBatch]:
    at_hand = _Buckets(len(gain))
    for batch in batches:
        words, counts, weights = [], [], []
        for text in batch.column(1).cast(pa.binary()):
            found = _words(text.as_py())
            n = _n_features(found, least, most)
            total = sum(int(gain[f].sum()) for f in _feature_buckets(found, least, most, at_hand))
            words.append(len(found))
            counts.append(n)
            weights.append(total // n if n else 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, pa.int64()) for v in (words, counts, weights)]], names=["doc_id", "n_words", "n_features", "weight"])


def weights(docs: DataFrame, gain: np.ndarray, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_weight_batches, gain=gain, least=least, most=most), "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """A Gumbel variate in thousandths, floored, drawn from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _bit_fields(rows: DataFrame, keys: list[tuple[Column, bool]]) -> list[tuple[Column, int]]:
    """Per key, least significant first, a long of which the low bits sort like it, and how many of them differ at all."""
    # as unsigned numbers, so that a difference of any size fits; null is a field of its own, and comes last
    plain = [F.coalesce(c, F.lit(0)).cast("long").bitwiseXOR(F.lit(SIGN)) for c, _ in keys]
    bounds = rows.agg(
        *[f(F.coalesce(c, F.lit(0)).cast("long")).alias(f"{n}{i}") for i, (c, _) in enumerate(keys) for n, f in (("low", F.min), ("high", F.max))],
        *[F.max(c.isNull()).alias(f"null{i}") for i, (c, _) in enumerate(keys)],
    ).first()
    fields = []
    for i, ((column, descending), bits) in enumerate(zip(keys, plain, strict=True)):
        low, high = bounds[f"low{i}"], bounds[f"high{i}"]
        width = 0 if low is None else ((low ^ high) & ((1 << 64) - 1)).bit_length()
        fields.append((F.bitwise_not(bits) if descending else bits, width))
        fields.append((F.when(column.isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long"), 1 if bounds[f"null{i}"] else 0))
    return fields


def _digits(fields: list[tuple[Column, int]], bits: int) -> list[Column]:
    """The digits of the fields put side by side, least significant first."""
    total, digits = sum(width for _, width in fields), []
    for start in range(0, total, bits):
        digit, at = F.lit(0).cast("long"), 0
        for column, width in fields:
            low, high = max(at, start), min(at + width, start + bits)
            if low < high:
                part = F.shiftrightunsigned(column, low - at).bitwiseAND(F.lit((1 << (high - low)) - 1))
                digit = digit.bitwiseOR(F.shiftleft(part, low - start))
            at += width
        digits.append(digit.cast("int"))
    return digits


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` as a written table with a first position: the offset of the row's file plus its place in it."""
    written = materialize(rows, "sort-input").select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    sizes = written.groupBy("__file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = sizes.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    return written.join(offsets, "__file").select(*rows.columns, (F.col("__offset") + F.col("__at")).alias("position"))


def _offsets(counts: DataFrame) -> DataFrame:
    """(block, digit, start): the global offset of each block's rows of a digit, digits in ascending order."""
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    lower = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # one row per digit
    below = totals.select("digit", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("below"))
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(below), "digit")
    return placed.select("block", "digit", (F.col("below") + F.col("before")).alias("start"))


def _pass(rows: DataFrame, digit: Column, block: int) -> DataFrame:
    """One stable counting sort: the new position of every row."""
    keyed = rows.select("*", F.floor(F.col("position") / block).alias("block"), digit.alias("digit"))
    starts = _offsets(materialize(keyed.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n")), "digit-counts"))
    among = Window.partitionBy("block", "digit").orderBy("position")  # at most the rows of a block
    placed = keyed.withColumn("place", F.row_number().over(among) - 1).join(starts, ["block", "digit"])
    kept = [c for c in rows.columns if c != "position"]
    return placed.select(*kept, (F.col("start") + F.col("place")).alias("position"))


def radix_sort(rows: DataFrame, keys: list[tuple[Column, bool]], bits: int = DIGIT, block: int = BLOCK) -> DataFrame:
    """``rows`` with ``position``, 0, 1, 2..., in the order of ``keys``: (column by name, descending), most significant first; nulls last."""
    ordered = materialize(_numbered(rows), "positions")
    for digit in _digits(_bit_fields(ordered, keys[::-1]), bits):
        ordered = materialize(_pass(ordered, digit, block), "positions")
    return ordered


def resample(
    docs: DataFrame, target: DataFrame, least: int = LEAST, most: int = MOST, buckets: int = BUCKETS,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED, bits: int = DIGIT, block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per document; rank is null for documents that are not drawn."""
    scored = weights(docs, gains(docs, target, least, most, buckets), least, most)
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = materialize(scored, "scored-documents")
    kept = ["doc_id", "n_features", "weight", "score"]
    long_enough = scored.where(F.col("n_words") >= min_words).select(*kept)
    ranked = radix_sort(long_enough, [(F.col("score"), True), (F.col("doc_id"), False), (F.col("n_features"), False)], bits, block)
    drawn = percent * ranked.count() // 100
    rank = F.when(F.col("position") < drawn, F.col("position") + 1)
    short = scored.where(F.col("n_words") < min_words).select(*kept, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*kept, rank.alias("rank")).union(short)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))"
_CRC = "xor(list_reduce(list_prepend(4294967295, octets), lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295)"
_TOKENS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP13_SQL = f"""
WITH crc_table AS (SELECT {_CRC_TABLE}::BIGINT[] AS crc),
corpus AS (SELECT doc_id, unnest({_TOKENS}) AS word FROM documents),
target AS (SELECT unnest({_TOKENS}) AS word FROM benchmark),
vocabulary AS (
    SELECT word, list_transform(range(1, octet_length(encode(word)) + 1),
        lambda i: ('0x' || substr(hex(encode(word)), (2 * i - 1)::INTEGER, 2))::BIGINT) AS octets
    FROM (SELECT word FROM corpus UNION SELECT word FROM target)),
hashed AS (SELECT word, ({_CRC} % {BUCKETS})::BIGINT AS bucket FROM vocabulary, crc_table),
s AS (SELECT bucket, count(*) AS n FROM corpus JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t_all),
gain AS (
    SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + {BUCKETS})
        / ((s.n + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), totals),
weighed AS (
    SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM corpus JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE))))::BIGINT AS score
    FROM documents d LEFT JOIN weighed USING (doc_id)),
ordered AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END::BIGINT AS rank
FROM scored LEFT JOIN ordered USING (doc_id)
"""
