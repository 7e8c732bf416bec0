"""Operator 7: benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits, lower-cased; in scripts written without spaces
each character is a token. A seed is the hash of the seven tokens
that a fixed mask selects from consecutive ones. Wherever two of 13 tokens are
substituted, one of the three masks has a place in the 13 that avoids both, so no window
that passes the check is missed. Seeds of the benchmark and of the
documents are joined; every hit names an alignment (document, item, offset), and that
alignment is verified token by token: it is a leak when some ``window`` of 13 aligned
tokens (the whole item, if it is shorter) agrees in at least 80 % of its places.

Items shorter than the window share two masks of four tokens: of six tokens with one
substitution, and so of up to twelve with the two that the check allows, one of them has a
place that avoids the substitutions. Items of under six tokens must agree in every token;
those of under four are a seed as they are. Every item with a token is sought; ``min_tokens``
asks for more evidence, since an item of a word or two is found in many documents.

The seed table of the benchmark is broadcast when its counted rows stay below
``broadcast_rows``; a larger one is joined by shuffle.

Defined results: a null or empty text has no tokens and no leak; a repeated passage is
reported once per offset; repeated rows of a document count once; equal items are each
reported; a null doc_id is a document like any other; an empty table of documents or of
items gives no leak; other columns of either table are not read, and texts of any length
are read whole. An ``agreement`` below 0.8 is refused, since the masks would miss passages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize, table

#: Selected positions; of the places these masks have in 13 tokens, one avoids any given two tokens.
MASKS = ((0, 1, 2, 4, 5, 9, 10), (0, 1, 2, 3, 4, 6, 7), (0, 1, 5, 6, 7, 8, 9))
SPAN = 13
#: The masks of items that are shorter than SPAN, and of those shorter than EXACT, which must agree in full.
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 4, 5))
EXACT = 6
MIN_TOKENS = 1
#: Code points of scripts written without spaces between words: Thai to Lao, Myanmar, Khmer, kana, Han. Ranges, as looking up each character's script costs more than the rest.
UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
TOKEN = rf"[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+|[\p{{L}}\p{{N}}&&[{UNSPACED}]]"
WINDOW = 13
AGREEMENT = 0.8
BROADCAST_ROWS = 1_000_000


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


Mask = tuple[int, int, tuple[int, ...]]


def _masks(lengths: Sequence[int]) -> list[Mask]:
    """(fewest tokens, most tokens, positions): the masks that seek items of these numbers of tokens, SPAN standing for any more."""
    whole = [(n, n, tuple(range(n))) for n in range(1, len(SHORT_MASKS[0]))]
    short = [(len(SHORT_MASKS[0]), SPAN - 1, SHORT_MASKS[0]), (EXACT, SPAN - 1, SHORT_MASKS[1])]
    masks = [*((SPAN, SPAN, mask) for mask in MASKS), *short, *whole]
    return [(low, high, mask) for low, high, mask in masks if any(low <= n <= high for n in lengths)]


def _seeds(hashes: str, masks: list[Mask]) -> Column:
    """Array of arrays: for each mask the seeds at every position."""

    def of(number: int, mask: tuple[int, ...]) -> Column:
        span = mask[-1] + 1
        places = F.sequence(F.lit(1), F.size(hashes) - span + 1)
        made = F.transform(places, lambda i: F.xxhash64(F.lit(number), *[F.get(F.col(hashes), i + (p - 1)) for p in mask]))
        return F.when(F.size(hashes) >= span, made).otherwise(F.array().cast("array<bigint>"))

    return F.array(*[of(number, mask) for number, (_, _, mask) in enumerate(masks)])


def _token_hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda t: F.xxhash64(t))


def _placed(rows: DataFrame, masks: list[Mask], *keys: str) -> DataFrame:
    """A row per seed: keys, ``seed`` and the position ``at`` of its first token."""
    each = rows.select(*keys, F.explode(_seeds("hashes", masks)).alias("seeds"))
    return each.select(*keys, F.posexplode("seeds").alias("at", "seed"))


def _items(benchmark: DataFrame, min_tokens: int) -> DataFrame:
    items = benchmark.select(F.col("item_id"), _token_hashes(F.col("text")).alias("hashes"))
    return items.where(F.size("hashes") >= max(min_tokens, 1))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    agreement: float = AGREEMENT,
    broadcast_rows: int = BROADCAST_ROWS,
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """(doc_id, text_hash, item_id, start, end, equal): verified alignments.

    ``start`` and ``end`` delimit, in token numbers of the document, the aligned part
    of the item; ``equal`` counts the places there that agree.
    """
    if agreement < AGREEMENT:
        raise ValueError(f"agreement must be at least {AGREEMENT}")
    items = materialize(_items(benchmark, min_tokens), "benchmark-items")
    length = F.least(F.size("hashes"), F.lit(SPAN)).alias("n")
    masks = _masks([SPAN, *(r.n for r in items.select(length).distinct().collect())])  # at most SPAN values
    # an item is sought with the masks of its own length
    low, high = F.array(*[F.lit(m[0]) for m in masks]), F.array(*[F.lit(m[1]) for m in masks])
    each = items.select("item_id", length, F.posexplode(_seeds("hashes", masks)).alias("mask", "seeds"))
    own = F.col("n").between(F.get(low, F.col("mask")), F.get(high, F.col("mask")))
    sought = each.where(own).select("item_id", F.posexplode("seeds").alias("item_at", "seed"))
    sought = materialize(sought, "benchmark-seeds")
    lookup = F.broadcast(sought) if sought.count() <= broadcast_rows else sought

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _token_hashes(F.col("text")).alias("hashes"))
    hits = _placed(rows, masks, "doc_id", "text_hash").join(lookup, "seed")
    aligned = hits.select("doc_id", "text_hash", "item_id", (F.col("at") - F.col("item_at")).alias("offset")).distinct()
    aligned = materialize(aligned, "alignments")

    found = aligned.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct()
    texts = docs.withColumn("__h", F.xxhash64("text")).select(F.col("doc_id").alias("id"), "__h", "text")
    texts = texts.join(found, F.expr("id <=> d and __h = h"), "left_semi").dropDuplicates(["id", "__h"])
    words = materialize(texts.select("id", "__h", _token_hashes(F.col("text")).alias("words")), "hit-tokens")
    # only the aligned slice of a text goes on
    first = F.greatest(F.col("offset"), F.lit(0))
    sliced = (
        aligned.join(words, F.expr("doc_id <=> id and text_hash = __h")).join(items, "item_id")
        .withColumn("start", first)
        .withColumn("mine", F.slice("words", first + 1, F.size("hashes") - (first - F.col("offset"))))
        .withColumn("theirs", F.slice("hashes", first - F.col("offset") + 1, F.size("mine")))
        .select("doc_id", "text_hash", "item_id", "start", "mine", "theirs", F.size("hashes").alias("n"))
    )
    same = F.zip_with("mine", "theirs", lambda a, b: F.when(a == b, 1).otherwise(0))
    judged = sliced.withColumn("same", same).withColumn("w", F.least(F.lit(window), F.col("n"))).where(F.size("same") >= F.col("w"))
    sums = F.transform(
        F.sequence(F.lit(1), F.size("same") - F.col("w") + 1),
        lambda i: F.aggregate(F.slice(F.col("same"), i, F.col("w")), F.lit(0), lambda a, b: a + b),
    )
    enough = F.when(F.col("n") < EXACT, F.col("w")).otherwise(F.ceil(F.col("w") * agreement))
    verified = judged.where(F.array_max(sums) >= enough)
    equal = F.aggregate("same", F.lit(0), lambda a, b: a + b)
    return verified.select("doc_id", "text_hash", "item_id", "start", (F.col("start") + F.size("same")).alias("end"), equal.alias("equal"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, agreement: float = AGREEMENT, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``docs`` without the documents that hold a leak."""
    found = leaks(docs, benchmark, window, agreement, min_tokens=min_tokens)
    found = materialize(found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct(), "leaking")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(found, F.expr("row.doc_id <=> d and xxhash64(row.text) = h"), "left_anti").select("row.*")


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "end", "equal")
