"""Operator 6: quality rules with an n-gram perplexity band per language.

The model is a modified Kneser-Ney model of the 4-grams of UTF-16 code units of each
language's texts. Tasks count 4-grams of whole texts in numpy and merge them before the
shuffle; Spark adds the counts up, derives continuation counts, discounts and back-off
weights by group-bys and joins on packed keys (16 bits per unit, so context and suffix
are shifts), and writes the model as hash arrays sorted by range partition. Tasks read
these arrays from the shared folder; nothing passes through the driver. A text's score is
its log perplexity per unit. The alphabet bounds the model, not the number of documents.

A document is rejected when its log perplexity lies outside its language's band: the
median, plus or minus ``SPREAD`` robust deviations (1.4826 times the median absolute
deviation) and a slack that shrinks with the root of the text's length. Medians are taken
over the documents that pass the base rules. A document that fails a base rule is
rejected in any case.

Defined results: null and empty texts have no words and fail the base rule; a null
language is a language; a language whose texts all fail the base rules has no band and
rejects nothing more; repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize, shared_dir, table
from demandgrid.llm.warc import _open

ORDER = 4
CHUNK = 1 << 21  # code units handled at once
BEGIN = 2  # code unit that stands for what precedes a text
SPREAD = 6.0
SLACK = 4.0
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MASKS = [0, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFFFFFF, 0xFFFFFFFFFFFFFFFF]


def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams that end at each unit of the texts, and where each text begins among them."""
    streams = [np.frombuffer(t.encode("utf-16-le", "surrogatepass"), dtype=np.uint16) for t in texts]
    lengths = np.fromiter(map(len, streams), dtype=np.int64, count=len(streams))
    pad = np.full(ORDER - 1, BEGIN, np.uint16)
    line = np.concatenate([x for s in streams for x in (pad, s)]).astype(np.uint64)
    packed = line[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        packed |= line[ORDER - 1 - back : len(line) - back] << np.uint64(16 * back)
    starts = np.cumsum(lengths) - lengths
    keep = np.ones(len(packed), dtype=bool)
    gaps = starts[1:] + (ORDER - 1) * np.arange(len(starts) - 1)  # where the next text's padding begins
    for i in range(ORDER - 1):
        keep[gaps + i] = False
    return packed[keep], starts


def _chunks(rows: list[int], texts: list[str]) -> Iterator[list[int]]:
    part, size = [], 0
    for i in rows:
        part.append(i)
        size += len(texts[i])
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def _pieces(text: str) -> Iterator[tuple[str, int]]:
    """A long text in pieces that repeat the context; the number of units that only are context."""
    yield text[:CHUNK], 0
    for i in range(CHUNK, len(text), CHUNK):
        yield text[i - ORDER + 1 : i + CHUNK], ORDER - 1


def _by_lang(langs: list[str | None], texts: list[str]) -> dict[str | None, list[int]]:
    groups: dict[str | None, list[int]] = {}
    for i, (lang, text) in enumerate(zip(langs, texts, strict=True)):
        if text:
            groups.setdefault(lang, []).append(i)
    return groups


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    return keys[first], np.add.reduceat(counts, first)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        for lang, rows in _by_lang(langs, texts).items():
            parts = held.setdefault(lang, [])
            for chunk in _chunks(rows, texts):
                packed, _ = _units([texts[i] for i in chunk])
                parts.append(np.unique(packed, return_counts=True))
            if len(parts) > 4:
                parts[:] = [_merged(parts)]
    for lang, parts in held.items():
        keys, counts = _merged(parts)
        for i in range(0, len(keys), 1 << 16):
            part = keys[i : i + (1 << 16)].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(counts[i : i + (1 << 16)])], names=["lang", "key", "c"])


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, key, c): how often each packed 4-gram occurs in all texts of a language."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_count_batches, "lang string, key long, c long").groupBy("lang", "key").agg(F.sum("c").alias("c"))


def _mask(n: int) -> Column:
    return F.lit((1 << (16 * n)) - 1 if n < 4 else -1).cast("bigint")


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, n, key, logp, bow) of every n-gram, n = 1 to 4, from the counts of the 4-grams.

    ``logp`` is the interpolated log probability of the last unit; ``bow`` the log of the
    weight that an unseen unit after this n-gram leaves to the shorter context.
    """
    grams = {ORDER: materialize(counts, "grams-4")}
    for n in range(ORDER - 1, 0, -1):
        longer = grams[n + 1].select("lang", F.col("key").bitwiseAND(_mask(n)).alias("key"))
        grams[n] = materialize(longer.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("c")), f"grams-{n}")
    k = F.least(F.col("c"), F.lit(3))
    lower, tables = None, []
    contexts: dict[int, DataFrame] = {}
    for n in range(1, ORDER + 1):
        found = grams[n].groupBy("lang").agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)], F.count(F.lit(1)).alias("v"))
        y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
        cut = [
            F.greatest(F.lit(0.05), F.least(F.lit(i - 0.05), F.when(F.col(f"n{i}") > 0, i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")).otherwise(0.5 * i)))
            for i in (1, 2, 3)
        ]
        discounts = found.select("lang", F.array(*cut).alias("d"), "v")
        rows = grams[n].join(discounts.withColumnRenamed("lang", "l"), F.expr("lang <=> l")).drop("l")
        rows = rows.select("lang", "key", "c", "v", F.get("d", (k - 1).cast("int")).alias("d"), F.shiftrightunsigned("key", 16).alias("ctx"))
        stats = rows.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("kept_back"))
        contexts[n - 1] = materialize(stats.select("lang", "ctx", "total", (F.col("kept_back") / F.col("total")).alias("gamma")), f"contexts-{n - 1}")
        ctx = contexts[n - 1].select(F.col("lang").alias("l"), F.col("ctx").alias("x"), "total", "gamma")
        rows = rows.join(ctx, F.expr("lang <=> l and ctx = x")).drop("l", "x")
        if lower is None:
            rows = rows.withColumn("q", 1.0 / (F.col("v") + 1))
        else:
            below = lower.select(F.col("lang").alias("l"), F.col("key").alias("x"), F.col("p").alias("q"))
            rows = rows.join(below, (F.expr("lang <=> l")) & (F.col("key").bitwiseAND(_mask(n - 1)) == F.col("x"))).drop("l", "x")
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("q")
        lower = materialize(rows.select("lang", "key", p.alias("p")), f"probabilities-{n}")
        tables.append(lower)
    out = None
    for n, probabilities in enumerate(tables, 1):
        if n < ORDER:
            after = contexts[n].select(F.col("lang").alias("l"), F.col("ctx").alias("x"), "gamma")
            rows = probabilities.join(after, F.expr("lang <=> l and key = x"), "left")
        else:
            rows = probabilities.withColumn("gamma", F.lit(None).cast("double"))
        rows = rows.select("lang", F.lit(n).alias("n"), "key", F.log("p").cast("float").alias("logp"), F.coalesce(F.log("gamma"), F.lit(0.0)).cast("float").alias("bow"))
        out = rows if out is None else out.union(rows)
    return out


def _hash(keys: np.ndarray, n: int, lang: np.uint64) -> np.ndarray:
    """Hash of packed n-grams of a language: one-to-one for each order and language."""
    x = (keys ^ lang) + np.uint64((0x9E3779B97F4A7C15 * n) & MASKS[4])
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lang_seed(lang: str | None) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest((lang or "").encode(), seed=1 if lang is None else 0))


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        seeds = np.array([_lang_seed(x) for x in langs.dictionary.to_pylist()] + [_lang_seed(None)], dtype=np.uint64)
        which = langs.indices.fill_null(len(seeds) - 1).to_numpy(zero_copy_only=False)
        keys = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        orders = batch.column(1).to_numpy(zero_copy_only=False)
        hashes = np.zeros(len(keys), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for n in np.unique(orders):
                at = orders == n
                hashes[at] = _hash(keys[at], int(n), seeds[which[at]])
        signed = (hashes ^ np.uint64(1 << 63)).view(np.int64)  # sorts as the unsigned hash
        yield pa.RecordBatch.from_arrays([pa.array(signed), batch.column(3), batch.column(4)], names=["h", "logp", "bow"])


def write_model(model: DataFrame) -> str:
    """Sorted hash arrays in the shared folder; files are in the order of the hashes."""
    hashed = model.mapInArrow(_hash_batches, "h long, logp float, bow float")
    path = shared_dir(model.sparkSession, "ngram-model")
    hashed.repartitionByRange("h").sortWithinPartitions("h").write.parquet(path)
    return path


class HashArrays:
    """Look-up in hash arrays through an index of the hashes' leading bits."""

    def __init__(self, path: str):
        fs, at = _open(path)
        parts = pq.read_table(at, filesystem=fs)
        hashes = parts["h"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
        if len(hashes) and (hashes[1:] < hashes[:-1]).any():
            raise ValueError(f"{path} is not sorted")
        self.hashes, self.logp, self.bow = hashes, parts["logp"].to_numpy(), parts["bow"].to_numpy()
        bits = max(1, int(len(hashes)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.first = np.append(self.first, np.int32(len(hashes)))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of the hashes, -1 where there is none."""
        bucket = (wanted >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        place = np.full(len(wanted), -1, dtype=np.int32)
        left = np.nonzero(at < end)[0]
        at = at[left]
        while len(left):
            hit = self.hashes[at] == wanted[left]
            place[left[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at < end[left])
            left, at = left[more], at[more]
        return place

    def log_probabilities(self, packed: np.ndarray, lang: np.uint64) -> np.ndarray:
        """Log probability of the last unit of each packed 4-gram, backing off where needed."""
        out = np.zeros(len(packed))
        left = np.arange(len(packed))
        for n in range(ORDER, 0, -1):
            place = self.find(_hash(packed[left] & np.uint64(MASKS[n]), n, lang))
            hit = place >= 0
            out[left[hit]] += self.logp[place[hit]]
            left = left[~hit]
            if not len(left):
                return out
            if n > 1:
                context = (packed[left] >> np.uint64(16)) & np.uint64(MASKS[n - 1])
                place = self.find(_hash(context, n - 1, lang))
                out[left] += np.where(place >= 0, self.bow[place], 0.0)
        out[left] += np.log(1e-6)  # a unit that the language's texts do not have
        return out


_MIX = np.random.default_rng(6).integers(1, 1 << 63, size=WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[bytes] = set()
    copies = 0
    if b"\n" in data:
        for line in data.split(b"\n"):
            if line.strip():
                copies += line in seen
                seen.add(line)
    repeated = 0
    n = len(words) - WINDOW + 1
    if n > 1:
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.uint64, count=len(words))
        if len(known) < len(words):
            ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            ids ^= ids >> np.uint64(29)
            windows = np.zeros(n, dtype=np.uint64)
            for i in range(WINDOW):
                windows += ids[i : i + n] * _MIX[i]
            ranked = np.sort(windows)
            twice = ranked[1:][ranked[1:] == ranked[:-1]]
            if len(twice):
                starts = np.nonzero(np.isin(windows, twice))[0]
                covered = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(covered, starts, 1)
                np.add.at(covered, starts + WINDOW, -1)
                repeated = int((np.cumsum(covered[:-1]) > 0).sum())
    return len(words), chars, symbols, copies, repeated


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORED = "doc_id long, lang string, " + ", ".join(f"{s} long" for s in STATS) + ", n_units long, log_perplexity double"


def _score_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = HashArrays(path)
    for batch in batches:
        langs, texts = batch.column(1).to_pylist(), [t or "" for t in batch.column(2).to_pylist()]
        base = np.array([base_counts(t) for t in texts], dtype=np.int64).reshape(len(texts), len(STATS))
        total, units = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
        with np.errstate(over="ignore"):
            for lang, rows in _by_lang(langs, texts).items():
                seed = _lang_seed(lang)
                short = [i for i in rows if len(texts[i]) <= CHUNK]
                for chunk in _chunks(short, texts):
                    packed, starts = _units([texts[i] for i in chunk])
                    total[chunk] = np.add.reduceat(model.log_probabilities(packed, seed), starts)
                    units[chunk] = np.diff(np.append(starts, len(packed)))
                for i in (i for i in rows if len(texts[i]) > CHUNK):
                    for piece, context in _pieces(texts[i]):
                        packed, _ = _units([piece])
                        total[i] += model.log_probabilities(packed[context:], seed).sum()
                        units[i] += len(packed) - context
        score = pa.array(-total / np.maximum(units, 1), mask=units == 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(base[:, j]) for j in range(len(STATS))], pa.array(units), score],
            names=["doc_id", "lang", *STATS, "n_units", "log_perplexity"],
        )


def score_quality(docs: DataFrame, path: str) -> DataFrame:
    """Base counts, length in code units and log perplexity per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_score_batches, path=path), SCORED)


def judge(scored: DataFrame, spread: float = SPREAD, slack: float = SLACK) -> DataFrame:
    """``scored`` with base_failed, low, high and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = scored.withColumn("base_failed", failed)
    good = rows.where("not base_failed and log_perplexity is not null")
    middle = good.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, 10_000).alias("mid"))
    middle = materialize(middle.withColumnRenamed("lang", "l"), "perplexity-medians")
    off = good.join(middle, F.expr("lang <=> l")).groupBy("l", "mid").agg(F.percentile_approx(F.abs(F.col("log_perplexity") - F.col("mid")), 0.5, 10_000).alias("mad"))
    band = materialize(off, "perplexity-bands")
    width = F.col("mad") * 1.4826 * spread * (1 + slack / F.sqrt(F.greatest("n_units", F.lit(1))))
    out = rows.join(band, F.expr("lang <=> l"), "left").withColumn("low", F.col("mid") - width).withColumn("high", F.col("mid") + width)
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside).drop("l", "mid", "mad")


def quality(docs: DataFrame) -> DataFrame:
    """Counts, perplexity, band and verdict of every document, the model trained on all of them."""
    path = write_model(kneser_ney(count_grams(docs)))
    return judge(materialize(score_quality(docs, path), "quality-scores"))


def op6_perplexity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity", "low", "high")
