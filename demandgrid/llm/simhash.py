"""Operator 8: SimHash near-duplicates with pivot distance tables.

A fingerprint has bit i set where more than half of the document's 4-word shingle
hashes (XXH64, seed 42) have it. Fingerprints that differ in at most four bits are
linked; a group is a connected component.

* Bits are counted in Arrow batches with numpy. Documents collapse to distinct
  fingerprints before anything is compared, so exact copies cost nothing.
* Two linked fingerprints agree in two of six bit blocks at least (four differing bits
  touch four blocks at most), so the fifteen pairs of blocks are the keys that bring
  linked fingerprints together; none is missed.
* Within a key, every fingerprint has a row of distances to ``pivots`` reference
  fingerprints. Since |d(x,p) - d(y,p)| <= d(x,y), a pair with a coordinate difference
  above four is discarded; what is left is verified on the fingerprints. Only links
  that join two so far separate fingerprints leave the task: fewer rows than members.
* Keys with more members than ``tile`` are dealt out to tiles (pairs of salted parts), so
  that no task holds a whole hot group.

Defined results: a null or empty text has fingerprint zero and is linked like any
other; a text of fewer than four words is one shingle; repeated rows are members of
one group; a null doc_id never names a group with another member; other columns of
the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize, table
from demandgrid.llm.components import components

SHINGLE = 4
DISTANCE = 4
BLOCKS = 6
PIVOTS = 16
TILE = 4096
CHUNK = 1 << 16  # shingles counted at once

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text; bytes.lower and bytes.split are ASCII-only, as defined."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)) if len(words) >= shingle else iter([b" ".join(words)])
    ones = np.zeros(64, dtype=np.int64)
    for _ in range(0, n, CHUNK):
        hashes = np.fromiter(map(_hash, islice(shingles, CHUNK)), dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary())
        prints = np.fromiter((fingerprint(t.as_py()) for t in texts), dtype=np.uint64, count=len(texts))
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(prints.view(np.int64))], names=["doc_id", "text_hash", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, print): the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, text_hash long, print long")


def _block_keys(bits: Column, blocks: int, distance: int) -> Column:
    """Keys of all choices of ``blocks - distance`` blocks: number of the choice, then the chosen bits."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    part = [F.shiftrightunsigned(bits, edges[b]).bitwiseAND(F.lit((1 << (edges[b + 1] - edges[b])) - 1)) for b in range(blocks)]
    return F.array(*[F.xxhash64(F.lit(i), *[part[b] for b in chosen]) for i, chosen in enumerate(combinations(range(blocks), blocks - distance))])


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, the same in every task."""
    return np.random.default_rng(8).integers(0, 1 << 63, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _links(keys: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join separate fingerprints of a key; ``keys`` is sorted."""
    table = np.bitwise_count(prints[:, None] ^ pivots()[None, :]).astype(np.int8)
    root = np.arange(len(keys))
    found: list[tuple[int, int]] = []
    i = np.arange(len(keys))
    for step in range(1, len(keys)):
        i = i[i + step < len(keys)]
        i = i[keys[i] == keys[i + step]]
        if not len(i):
            break
        c = i[root[i] != root[i + step]]
        for p in range(table.shape[1]):  # the largest coordinate difference, one coordinate at a time
            if not len(c):
                break
            c = c[np.abs(table[c, p] - table[c + step, p]) <= distance]
        c = c[np.bitwise_count(prints[c] ^ prints[c + step]) <= distance]
        for a in c.tolist():
            ra, rb = a, a + step
            while root[ra] != ra:
                ra = root[ra]
            while root[rb] != rb:
                rb = root[rb]
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
                found.append((a, a + step))
        if len(c):
            while (up := root[root]).tobytes() != root.tobytes():
                root = up
    at = np.array(found, dtype=np.int64).reshape(-1, 2)
    return prints[at[:, 0]], prints[at[:, 1]]


def _link_batches(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Input sorted by key; the last key of a batch waits for the next batch."""
    keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)

    def linked(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        several = np.zeros(len(k), dtype=bool)
        same = k[1:] == k[:-1]
        several[1:] |= same
        several[:-1] |= same
        a, b = _links(k[several], f[several], distance)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
        prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if len(keys):
            cut = int(np.searchsorted(keys, keys[-1]))
            yield linked(keys[:cut], prints[:cut])
            keys, prints = keys[cut:], prints[cut:]
    yield linked(keys, prints)


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(a, b): links that join all distinct fingerprints of ``prints`` within ``distance`` bits."""
    keyed = prints.select("print", F.explode(_block_keys(F.col("print"), blocks, distance)).alias("k"))
    hot = materialize(keyed.groupBy("k").count().where(F.col("count") > tile), "hot-keys")
    parts = F.ceil(F.col("count") / tile).cast("int")
    mine = F.pmod(F.xxhash64("print", F.lit(3)), parts)
    tiles = F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.xxhash64("k", F.least(mine, j), F.greatest(mine, j)))
    spread = (
        keyed.join(hot, "k", "left")
        .select("print", F.explode(F.when(F.col("count").isNull(), F.array("k")).otherwise(tiles)).alias("k"))
    )
    sorted_rows = spread.select("k", "print").repartition("k").sortWithinPartitions("k")
    return sorted_rows.mapInArrow(partial(_link_batches, distance=distance), "a long, b long")


def _grouped(prints: DataFrame, distance: int, blocks: int, tile: int) -> DataFrame:
    """(print, component_id) for every distinct fingerprint."""
    distinct = materialize(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    links = materialize(fingerprint_links(distinct.select("print"), distance, blocks, tile), "print-links")
    rooted = distinct.join(components(links, "a", "b").withColumnRenamed("node", "print"), "print", "left")
    rooted = materialize(rooted.select("print", "first", F.coalesce("root", "print").alias("root")), "print-roots")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(named, "root").select("print", "component_id")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(doc_id, text_hash, print, component_id) per document."""
    prints = materialize(fingerprints(docs), "prints")
    groups = materialize(_grouped(prints, distance, blocks, tile), "print-groups")
    return prints.join(groups, "print").select("doc_id", "text_hash", "print", "component_id")


def keep_one_of_each(docs: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id, then text hash.

    Documents without a doc_id are one document per group of equal ids, like any other.
    """
    members = materialize(near_duplicates(docs, distance, blocks, tile), "group-members")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    group = F.coalesce(F.col("component_id"), F.col("print"))
    kept = members.groupBy(group.alias("g"), F.col("component_id").isNull().alias("unnamed")).agg(F.min(place).alias("keep"))
    repeats = members.groupBy("doc_id", "text_hash").agg((F.count(F.lit(1)) > 1).alias("repeated"))
    chosen = kept.select(F.col("keep.doc_id").alias("kept_id"), F.col("keep.text_hash").alias("kept_hash")).join(
        repeats, F.expr("kept_id <=> doc_id and kept_hash = text_hash")
    ).select("kept_id", "kept_hash", "repeated")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("h", F.xxhash64("row.text"))
    rows = rows.join(materialize(chosen, "kept"), F.expr("row.doc_id <=> kept_id and h = kept_hash"))
    once = rows.where("repeated").groupBy("kept_id", "kept_hash").agg(F.first("row").alias("row"))
    return rows.where("not repeated").select("row").union(once.select("row")).select("row.*")


def op8_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
