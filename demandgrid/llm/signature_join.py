"""Operator 12: MinHash near-duplicates by an inverted join on signature coordinates.

A document's set holds its distinct ``SHINGLE``-word shingles. Documents with
100 * |A and B| >= PERCENT * |A or B| are linked; a group is a connected component.

* Documents of equal sets are one class; all that follows compares classes.
* A class has one minimum per coordinate (``COORDINATES`` permutations of the shingle
  hashes). A posting is a class under a (coordinate, value) pair. Two classes match in as
  many coordinates as they have postings in common.
* Prefix merging: a class keeps its postings in order of their list's length. Two classes
  that match in ``MATCHES`` coordinates share one of the first COORDINATES - MATCHES + 1, so
  only these are joined. Values that no other class has come first and are in no list, so a
  class with fewer than ``MATCHES`` shared values is in none.
* Each list's members are first compared with its most central member (the one with the
  most and the longest shared lists): one row per posting. The links found are contracted;
  lists whose members are then in one component are done.
* Skip merging: in the other lists the coordinates are counted in blocks, and a pair goes as
  soon as the coordinates left cannot bring it to ``MATCHES``. Pairs of one component and of
  too unequal sizes are skipped. Lists longer than ``TILE`` are dealt out to tiles.
* A sketch of the parities of the shingle hashes bounds the sets' difference from below, so
  pairs that differ too much go without being fetched; no linked pair is lost by it.
* What is left is confirmed on the full sets, which are read once for the classes in lists;
  a bitmap of fixed size keeps most other documents out of that join.

A pair at the threshold reaches 38 of 64 matches with probability 0.9999, more similar ones
more surely. Shingles and sets are compared as 64-bit hashes. A list of n members that stay
in several components costs up to n squared comparisons (in numpy, spread over tiles).

Defined results: a null text or one without words has the empty set and is linked with
nothing; a text of fewer words than a shingle is one shingle; repeated rows are members of
one group; a null doc_id never names a group with another member, and counts as equal to a
null component_id in ``kept``; very long texts are taken whole; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize, table, thinned
from demandgrid.llm.components import components

SHINGLE = 4
PERCENT = 80
COORDINATES = 64
MATCHES = 38
SKIP_BLOCK = 16  # coordinates counted at once
PARITY_BITS = 1024
TILE = 4096
WORDS_HELD = 300_000  # word hashes a task keeps at hand
HASHES_AT_ONCE = 1 << 20
TEXTS_AT_ONCE = 2048
POSTS_PER_TASK = 20_000

SKETCH = "doc_id long, text_hash long, c long, n long, sig array<int>, odd array<long>"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _odd_numbers(seed: int, count: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingle_set(text: bytes | None, words: dict, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; bytes.lower and bytes.split are ASCII-only, as defined."""
    parts = (text or b"").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    taken = min(width, len(parts))  # a shingle's number of words is part of its hash
    sums = np.full(len(parts) - taken + 1, taken, np.uint64)
    for j, factor in enumerate(_odd_numbers(12, width)[:taken]):
        sums += hashes[j : len(parts) - taken + 1 + j] * factor
    return np.unique(_mixed(sums))


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Minima of the non-empty ``sets``, one row each, as 32-bit values."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), coordinates), np.uint32)
    for i, (a, b) in enumerate(zip(_odd_numbers(64, coordinates), _odd_numbers(65, coordinates), strict=True)):
        out[:, i] = np.minimum.reduceat((values * a + b) >> np.uint64(32), starts)
    return out


def parities(sets: list[np.ndarray], bits: int = PARITY_BITS) -> np.ndarray:
    """Per set the parity of the number of hashes in each of ``bits`` cells, as 64-bit words."""
    cells = np.concatenate([(s >> np.uint64(20)) % np.uint64(bits) + np.uint64(i * bits) for i, s in enumerate(sets)])
    odd = (np.bincount(cells.astype(np.int64), minlength=len(sets) * bits) & 1).astype(np.uint8).reshape(len(sets), bits)
    return np.packbits(odd, axis=1, bitorder="little").view(np.uint64)


def _arrays(rows: np.ndarray, at: np.ndarray, total: int, kind: pa.DataType) -> pa.Array:
    """``rows[i]`` as a list at place ``at[i]`` of ``total``, null elsewhere."""
    lengths = np.zeros(total, np.int32)
    lengths[at] = rows.shape[1]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    empty = np.ones(total, bool)
    empty[at] = False
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind), mask=pa.array(empty))


def _grouped(sets: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    group, size = [], 0
    for s in sets:
        group.append(s)
        size += len(s)
        if size >= HASHES_AT_ONCE or len(group) >= TEXTS_AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


def _sketch_batches(batches: Iterator[pa.RecordBatch], width: int, coordinates: int) -> Iterator[pa.RecordBatch]:
    words = _WordHashes()
    for batch in batches:
        at = 0
        for sets in _grouped(shingle_set(t.as_py(), words, width) for t in batch.column(2).cast(pa.binary())):
            filled = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
            some = [sets[i] for i in filled]
            names = [xxhash.xxh64_intdigest(s.tobytes()) if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i).slice(at, len(sets)) for i in range(2)],
                    pa.array(np.array(names, np.uint64).view(np.int64), mask=np.array([not len(s) for s in sets], bool)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _arrays(signatures(some, coordinates).view(np.int32) if some else np.empty((0, 1), np.int32), filled, len(sets), pa.int32()),
                    _arrays(parities(some).view(np.int64) if some else np.empty((0, 1), np.int64), filled, len(sets), pa.int64()),
                ],
                names=["doc_id", "text_hash", "c", "n", "sig", "odd"],
            )
            at += len(sets)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def sketches(docs: DataFrame, shingle: int = SHINGLE, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, text_hash, c, n, sig, odd): class, set size, signature and parities; c, sig and odd are null for the empty set."""
    return _rows(docs).mapInArrow(partial(_sketch_batches, width=shingle, coordinates=coordinates), SKETCH)


def _set_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    words = _WordHashes()
    for batch in batches:
        for name, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
            s = shingle_set(text.as_py(), words, width)
            yield pa.RecordBatch.from_arrays([pa.array([name.as_py()], pa.int64()), pa.array([s.view(np.int64)], pa.list_(pa.int64()))], names=["c", "s"])


def _sets(docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(c, s): the full set of every class, from its first document."""
    first = materialize(classes.select("c", F.col("place.doc_id").alias("id"), F.col("place.text_hash").alias("h")), "class-documents")
    found = thinned(_rows(docs), "text_hash", first, "h").join(first, F.expr("doc_id <=> id and text_hash = h"))
    sets = found.select("c", "text").mapInArrow(partial(_set_batches, width=shingle), "c long, s array<long>")
    return materialize(sets.dropDuplicates(["c"]), "class-sets")


def _near(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def postings(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """(t, c, n, held, weight): the prefix of every class that shares ``matches`` values with others.

    ``held`` is the number of its shared values and ``weight`` the sum of their lists' lengths.
    """
    cells = classes.select("c", "n", F.posexplode("sig").alias("i", "v"))
    value = F.shiftleft(F.col("i").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    cells = cells.select("c", "n", value.alias("t"))
    shared = materialize(cells.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-values")
    held = cells.join(shared, "t").groupBy("c", "n").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("ts"))
    size = F.size("ts")
    prefix = held.where(size >= matches).select(
        "c", "n", size.alias("held"), F.aggregate("ts", F.lit(0).cast("long"), lambda x, e: x + e["df"]).alias("weight"),
        F.explode(F.slice("ts", 1, size - matches + 1)).alias("e"),
    )
    return prefix.select(F.col("e.t").alias("t"), "c", "n", "held", "weight")


def _alike(pairs: DataFrame, classes: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs (a, b) that match in enough coordinates and whose parities allow the similarity."""
    side = lambda name: classes.select(F.col("c").alias(name), *[F.col(x).alias(f"{x}_{name}") for x in ("n", "sig", "odd")])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    hits = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda x: x))
    apart = F.aggregate(F.zip_with("odd_a", "odd_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    allowed = (100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return both.where((hits >= matches) & allowed).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked by their full sets."""
    both = pairs.join(sets.toDF("a", "s"), "a").join(sets.toDF("b", "t"), "b")
    shared = F.size(F.array_intersect("s", "t"))
    linked = both.select("a", "b", shared.alias("shared"), (F.size("s") + F.size("t")).alias("both"))
    return linked.where(100 * F.col("shared") >= percent * (F.col("both") - F.col("shared"))).select("a", "b")


def _candidates(keys: np.ndarray, sizes: np.ndarray, roots: np.ndarray, sig: np.ndarray, odd: np.ndarray, matches: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of one key that may be linked; rows are sorted by key and size."""
    left, right = [], []
    i = np.arange(len(keys))
    for step in range(1, len(keys)):
        i = i[i + step < len(keys)]
        # sizes ascend within a key: what is too large now stays so
        i = i[(keys[i] == keys[i + step]) & (100 * sizes[i] >= percent * sizes[i + step])]
        if not len(i):
            break
        c = i[roots[i] != roots[i + step]]
        counted = np.zeros(len(c), np.int16)
        for start in range(0, sig.shape[1], SKIP_BLOCK):
            block = slice(start, start + SKIP_BLOCK)
            counted += (sig[c, block] == sig[c + step, block]).sum(axis=1, dtype=np.int16)
            reach = counted + max(0, sig.shape[1] - start - SKIP_BLOCK) >= matches
            c, counted = c[reach], counted[reach]
        apart = np.bitwise_count(odd[c] ^ odd[c + step]).sum(axis=1, dtype=np.int64)
        c = c[(100 + percent) * apart <= (100 - percent) * (sizes[c] + sizes[c + step])]
        left.append(c)
        right.append(c + step)
    return np.concatenate([*left, np.empty(0, np.int64)]), np.concatenate([*right, np.empty(0, np.int64)])


def _matrix(column: pa.Array, kind: type, rows: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.view(kind).reshape(rows, -1) if rows else np.empty((0, 1), kind)


def _candidate_batches(batches: Iterator[pa.RecordBatch], matches: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Input (k, n, c, root, sig, odd) sorted by k and n; the last key of a batch waits for the next batch."""
    held: list[np.ndarray] | None = None

    def found(part: list[np.ndarray]) -> pa.RecordBatch:
        a, b = _candidates(part[0], part[1], part[3], part[4], part[5], matches, percent)
        pairs = np.unique(np.stack([np.minimum(part[2][a], part[2][b]), np.maximum(part[2][a], part[2][b])], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        new += [_matrix(batch.column(4), np.int32, batch.num_rows), _matrix(batch.column(5), np.uint64, batch.num_rows)]
        held = new if held is None else [np.concatenate(p) for p in zip(held, new, strict=True)]
        cut = int(np.searchsorted(held[0], held[0][-1]))
        if cut:
            yield found([p[:cut] for p in held])
            held = [p[cut:] for p in held]
    if held is not None:
        yield found(held)


def _mixed_lists(posts: DataFrame, lists: DataFrame, links: DataFrame, classes: DataFrame, tile: int) -> DataFrame:
    """(k, n, c, root, sig, odd): members of the lists, or tiles of lists, that hold several components."""
    roots = components(links, "a", "b").withColumnRenamed("node", "c")
    rooted = posts.join(lists.select("t", "members"), "t").select("t", "members", "c", "n").join(roots, "c", "left")
    rooted = materialize(rooted.withColumn("root", F.coalesce("root", "c")), "rooted-postings")
    mixed = rooted.groupBy("t").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("t")
    parts = F.ceil(F.col("members") / tile).cast("int")
    mine = F.pmod(F.xxhash64("c", F.lit(3)), parts)
    tiles = F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.xxhash64("t", F.least(mine, j), F.greatest(mine, j)))
    dealt = rooted.join(mixed, "t").select("n", "c", "root", F.explode(F.when(F.col("members") <= tile, F.array("t")).otherwise(tiles)).alias("k"))
    return dealt.join(classes.select("c", "sig", "odd"), "c").select("k", "n", "c", "root", "sig", "odd")


def class_links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, matches: int = MATCHES, shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """(a, b): confirmed links between classes, enough to join all that are joined."""
    posts = materialize(postings(classes, matches), "postings")
    central = F.struct("held", "weight", "c")
    lists = posts.groupBy("t").agg(F.count(F.lit(1)).alias("members"), F.max_by(F.struct("c", "n"), central).alias("lead")).where("members > 1")
    lists = materialize(lists, "posting-lists")
    listed = posts.join(lists, "t")
    classes = materialize(classes.join(listed.select("c").distinct(), "c", "left_semi"), "listed-classes")
    sets = _sets(docs, classes, shingle)

    near = (F.col("c") != F.col("lead.c")) & _near(F.col("n"), F.col("lead.n"), percent)
    pairs = materialize(listed.where(near).select(F.col("c").alias("a"), F.col("lead.c").alias("b")).distinct(), "lead-pairs")
    stars = materialize(_confirmed(_alike(pairs, classes, matches, percent), sets, percent), "lead-links")

    members = materialize(_mixed_lists(posts, lists, stars, classes, tile), "mixed-lists")
    tasks = 1 + members.count() // POSTS_PER_TASK
    in_order = members.repartition(tasks, "k").sortWithinPartitions("k", "n")
    rest = in_order.mapInArrow(partial(_candidate_batches, matches=matches, percent=percent), "a long, b long").distinct()
    return stars.union(_confirmed(materialize(rest, "match-pairs"), sets, percent))


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, coordinates: int = COORDINATES, matches: int = MATCHES, tile: int = TILE
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document."""
    sketch = materialize(sketches(docs, shingle, coordinates), "set-sketches")
    place = F.min(F.struct("doc_id", "text_hash")).alias("place")
    classes = sketch.where("n > 0").groupBy("c").agg(
        place, F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("odd").alias("odd")
    )
    classes = materialize(classes, "set-classes")
    links = materialize(class_links(docs, classes, percent, matches, shingle, tile), "class-links")
    rooted = classes.select("c", "first").join(components(links, "a", "b").withColumnRenamed("node", "c"), "c", "left")
    rooted = materialize(rooted.select("c", "first", F.coalesce("root", "c").alias("root")), "class-roots")
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(names, "root").select("c", "component_id"), "class-names")
    joined = sketch.select("doc_id", "n", "c").join(named, "c", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op12_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: Sets compared by the shingles they share; equal sets are one class, and the components are the fixed point of smallest labels.
OP12_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i, len(w) AS n FROM words),
runs AS (
  SELECT doc_id, i, n, concat_ws(' ', t, lead(t, 1) OVER o, lead(t, 2) OVER o, lead(t, 3) OVER o) AS g
  FROM places WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), filled AS (
  SELECT doc_id, list_sort(list(DISTINCT g)) AS s FROM runs WHERE i <= greatest(n - 3, 1) GROUP BY doc_id
), sets AS (
  SELECT doc_id, coalesce(s, []) AS s FROM documents LEFT JOIN filled USING (doc_id)
), classes AS (
  SELECT s, min(doc_id) AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), cells AS (SELECT c, n, unnest(s) AS g FROM classes),
pairs AS (
  SELECT a.c AS a, b.c AS b FROM cells a JOIN cells b ON a.g = b.g AND a.c <> b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
  SELECT c AS node, c AS other FROM classes
  UNION SELECT reached.node, pairs.b FROM reached JOIN pairs ON reached.other = pairs.a
), roots AS (SELECT node, min(other) AS root FROM reached GROUP BY node)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM sets LEFT JOIN classes ON sets.s = classes.s LEFT JOIN roots ON classes.c = roots.node
"""
