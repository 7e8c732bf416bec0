"""Operator 10: fuzzy line deduplication by MinHash, one line kept per component.

A line's shingles are the runs of five characters that begin at each of its characters,
lower-cased, with runs of spaces taken as one; a shorter line is a shingle of its own, so
that it equals only itself. Two lines are linked when their
shingle sets have a Jaccard similarity of 0.8 or more; of every component of linked
lines the first occurrence, by doc_id, text hash and line number, is kept.

* Equal lines are one line first, by one shuffle of the lines. What follows it up to the band keys
  needs no further shuffle.
* Signatures: a shingle is hashed once and falls into one cell of a grid of six rows and eight columns; a
  cell holds its least hash, an empty one that of the next cell of its row (of its column, where the row is empty). A band
  is six cells along a line of the grid, one of each row, for three slopes: 24 bands. They bring two lines of
  similarity 0.8 together with probability 0.99 (simulated, 70 shingles or more). Lines of at most 64 characters have
  a second such grid, of eight hashes a shingle, as one hash fills too few cells.
* Candidates: band keys are counted without their lines; only keys of several distinct lines
  meet their lines again, and only those lines' texts are read again. A band compares each
  member with one of them (a row per member, not per pair). A band whose members are
  then still in several components is searched for all remaining pairs, each in the first band
  that it shares. Sizes and a sketch of the parities of the shingle hashes, which bounds the difference
  of two sets from below, are part of the join condition; the sketch has bits enough for lines of some hundred
  characters, so that what leaves the join is close to the limit.
* Verification is exact, on the full sets of the shingles' 64-bit hashes: arrays of a pair's two lines, rows where a
  line is longer than ``PIECE``. Shuffle files of a written table go as soon as it is written.

All of it is DataFrame code. Hot lines are combined before their shuffle, and joins on line
hashes are ones that adaptive execution can split.

Defined results: a null or empty text has one line that is never judged; every line with
a word is judged (``min_chars`` asks for more evidence, counted in characters, so that
scripts without spaces are treated alike); repeated rows (same doc_id, same text) share one fate; equal
doc_ids with different texts are different documents; a null doc_id comes last.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm import base
from demandgrid.llm.base import discard, table, thinned, word_count
from demandgrid.llm.components import components

SIMILARITY = 0.8
WIDTH = 5
SHORT = 64  # lines of so many characters have a second grid of minima
THROWS = 8  # hashes of a shingle in the second grid
ROWS = 6
COLUMNS = 8
SLOPES = (0, 1, 3)
BANDS = 16  # of ``band_keys``
SHORT_BANDS = 32
MIN_WORDS = 1  # every line with a word is judged
MIN_CHARS = 1
BLANKS = " \t\x0b\x0c\r"
PARITY_WORDS = 16  # of 64 bits
TILE = 256  # members of a band, of which a task compares so many at once with the others
TASK_PAIRS = 4096  # pairs verified by a task
PIECE = 1 << 16  # shingles hashed at once
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST_ROWS = 1_000_000  # ids of lines in shared bands: broadcast up to this count, else joined by shuffle

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


# Banding by independent minima in numpy: what the bands of the grid are held against. The query does not run it.


def _flat(line: str) -> str:
    """Runs of spaces taken as one, none at the ends."""
    return " ".join(w for w in line.split(" ") if w) if "  " in line else line.strip(" ")


def _pieces(line: str, width: int = WIDTH) -> list[str]:
    """The line in overlapping pieces of at most ``PIECE`` runs, each run in one piece; a short line is filled up."""
    flat = _flat(line).ljust(width, "\0")
    return [flat[i : i + PIECE + width - 1] for i in range(0, len(flat) - width + 1, PIECE)]


def _run_hashes(pieces: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of all pieces, one after the other, and where each piece begins among them."""
    chars = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    hashes = chars[: len(chars) - width + 1].copy()
    for i in range(1, width):
        hashes *= _STEP
        hashes += chars[i : len(chars) - width + 1 + i]
    for factor in (_MIX, _STEP):
        hashes ^= hashes >> _HALF
        hashes *= factor
    hashes ^= hashes >> _HALF
    within_piece = np.ones(len(chars), dtype=bool)
    for i in range(1, width):
        within_piece[np.cumsum(sizes) - i] = False
    runs = sizes - width + 1
    return hashes[within_piece[: len(hashes)]], np.cumsum(runs) - runs


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and masks, the same in every task; the first ones do not depend on ``count``."""
    drawn = np.random.default_rng(10).integers(0, 1 << 32, size=(count, 2), dtype=np.uint32)
    return drawn[:, 0] | np.uint32(1), drawn[:, 1]


def band_keys(lines: list[str], bands: int = BANDS, rows_per_band: int = ROWS) -> np.ndarray:
    """A row of ``bands`` keys for every line."""
    keys = np.empty((len(lines), bands), dtype=np.uint64)
    factors, masks = _permutations(bands * rows_per_band)

    def signed(first: int, pieces: list[list[str]]) -> None:
        hashes, starts = _run_hashes([p for line in pieces for p in line])
        low = (hashes >> _HALF).astype(np.uint32)
        room = np.empty_like(low)
        line_starts = np.cumsum([0] + [len(line) for line in pieces[:-1]])
        for band in range(bands):
            key = np.full(len(pieces), band, dtype=np.uint64)
            for row in range(band * rows_per_band, (band + 1) * rows_per_band):
                np.multiply(low, factors[row], out=room)
                np.bitwise_xor(room, masks[row], out=room)
                key ^= np.minimum.reduceat(np.minimum.reduceat(room, starts), line_starts)
                key *= _STEP
                key ^= key >> _HALF
            keys[first : first + len(pieces), band] = key

    first, waiting, runs = 0, [], 0
    for line in lines:
        waiting.append(_pieces(line))
        runs += sum(map(len, waiting[-1]))
        if runs >= PIECE:
            signed(first, waiting)
            first, waiting, runs = first + len(waiting), [], 0
    if waiting:
        signed(first, waiting)
    return keys.view(np.int64)


def sketch(hashes: np.ndarray, words: int = PARITY_WORDS) -> np.ndarray:
    """``words`` longs: for each of their bits, the parity of the number of (distinct) hashes that fall on it."""
    counts = np.bincount((hashes % np.uint64(64 * words)).astype(np.int64), minlength=64 * words)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def within(bits: Column, other: Column, n: Column, m: Column, similarity: float, words: int = PARITY_WORDS) -> Column:
    """Whether sets of n and m hashes can be so similar: by their sizes, and as their parities differ in no more bits than the sets in hashes."""
    near = F.least(n, m) >= similarity * F.greatest(n, m)
    apart = sum((F.bit_count(bits[w].bitwiseXOR(other[w])) for w in range(words)), F.lit(0))
    return near & ((1 + similarity) * apart <= (1 - similarity) * (n + m) + 1e-6)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table; the shuffle files that made it go as soon as it is written."""
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return base.materialize(df, label)
    finally:
        conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, text_hash, line_no, line, h): every line, lower-cased; h is null where the line is not judged."""
    parts = F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), "\n")
    lines = docs.select(
        F.col("doc_id").alias("doc"), F.xxhash64("text").alias("text_hash"), F.posexplode(parts).alias("line_no", "line")
    )
    judged = F.length(F.trim("line", F.lit(BLANKS))) >= F.lit(max(min_chars, MIN_WORDS))  # a word has a character
    return lines.withColumn("h", F.when(judged, F.xxhash64("line")))


def _place() -> Column:
    """Sort key of an occurrence."""
    return F.struct(F.col("doc").isNull().alias("none"), "doc", "text_hash", "line_no")


def _mixed(bands: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (k, h, root) of the bands that still hold several components."""
    rooted = bands.where("members > 2").join(roots.withColumnRenamed("node", "h"), "h", "left").withColumn("root", F.coalesce("root", "h"))
    mixed = rooted.groupBy("k").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("k")
    return rooted.join(mixed, "k").select("k", "h", "root")


def _spaced(line: Column) -> Column:
    """The line with runs of spaces taken as one and none at the ends."""
    return F.trim(F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line))


def _code_points(line: Column) -> Column:
    """The spaced line, four bytes a character."""
    return F.encode(_spaced(line), "UTF-32")


def _last(points: Column) -> Column:
    """Where the last shingle begins."""
    return F.greatest(F.lit(1), F.length(points) - F.lit(4 * (WIDTH - 1)))


def _hashes(line: Column) -> Column:
    """The hashes of a line's shingles as an array, those of ``_runs``; for lines of at most ``PIECE`` characters."""
    run = lambda points, at: F.xxhash64(F.substring(points, at, F.lit(4 * WIDTH)))
    # the code points as an element of an array: made once and held, while a column of bytes is copied each time it is named
    inner = lambda points: F.transform(F.sequence(F.lit(1), _last(points), F.lit(4)), lambda at: run(points, at))
    return F.transform(F.array(_code_points(line)), inner)[0]


def _runs(rows: DataFrame, *salts: str) -> DataFrame:
    """``rows`` with a row for every shingle of their ``points``, its hash as ``s`` in their place; long lines a piece at a time."""
    kept = [c for c in rows.columns if c != "points"]
    pieces = rows.select("*", F.explode(F.sequence(F.lit(1), _last(F.col("points")), F.lit(4 * PIECE))).alias("piece"))
    until = F.least(_last(F.col("points")), F.col("piece") + F.lit(4 * PIECE - 4))
    starts = pieces.select(*kept, "points", F.explode(F.sequence("piece", until, F.lit(4))).alias("at"))
    return starts.select(*kept, F.xxhash64(*salts, F.substring("points", F.col("at"), F.lit(4 * WIDTH))).alias("s"))


def _filled(cells: list[Column]) -> list[Column]:
    """Each cell, or where it is null the next one, around."""
    return [F.coalesce(*cells[i:], *cells[:i]) for i in range(len(cells))]


def _signed(lines: DataFrame) -> DataFrame:
    """(h, family, keys): the band keys of every distinct line, a row for each of its grids; ``lines`` has (h, line)."""
    once = lines.groupBy("h").agg(F.min("line").alias("line"))
    throws = F.when(F.length("line") <= SHORT, F.sequence(F.lit(0), F.lit(THROWS))).otherwise(F.array(F.lit(0)))
    run = _runs(once.select("h", _code_points(F.col("line")).alias("points"), F.explode(throws).alias("throw")), "throw")
    cell = run.select(
        "h", F.least("throw", F.lit(1)).alias("family"), F.expr(f"cast(shiftrightunsigned(s, 32) % {ROWS} as int)").alias("row"), F.expr(f"cast(s & {COLUMNS - 1} as int)").alias("column"), "s"
    )
    rows = cell.groupBy("h", "family", "row").agg(*[F.min(F.when(F.col("column") == c, F.col("s"))).alias(f"c{c}") for c in range(COLUMNS)])
    rows = rows.select("h", "family", "row", *[c.alias(f"c{i}") for i, c in enumerate(_filled([F.col(f"c{c}") for c in range(COLUMNS)]))])
    grid = rows.groupBy("h", "family").agg(*[F.min(F.when(F.col("row") == r, F.col(f"c{c}"))).alias(f"m{r}_{c}") for r in range(ROWS) for c in range(COLUMNS)])
    columns = [_filled([F.col(f"m{r}_{c}") for r in range(ROWS)]) for c in range(COLUMNS)]
    grid = grid.select("h", "family", *[columns[c][r].alias(f"m{r}_{c}") for r in range(ROWS) for c in range(COLUMNS)])
    bands = [[f"m{r}_{(first + slope * r) % COLUMNS}" for r in range(ROWS)] for slope in SLOPES for first in range(COLUMNS)]
    return grid.select("h", "family", F.array(*[F.xxhash64("family", F.lit(i), *band) for i, band in enumerate(bands)]).alias("keys"))


def _shared_bands(signed: DataFrame) -> DataFrame:
    """(k, h, members, lead): the bands of several distinct lines, each with one of them."""
    cells = signed.select("h", F.explode("keys").alias("k"))
    # the bare keys are shuffled first: most are of one line, and go no further
    several = materialize(cells.groupBy("k").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shared-keys")
    held = materialize(thinned(cells, "k", several, "k").join(several, "k"), "shared-cells")
    leads = held.groupBy("k").agg(F.min("h").alias("lead"))
    shared = materialize(held.join(leads, "k").select("k", "h", "members", "lead"), "shared-bands")
    discard(several, held)
    return shared


def _sketched(lines: DataFrame) -> DataFrame:
    """(h, line), h once each, to (h, line, long, n, bits): number of shingles and their sketch."""
    # an outer explode: Spark would look whether an inner one's array is empty by making it once more
    short, long = lines.where(F.length("line") <= PIECE), lines.where(F.length("line") > PIECE)
    long = long.select("h", _code_points(F.col("line")).alias("points"))
    run = short.select("h", F.explode_outer(F.array_distinct(_hashes(F.col("line")))).alias("s")).union(_runs(long).distinct())
    # a word at a time: one parity for each shingle to change
    word = F.shiftright("s", 6).bitwiseAND(F.lit(PARITY_WORDS - 1)).alias("word")
    found = run.groupBy("h", word).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits"))
    words = [F.max(F.when(F.col("word") == w, F.col("bits"))) for w in range(PARITY_WORDS)]
    found = found.groupBy("h").agg(F.sum("n").cast("int").alias("n"), F.array(*[F.coalesce(w, F.lit(0).cast("long")) for w in words]).alias("bits"))
    return lines.join(found, "h").select("h", "line", (F.length("line") > PIECE).alias("long"), "n", "bits")


def _texts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, line, long, n, bits) of the wanted lines, once each."""
    few = wanted.count() <= BROADCAST_ROWS
    rows = lines.select("h", "line") if few else thinned(lines.select("h", "line"), "h", wanted, "h")
    rows = rows.join(F.broadcast(wanted) if few else wanted, "h", "left_semi")
    return _sketched(rows.groupBy("h").agg(F.min("line").alias("line")))


def _links(lines: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """(a, b): verified links between hashes of lines, enough to join all that are joined."""
    shared = _shared_bands(signed)
    pairs = shared.where("h != lead").select(F.col("h").alias("a"), F.col("lead").alias("b")).distinct()
    pairs = materialize(pairs, "line-pairs")
    wanted = materialize(shared.select("h").distinct(), "wanted-lines")
    texts = materialize(_texts(lines, wanted), "line-texts")

    # each member with one of its band
    stars = materialize(_verified(pairs, texts, similarity), "line-stars")
    # what is then still apart in a band, all of it
    rest = _mixed(shared, components(stars, "a", "b")).groupBy("h", "root").agg(F.collect_set("k").alias("ks"))
    rest = materialize(rest.join(texts.select("h", "n", "bits"), "h"), "mixed-bands")
    more = materialize(_across(rest, similarity), "line-pairs")
    found = materialize(stars.union(_verified(more, texts, similarity)), "line-links")
    discard(shared, pairs, wanted, texts, rest, more, stars)
    return found


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of lines whose shingle sets are similar enough."""
    side = lambda name, *columns: texts.select(F.col("h").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])
    possible = within(F.col("bits_a"), F.col("bits_b"), F.col("n_a"), F.col("n_b"), similarity)
    left = pairs.join(side("a", "n", "bits", "long"), "a").join(side("b", "n", "bits", "long"), "b").where(possible)
    left = materialize(left.select("a", "b", "n_a", "n_b", (F.col("long_a") | F.col("long_b")).alias("long")), "possible-pairs")
    both = lambda some: left.where(some).drop("long").join(side("a", "line"), "a").join(side("b", "line"), "b")
    # by so many tasks that each holds few pairs at once
    short = both("not long").repartition(1 + left.count() // TASK_PAIRS, "a", "b")
    shared = F.size(F.array_intersect(_hashes(F.col("line_a")), _hashes(F.col("line_b"))))
    counted = short.select("a", "b", "n_a", "n_b", shared.alias("shared"))
    # pairs with a very long line: a row for every shingle
    sides = both("long").select("a", "b", "n_a", "n_b", F.explode(F.array(F.lit(1), F.lit(2))).alias("side"), "line_a", "line_b")
    run = _runs(sides.select("a", "b", "n_a", "n_b", "side", _code_points(F.when(F.col("side") == 1, F.col("line_a")).otherwise(F.col("line_b"))).alias("points")))
    shared = run.groupBy("a", "b", "n_a", "n_b", "s").agg(F.bit_or("side").alias("sides")).where("sides = 3")
    counted = counted.union(shared.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).cast("int").alias("shared")))
    # shared / (n_a + n_b - shared) >= similarity, with ``shared`` named once: it is worked out as often as it is named
    return counted.where((1 + similarity) * F.col("shared") >= similarity * (F.col("n_a") + F.col("n_b")) - 1e-6).select("a", "b")


def _across(rest: DataFrame, similarity: float) -> DataFrame:
    """(a, b): possible links between lines of several components, each from the first band of both; ``rest`` is (h, root, ks, n, bits)."""
    side = rest.select("*", F.explode("ks").alias("k"))
    # large bands are dealt out: each member to one part on the left, to all parts on the right
    parts = side.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"))
    side = side.join(parts, "k")
    left = side.withColumn("part", F.pmod(F.xxhash64("h"), F.col("parts")).cast("int")).repartition("k", "part")
    right = side.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = right.select(*[F.col(c).alias(f"{c}_b") for c in right.columns])
    apart = (F.col("k") == F.col("k_b")) & (F.col("part") == F.col("part_b")) & (F.col("root") < F.col("root_b"))
    possible = within(F.col("bits"), F.col("bits_b"), F.col("n"), F.col("n_b"), similarity)
    first = F.col("k") == F.array_min(F.array_intersect("ks", "ks_b"))
    return left.join(right, apart & possible & first).select(F.col("h").alias("a"), F.col("h_b").alias("b"))


def line_decisions(docs: DataFrame, similarity: float = SIMILARITY, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, text_hash, line_no, judged, dropped): one row per line of every document."""
    lines = _lines(docs, min_chars)
    places = lines.drop("line")
    judged = lines.where("h is not null").select("h", "line", _place().alias("place"))
    signed = materialize(_signed(judged), "line-keys")
    roots = components(_links(judged, signed, similarity), "a", "b")
    counted = judged.groupBy("h").agg(F.count(F.lit(1)).alias("copies"), F.min("place").alias("first"))
    rooted = counted.join(roots.withColumnRenamed("node", "h"), "h", "left").where("copies > 1 or root is not null")
    rooted = materialize(rooted.select("h", F.coalesce("root", "h").alias("root"), "first"), "line-roots")
    keep = rooted.groupBy("root").agg(F.min("first").alias("keep"))
    verdict = materialize(rooted.join(keep, "root").select("h", "keep"), "line-keep")
    discard(signed, rooted)
    dropped = F.col("keep").isNotNull() & F.expr("not (keep.doc <=> doc) or keep.text_hash != text_hash or keep.line_no != line_no")
    return places.join(verdict, "h", "left").select("doc", "text_hash", "line_no", F.col("h").isNotNull().alias("judged"), dropped.alias("dropped"))


def _per_document(decisions: DataFrame) -> DataFrame:
    lines = F.array_sort(F.collect_set(F.struct("line_no", "dropped", "judged")))
    return decisions.groupBy("doc", "text_hash").agg(lines.alias("lines"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the dropped lines.

    Documents of which every line with words was dropped go; those that had no such
    line stay. All columns are kept; an existing ``n_chars`` is counted anew where
    lines went.
    """
    lines = _per_document(line_decisions(docs, similarity, min_chars)).where(F.exists("lines", lambda x: x["dropped"]))
    lost = lines.select("doc", "text_hash", F.transform("lines", lambda x: x["dropped"]).alias("flags"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("key", F.xxhash64("row.text"))
    joined = rows.join(lost, F.expr("row.doc_id <=> doc and key = text_hash"), "left")
    parts = F.filter(F.split("row.text", "\n"), lambda _, i: ~F.col("flags")[i])
    text = F.when(F.col("flags").isNull(), F.col("row.text")).otherwise(F.array_join(parts, "\n"))
    kept = joined.withColumn("new_text", text).where(F.col("flags").isNull() | (word_count(F.col("new_text")) > 0))
    new = {"text": F.col("new_text"), "n_chars": F.when(F.col("flags").isNull(), F.col("row.n_chars")).otherwise(F.length("new_text")) if "n_chars" in docs.columns else None}
    return kept.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of lines, lines judged, and the numbers of the dropped lines."""
    return _per_document(line_decisions(table(spark, sf_dir, "documents"))).select(
        F.col("doc").alias("doc_id"),
        F.size("lines").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x["judged"])).alias("n_judged"),
        F.transform(F.filter("lines", lambda x: x["dropped"]), lambda x: x["line_no"]).alias("dropped_lines"),
    )
