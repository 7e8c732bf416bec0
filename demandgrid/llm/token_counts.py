"""Operator 9: token counts of flat token files by a separator scan.

A flat token file is a sequence of little-endian token ids in which an end-of-document id
closes each document; it has no index. Blocks of fixed length are dealt out over tasks,
whatever file they belong to, so one file with most of the tokens is no hot task. Each
task reads its block by range and finds the separators in one vectorised comparison. A
document that crosses blocks is stitched by a prefix scan over the blocks' summaries
(separators, tokens before the first, tokens after the last): one small row per block.

Defined results: two separators in a row close a document of no tokens; tokens after the
last separator of a file are a last, unclosed document; a file of no tokens has none; a
file whose size is no multiple of the id width is an error; documents are numbered by
their place in the file.

The query encodes the texts with a byte-level BPE vocabulary of 50,256 ids, 50256 being
the free id that closes documents; null and empty texts have no tokens. The vocabulary's
folder is a parameter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize, shared_dir, table
from demandgrid.llm.warc import _open, _Part

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the published split pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
FILES_PER_TASK = 64  # of which the sizes are asked for
BLOCKS_PER_TASK = 4
BLOCK = 1 << 21  # ids in a block
FLUSH = 1 << 20


def _encoder(ranks: bytes):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def _write_batches(batches: Iterator[pa.RecordBatch], folder: str, ranks: bytes, end: int) -> Iterator[pa.RecordBatch]:
    encoder, part, number = None, None, 0
    for batch in batches:
        ids, names, numbers, held, size = batch.column(0), [], [], [], 0
        for text in batch.column(1).to_pylist():
            encoder = encoder or _encoder(ranks)
            part = part or _Part(folder, f"tokens-{TaskContext.get().partitionId():06d}.bin")
            held.append(np.array([*encoder.encode_ordinary(text or ""), end], dtype="<u2"))
            size += len(held[-1])
            if size >= FLUSH:
                part.write(np.concatenate(held).tobytes())
                held, size = [], 0
            names.append(part.name.rsplit("/", 1)[1])
            numbers.append(number)
            number += 1
        if held:
            part.write(np.concatenate(held).tobytes())
        yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(numbers, pa.int64())], names=["doc_id", "file", "number"])
    if part:
        part.close()


def write_tokens(docs: DataFrame, folder: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Encodes texts to flat files of 16-bit ids, one per task; (doc_id, file, number) of each document."""
    with open(f"{tokenizers}/{VOCABULARY}", "rb") as file:
        ranks = file.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    written = rows.mapInArrow(partial(_write_batches, folder=folder, ranks=ranks, end=END), "doc_id long, file string, number long")
    return materialize(written, "token-order")


def _size_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, at = _open(folder)
    for batch in batches:
        sizes = [fs.get_file_info(f"{at}/{name}").size for name in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["file", "bytes"])


def _scan_batches(batches: Iterator[pa.RecordBatch], folder: str, end: int, width: int) -> Iterator[pa.RecordBatch]:
    fs, at = _open(folder)
    for batch in batches:
        for row in batch.to_pylist():
            with fs.open_input_file(f"{at}/{row['file']}") as file:
                file.seek(row["start"] * width)
                ids = np.frombuffer(file.read(row["n"] * width), dtype=f"<u{width}")
            if len(ids) != row["n"]:
                raise ValueError(f"{row['file']}: {len(ids)} ids at {row['start']}, {row['n']} expected")
            ends = np.flatnonzero(ids == end)
            head, tail = (int(ends[0]), len(ids) - 1 - int(ends[-1])) if len(ends) else (len(ids), len(ids))
            yield pa.RecordBatch.from_pydict({
                "file": [row["file"]], "block": pa.array([row["block"]], pa.int64()), "ends": pa.array([len(ends)], pa.int64()),
                "head": pa.array([head], pa.int64()), "tail": pa.array([tail], pa.int64()),
                "inner": pa.array([np.diff(ends) - 1], pa.list_(pa.int64())),
            })


def count_tokens(files: DataFrame, folder: str, end: int = END, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(file, number, n_tokens) of every document of the flat token files that ``files.file`` names."""
    named = materialize(files.select("file").distinct(), "token-files")
    # rows are few and small, the work behind each is not: numbers of partitions that adaptive execution keeps
    sized = named.repartition(1 + named.count() // FILES_PER_TASK, "file").mapInArrow(partial(_size_batches, folder=folder), "file string, bytes long")
    sized = sized.withColumn("ids", F.when(F.col("bytes") % width == 0, (F.col("bytes") / width).cast("long")).otherwise(F.raise_error(F.concat("file", F.lit(": size is no multiple of the id width")))))
    start = F.explode(F.when(F.col("ids") > 0, F.sequence(F.lit(0).cast("long"), F.col("ids") - 1, F.lit(block).cast("long"))))
    blocks = sized.select("file", "ids", start.alias("start"))
    blocks = blocks.select("file", (F.col("start") / block).cast("long").alias("block"), "start", F.least(F.lit(block), F.col("ids") - F.col("start")).cast("int").alias("n"))
    blocks = materialize(blocks, "token-blocks")
    tasks = 1 + blocks.count() // BLOCKS_PER_TASK
    found = blocks.repartitionByRange(tasks, "file", "block").mapInArrow(
        partial(_scan_batches, folder=folder, end=end, width=width), "file string, block long, ends long, head long, tail long, inner array<long>"
    )
    found = materialize(found, "token-summaries")
    # prefix scan over the summaries: documents closed before a block, and tokens left open before it
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = found.select("file", "block", "ends", "head", "tail")
    scan = summary.withColumn("number", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    scan = scan.withColumn("run", F.coalesce(F.sum(F.when(F.col("ends") > 0, 1).otherwise(0)).over(before), F.lit(0)))
    # a run begins with a block that closes a document and goes on to the next such block
    joined = scan.withColumn("opens", F.when(F.col("ends") > 0, F.col("run") + 1).otherwise(F.col("run")))
    left = joined.groupBy("file", "opens").agg(F.sum("tail").alias("open"))
    closing = scan.where("ends > 0").join(left.withColumnRenamed("opens", "run"), ["file", "run"], "left")
    closing = closing.select("file", "block", "number", (F.coalesce("open", F.lit(0)) + F.col("head")).alias("first"))
    lengths = found.select("file", "block", "inner").join(closing, ["file", "block"])
    each = lengths.select("file", "number", F.posexplode(F.concat(F.array("first"), "inner")).alias("i", "n_tokens"))
    closed = each.select("file", (F.col("number") + F.col("i")).alias("number"), "n_tokens")
    total = joined.groupBy("file").agg(F.sum("ends").alias("number"), F.max("opens").alias("opens"))
    unclosed = total.join(left, ["file", "opens"]).where("open > 0").select("file", "number", F.col("open").alias("n_tokens"))
    return closed.union(unclosed)


def op9_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    order = write_tokens(table(spark, sf_dir, "documents"), folder)
    return order.join(count_tokens(order, folder), ["file", "number"]).select("doc_id", "n_tokens")
