"""Operator 5: WARC archives, with a normaliser for monolithic gzip.

Writing: each task writes its pages as WARC 1.1 records into one gzip stream (the
monolithic form that a careless writer leaves behind). Normalising: each task inflates
one such file once, as a stream of blocks, writes every record as a gzip member of its
own into a new file, and a sidecar index of (record id, offset, length). Reading back:
the index rows are dealt out, and each member is opened at its offset alone.

Of records with equal payloads of at least ``least`` bytes, the one with the largest
page id is the response; the others are revisits that name it and carry only their HTTP
header, whose Content-Length is that of the full payload. Smaller payloads are always
responses.

Files are written below the shared folder through the filesystem that its address names,
under a name of the task attempt, and moved into place when complete; a repeated task
writes the same bytes, so a lost executor costs its tasks only. Memory per task is one
block and one record, whatever the size of a file.

Defined results: a null html is the empty payload; equal payloads of pages with the same
page id are ordered by url; repeated rows are a response and its revisits; a null page id
is the smallest; a page without url has the empty target; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize, shared_dir, table

LEAST = 0
LEVEL = 1
READ_BYTES = 8 << 20  # members that a task reads back
BLOCK = 1 << 20
GZIP = 16 + zlib.MAX_WBITS
DATE = "2000-01-01T00:00:00Z"  # records are the same whenever they are written
PAGES = "row_id long, page_id long, url string, payload binary, digest string, n_bytes long, refers_to long, revisit boolean"


def _open(address: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in address and not address.startswith("file:"):
        return pafs.LocalFileSystem(), address
    return pafs.FileSystem.from_uri(address if "://" in address else address.replace("file:", "file://", 1))


def _record(row: dict) -> bytes:
    payload = row["payload"] or b""
    kind = "revisit" if row["revisit"] else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n".encode()
    block = http + (b"" if row["revisit"] else payload)
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:row:{row['row_id']}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((row['url'] or '').split())}", f"WARC-Payload-Digest: sha1:{row['digest']}",
        f"Page-ID: {'' if row['page_id'] is None else row['page_id']}", "Content-Type: application/http; msgtype=response",
    ]
    if row["revisit"]:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To-Page: {'' if row['refers_to'] is None else row['refers_to']}",
        ]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Part:
    """A file that appears under its name only when it is complete."""

    def __init__(self, folder: str, name: str):
        self.fs, at = _open(folder)
        attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
        self.name, self.temporary = f"{at}/{name}", f"{at}/_{name}.{attempt}"
        self.fs.create_dir(at, recursive=True)
        self.stream = self.fs.open_output_stream(self.temporary, compression=None)
        self.offset = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.offset += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.name)


def _write_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One gzip stream per task."""
    part, packer, n = None, zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), 0
    for batch in batches:
        for row in batch.to_pylist():
            part = part or _Part(folder, f"part-{TaskContext.get().partitionId():06d}.warc.gz")
            part.write(packer.compress(_record(row)))
            n += 1
    if part:
        part.write(packer.flush())
        part.close()
        yield pa.RecordBatch.from_pydict({"name": [part.name.rsplit("/", 1)[1]], "records": [n]})


def records(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Records of an inflated WARC stream that comes in blocks of any size."""
    data = bytearray()
    for block in blocks:
        data += block
        while (end := data.find(b"\r\n\r\n")) >= 0:
            size = next(int(h[15:]) for h in bytes(data[:end]).split(b"\r\n") if h[:15].lower() == b"content-length:")
            if len(data) < end + 8 + size:
                break
            yield bytes(data[: end + 8 + size])
            del data[: end + 8 + size]
    if data:
        raise ValueError(f"{len(data)} bytes after the last whole record")


def inflate(source: pa.NativeFile, block: int = BLOCK) -> Iterator[bytes]:
    """The bytes of a gzip file of one or several members, a bounded block at a time."""
    unpack = zlib.decompressobj(GZIP)
    while chunk := source.read(block):
        while chunk:
            yield unpack.decompress(chunk, block)
            while unpack.unconsumed_tail:
                yield unpack.decompress(unpack.unconsumed_tail, block)
            chunk = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(GZIP)


def _head(record: bytes) -> dict[str, str]:
    lines = record[: record.index(b"\r\n\r\n")].decode().split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)}


def _normalise_batches(batches: Iterator[pa.RecordBatch], source: str, target: str) -> Iterator[pa.RecordBatch]:
    """Each named file of ``source``, member by member, to ``target``; yields its index."""
    for batch in batches:
        for name in batch.column(0).to_pylist():
            fs, at = _open(source)
            part, rows = _Part(target, name), []
            with fs.open_input_stream(f"{at}/{name}", compression=None) as stream:
                for record in records(inflate(stream)):
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                    member = packer.compress(record) + packer.flush()
                    rows.append({"file": name, "record_id": _head(record)["warc-record-id"], "at": part.offset, "size": len(member)})
                    part.write(member)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, INDEX)
                        rows = []
            part.close()
            yield pa.RecordBatch.from_pylist(rows, INDEX)


INDEX = pa.schema([("file", pa.string()), ("record_id", pa.string()), ("at", pa.int64()), ("size", pa.int64())])
READ = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def _read_batches(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    """Opens each indexed member at its offset and reads its record."""
    fs, at = _open(folder)
    name, file = None, None
    for batch in batches:
        rows, held = [], 0
        for row in batch.to_pylist():
            if row["file"] != name:
                name, file = row["file"], fs.open_input_file(f"{at}/{row['file']}")
            file.seek(row["at"])
            record = zlib.decompress(file.read(row["size"]), GZIP)
            head = _head(record)
            block = record[record.index(b"\r\n\r\n") + 4 : -4]
            split = block.index(b"\r\n\r\n") + 4
            http, payload = _head(block[:split]), block[split:]
            response = head["warc-type"] == "response"
            stated = head["warc-payload-digest"].removeprefix("sha1:")
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else stated
            if digest != stated:
                raise ValueError(f"{row['file']} at {row['at']}: the payload has digest {digest}, its record says {stated}")
            rows.append({
                "page_id": int(head["page-id"]) if head["page-id"] else None, "url": head["warc-target-uri"],
                "payload_bytes": len(payload) if response else int(http["content-length"]), "payload_digest": digest,
                "record_type": head["warc-type"], "payload": payload if payloads and response else None,
                "refers_to": int(head["warc-refers-to-page"]) if head.get("warc-refers-to-page") else None,
            })
            held += len(payload)
            if held > 16 * BLOCK:
                yield pa.RecordBatch.from_pylist(rows, READ)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, READ)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [base64.b32encode(hashlib.sha1(p or b"").digest()).decode() for p in batch.column("payload").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests)], names=[*batch.schema.names, "digest"])


def _payload() -> Column:
    return F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")


def plan_records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows to write: payload, digest, and whether and to what a record is a revisit.

    Payloads are not shuffled: only digests are, pre-aggregated, and the digests that
    occur more than once come back by a join.
    """
    rows = pages.select(F.monotonically_increasing_id().alias("row_id"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), _payload())
    rows = rows.mapInArrow(_digest_batches, "row_id long, page_id long, url string, payload binary, digest string").withColumn("n_bytes", F.length("payload").cast("long"))
    place = F.struct("page_id", "url", "row_id")
    first = rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.max(place).alias("first"), F.count(F.lit(1)).alias("n"))
    shared = materialize(first.where("n > 1").select("digest", "first"), "shared-payloads")
    joined = rows.join(shared, (rows["digest"] == shared["digest"]) & (F.col("n_bytes") >= least), "left").drop(shared["digest"])
    revisit = F.coalesce(F.col("first.row_id") != F.col("row_id"), F.lit(False))
    return joined.select(
        "row_id", "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest", "n_bytes",
        F.when(revisit, F.col("first.page_id")).alias("refers_to"), revisit.alias("revisit"),
    )


def write_monolithic(rows: DataFrame, folder: str) -> DataFrame:
    """Writes planned rows, one gzip stream per task; (name, records) of each file."""
    return materialize(rows.mapInArrow(partial(_write_batches, folder=folder), "name string, records long"), "warc-files")


def normalise(spark: SparkSession, files: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites the named files with a member per record; the written sidecar index."""
    # a row is a whole file: a task each, which adaptive execution would merge for the rows' small size
    named = files.select("name").repartitionByRange(max(1, files.count()), "name")
    done = named.mapInArrow(partial(_normalise_batches, source=source, target=target), "file string, record_id string, at long, size long")
    path = f"{target}/index"
    done.write.parquet(path)
    return spark.read.parquet(path)


def read_archive(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that the index lists; ``payload`` is null for revisits or if not asked for."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    tasks = 1 + (index.agg(F.sum("size")).first()[0] or 0) // READ_BYTES
    return index.repartitionByRange(tasks, "file", "at").sortWithinPartitions("file", "at").mapInArrow(partial(_read_batches, folder=folder, payloads=payloads), schema)


def op5_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, archive = shared_dir(spark, "warc-raw"), shared_dir(spark, "warc")
    files = write_monolithic(plan_records(table(spark, sf_dir, "pages")), raw)
    index = normalise(spark, files, raw, archive)
    return read_archive(index, archive, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: SHA-1 in base 32 of each payload; the largest page_id of equal payloads responds.
OP5_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages
), digests AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY payload) AS response,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest
  FROM payloads
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM digests
"""
