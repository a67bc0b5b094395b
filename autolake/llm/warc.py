"""WARC archives with payload deduplication: write, read back, resolve revisits.

Headers (id, url, payload digest, size) are taken from the pages and stored; they alone are
shuffled by digest to choose each payload's original. Revisit records are written from headers;
payload rows are joined to nothing but the short list of (id, digest) pairs that are revisits.
Reading gives headers again; revisits are joined to their originals by digest.

Every record is a gzip member of its own, so a record can be read at its offset. Spark's text
writer writes the members, so commits, retries and the file system are Spark's: its line
separator is an empty gzip member, which readers pass over. The binaryFile source reads them.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.functions.joins import bounded_broadcast
from autolake.llm import words
from autolake.llm.stored import stored

RECORD_END = b"\r\n\r\n"
# A file gets as many records as make about so many payload bytes.
FILE_BYTES = 64 << 20
SLICE_BYTES = 4 << 20
READ_BYTES = 1 << 16
# The gzip stream of nothing, between two records' members.
_EMPTY_MEMBER = bytes([31, 139, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0]) + bytes(8)
# Payloads of fewer bytes are always written whole.
LEAST_BYTES = 0

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value) -> str:
    """A header line; control characters and blanks at its ends are percent-encoded."""
    if value is None:
        return ""
    safe = "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in str(value))
    body = safe.strip(" ")
    left = len(safe) - len(safe.lstrip(" "))
    return f"{name}: {'%20' * left}{body}{'%20' * (len(safe) - left - len(body))}\r\n"


def _uri(page_id, url, payload_digest) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {payload_digest}')}>"


def record(page_id, url, payload: bytes, payload_digest: str, original, date: str) -> bytes:
    """One record without its end. ``original``: None for a response, else (page id, url) it repeats."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if original is None else b"")
    head = "WARC/1.1\r\n" + _line("WARC-Type", "response" if original is None else "revisit")
    head += _line("WARC-Record-ID", _uri(page_id, url, payload_digest)) + _line("WARC-Date", date)
    head += _line("WARC-Target-URI", url) + _line("WARC-Payload-Digest", f"sha1:{payload_digest}")
    if original is not None:
        head += _line("WARC-Profile", _PROFILE) + _line("WARC-Refers-To", _uri(*original, payload_digest))
        head += _line("WARC-Refers-To-Target-URI", original[1])
    head += _line("Page-ID", page_id) + _line("Content-Type", "application/http;msgtype=response") + _line("Content-Length", len(block))
    return head.encode() + b"\r\n" + block


def info(date: str) -> bytes:
    """The warcinfo record that begins a task's output."""
    block = b"software: autolake\r\nformat: WARC File Format 1.1\r\n"
    head = "WARC/1.1\r\n" + _line("WARC-Type", "warcinfo") + _line("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>") + _line("WARC-Date", date)
    head += _line("Content-Type", "application/warc-fields") + _line("Content-Length", len(block))
    return head.encode() + b"\r\n" + block


def member(data: bytes) -> bytes:
    """A record and its end as one gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data + RECORD_END) + packer.flush()


def members(content: memoryview) -> Iterator[bytes]:
    """The data of every gzip member in a row; empty ones are passed over."""
    at = 0
    while at < len(content):
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(content):
                raise ValueError("broken gzip member")
            part = content[at:at + READ_BYTES]
            out.append(unpacker.decompress(part))
            at += len(part) - len(unpacker.unused_data)
        data = b"".join(out)
        if data:
            yield data


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block, of one record."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = data[end + 4:end + 4 + int(fields["content-length"])]
    if data[end + 4 + len(block):] != RECORD_END:
        raise ValueError("broken WARC record end")
    return fields, block


_HEADS = "page_id long, url string, digest string, bytes long"


def _heads(batches: Iterator[pa.RecordBatch], keep_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in words.slices(batch, "payload", SLICE_BYTES):
            payloads = [p or b"" for p in rows.column("payload").to_pylist()]
            out = {"page_id": rows.column("page_id"), "url": rows.column("url"), "digest": pa.array([digest(p) for p in payloads], pa.string())}
            out |= {"payload": pa.array(payloads, pa.binary())} if keep_payload else {"bytes": pa.array([len(p) for p in payloads], pa.int64())}
            yield pa.RecordBatch.from_pydict(out)


def revisits(heads: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Headers of the rows that revisit another one, with its (page_id, url) in ``original``."""
    originals = stored(heads.where(F.col("bytes") >= least_bytes).groupBy("digest")
                       .agg(F.max(F.struct("page_id", "url")).alias("original"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-originals")
    found = heads.where(F.col("bytes") >= least_bytes).join(originals, "digest")
    return stored(found.where(~F.col("page_id").eqNullSafe(F.col("original.page_id"))), "warc-revisits")


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: str | None = None) -> None:
    """Write every row of ``pages`` (page_id, url, payload binary) as one record under ``path``.

    Of equal payloads of at least ``least_bytes`` bytes, the row with the largest page_id is a
    response, the others revisit it; smaller ones are all responses. Null payloads are empty.
    A null page_id counts as the smallest. Rows that repeat the original's page_id are
    responses too. Null urls leave the target out. An empty table makes a folder without records.
    page_id must be a whole number. ``date`` is the records' WARC-Date, by default the time of the call.
    Other columns are not read.
    """
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "payload")
    heads = stored(own.mapInArrow(lambda b: _heads(b, False), _HEADS), "warc-heads")
    again = revisits(heads, least_bytes)
    size = heads.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).first()
    per_file = max(1, FILE_BYTES * size["n"] // max(size["bytes"] or 0, 1))

    def responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            for rows in words.slices(batch, "payload", SLICE_BYTES):
                out = [member(info(date))] if first else []
                first = False
                out += [member(record(r["page_id"], r["url"], r["payload"], r["digest"], None, date)) for r in rows.to_pylist()]
                yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [member(record(r["page_id"], r["url"], b"", r["digest"], (r["original"]["page_id"], r["original"]["url"]), date)) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})

    # the pairs that revisit: short rows, sent to the payloads if they are few, else joined by (id, digest)
    pairs = bounded_broadcast(again.select(F.col("page_id").alias("own_id"), F.col("digest").alias("own_digest")).distinct())
    whole = (own.mapInArrow(lambda b: _heads(b, True), "page_id long, url string, digest string, payload binary")
             .join(pairs, F.col("own_id").eqNullSafe(F.col("page_id")) & (F.col("own_digest") == F.col("digest")), "left_anti"))
    records = (whole.mapInArrow(responses, "value binary")
               .unionAll(again.select("page_id", "url", "digest", "original").mapInArrow(repeats, "value binary")))
    (records.select(F.col("value").cast("string").alias("value"))
            .write.option("lineSep", _EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
            .option("maxRecordsPerFile", per_file).mode("overwrite").text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Headers of all records: page_id, url, record_type, payload_digest, payload_bytes (null for revisits).

    A response's digest is computed from the payload read, and must equal its header's. A task
    holds one file's compressed bytes and one record.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("page_id", "url", "record_type", "payload_digest", "payload_bytes")
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
        for batch in batches:
            for content in batch.column("content"):
                out = []
                for data in members(memoryview(content.as_buffer())):
                    fields, block = parse(data)
                    if fields["warc-type"] == "warcinfo":
                        continue
                    named = fields["warc-payload-digest"].removeprefix("sha1:")
                    size = None
                    if fields["warc-type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        size = len(payload)
                        if digest(payload) != named:
                            raise ValueError(f"payload digest differs in {fields['warc-record-id']}")
                    page = fields.get("page-id")
                    out.append((None if page is None else int(page), fields.get("warc-target-uri"), fields["warc-type"], named, size))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)], names)

    return (spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("content")
                 .mapInArrow(run, "page_id long, url string, record_type string, payload_digest string, payload_bytes long"))


def resolve(headers: DataFrame) -> DataFrame:
    """``read``'s rows with revisits joined to their originals by digest: payload_bytes, refers_to."""
    # stored, so that the join's sides are plain shuffles and a digest on many headers can be split
    headers = stored(headers, "warc-headers")
    answers = stored(headers.where(F.col("record_type") == "response").groupBy("payload_digest")
                     .agg(F.max(F.struct("page_id", "payload_bytes")).alias("answer")), "warc-answers")
    revisit: Column = F.col("record_type") == "revisit"
    return (headers.join(answers, "payload_digest", "left")
                   .select("page_id", "url", F.when(revisit, F.col("answer.payload_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                           "payload_digest", "record_type", F.when(revisit, F.col("answer.page_id")).alias("refers_to")))
