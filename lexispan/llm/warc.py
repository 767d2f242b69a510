"""WARC archives that store each payload once.

``write_archive`` writes one record per page: a ``response`` with its payload,
or a ``revisit`` of the page whose record has the same payload. Payloads are
told apart by their SHA-256 digest; ``read_archive`` computes it again, refuses
a record whose payload does not match, and writes what it parsed as a table.
From that table come the two sides of the archive: ``heads``, the exact header
bytes of every record and the digest it names, and ``payloads``, each payload
once by its digest. ``restored`` joins them into pages and exact records.

Files are plain WARC/1.0, compressed as a whole, and of bounded size. Spark's
text writer makes them: its line separator is the one that ends a record.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.llm.workers import lean
from lexispan.operators.keys import broadcast_if_small
from lexispan.sources.workspace import materialized

# The format's version line, line end and record end, and the profile of a revisit.
VERSION = "WARC/1.0"
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

# Payloads from this size on are stored once.
SHARED_FROM = 1000

# A file holds at most this many records that store less than LARGE bytes, so 128 MB of them.
RECORDS_PER_FILE = 2000
LARGE = 64 << 10
# Each task spreads its larger records over this many files.
LARGE_FILES = 1024

# Bounds of what a worker holds of a file it parses, and of the rows that name one digest in one task of a join.
INFLATED = 1 << 20
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20
NAMED_PER_TASK = 100_000

COLUMNS = {
    "at": pa.int64(), "page_id": pa.string(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.string(),
    "sha1": pa.string(), "sha256": pa.string(), "headers": pa.binary(), "http_head": pa.binary(), "payload": pa.binary(),
}
RECORD = (
    "file string, at bigint, page_id string, url string, record_type string, refers_to string, sha1 string, sha256 string, "
    "headers binary, http_head binary, payload binary"
)


def write_archive(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row of ``pages(page_id, url, html)`` below ``folder``; ``date`` is every record's WARC-Date.

    Of rows with equal payloads of ``SHARED_FROM`` bytes or more, the one with
    the largest id is the response and the others revisit it; a row equal to it
    in id and payload is a response as well, and a null id never is one if
    another row has an id. A null html is an empty payload. A null id or url
    leaves its header out; line breaks in a url are escaped. Large records go to
    files of their own, so that no file grows with the size of its pages.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").alias("id"), "url", payload.alias("payload"), F.octet_length(payload).alias("bytes"),
        F.sha1(payload.cast("binary")).alias("sha1"), F.sha2(payload.cast("binary"), 256).alias("sha256"),
    )
    shared = rows.where(F.col("bytes") >= SHARED_FROM).select("sha256", "id")
    shared = shared.groupBy("sha256").agg(F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(shared, "sha256", "left").withColumn("revisit", F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper")))
    stored = F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))
    files = F.when(stored < LARGE, "small").otherwise(F.pmod(F.xxhash64("id", "sha256"), F.lit(LARGE_FILES)).cast("string"))
    writer = rows.select(files.alias("files"), _record(date).alias("record")).write.partitionBy("files")
    writer = writer.option("lineSep", RECORD_END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def _record(date: str) -> Column:
    """Header lines, a blank line, the block: an HTTP head and, for a response, the payload."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(RECORD_END)
    )
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    return F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        optional("WARC-Record-ID", page("id")),
        line("WARC-Date", F.lit(date)),
        optional("WARC-Target-URI", url),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", page("keeper")), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        line("X-Payload-SHA256", F.col("sha256")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)),
        F.lit(CRLF),
        block,
    )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all ``.gz`` files below ``folder``, parsed once: ``RECORD`` columns, ids as text.

    ``headers`` and ``http_head`` are the bytes of the record up to the blank
    line, and from there to the payload, as they stand in the file, ``at`` is its
    place there. A revisit has no ``payload``; its ``sha256`` is the one it
    names. Other archives are read as well: of a record that is no HTTP response
    the whole block is the payload, digests that it does not name are computed,
    and a revisit that names no SHA-256 has a null ``sha256``. A payload that
    does not have the digests its record names, and a file that ends within a
    record, are errors. Without files there are no records.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(folder)
    return materialized(files.select("path", "content").mapInArrow(lean(_parsed), RECORD), compression="zstd")


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            held: list[tuple] = []
            size = 0
            for record in archive_records(content.as_buffer()):
                held.append(record)
                size += sum(len(part) for part in record[-3:] if part is not None)
                if len(held) == BATCH_ROWS or size >= BATCH_BYTES:
                    yield _batch(path.as_py(), held)
                    held, size = [], 0
            if held:
                yield _batch(path.as_py(), held)


def _batch(path: str, records: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*records), COLUMNS.values())]
    return pa.RecordBatch.from_arrays([pa.array([path] * len(records)), *columns], names=["file", *COLUMNS])


def _inflated(content) -> Iterator[bytes]:
    """The bytes of a compressed file of one or more members, ``INFLATED`` at a time."""
    rest, member, begun = memoryview(content), zlib.decompressobj(31), False
    while len(rest):
        piece, rest = rest[:INFLATED], rest[INFLATED:]
        while len(piece):
            begun = True
            yield member.decompress(piece, INFLATED)
            if member.eof:
                piece, member, begun = member.unused_data, zlib.decompressobj(31), False
            else:
                piece = member.unconsumed_tail
    if begun:
        yield member.flush()
        if not member.eof:
            raise ValueError("the file ends within its compressed data")


def archive_records(content) -> Iterator[tuple]:
    """The ``COLUMNS`` of each record of one compressed file, by the lengths the records state; holds one record at a time."""
    chunks, held, at = _inflated(content), bytearray(), 0

    def more() -> bool:
        chunk = next(chunks, None)
        held.extend(chunk or b"")
        return chunk is not None

    while held or more():
        if not held:
            continue
        searched = 0
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(held) - 3)
            if not more():
                raise ValueError(f"the file ends within the headers at byte {at}")
        begin = end + 4
        lines = held[:end].decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {name.strip().lower(): value.removeprefix(" ") for name, _, value in (x.partition(":") for x in lines[1:])}
        stop = begin + int(fields["content-length"])
        while len(held) < stop + 4 and more():
            pass
        if held[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield _record_row(at, fields, bytes(held[:begin]), bytes(held[begin:stop]))
        del held[: stop + 4]
        at += stop + 4


def _record_row(at: int, fields: dict[str, str], headers: bytes, block: bytes) -> tuple:
    kind = fields["warc-type"].strip()
    named = dict(
        _digest(fields[name]) for name in ("warc-payload-digest", "x-payload-sha256") if name in fields
    )
    if kind == "revisit":
        head, payload, found = block, None, named
    else:
        is_http = kind == "response" and fields.get("content-type", "").strip().startswith("application/http")
        split = block.find(b"\r\n\r\n") + 4 if is_http else 0
        if is_http and split == 3:
            split = len(block)
        head, payload = block[:split], block[split:]
        found = {"sha1": hashlib.sha1(payload).hexdigest(), "sha256": hashlib.sha256(payload).hexdigest()}
        if any(found.get(method, value) != value for method, value in named.items()):
            raise ValueError(f"the payload of the record at byte {at} is not what its digest says")
    return (
        at, _page(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, _page(fields.get("warc-refers-to")),
        found.get("sha1"), found.get("sha256"), headers, head, payload,
    )


def _digest(text: str) -> tuple[str, str]:
    """Method and lower-case hex of a digest field; archives write SHA-1 in base 32 as well, SHA-256 may stand alone."""
    method, _, value = text.strip().rpartition(":")
    if method.lower() == "sha1" and len(value) == 32:
        value = base64.b32decode(value.upper()).hex()
    return method.lower() or "sha256", value.lower()


def _page(urn: str | None) -> str | None:
    return None if urn is None else urn.removeprefix("<urn:page:").removesuffix(">")


def heads(records: DataFrame) -> DataFrame:
    """Every record without its payload: the digest it names stands for it."""
    return records.drop("payload")


def payloads(records: DataFrame) -> DataFrame:
    """``(sha256, payload)``: every payload once."""
    return records.where(F.col("payload").isNotNull()).groupBy("sha256").agg(F.first("payload").alias("payload"))


def restored(records: DataFrame) -> DataFrame:
    """``(file, at, page_id, url, html, headers, http_head, record)`` of all records, heads and payloads joined by digest.

    ``record`` has the exact bytes of the record in its file (the record end
    left out), ``html`` is the page, also of a revisit; it is null where the
    archive has no payload of the digest that a revisit names.
    """
    joined = _with_stored(heads(records), payloads(records))
    own = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat("headers", "http_head", own).alias("record")
    return joined.select("file", "at", "page_id", "url", F.col("payload").cast("string").alias("html"), "headers", "http_head", record)


def record_summary(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of all records.

    Size and SHA-1 are those of the stored payload that the record's digest
    leads to, for revisits as for responses; null where there is none.
    """
    size, sha1 = F.octet_length("payload").cast("long"), F.sha1("payload")
    stored = records.where(F.col("payload").isNotNull()).select("sha256", size.alias("payload_bytes"), sha1.alias("payload_digest"))
    stored = stored.groupBy("sha256").agg(F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"))
    named = records.select("file", "at", "page_id", "sha256", "record_type", "refers_to")
    return _with_stored(named, stored).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _with_stored(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Left join on ``sha256``; a digest that very many rows name is spread over several tasks, with a copy of its payload each."""
    parts = F.ceil(F.count("*") / NAMED_PER_TASK).cast("int").alias("_parts")
    hot = broadcast_if_small(materialized(rows.groupBy("sha256").agg(parts).where("_parts > 1")))
    part = F.coalesce(F.pmod(F.xxhash64("file", "at"), F.col("_parts")).cast("int"), F.lit(0))
    rows = rows.join(hot, "sha256", "left").withColumn("_part", part).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    stored = stored.join(hot, "sha256", "left").withColumn("_part", copies).drop("_parts")
    return rows.join(stored, ["sha256", "_part"], "left").drop("_part")


def oracle() -> str:
    """DuckDB SQL with the rows of :func:`record_summary` over ``pages``, ids as numbers."""
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    k AS (SELECT payload, max(page_id) AS keeper FROM p WHERE strlen(payload) >= {SHARED_FROM} GROUP BY payload)
    SELECT page_id, strlen(p.payload) AS payload_bytes, sha1(p.payload) AS payload_digest,
      CASE WHEN keeper IS NULL OR keeper IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN keeper IS DISTINCT FROM page_id THEN keeper END AS refers_to
    FROM p LEFT JOIN k ON p.payload = k.payload
    """
