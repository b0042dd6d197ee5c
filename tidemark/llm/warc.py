"""Web archives (WARC 1.1), one Zstandard frame per record, with a dictionary of their own.

Every archive starts with a skippable frame that holds a dictionary built from records of that archive;
all frames after it are compressed with it, so that a record can be read alone and small pages shrink like
large ones. The first record describes the archive. Equal payloads are stored once: later ones are
`revisit` records that name the record which has the payload.

Tasks write archives below a shared folder under names of their own attempt, and a Parquet table, which
Spark commits as a whole, lists the archives that count. What a lost task has left is in no list and never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tidemark.llm.common import arrow_type, materialise, prepare, table, utf8
from tidemark.session import work_dir

#: payloads from this size are stored once
REVISIT_BYTES = 100
#: an archive is closed once its records hold so many bytes before compression
ARCHIVE_BYTES = 64 << 20
#: a dictionary has at most this size and is built from the first records of its archive, up to this many bytes
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
#: of one record the dictionary builder sees at most so many bytes; the record itself is written whole
SAMPLE_RECORD = 128 << 10
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"

# Magic numbers, record names and profile of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

#: header of this writer that carries the id of a page
PAGE_ID = "Page-Id"


# ---- records -----------------------------------------------------------------------------


def _field(value: str) -> str:
    """A header value on one line: control characters and spaces at its ends are percent-encoded."""
    inner = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)
    stripped = inner.strip(" ")
    lead, trail = len(inner) - len(inner.lstrip(" ")), len(inner) - len(inner.rstrip(" "))
    return "%20" * lead + stripped + ("%20" * trail if stripped else "")


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {_field(v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of one record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(VERSION):
        raise ValueError("not a WARC record")
    headers = {}
    for line in head[len(VERSION) :].decode().split("\r\n"):
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip(" ")
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut off")
    return headers, rest[:size]


def record_uri(text: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, text).urn}>"


def page_record(row: dict, unnamed: str) -> bytes:
    """The record of a page: `first` names another page with the same payload."""
    payload, digest, page = row["payload"], row["digest"], row["page_id"]
    http = HTTP.format(len(payload)).encode()
    revisit = row["first"] is not None and row["first"] != page
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_uri(f"{page}:{digest}" if page is not None else unnamed)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", row["url"] or ""),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_uri(f"{row['first']}:{digest}"))]
    if page is not None:
        headers.append((PAGE_ID, page))
    return record_bytes(headers, http if revisit else http + payload)


# ---- archives ----------------------------------------------------------------------------


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from records; where they are too few or too small to train on, their own bytes."""
    samples = [r[:SAMPLE_RECORD] for r in records]
    held = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(max(1024, min(DICTIONARY_BYTES, held // 8)), samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class ArchiveWriter:
    """One archive: holds its first records back until the dictionary is built from them."""

    def __init__(self, path: str):
        self.path, self.records, self.raw = path, 0, 0
        self._held: list[bytes] = []
        self._out = None
        self.packed = self.dictionary = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        self.raw += len(record)
        if self._out is not None:
            self._write(record)
            return
        self._held.append(record)
        if self.raw >= SAMPLE_BYTES:
            self._open()

    def _open(self) -> None:
        content = build_dictionary(self._held)
        files, path = fs.FileSystem.from_uri(self.path)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self._out = files.open_output_stream(path, compression=None)
        head = struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content
        self._out.write(head)
        self.dictionary, self.packed = len(content), len(head)
        self._press = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_checksum=True, write_content_size=True)
        about = f"software: tidemark\r\nformat: WARC File Format 1.1\r\ndictionary: {len(content)} bytes\r\n".encode()
        self._write(record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_uri(self.path)), ("WARC-Date", DATE),
                                  ("Content-Type", "application/warc-fields")], about))
        for record in self._held:
            self._write(record)
        self._held = []

    def _write(self, record: bytes) -> None:
        frame = self._press.compress(record)
        self._out.write(frame)
        self.packed += len(frame)

    def close(self) -> dict:
        if self._out is None:
            self._open()
        self._out.close()
        return {"archive": self.path, "records": self.records, "raw_bytes": self.raw, "archive_bytes": self.packed, "dictionary_bytes": self.dictionary}


def _exactly(source: BinaryIO, size: int) -> bytes:
    data = source.read(size)
    if len(data) != size:
        raise ValueError("an archive is cut off")
    return data


def read_frames(source: BinaryIO) -> Iterator[tuple[int, bytes, bytes]]:
    """(place, frame, content of a skippable frame) of every frame, found by the sizes of its blocks. One frame is held at a time."""
    place = 0
    while first := source.read(4):
        magic = struct.unpack("<I", first)[0]
        if magic & 0xFFFFFFF0 == DICTIONARY_MAGIC & 0xFFFFFFF0:
            size = _exactly(source, 4)
            content = _exactly(source, struct.unpack("<I", size)[0])
            yield place, b"", content
            place += 8 + len(content)
            continue
        if magic != FRAME_MAGIC:
            raise ValueError("not a Zstandard frame")
        flags = _exactly(source, 1)
        single, checksum = flags[0] >> 5 & 1, flags[0] >> 2 & 1
        rest = (0 if single else 1) + (0, 1, 2, 4)[flags[0] & 3] + ((1 if single else 0), 2, 4, 8)[flags[0] >> 6]
        parts, last = [first, flags, _exactly(source, rest)], False
        while not last:
            head = _exactly(source, 3)
            block = int.from_bytes(head, "little")
            last = bool(block & 1)
            parts += [head, _exactly(source, 1 if block >> 1 & 3 == 1 else block >> 3)]
        frame = b"".join([*parts, _exactly(source, 4 * checksum)])
        yield place, frame, b""
        place += len(frame)


def read_archive(path: str) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(place, length, headers, block) of every record of an archive."""
    files, inner = fs.FileSystem.from_uri(path)
    press = zstandard.ZstdDecompressor()
    with files.open_input_stream(inner, compression=None, buffer_size=1 << 20) as source:
        for place, frame, content in read_frames(source):
            if not frame:
                press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            else:
                yield place, len(frame), *parse_record(press.decompress(frame))


# ---- Spark -------------------------------------------------------------------------------

ARCHIVES = StructType([StructField("archive", StringType()), *(StructField(n, LongType()) for n in ("records", "raw_bytes", "archive_bytes", "dictionary_bytes"))])


def with_first(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, first): `first` is the smallest id among pages with the same payload, null
    for small payloads. Only digests are grouped; the pages are joined with those that occur more
    than once, where Spark can split a digest with very many pages."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), utf8(F.col(html)).alias("payload"))
    large = F.length("payload") >= REVISIT_BYTES
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    repeated = (rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                .where((F.col("n") > 1) & F.col("first").isNotNull()).select(F.col("digest").alias("key"), "first"))
    key = F.when(large, F.col("digest")).otherwise(F.monotonically_increasing_id().cast("string"))
    return rows.withColumn("key", key).join(repeated, "key", "left").drop("key")


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive all pages below a folder; the table of archives, also written there as `archives`.

    Null html is an empty payload, null urls are empty, pages without id get a record without a page id and are
    never referred to. Of pages with equal id and payload each that has the smallest id is a response. No pages
    make no archive. Other columns are not archived.
    """
    spark = pages.sparkSession
    prepare(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, archive, number = TaskContext.get().partitionId(), uuid.uuid4().hex, None, 0
        done: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if archive is None:
                    archive = ArchiveWriter(f"{folder}/part-{part:05d}-{number:05d}-{attempt}.warc.zst")
                    number += 1
                archive.add(page_record(row, f"{archive.path}#{archive.records}"))
                if archive.raw >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([(f.name, arrow_type(f.dataType)) for f in ARCHIVES.fields]))

    rows = with_first(pages, page_id, url, html)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "first")})
    rows.mapInArrow(write, ARCHIVES).write.parquet(f"{folder}/archives")
    return spark.read.schema(ARCHIVES).parquet(f"{folder}/archives")


RECORD = [StructField("archive", StringType()), StructField("place", LongType()), StructField("length", LongType()), StructField("record_id", StringType()),
          StructField("record_type", StringType()), StructField("page_id", StringType()), StructField("url", StringType()),
          StructField("refers_to", StringType()), StructField("payload_digest", StringType()), StructField("payload_bytes", LongType())]


def read_warc(archives: DataFrame, payload: bool = False) -> DataFrame:
    """Every record of a page, from the archives themselves: where it lies, its ids, the digest and size of its
    payload, computed again (a digest that differs from the stored one is an error), and the payload if wanted.

    Of revisits the digest is the stored one, size and payload are null until `resolve` looks them up.
    """
    schema = StructType([*RECORD, *([StructField("payload", BinaryType())] if payload else [])])

    def rows_of(paths: Iterable[str]) -> Iterator[dict]:
        for path in paths:
            for place, length, headers, block in read_archive(path):
                kind = headers["warc-type"]
                if kind == "warcinfo":
                    continue
                stored = headers["warc-payload-digest"].removeprefix("sha256:")
                body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                if body is not None and hashlib.sha256(body).hexdigest() != stored:
                    raise ValueError(f"{path} at {place}: the payload does not have its digest")
                yield {"archive": path, "place": place, "length": length, "record_id": headers["warc-record-id"], "record_type": kind,
                       "page_id": headers.get(PAGE_ID.lower()), "url": headers["warc-target-uri"], "refers_to": headers.get("warc-refers-to"),
                       "payload_digest": stored, "payload_bytes": None if body is None else len(body), "payload": body}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema.fields])
        for batch in batches:
            held, size = [], 0
            for row in rows_of(batch.column(0).to_pylist()):
                held.append({n: row[n] for n in schema.names})
                size += (row["payload_bytes"] or 0) if payload else 0
                if len(held) == 1024 or size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema=fields)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=fields)

    # a task for each archive: by the bytes of their names, Spark would read very many in one
    return archives.select("archive").repartition(max(1, archives.count())).mapInArrow(read, schema)


def resolve(records: DataFrame) -> DataFrame:
    """records with the payload size (and payload, if read) of revisits, and `refers_to` as the page id of the
    record that a revisit names. Equal responses count once. Spark can split a response that very many name.
    Both sides are shuffled: how many records archives hold is not known from their names."""
    found = [c for c in ("payload_bytes", "payload") if c in records.columns]
    named = records.where("record_type = 'response'").dropDuplicates(["record_id"])
    named = named.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page"), *(F.col(c).alias(f"_{c}") for c in found))
    revisits = records.where("record_type = 'revisit'").join(named.hint("shuffle_hash"), "refers_to", "left")
    revisits = revisits.withColumns({"refers_to": F.col("_page"), **{c: F.col(f"_{c}") for c in found}}).select(*records.columns)
    return records.where("record_type = 'response'").unionByName(revisits)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    rows = resolve(materialise(read_warc(write_warc(pages, work_dir(spark, "warc")))))
    return rows.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE_OP12 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest"""
