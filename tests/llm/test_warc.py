"""Archives: an exact round trip, and what a reader of the plain format sees."""

import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.compare import connect, rows_of
from tests.llm.test_operators import SF, prose
from tidemark.llm import warc as W

PAGES = "page_id long, url string, html string, archive string, digest string, first int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES)


LONG = "<p>" + prose(1, 400) + "</p>"
ROWS = [(9, "http://a/9", LONG), (3, "http://a/3", LONG), (4, None, LONG), (None, "u", LONG), (5, "http://b/\r\nWARC-Type: x ", "é" * 50),
        (6, " ", "é" * 50), (7, "h", "é" * 49 + "x"), (8, "h", "é" * 49 + "x"), (1, "x", None), (2, "y", ""), (0, "z", ""),
        (20, "big", prose(2, 60000)), (21, "\x00ü", "a\r\n\r\nWARC/1.1\r\n" * 20), (3, "http://a/3", LONG), (9, "http://a/9", "other " * 40), (11, "q", "other " * 40)]


def expected(rows):
    firsts = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            firsts[data] = min(firsts.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = firsts.get(data)
        revisit = first is not None and first != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("archive_bytes", [W.ARCHIVE_BYTES, 3000])
def test_round_trip(spark, tmp_path, archive_bytes):
    docs = pages(spark, ROWS).repartition(3)
    archives = W.write_warc(docs, str(tmp_path / "warc"), archive_bytes=archive_bytes)
    assert archives.agg(F.sum("records")).first()[0] == len(ROWS)
    rows = W.resolve(W.read_warc(archives, payload=True)).collect()
    got = [(r.page_id and int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in rows]
    assert sorted(map(str, got)) == expected(ROWS)
    assert sorted(bytes(r.payload) for r in rows) == sorted((h or "").encode() for _, _, h in ROWS)
    urls = {r.page_id: r.url for r in rows}
    assert urls["5"] == "http://b/%0D%0AWARC-Type: x%20" and urls["6"] == "%20" and urls["4"] == "" and urls["21"] == "%00ü"


def test_archives_are_frames_of_one_record_with_a_leading_dictionary(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html><body><h1>Shared heading of all pages</h1><p>{prose(i, 30)}</p></body></html>") for i in range(300)]
    archives = W.write_warc(pages(spark, rows).coalesce(1), str(tmp_path / "warc")).collect()
    names = []
    for archive in archives:
        data = open(archive.archive, "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D and size == archive.dictionary_bytes and len(data) == archive.archive_bytes
        content = data[8 : 8 + size]
        assert zstandard.ZstdCompressionDict(content).dict_id() or archive.records < 10
        # a streaming reader that knows nothing of places
        whole = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content)).stream_reader(io.BytesIO(data[8 + size :]), read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\n") == archive.records + 1 and whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        for place, length, headers, block in W.read_archive(archive.archive):
            frame = data[place : place + length]  # any record alone
            again = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content)).decompress(frame)
            assert W.parse_record(again) == (headers, block)
            names.append(headers.get("page-id"))
        plain = sum(len(zstandard.compress(r[2].encode(), 6)) for r in rows)
        assert len(archives) > 1 or archive.archive_bytes - size < plain
    assert sorted(n for n in names if n) == sorted(str(r[0]) for r in rows)


def test_damage_is_noticed(spark, tmp_path):
    archive = W.write_warc(pages(spark, [(1, "u", LONG)]), str(tmp_path / "warc")).first().archive
    data = open(archive, "rb").read()
    for broken in (data[:-5], data[:-40] + bytes([data[-40] ^ 1]) + data[-39:]):
        with open(tmp_path / "broken.zst", "wb") as out:
            out.write(broken)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(W.read_archive(str(tmp_path / "broken.zst")))


def test_archives_of_lost_attempts_are_not_read(spark, tmp_path):
    archives = W.write_warc(pages(spark, ROWS), str(tmp_path / "warc"))
    stray = W.ArchiveWriter(str(tmp_path / "warc" / "part-00000-00000-lost.warc.zst"))
    stray.add(W.page_record({"page_id": "77", "url": "u", "payload": b"x", "digest": "0", "first": None}, "n"))
    stray.close()
    assert W.read_warc(archives).count() == len(ROWS)


def test_no_pages_make_no_archive(spark, tmp_path):
    archives = W.write_warc(pages(spark, []), str(tmp_path / "warc"))
    assert archives.count() == 0 and W.resolve(W.read_warc(archives)).count() == 0


def test_registered_query_equals_its_sql(spark):
    got = W.op12_warc(spark, SF)
    cursor = connect(SF).execute(W.ORACLE_OP12)
    assert got.schema["page_id"].dataType == got.schema["refers_to"].dataType
    assert rows_of(got.columns, got.collect()) == rows_of([d[0] for d in cursor.description], cursor.fetchall())
