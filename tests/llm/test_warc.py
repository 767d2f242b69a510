import base64
import gzip
import hashlib

import duckdb
import pytest

from lexispan.llm import warc
from lexispan.llm.warc import archive_records, read_archive, record_summary, restored, write_archive

BIG = "<p>é</p>\r\n\r\nWARC/1.0\r\n" * 100
ROWS = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://a/9", BIG), (3, "http://a/3", "small"), (4, "http://a/4", "small"),
    (5, None, ""), (6, "http://a\r\nX: y", None), (7, "http://a/7", "x" * 1000), (8, "http://a/8", "x" * 999), (10, "http://a/10", "x" * 999),
]
SUMMARY = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_archive_against_sql(spark, tmp_path):
    write_archive(pages(spark), str(tmp_path / "w"))
    records = read_archive(spark, str(tmp_path / "w"))
    found = record_summary(records).selectExpr("cast(page_id AS long)", "payload_bytes", "payload_digest", "record_type", "cast(refers_to AS long)")
    connection = duckdb.connect()
    connection.register("pages", pages(spark).toArrow())
    expected = connection.execute(f"SELECT {', '.join(SUMMARY)} FROM ({warc.oracle()})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert sum(r.record_type == "revisit" for r in found.collect()) == 2


def test_round_trip(spark, tmp_path):
    write_archive(pages(spark), str(tmp_path / "w"))
    back = {int(r.page_id): (r.url, r.html) for r in restored(read_archive(spark, str(tmp_path / "w"))).collect()}
    urls = {6: "http://a%0D%0AX: y"}
    assert back == {i: (urls.get(i, url), html or "") for i, url, html in ROWS}


def test_a_changed_payload_is_noticed(spark, tmp_path):
    write_archive(pages(spark, ROWS[:1]), str(tmp_path / "w"))
    file = next((tmp_path / "w").rglob("*.gz"))
    data = gzip.decompress(file.read_bytes())
    assert len(list(archive_records(gzip.compress(data)))) == 1
    with pytest.raises(ValueError, match="digest"):
        list(archive_records(gzip.compress(data.replace("é".encode(), "è".encode(), 1))))


def test_odd_rows(spark, tmp_path):
    rows = [(1, "u", BIG), (1, "u", BIG), (None, "v", BIG), (None, "w", "y" * 2000), (None, "w", "y" * 2000)]
    extra = pages(spark, rows).selectExpr("*", "1 AS sha256", "2 AS payload")
    write_archive(extra, str(tmp_path / "w"))
    found = record_summary(read_archive(spark, str(tmp_path / "w"))).collect()
    assert sorted(str((r.page_id, r.record_type, r.refers_to)) for r in found) == sorted(map(str, [
        ("1", "response", None), ("1", "response", None), (None, "revisit", "1"), (None, "response", None), (None, "response", None)]))
    write_archive(pages(spark, ROWS).limit(0), str(tmp_path / "none"))
    assert read_archive(spark, str(tmp_path / "none")).collect() == []


def test_records_byte_for_byte(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LARGE", 1500)
    monkeypatch.setattr(warc, "NAMED_PER_TASK", 1)
    write_archive(pages(spark), str(tmp_path / "w"))
    found: dict[str, bytes] = {}
    for r in restored(read_archive(spark, str(tmp_path / "w"))).orderBy("file", "at").collect():
        assert bytes(r.record).startswith(bytes(r.headers) + bytes(r.http_head))
        found[r.file] = found.get(r.file, b"") + bytes(r.record) + b"\r\n\r\n"
    files = {str(f): gzip.decompress(f.read_bytes()) for f in (tmp_path / "w").rglob("*.gz")}
    files = {name: data for name, data in files.items() if data}
    assert {name.split(":", 1)[1].replace("//", ""): data for name, data in found.items()} == files
    assert any("files=small" in name for name in files) and any("files=small" not in name for name in files)


def record(kind, block, *fields):
    lines = ["WARC/1.1", f"warc-type: {kind}", f"CONTENT-LENGTH: {len(block)}", *fields]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_of_other_writers(spark, tmp_path):
    http, page = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n", b"<p>page</p>\r\n\r\n"
    sha1 = base64.b32encode(hashlib.sha1(page).digest()).decode()
    response = ("Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha1}", "WARC-Record-ID: <urn:uuid:1>")
    records = [
        record("warcinfo", b"software: x"),
        record("response", http + page, *response),
        record("revisit", http, f"WARC-Payload-Digest: sha1:{sha1}"),
        record("revisit", http, f"WARC-Payload-Digest: sha256:{hashlib.sha256(page).hexdigest()}"),
        record("response", b"no head", "Content-Type: application/http"),
        record("resource", b""),
    ]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    back = restored(read_archive(spark, str(tmp_path / "w"))).orderBy("at").collect()
    assert [r.html for r in back] == ["software: x", page.decode(), None, page.decode(), "", ""]
    assert [bytes(r.record) + b"\r\n\r\n" for r in back] == records
    with pytest.raises(ValueError, match="digest"):
        list(archive_records(gzip.compress(record("response", http + page + b"!", *response))))


def test_large_records_and_cut_files(monkeypatch):
    monkeypatch.setattr(warc, "INFLATED", 1000)
    payloads = [b"ab" * n for n in (0, 1, 499, 500, 501, 300_000)] + [b"\r\n\r\n" * 2000]
    data = b"".join(record("resource", p) for p in payloads)
    content = gzip.compress(data)
    assert [r[-1] for r in archive_records(content)] == payloads
    for wrong in (gzip.compress(data[:-1]), gzip.compress(data[:-20]), content[:-20], gzip.compress(b"x" + data)):
        with pytest.raises(ValueError):
            list(archive_records(wrong))
