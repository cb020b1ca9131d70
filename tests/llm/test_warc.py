"""WARC archives: round trips, the format by hand, damage, and the DuckDB oracle."""

import base64
import gzip
import hashlib
import io

import duckdb
import pytest
from pyspark.sql import functions as F

from indicast.llm import queries, warc

PAGES = "page_id long, url string, html string"
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def expected(rows, least=0):
    """The contract's rows by brute force."""
    last = {}
    for page_id, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), page_id)
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        first = last[html or ""] == page_id or len(raw) < least
        out.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if first else "revisit", None if first else last[html or ""]))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


CASES = [(1, "http://a/1", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://a/3 x\r\ny", "<p>ünï\r\n\r\n</p>"), (4, "u", None),
         (5, "u", ""), (6, "", "<p>one</p>"), (7, "u", "x" * 300_000), (8, "u", "\r\n\r\n"), (9, "u", "WARC/1.1\r\n")]


def test_query_equals_brute_force_and_its_oracle(spark, tmp_path):
    spark.createDataFrame(CASES, PAGES).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    assert rows_of(queries.QUERIES["op12_warc"](spark, str(tmp_path))) == expected(CASES)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({warc.ORACLE})").fetchall()) == expected(CASES)


def test_payloads_and_addresses_come_back(spark):
    manifest, folder = warc.write_archives(spark.createDataFrame(CASES, PAGES))
    found = {r.page_id: r for r in warc.read_archives(spark, manifest, folder, with_payload=True).collect()}
    for page_id, _, html in CASES:
        row = found[page_id]
        assert row.error is None
        assert row.payload is None if row.record_type == "revisit" else row.payload == (html or "").encode()
    assert found[1].url == "http://a/1" and found[2].url is None and found[3].url == "http://a/3%20x%0D%0Ay"


def test_least_size_of_revisits(spark):
    manifest, folder = warc.write_archives(spark.createDataFrame(CASES, PAGES), min_bytes=5)
    assert rows_of(warc.read_archives(spark, manifest, folder)) == expected(CASES, 5)


def test_hot_payload_goes_by_broadcast_and_others_by_digest(spark, monkeypatch):
    rows = [(i, f"u{i}", "hot" if i % 3 else f"cold {i // 2}") for i in range(300)]
    monkeypatch.setattr(warc, "HOT_SHARE", 4)
    manifest, folder = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(5))
    assert rows_of(warc.read_archives(spark, manifest, folder)) == expected(rows)


def test_files_and_stretches_are_cut(spark, monkeypatch):
    rows = [(i, "u", f"{i} " * 50) for i in range(100)]
    monkeypatch.setattr(warc, "FILE_BYTES", 6000)
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 2000)
    manifest, folder = warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1))
    kept = manifest.collect()
    assert len({r.file for r in kept}) > 3 and len(kept) > len({r.file for r in kept})
    assert sum(r.n_records for r in kept) == 100
    assert rows_of(warc.read_archives(spark, manifest, folder)) == expected(rows)


def test_repeated_rows_null_ids_clashing_columns_and_empty_tables(spark):
    twice = spark.createDataFrame([(5, "u", "x"), (5, "u", "x"), (None, "u", "x"), (None, "v", "only")], PAGES)
    clash = twice.withColumns({"digest": F.lit(1), "size": F.lit("s"), "n": F.lit(0), "last": F.lit(9), "sha": F.lit(b"")})
    manifest, folder = warc.write_archives(clash)
    found = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.read_archives(spark, manifest, folder).collect())
    assert found == [("5", "response", None), ("5", "response", None), ("None", "response", None), ("None", "revisit", 5)]
    manifest, folder = warc.write_archives(twice.limit(0))
    assert warc.read_archives(spark, manifest, folder).collect() == []


def member(payload=b"<p>text</p>", **kw):
    return warc.record(7, "http://a", payload, hashlib.sha1(payload).digest(), date="2024-01-01T00:00:00Z", **kw)


def read(raw, **kw):
    return list(warc.RecordReader(io.BytesIO(raw), **kw))


def test_format_by_hand():
    plain = gzip.decompress(member())
    head, _, block = plain.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1" and "WARC-Type: response" in lines
    size = int(next(x for x in lines if x.startswith("Content-Length")).split(": ")[1])
    assert block[size:] == b"\r\n\r\n" and block[:size].endswith(b"\r\n\r\n<p>text</p>")
    assert f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block[:size]).digest()).decode()}" in lines
    revisit = gzip.decompress(member(refers_to=9, revisit=True)).decode()
    assert "WARC-Refers-To: <urn:page:9:" in revisit and "<p>" not in revisit


@pytest.mark.parametrize("step", [1, 2, 3, 1000, 1 << 16])
def test_reading_in_blocks_of_any_size(step, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", step)
    size = 20 if step < 1000 else 300_000
    raw = member(b"a" * size) + member(b"") + member(refers_to=3, revisit=True)
    found = read(raw, with_payload=True)
    assert [(r["record_type"], r["payload_bytes"]) for r in found] == [("response", size), ("response", 0), ("revisit", 11)]
    assert found[0]["payload"] == b"a" * size


def test_a_record_of_another_tool():
    body = b"hello"
    head = (b"WARC/1.0\r\nwarc-type:resource\r\nWARC-Record-ID: <urn:uuid:x>\r\nContent-Type: text/plain\r\n"
            b"content-length: 5\r\n\r\n")
    found, = read(gzip.compress(head + body + b"\r\n\r\n"), with_payload=True)
    assert found["payload"] == body and found["payload_bytes"] == 5 and found["record_type"] == "resource"


def broken(old, new):
    plain = gzip.decompress(member())
    assert old in plain
    return gzip.compress(plain.replace(old, new, 1))


@pytest.mark.parametrize("raw, says", [
    (broken(b"<p>text</p>", b"<p>TEXT</p>"), "wrong warc-block-digest"),
    (broken(b"\r\n\r\n<p>text</p>\r\n\r\n", b"\r\n\r\n<p>text</p>\r\n"), "no two empty lines"),
    (broken(b"<p>text", b"<p>"), "no two empty lines|shorter"),
    (broken(b"Content-Length", b"Content-Lengs"), "without Content-Length"),
    (broken(b"WARC/1.1", b"HTTP/1.1"), "version line"),
    (member()[:-30], "ends within a record"),
    (member()[:-8] + bytes(8), "not a gzip member"),
    (b"plain text", "not a gzip member"),
])
def test_damage_is_found(raw, says):
    with pytest.raises(ValueError, match=says):
        read(raw)
    assert read(raw, strict=False)[0]["error"]


def test_a_damaged_record_does_not_hide_the_next():
    found = read(broken(b"<p>text</p>", b"<p>TEXT</p>") + member(), strict=False)
    assert found[0]["error"] and found[1]["error"] is None and found[1]["payload_bytes"] == 11
