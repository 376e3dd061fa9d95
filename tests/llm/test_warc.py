import base64
import gzip
import hashlib

import pytest

from churnkit.llm import warc as W
from churnkit.session import scratch_path

PAGE = "page_id long, url string, html string, n long, block string, type string"


def pages(spark, rows):
    return spark.createDataFrame([(p, u, h, 1, "x", "y") for p, u, h in rows], PAGE).repartition(3)


ROWS = [(1, "http://a/1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://a/3", None), (4, "", ""), (5, "u\r\nWARC/1.1", "WARC/1.1\r\n\r\n" * 3),
        (6, "http://a/6", "ab\r\n" * 50_000), (7, "http://b/7", "ab\r\n" * 50_000), (8, "http://b", "x" * 33_000), (None, "n", "<p>é</p>"),
        (None, "n", "only"), (1, "http://a/1", "<p>é</p>")]


def brute(rows):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        keep = first.get(h or "")
        kind = "response" if p == keep else "revisit"
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), kind, keep if kind == "revisit" else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment,chunk", [(32768, 8192), (100, 7)])
def test_round_trip(spark, segment, chunk):
    rows = ROWS if segment > 100 else [r for r in ROWS if len(r[2] or "") < 1000]
    got = W.archive_pages(spark, pages(spark, rows), segment_bytes=segment, chunk_bytes=chunk, records_per_file=3)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(rows)


def test_payloads_come_back(spark):
    path = scratch_path(spark, "warc-test")
    W.write_archive(spark, pages(spark, ROWS), path, segment_bytes=1000, records_per_file=5)
    got = {(r["page_id"], bytes(r["payload"]).decode()) for r in W.read_archive(spark, path).where("type = 'response'").collect()}
    assert got == {(p, h or "") for p, _, h in ROWS if p in (1, 3, 5, 6, 8)} | {(None, "only")}


def test_table(spark, small):
    rows = [(r["page_id"], r["url"], r["html"]) for r in small("pages")]
    got = W.archive_pages(spark, spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows)


def test_empty(spark):
    assert W.archive_pages(spark, pages(spark, [])).count() == 0


def test_chunked_framing():
    assert W.unchunk(W.chunked(b"abc" * 100, 7)) == b"abc" * 100 and W.unchunk(b"0\r\n\r\n") == b""
    assert W.unchunk(b"3;x=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: y\r\n\r\n") == b"abc0123456789"
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"x\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(W.WarcError):
            W.unchunk(bad)


def segment(origin, number, total, block):
    return (origin, number, total, "response" if number == 1 else "continuation", 9, "u", "sha1:X", 4, bytearray(block))


SEGMENT = "origin string, number int, total long, type string, page_id long, url string, digest string, bytes long, block binary"


def test_reassembly_orders_and_checks(spark):
    good = [segment("a", 3, 6, b"ef"), segment("a", 1, None, b"ab"), segment("a", 2, None, b"cd")]
    row = W.reassemble(spark.createDataFrame(good, SEGMENT)).first()
    assert bytes(row["block"]) == b"abcdef" and row["type"] == "response"
    for bad in ([good[0], good[1]], [good[1], good[2]], [segment("a", 3, 7, b"ef"), *good[1:]], [*good, good[2]]):
        with pytest.raises(Exception, match="WARC record a"):
            W.reassemble(spark.createDataFrame(bad, SEGMENT)).collect()


def test_foreign_archive(tmp_path, spark):
    """Plain and gzip members per record, an unframed body, and continuation segments in another file."""
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    digest = "sha1:" + W.base32_sha1(b"hello")
    whole = W.record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), ("WARC-Payload-Digest", digest), ("X-Page-Id", 1)], body) + b"\r\n\r\n"
    first = W.record([("WARC-Type", "response"), ("WARC-Record-ID", "<b>"), ("WARC-Payload-Digest", digest), ("X-Page-Id", 2),
                      ("WARC-Segment-Number", 1)], body[:10]) + b"\r\n\r\n"
    rest = W.record([("WARC-Type", "continuation"), ("WARC-Record-ID", "<c>"), ("WARC-Segment-Origin-ID", "<b>"), ("WARC-Segment-Number", 2),
                     ("WARC-Segment-Total-Length", len(body))], body[10:]) + b"\r\n\r\n"
    (tmp_path / "1.warc").write_bytes(rest)
    (tmp_path / "2.warc.gz").write_bytes(gzip.compress(whole) + gzip.compress(first))
    got = sorted((r["page_id"], bytes(r["payload"])) for r in W.read_archive(spark, str(tmp_path)).collect())
    assert got == [(1, b"hello"), (2, b"hello")]
