"""Operator 7: archives written and read back."""
import hashlib

import pytest
from pyspark.sql import functions as F

from panelcast.llm import warc

BIG = "".join(chr(0x4E00 + i % 5000) for i in range(9000))
PAGES = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (3, "u\r\nWARC-Type: forged", "x" * 999),
    (4, None, "x" * 999), (5, "http://b", None), (6, "http://b", ""), (7, "http://é", BIG), (8, "http://c", BIG),
    (9, "http://c", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40), (10, "http://d", "ends \r\n"),
    (11, "http://d", "\n" * 3000), (None, "http://null", "q" * 1200), (12, "http://null", "q" * 1200),
    (2, "http://again", "x" * 1000), (13, "http://null", "\u0000\r" * 700),
]


def brute(rows):
    best = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000 and i is not None:
            best[h] = max(best.get(h, i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        kept = best.get(h, i)
        again = kept != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", kept if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 16])
def test_round_trip(spark, chunk):
    pages = spark.createDataFrame([(*r, 0, "x") for r in PAGES], "page_id long, url string, html string, id int, payload string")
    got = warc.archive_pages(pages, chunk_bytes=chunk).select(
        "page_id", "payload_bytes", "payload_sha1", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == brute(PAGES)


def test_chunks_hold_the_payload_and_running_digests(spark, scratch):
    pages = spark.createDataFrame([r for r in PAGES if r[0] in (7, 9, 11)], "page_id long, url string, html string")
    warc.write_archives(pages, f"{scratch}/w", chunk_bytes=1000)
    rows = warc.read_archives(spark, f"{scratch}/w").collect()
    for i, _, h in PAGES:
        if i in (7, 9, 11):
            own = sorted((r for r in rows if r.page_id == i), key=lambda r: r.chunk)
            seen = b""
            for k, r in enumerate(own):
                seen += bytes(r.data)
                assert r.chunk == k and r.running_sha1 == hashlib.sha1(seen).hexdigest() and len(r.data) <= 1000
            assert seen == h.encode() and [r.last for r in own] == [False] * (len(own) - 1) + [True]


def test_broken_archives_raise():
    def record(body, length=None):
        sha = hashlib.sha1(body).hexdigest()
        block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(body) + body
        head = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\n"
                f"WARC-Payload-Digest: sha1:{sha}\r\nContent-Length: {length or len(block)}\r\n\r\n")
        return head.encode() + block + b"\r\n\r\n"

    good = record(b"abc")
    assert [r[:4] for r in warc.ArchiveReader(True).feed(good)] == [(1, 0, 3, hashlib.sha1(b"abc").hexdigest())]
    for bad in (record(b"abc", 30), good.replace(b"abc", b"abd"), b"x" + good):
        with pytest.raises(ValueError):
            list(warc.ArchiveReader(True).feed(bad))
    half = warc.ArchiveReader(True)
    list(half.feed(good[:-9]))
    with pytest.raises(ValueError):
        half.close()


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(none).count() == 0
