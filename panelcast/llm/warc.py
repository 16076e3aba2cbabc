"""Operator 7: web archives through a chunked record table.

Writing. A record's block (HTTP head and payload) is cut into chunk rows
``(record, chunk number, bytes)``. One chunk is one WARC record: the first is the
``response`` (or ``revisit``), the others are ``continuation`` records with
``WARC-Segment-Number`` and ``WARC-Segment-Origin-ID``, as WARC 1.1 segments
oversized records. Rows never hold more than one chunk, so no step builds a whole
record. Archives are written with Spark's line writer, whose separator is the end
of a WARC record (CR LF CR LF), gzip-compressed and thus read from their start.

Reading. Lines of an archive stream through a small state machine per file; a
payload is never assembled: its chunk rows carry the SHA-1 of all bytes of the
record so far, and the last one is checked against the header's payload digest.

Revisits. Payloads of at least ``min_bytes`` are grouped by SHA-1, MD5 and length
with map-side combine; of each group one record is the response and the others
refer to it. The groups of two or more are written first, so a payload shared by
a third of all pages joins as an ordinary exchange that the adaptive planner splits.

Edge cases: a null payload is empty; a null url has no target line; line ends in a
url are percent-encoded; a null page id is written as ``null`` and never wins
over another id; rows repeated under one id are records each (all response if that
id is kept); an empty table gives no records; other columns are ignored. A broken
archive raises.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import cut_lineage, ship_package

# Fixed values of the WARC 1.1 format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK_BYTES, MIN_REVISIT_BYTES = 64 << 10, 1000
ROWS = ("page_id long, chunk int, n_bytes long, running_sha1 string, last boolean, record_type string, "
        "refers_to long, payload_sha1 string, payload_bytes long, data binary")


def typed_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``id, url, payload, payload_bytes, payload_sha1, record_type, refers_to``."""
    base = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary").alias("payload"))
    base = base.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha1("payload").alias("payload_sha1"), F.md5("payload").alias("md5"))
    key = ["payload_sha1", "md5", "payload_bytes"]
    groups = cut_lineage(base.filter(F.col("payload_bytes") >= min_bytes).groupBy(*key)
                         .agg(F.max("id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    revisit = F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept"))
    return base.join(groups, key, "left").select(
        "id", "url", "payload", "payload_bytes", "payload_sha1",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("kept")).alias("refers_to"))


def chunk_rows(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of a record's block; a revisit's block is the HTTP head alone."""
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes"), F.lit(END)).cast("binary")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    more = F.ceil(F.octet_length(body) / F.lit(chunk_bytes)).cast("int")
    cut = records.withColumn("chunks", F.greatest(more, F.lit(1))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    part = F.substring(body, F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    first = F.col("chunk") == 0
    return cut.select("id", "url", "payload_sha1", "record_type", "refers_to", "chunk", "chunks",
                      (F.octet_length(head) + F.octet_length(body)).alias("block_bytes"),
                      F.when(first, F.concat(head, part)).otherwise(part).alias("data"))


def archive_lines(chunks: DataFrame, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """The WARC record of each chunk row, without its end."""
    def name(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))

    first, segmented = F.col("chunk") == 0, F.col("chunks") > 1
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda field, value: F.concat(F.lit(f"{field}: "), value)  # noqa: E731  null drops the line
    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        line("WARC-Record-ID", F.concat(name(F.col("id")), F.when(first, "").otherwise(
            F.concat(F.lit(":"), F.col("chunk") + 1)), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("Content-Type", F.when(first, "application/http; msgtype=response")),
        line("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("payload_sha1")))),
        line("WARC-Profile", F.when(first & F.col("refers_to").isNotNull(), PROFILE)),
        line("WARC-Refers-To", F.when(first & F.col("refers_to").isNotNull(), F.concat(name(F.col("refers_to")), F.lit(">")))),
        line("WARC-Segment-Number", F.when(segmented, (F.col("chunk") + 1).cast("string"))),
        line("WARC-Segment-Origin-ID", F.when(~first, F.concat(name(F.col("id")), F.lit(">")))),
        line("WARC-Segment-Total-Length", F.when(segmented & (F.col("chunk") == F.col("chunks") - 1),
                                                 F.col("block_bytes").cast("string"))),
        line("Content-Length", F.octet_length("data").cast("string")),
    ]
    head = F.concat(F.concat_ws("\r\n", *lines), F.lit(END)).cast("binary")
    return chunks.select(F.concat(head, F.col("data")).cast("string").alias("value"))


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES,
                   min_bytes: int = MIN_REVISIT_BYTES, **columns) -> None:
    chunks = chunk_rows(typed_records(pages, min_bytes=min_bytes, **columns), chunk_bytes)
    archive_lines(chunks).write.option("lineSep", END).option("compression", "gzip").text(path)


class ArchiveReader:
    """Turns the bytes of an archive, fed in any pieces, into chunk rows."""

    def __init__(self, with_data: bool):
        self.with_data, self.buffer, self.need, self.record = with_data, b"", None, None

    def feed(self, data: bytes) -> Iterator[tuple]:
        data, at = self.buffer + data, 0
        while True:
            if self.need is None:
                end = data.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                self.fields, at = self._head(data[at:end]), end + 4
                self.need = int(self.fields["content-length"])
            if len(data) - at < self.need + 4:
                break
            block, at = data[at:at + self.need], at + self.need + 4
            if data[at - 4:at] != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            self.need = None
            yield self._chunk(self.fields, block)
        self.buffer = data[at:]

    @staticmethod
    def _head(head: bytes) -> dict[str, str]:
        version, *lines = head.decode("utf-8").split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}

    def _chunk(self, fields: dict[str, str], block: bytes) -> tuple:
        number = int(fields.get("warc-segment-number", 1))
        if number == 1:
            if self.record:
                raise ValueError("a segmented record does not end")
            head, _, block = block.partition(b"\r\n\r\n")
            refers = fields.get("warc-refers-to")
            self.record = {
                "name": fields["warc-record-id"], "type": fields["warc-type"], "sha": hashlib.sha1(), "seen": 0,
                "refers": int(refers[10:-1]) if refers else None, "declared": fields["warc-payload-digest"][5:],
                "bytes": int(head.rpartition(b"Content-Length: ")[2]), "number": 0}
        r = self.record
        if not r or number != r["number"] + 1 or number > 1 and fields["warc-segment-origin-id"] != r["name"]:
            raise ValueError("segments are out of order")
        r["number"], r["seen"] = number, r["seen"] + len(block)
        r["sha"].update(block)
        last = "warc-segment-number" not in fields or "warc-segment-total-length" in fields
        running = r["sha"].hexdigest()
        if last:
            self.record = None
            if r["type"] == "response" and (running, r["seen"]) != (r["declared"], r["bytes"]):
                raise ValueError(f"payload digest of {r['name']} does not match")
        own = r["name"][10:-1]
        return (None if own == "null" else int(own), number - 1, len(block), running, last, r["type"], r["refers"],
                r["declared"], r["bytes"], block if self.with_data else None)

    def close(self) -> None:
        if self.buffer or self.record:
            raise ValueError("the archive ends inside a record")


def read_archives(spark: SparkSession, path: str, with_data: bool = True) -> DataFrame:
    """The chunk rows of all archives under ``path`` (columns of ``ROWS``)."""
    ship_package(spark)
    names = [c.split()[0] for c in ROWS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.string(),
             pa.int64(), pa.binary()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ArchiveReader(with_data)
        for batch in batches:
            for line in batch.column(0):
                rows = list(reader.feed(line.as_buffer().to_pybytes() + b"\n"))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        reader.close()

    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(parse, ROWS)


def archive_pages(pages: DataFrame, path: str | None = None, chunk_bytes: int = CHUNK_BYTES,
                  min_bytes: int = MIN_REVISIT_BYTES, **columns) -> DataFrame:
    """Writes the archives and reads them back: the last chunk row of each record."""
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    write_archives(pages, path, chunk_bytes, min_bytes, **columns)
    return read_archives(spark, path, with_data=False).filter("last").drop("data", "last")
