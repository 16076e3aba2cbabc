"""Operator 5: token ids as length-delimited binary records with an offset index.

Documents are range-partitioned by id and sorted inside the partitions, so files
in order of their first id hold all documents in ascending id order. The *texts*
are shuffled (smaller than their ids), then encoded and written by the same task.
The number of files follows the bytes of the texts (``FILE_BYTES`` each), and rows of one
id may be dealt to several files, so that a file stays of that order (plus one
document) whatever id holds how many rows: a reader holds one file, never a share of the corpus.

File format. A file is a sequence of frames; all numbers are little-endian:

    uint64  payload length
    uint32  masked CRC-32 of the eight length bytes
    bytes   payload: uint8 id width (2 or 4), uint8 has a document id,
            int64 document id, then the token ids of that width
    uint32  masked CRC-32 of the payload
    uint8   0x0A, the end of a frame (the separator of Spark's line writer)

The mask is ``rotate_right(crc, 15) + 0xa282ead8``, so that a checksum over data
that itself holds checksums stays meaningful. Two-byte ids are used where all ids
of the vocabulary and the end id fit, four-byte ids otherwise; an id that does not
fit a given width raises. Frames are under ``<path>/files``. The index, a Parquet table of
``file, offset, length, doc_id, n_tokens, start_in_file, ids_crc32, start``, is written to
``<path>/index`` from a sequential read that checks every frame, and stays there for
shuffled reads (:func:`open_index`, :func:`read_at`), which decode the wanted frames alone.

Edge cases: a null text is empty and gives the end id alone; null ids come first;
rows repeated under one id are all written, next to each other, by their text; an empty
table gives an empty index; other columns are ignored. A damaged frame raises.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import cut_lineage, narrow, ship_package

HEAD, BODY, CHECK, END = struct.Struct("<QI"), struct.Struct("<BBq"), struct.Struct("<I"), b"\n"
FILE_BYTES, LEAST_BYTES = 16 << 20, 1 << 20
FILES_BY_NAME = 1000
INDEX = ("file string, offset long, length long, doc_id long, n_tokens long, "
         "start_in_file long, ids_crc32 long")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """One record; the line writer adds the end byte."""
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < 1 << 8 * width:
        raise ValueError(f"a token id does not fit {width} bytes")
    body = BODY.pack(width, doc_id is not None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(body))
    return length + CHECK.pack(masked(length)) + body + CHECK.pack(masked(body))


def unframe(data: memoryview, at: int = 0) -> tuple[int | None, np.ndarray, int]:
    """Document id, token ids (uint32) and the offset after the frame at ``at``."""
    length, check = HEAD.unpack_from(data, at)
    if masked(bytes(data[at:at + 8])) != check:
        raise ValueError(f"damaged length at offset {at}")
    body = bytes(data[at + HEAD.size:at + HEAD.size + length])
    end = at + HEAD.size + length
    if len(body) != length or CHECK.unpack_from(data, end)[0] != masked(body):
        raise ValueError(f"damaged record at offset {at}")
    width, has_id, doc_id = BODY.unpack_from(body)
    ids = np.frombuffer(body, f"<u{width}", offset=BODY.size).astype(np.uint32)
    return (doc_id if has_id else None), ids, end + CHECK.size + len(END)


def file_count(docs: DataFrame) -> int:
    """Files for the texts of ``docs`` (``text``): ``FILE_BYTES`` each; a small corpus is spread
    over the cores, but not below ``LEAST_BYTES``."""
    total = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-total // FILE_BYTES), min(cores, -(-total // LEAST_BYTES)))


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                  id_col: str = "doc_id", text_col: str = "text", width: int | None = None) -> None:
    """Writes the files of ``docs`` under ``path`` in ascending id order; without a
    ``width``, the tokenizer's largest id decides."""
    ship_package(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .textblocks import blocks
        from .tokens import encode_block, huggingface

        table, end = huggingface(tokenizer), np.array([end_id], np.uint32)
        size = width or (2 if max(table.top, end_id) < 1 << 16 else 4)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                ids, off = encode_block(block, table)
                out = [frame(doc_ids[block.first + i], np.concatenate([ids[off[i]:off[i + 1]], end]), size)
                       for i in range(block.n)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    base = narrow(docs, id_col, text_col)
    # Rows of one id are dealt by text, equal rows in the order they are read (it makes no
    # difference which of them stands first).
    by = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = (base.withColumns({"h": by[1], "m": by[2]}).repartitionByRange(file_count(base), by[0], "h", "m")
               .sortWithinPartitions(by[0], "h", "text").select("id", "text"))
    (ordered.mapInArrow(encode, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", END.decode()).text(path))


def file_index(file: str, content: bytes) -> Iterator[tuple]:
    """The index rows of one file, every frame checked."""
    data, at, start = memoryview(content), 0, 0
    while at < len(data):
        doc_id, ids, after = unframe(data, at)
        yield file, at, after - at, doc_id, len(ids), start, zlib.crc32(ids.astype("<u4").tobytes())
        at, start = after, start + len(ids)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index of the files under ``path``, from a sequential, checked read; a task
    holds one file at a time."""
    ship_package(spark)
    files = spark.sparkContext.binaryFiles(f"{path}/part-*")  # an Arrow batch would hold many files
    return spark.createDataFrame(files.flatMap(lambda f: file_index(*f)), INDEX)


def with_starts(index: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before this one, over all files.
    One row per file is ordered; the documents are not."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("held"), F.min("doc_id").alias("lowest"),
                                      F.count("*").alias("n"), F.count("doc_id").alias("n_ids"))
    # Files of one lowest id follow their numbers.
    order = Window.orderBy(F.expr("if(n_ids < n, null, lowest)").asc_nulls_first(), F.length("file"), "file")
    base = files.select("file", (F.sum("held").over(order) - F.col("held")).alias("base"))
    return index.join(base, "file").withColumn("start", F.col("base") + F.col("start_in_file")).drop("base")


def read_at(spark: SparkSession, wanted: DataFrame) -> DataFrame:
    """``doc_id, ids`` for index rows in any order (shuffled reads): the wanted frames
    of a file are fetched by offset; ``wanted`` has ``file, offset``. Where they lie in few
    files, only these are read."""
    ship_package(spark)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets in zip(batch.column(0), batch.column(1).to_pylist()):
                data = memoryview(content.as_buffer())
                got = [unframe(data, at)[:2] for at in offsets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()),
                     pa.array([g[1].tolist() for g in got], pa.list_(pa.int64()))], ["doc_id", "ids"])

    per_file = wanted.groupBy("file").agg(F.collect_list("offset").alias("offsets"))
    from_ = [r[0] for r in per_file.select("file").limit(FILES_BY_NAME + 1).collect()]
    if len(from_) > FILES_BY_NAME:
        from_ = [r[0] for r in wanted.select(F.regexp_replace("file", "/[^/]*$", "")).distinct().collect()]
    if not from_:
        return spark.createDataFrame([], "doc_id long, ids array<long>")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(from_)
    return (files.join(per_file, files["path"] == per_file["file"]).select("content", "offsets")
            .mapInArrow(fetch, "doc_id long, ids array<long>"))


def open_index(spark: SparkSession, path: str) -> DataFrame:
    """The index that :func:`token_records` left under ``path``."""
    return spark.read.parquet(f"{path.rstrip('/')}/index")


def token_records(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text", width: int | None = None) -> DataFrame:
    """Writes the files and the index under ``path`` (by default a folder of its own in the
    checkpoint folder) and returns the index, which has ``start`` as well."""
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/records-{uuid.uuid4().hex}"
    write_records(docs, f"{path}/files", tokenizer, end_id, id_col, text_col, width)
    with_starts(cut_lineage(read_index(spark, f"{path}/files"))).write.parquet(f"{path}/index")
    return open_index(spark, path)
