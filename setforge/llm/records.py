"""Token ids as length-delimited binary records with checksums, an offset index, and shuffled reads.

A record in a file, all numbers little-endian:

    length   u64   bytes of the payload
    check    u32   masked CRC-32 of the eight length bytes
    payload  bytes doc_id i64 | flags u32 (bits 0-7: bytes an id takes, bit 8: doc_id is null) | ids
    check    u32   masked CRC-32 of the payload
    mark     u8    0x0A, put after each frame by the writer

A mask turns the CRC right by 15 bits and adds 0xA282EAD8, so a checksum of data that holds checksums stays
useful. CRC-32 is the one of zlib. The final mark lets Spark's own text writer, and with it Spark's commit
protocol and any store that Spark reaches, write the frames: lost tasks leave nothing behind.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_folder, partitions, table
from .tokens import encoder, word_bpe

HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<qI")
CHECK = struct.Struct("<I")
IS_NULL = 1 << 8


def masked(data) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    payload = PAYLOAD.pack(doc_id or 0, ids.dtype.itemsize | (IS_NULL if doc_id is None else 0)) + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload))))


def read_frame(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids and the place after the frame at ``at``; raises ValueError where a checksum is wrong."""
    length, check = HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"length checksum is wrong at byte {at}")
    begin = at + HEAD.size
    payload = data[begin : begin + length]
    if len(payload) != length or masked(payload) != CHECK.unpack_from(data, begin + length)[0]:
        raise ValueError(f"payload checksum is wrong at byte {at}")
    doc_id, flags = PAYLOAD.unpack_from(payload)
    ids = np.frombuffer(payload[PAYLOAD.size :], "<u2" if flags & 0xFF == 2 else "<u4")
    return None if flags & IS_NULL else doc_id, ids, begin + length + CHECK.size + 1


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, files: int | None = None) -> None:
    """Write the token ids of every row of ``docs`` (doc_id, text) into ``folder``, ascending by doc_id.

    Null text is empty; null doc_ids come first; rows that share a doc_id all stay, ordered by a hash of the
    text; an empty table writes no record. Files are ranges of doc_id, so the order over all files is global,
    and no task holds more than its range. Other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, end_id)
        for batch in batches:
            out, size = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                data = frame(doc_id, coder.ids(text.as_py()))
                out.append(data)
                size += len(data)
                if size > 1 << 24:
                    yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    ordered = rows.repartitionByRange(files or partitions(spark), F.asc_nulls_first("doc_id"), F.xxhash64("text")).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    ordered.mapInArrow(encode, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(folder)


INDEX = "file int, path string, record long, offset long, length long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long"


def scan_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of all files, every checksum tested: place in its file, doc_id, number and CRC of ids.

    A file is one row to Spark, so files are bounded by the number given to ``write_records``.
    """
    schema = pa.schema([("file", pa.int32()), ("path", pa.string()), ("record", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("doc_id", pa.int64()), ("start_in_file", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, file, content in zip(batch.column("path").to_pylist(), batch.column("file").to_pylist(), batch.column("content"), strict=True):
                data, at, start, rows = memoryview(content.as_buffer()), 0, 0, []
                while at < len(data):
                    doc_id, ids, after = read_frame(data, at)
                    rows.append((file, path, len(rows), at, after - at, doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at, start = after, start + len(ids)
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("file"), "content").mapInArrow(scan, INDEX)


def write_index(spark: SparkSession, folder: str, index_folder: str) -> None:
    """Read all records back, test their checksums and write the offset index as Parquet."""
    scan_records(spark, folder).write.parquet(index_folder)


def with_start(index: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before. The window sees one row per file only."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return index.join(files, "file").withColumn("start", F.col("base") + F.col("start_in_file")).drop("base")


def read_shuffled(spark: SparkSession, folder: str, index_folder: str, seed: int = 0) -> DataFrame:
    """(doc_id, ids) of all records in an order drawn by ``seed``, by slices at the offsets of the index.

    Files are dealt to tasks in a drawn order and the records within a file in a drawn order: one read per
    file, as a loader over a large set would do. The same seed gives the same order within a task.
    """

    def slices(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})
        order = np.random.default_rng([seed, key[0].as_py()]).permutation(left.num_rows)
        data = memoryview(right.column("content")[0].as_buffer())
        offsets = left.column("offset").to_pylist()
        frames = [read_frame(data, offsets[i]) for i in order]
        return pa.table({"doc_id": pa.array([f[0] for f in frames], pa.int64()), "ids": pa.array([f[1].astype(np.int32) for f in frames], pa.list_(pa.int32()))})

    index = spark.read.parquet(index_folder).select("file", "offset")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("file"), "content")
    return index.groupBy("file").cogroup(files.groupBy("file")).applyInArrow(slices, "doc_id long, ids array<int>")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the files: write, read back, index."""
    folder = new_folder(spark, "records")
    write_records(table(spark, sf_dir, "documents"), f"{folder}/data", word_bpe())
    write_index(spark, f"{folder}/data", f"{folder}/index")
    return with_start(spark.read.parquet(f"{folder}/index")).select("doc_id", "start", "n_tokens", "ids_crc32")
