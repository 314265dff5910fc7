"""Lexical retrieval packing: documents fill windows together with their BM25 neighbours.

1. Token ids of every document are written once, with a min-hash of their pairs. The task that writes them
   counts the documents of each id and their lengths, and writes the counts in slices beside the documents.
2. The slices are added up to the document frequencies of all ids and the mean length over all documents.
3. Rows are dealt by ranges of (min-hash, doc_id), so near texts meet and a large group of copies is split
   over ranges. Each range is cut into shards of a bounded number of ids; a shard has its own inverted
   index (ids to postings), weighted by the global counts.
4. In a shard each seed document asks the index for its unused neighbours, best first, and they fill the
   seed's window; the one that does not fit is cut and its rest stays available.

Nothing is lost or cut off: every id lies in one piece. What remains at the end of a shard is laid out as
sequences of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE, partitions, stage, summed_slices, table, tidy
from .tokens import blocks, encoder, word_bpe

#: BM25's usual constants.
K1, B = 1.2, 0.75
#: Most distinctive ids of a seed that ask the index.
QUERY_TERMS = 12
#: Ids in a shard's index; bounds a task's memory (about 60 bytes each).
SHARD_IDS = 4_000_000

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)


def pair_min_hash(ids: np.ndarray) -> int:
    """The smallest hash of two neighbouring ids: texts that share most pairs mostly share it."""
    x = ids.astype(np.uint32)
    x = (x[:-1] << np.uint32(16) ^ x[1:] if len(x) > 1 else x) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    return int(x.min())


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, ascending, and how often each occurs."""
    x = np.sort(ids, kind="stable")  # a radix sort for 16 bits
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    return x[first], np.diff(np.append(first, len(x)))


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, near, width, ids) of each document: ids as bytes of the encoder's width; null text is empty.

    Besides, rows (slice, counts) of each task: numbers of its documents that hold each id, then of its documents
    and of their ids. In these rows ``ids`` is null, in those of documents ``slice``.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("near", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, end_id)
        total = np.zeros(coder.vocabulary + 2, np.int64)
        last = np.zeros(coder.vocabulary, np.int32)  # where each id stands last in the document at hand
        for batch in batches:
            for part in blocks(batch, "text"):
                ids = coder.each(part.column("text"))
                for x in ids:
                    place = np.arange(len(x), dtype=np.int32)
                    last[x] = place
                    total[x[last[x] == place]] += 1
                total[-2] += len(ids)
                total[-1] += sum(map(len, ids))
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(map(pair_min_hash, ids), pa.int64()), pa.array([coder.dtype.itemsize] * len(ids), pa.int32()), pa.array([i.tobytes() for i in ids], pa.binary()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())],
                    schema=schema,
                )
        if total[-2]:
            parts = [total[at : at + SLICE].tobytes() for at in range(0, len(total), SLICE)]
            none = [pa.nulls(len(parts), t) for t in schema.types[:4]]
            yield pa.record_batch([*none, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(tidy(encode), "doc_id long, near long, width int, ids binary, slice int, counts binary")


def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    widths = batch.column("width").to_pylist()
    return [np.frombuffer(c.as_buffer(), "<u2" if w == 2 else "<u4") for c, w in zip(batch.column("ids"), widths, strict=True)]


class Shard:
    """Documents of a shard with their inverted index."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.docs = docs
        sizes = np.array([len(d) for d in docs], np.int64)
        terms, counts = zip(*map(counted, docs), strict=True)
        doc = np.repeat(np.arange(len(docs)), [len(t) for t in terms])
        term, tf = np.concatenate(terms), np.concatenate(counts)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / mean))
        # the query side of each document: its heaviest terms
        self.begin = np.searchsorted(doc, np.arange(len(docs) + 1))
        self.term, self.weight = term, weight
        order = np.argsort(term, kind="stable")
        self.post_doc, self.post_weight = doc[order], weight[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.first = np.append(first, len(order))
        self.scores = np.zeros(len(docs))

    def neighbours(self, doc: int, free: np.ndarray) -> list[int]:
        """Documents with free ids that share a query term with ``doc``, best first; ties by place."""
        begin, end = self.begin[doc], self.begin[doc + 1]
        own, weight = self.term[begin:end], self.weight[begin:end]
        if len(own) > QUERY_TERMS:
            own = own[np.argpartition(-weight, QUERY_TERMS)[:QUERY_TERMS]]
        found = []
        for at in np.searchsorted(self.terms, np.sort(own)):
            posts = slice(self.first[at], self.first[at + 1])
            self.scores[self.post_doc[posts]] += self.post_weight[posts]
            found.append(self.post_doc[posts])
        near = np.unique(np.concatenate(found))
        score = self.scores[near].copy()
        self.scores[near] = 0
        keep = (free[near] > 0) & (near != doc)
        near, score = near[keep], score[keep]
        return near[np.lexsort((near, -score))].tolist()


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of a shard as lists of (document, start, length)."""
    done = np.zeros(len(docs), np.int64)
    free = np.array([len(d) for d in docs], np.int64)
    for doc in np.flatnonzero(free >= window):
        for _ in range(free[doc] // window):
            yield [(int(doc), int(done[doc]), window)]
            done[doc] += window
            free[doc] -= window
    index = Shard(docs, idf, mean)
    pieces, room = [], window

    def take(doc: int) -> None:
        nonlocal room
        n = int(min(room, free[doc]))
        pieces.append((doc, int(done[doc]), n))
        done[doc] += n
        free[doc] -= n
        room -= n

    for seed in range(len(docs)):
        while free[seed]:
            take(seed)
            if room:
                for doc in index.neighbours(seed, free):
                    take(doc)
                    if not room:
                        break
            if not room:
                yield pieces
                pieces, room = [], window
    # the rest of the shard, in sequences of falling powers of two
    rest, size = pieces, 1 << max(window - room, 1).bit_length()
    while rest:
        total = sum(n for _, _, n in rest)
        while size > total:
            size //= 2
        cut, left, room = [], [], size
        for doc, start, n in rest:
            part = min(n, room)
            room -= part
            if part:
                cut.append((doc, start, part))
            if n - part:
                left.append((doc, start + part, n - part))
        yield cut
        rest = left


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, shard_ids: int = SHARD_IDS, with_ids: bool = True) -> DataFrame:
    """Pieces of sequences of at most ``window`` ids: PIECES, with the ids of each piece as u32 bytes; without them (null) on request.

    Null text is empty and gives the end id alone. Null doc_ids and rows that share a doc_id are documents of
    their own. An empty table gives no piece. A document longer than the window first fills whole windows;
    its rest takes part in the retrieval. Other columns are ignored. A document longer than ``shard_ids``
    makes a shard alone. Sequence ids are the task's number and a count in it, so a task that runs again gives the
    same ones.
    """
    spark = docs.sparkSession
    # with a hash of the ids, so that the ranges are found without reading the ids themselves
    written = stage(tokenized(docs, tokenizer, end_id).withColumn("tie", F.xxhash64("ids")))
    ids = written.where("slice is null").select("doc_id", "near", "tie", "width", "ids")
    counts = summed_slices(written.where("slice is not null").select("slice", "counts"), encoder(tokenizer, end_id).vocabulary + 2)
    n, total = counts[-2], counts[-1]
    idf = np.log1p((n - counts[:-2] + 0.5) / (counts[:-2] + 0.5))
    mean = max(1.0, total / max(1, n))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sequence = TaskContext.get().partitionId(), 0
        names: list = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, names, held, size
            rows = []
            for pieces in pack_shard(held, idf, mean, window):
                offset = 0
                for doc, start, length in pieces:
                    data = held[doc][start : start + length].astype("<u4").tobytes()
                    rows.append((names[doc], start, length, zlib.crc32(data), len(held[doc]), task << 40 | sequence, offset, data if with_ids else None))
                    offset += length
                sequence += 1
                if len(rows) >= 2000:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECES.types, strict=True)], schema=PIECES)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECES.types, strict=True)], schema=PIECES)
            names, held, size = [], [], 0

        for batch in batches:
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), arrays(batch), strict=True):
                if held and size + len(x) > shard_ids:
                    yield from flush()
                names.append(doc_id)
                held.append(x.copy())
                size += len(x)
        if held:
            yield from flush()

    order = [F.col("near"), F.asc_nulls_first("doc_id"), F.col("tie")]
    dealt = ids.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "width", "ids").mapInArrow(tidy(packed), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 ids."""
    return pack(table(spark, sf_dir, "documents"), word_bpe(), with_ids=False).drop("ids")
