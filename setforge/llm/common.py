"""Helpers shared by the operators: written stages, words, counts gathered from all tasks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setforge.session import cut_lineage, ensure_checkpoint_dir

#: The word of all contracts: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """``df`` written as a table into the shared folder and read again."""
    return cut_lineage(df)


#: Rows of keys or labels that are broadcast at most (about 30 bytes each); beyond it their join is dealt by key.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """A written table of a few short columns, with a broadcast hint if its rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: str) -> str:
    """SQL for the number of words of a text column; null has none."""
    return f"coalesce(regexp_count({text}, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0)"


def tidy(compute: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``compute`` for mapInArrow, which gives memory that Arrow keeps for later back to the system, after each batch and at the end.

    Workers outlive their tasks, so what one keeps would stand beside the memory of stages that need no Python.
    """

    def release() -> None:
        pa.default_memory_pool().release_unused()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release()

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from compute(each(batches))
        release()

    return tidied


#: Counters that go to one row; 64 KB of 32-bit counts.
SLICE = 1 << 14


def gathered_counts(docs: DataFrame, columns: list[str], size: int, count, task_most: int | None = None) -> np.ndarray:
    """Sums over all rows of a vector of ``size`` counters.

    ``count(batch, total)`` adds a batch to its task's counters. Each task sends one row per slice of
    2^14 counters, and each slice is summed by itself. ``size`` bounds what the driver gets (8 bytes each).
    Where estimates will do, ``task_most`` stops each task's counters at 255, to send one byte each.
    """
    cell = np.dtype(np.int64 if task_most is None else np.uint8)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            count(batch, total)
        for at in range(0, size, SLICE):
            part = total[at : at + SLICE]
            part = part if task_most is None else np.minimum(part, task_most).astype(cell)
            if part.any():
                yield pa.record_batch([pa.array([at // SLICE], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "counts"])

    return summed_slices(docs.select(*columns).mapInArrow(tidy(local), "slice int, counts binary"), size, cell)


def summed_slices(slices: DataFrame, size: int, cell: np.dtype = np.dtype(np.int64)) -> np.ndarray:
    """Sum of vectors of ``size`` counters of type ``cell``, given in rows (slice, counts) of 2^14 counters each."""

    def add(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in parts:
            for part in batch.column("counts"):
                values = np.frombuffer(part.as_buffer(), cell).astype(np.int64)
                total = values if total is None else total + values
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "counts"])

    out = np.zeros(size, np.int64)
    for row in slices.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect():  # one for each slice
        values = np.frombuffer(row["counts"], np.int64)
        out[row["slice"] * SLICE : row["slice"] * SLICE + len(values)] = values
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an undirected edge table; component is the smallest node.

    Large-star / small-star contraction: every round is two pre-aggregated minima and two joins, and is
    written to the shared folder, so no component is ever gathered in one place.
    """
    at = stage(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct())
    was = None
    for _ in range(rounds):
        both = at.select("a", "b").union(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # large star: every larger neighbour hangs on the smallest node of the neighbourhood
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # small star: smaller neighbours hang on the smallest of them
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(low.select("a", F.col("m").alias("b"))).distinct()
        at = stage(small)
        now = at.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == was:
            break
        was = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = at.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return at.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
