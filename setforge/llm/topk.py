"""Exact top-k search: tiles of queries times shards, partial selection per tile, tree merging.

Queries and candidates are dealt into blocks and shards of bounded size by a hash. Blocks are sent, as whole
matrices, to every shard and shards to every block (an equi join on block and shard): the stated query
set meets all rows, in tiles. A tile is one matrix product and keeps k candidates a query. Partial lists
are then merged in groups of ``FAN`` shards, level by level.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

#: Queries in a block and candidates in a shard: a tile of scores takes 8 x BLOCK x STRIP bytes.
BLOCK, SHARD, STRIP = 1024, 16384, 4096
#: Partial lists merged at once.
FAN = 16

TILE = "query_id long, vec_id long, score long, shard int"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): components floor(64 x), x as double. Vectors that are null or hold null or non-finite
    components, and rows without vec_id, take no part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = F.col("embedding").isNotNull() & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * 64).cast("double")).alias("v"))


def matrices(rows: DataFrame, block: str) -> DataFrame:
    """One row per block: its ids and vectors, ascending by id; the block's size is bounded by its hash."""
    return rows.groupBy(block).agg(F.array_sort(F.collect_list(F.struct("vec_id", "v"))).alias("rows"))


def longest(cells: pa.StructArray) -> int:
    return int(cells.field("v").value_lengths().to_numpy(zero_copy_only=False).max(initial=0))


def dense(cells: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block; shorter vectors end in zeros."""
    ids = cells.field("vec_id").to_numpy(zero_copy_only=False)
    lists = cells.field("v")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(ids), width))
    out[np.repeat(np.arange(len(ids)), sizes), np.concatenate([np.arange(n) for n in sizes]) if len(sizes) else []] = lists.flatten().to_numpy(zero_copy_only=False)
    return ids, out


def product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products. Floats are exact while sums stay under 2^53; beyond it Python's integers are
    used, and scores outside of the long range become its ends."""
    if not q.size or not c.size or np.abs(q).max() * np.abs(c).max() * q.shape[1] < 2**53:
        return q @ c.T
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(q) @ whole(c).T
    return np.frompyfunc(lambda s: min(max(s, -(2**63)), 2**63 - 1), 1, 1)(exact)


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest, ties to the earlier place."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, len(scores) - k)[-k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


def tile_lists(k: int):
    def tile(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        for lq in range(left.num_rows):
            q_cells = left.column("rows").combine_chunks()[lq].values
            for rc in range(right.num_rows):
                c_cells = right.column("rows").combine_chunks()[rc].values
                width = max(1, longest(q_cells), longest(c_cells))
                (q_ids, q), (c_ids, c) = dense(q_cells, width), dense(c_cells, width)
                for qi, row in zip(q_ids.tolist(), strips(q, c), strict=True):
                    ids, own = c_ids, row
                    if (c_ids == qi).any():
                        ids, own = c_ids[c_ids != qi], row[c_ids != qi]
                    at = best_of(own, k)
                    found.extend((qi, i, int(s), key[1].as_py()) for i, s in zip(ids[at].tolist(), own[at].tolist(), strict=True))
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["query_id", "vec_id", "score", "shard"])

    return tile


def strips(q: np.ndarray, c: np.ndarray):
    """Rows of the product, a bounded number of queries at once."""
    step = max(1, BLOCK * STRIP // max(1, len(c)))
    for at in range(0, len(q), step):
        yield from product(q[at : at + step], c)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query row's vec_id, ties to the smaller vec_id.

    Candidates of a query are all rows with another vec_id. Equal rows of candidates each count; query rows
    that repeat a vec_id are one query (of the smallest vector). Vectors of unequal length are filled up
    with zeros. See ``usable`` for rows that take no part. No queries, or no candidates: no row.
    """
    q = stage(usable(queries).groupBy("vec_id").agg(F.min("v").alias("v")))
    c = stage(usable(candidates))
    blocks, shards = max(1, ceil(q.count() / block)), max(1, ceil(c.count() / shard))
    # the number of a row of the written table, so that many equal rows are spread too
    q = matrices(q.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "block")
    c = matrices(c.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")), "shard")
    q = q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    c = c.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    lists = q.groupBy("block", "shard").cogroup(c.groupBy("block", "shard")).applyInArrow(tile_lists(k), TILE)
    order = [F.desc("score"), F.asc("vec_id")]
    while shards > FAN:
        lists = lists.withColumn("shard", (F.col("shard") / FAN).cast("int"))
        level = Window.partitionBy("query_id", "shard").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(level)).where(f"rank <= {k}")
        shards = ceil(shards / FAN)
    last = Window.partitionBy("query_id").orderBy(*order)
    return lists.withColumn("rank", F.row_number().over(last)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose vec_id is divisible by 20 against all rows, 20 best."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.where("vec_id % 20 = 0"), vectors)


OP2_SQL = """
WITH u AS (
  SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 64) AS HUGEINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM u q JOIN u c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
