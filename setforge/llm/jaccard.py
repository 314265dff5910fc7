"""Similarity join of documents on the Jaccard coefficient of their word shingles.

Prefix filter with several matches, adapted to each document:

1. One pass counts all shingles in a table of fixed size. The (rounded) estimates and the shingle's hash make
   one global order, rare first. Any order is right; the estimates only decide how much work is done.
2. A document of n shingles whose partners share at least ``need`` of them keeps the first
   n - need + l shingles. l is chosen for each document by the estimated cost of its lists and candidates:
   a longer prefix asks for l common prefix shingles instead of one. Two documents that link share at least
   min(l, l') of the prefixes they keep.
3. Documents with equal sets are one node; shingles that one node alone keeps are dropped.
4. Hubs: each node is compared with the node that most often leads its lists, for a few drawn leaders. The links found join most of a
   large group of near copies at the cost of one comparison a member.
5. What is left are pairs of nodes in different components. In each list only nodes outside the list's main
   component meet the others; a pair inside a component can add nothing to the components and isn't made. In long lists a
   pair isn't made again that has met in a list shortly before.

Each set has a parity bitmap: a shingle turns one of its bits over. Bits in which two bitmaps differ are no more
than the shingles in which the sets differ. With 512 bits, pairs far apart are left out of the joins that make candidates.
A candidate pair is then held against bitmaps of as many bits as the sets have shingles, an eighth of a byte each,
which tell sets of a similarity below about 0.74 from those that link. Every link is then verified on the whole
sets. Shingles are 64-bit hashes (of five words).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, gathered_counts, small, stage, table, tidy

#: Counters of the shingle estimates (one byte each a task).
SKETCH_BITS = 21
#: Hubs that a node is compared with, by round: most groups settle in the first.
HUBS = (1, 6)
#: Longest extension of a prefix, and the cost of a verification in list entries.
MOST_MATCHES, VERIFY_COST = 4, 8

#: In lists longer than SHORT, nodes that have one of the LAST tokens before in common do not meet again.
SHORT, LAST = 3, 8

#: Bytes of a text that are hashed at a time; a block ends at white space.
BLOCK = 1 << 16
#: Odd base of the word hashes.
BASE = 0xD6E8FEB86659FD93
WHITE = re.compile(rb"[\x20\x09-\x0D]")


def spread(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers mixed one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """A random 64-bit number for each byte, the same for both cases of A-Z."""
    value = spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    value[65:91] = value[97:123]
    return value


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    one = np.ones(1, np.uint64)
    return tuple(np.cumprod(np.concatenate((one, np.full(n - 1, base, np.uint64)))) for base in (BASE, pow(BASE, -1, 1 << 64)))


def word_hashes(text: bytes) -> np.ndarray:
    """Unsigned 64-bit hashes of the words of a text, A-Z in lower case.

    A word's hash is a polynomial of its bytes' numbers, taken from prefix sums over a block of text.
    """
    found, at = [np.empty(0, np.uint64)], 0
    while at < len(text):
        cut = WHITE.search(text, at + BLOCK)
        end = cut.start() if cut else len(text)
        block = np.frombuffer(text, np.uint8, end - at, at)
        at = end
        white = np.ones(len(block) + 2, bool)
        white[1:-1] = (block == 32) | (block - np.uint8(9) < 5)
        edge = np.flatnonzero(white[1:] != white[:-1])
        first, last = edge[::2], edge[1::2]
        power, inverse = powers(max(BLOCK, 1 << (len(block) - 1).bit_length()) * 2)
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(letters()[block] * power[: len(block)], out=sums[1:])
        found.append(spread((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)))
    return np.concatenate(found)


def shingles(text: bytes | None, width: int = 5) -> np.ndarray:
    """Distinct hashes, ascending as unsigned numbers, of all runs of ``width`` words, A-Z in lower case; all words, if they are fewer."""
    h = word_hashes(text or b"")
    if not len(h):
        return np.empty(0, np.int64)
    n = min(width, len(h))
    x = np.full(len(h) - n + 1, n, np.uint64)
    for k, factor in enumerate(spread(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)):
        x += h[k : len(h) - n + 1 + k] * factor
    x = np.sort(spread(x))
    return x[np.concatenate(([True], x[1:] != x[:-1]))].view(np.int64)


def counter(x: np.ndarray, bits: int) -> np.ndarray:
    return (x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def estimates(docs: DataFrame, width: int, bits: int) -> np.ndarray:
    """Documents with a shingle of each counter, over all documents."""

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for cell in batch.column("text"):
            np.add.at(total, counter(shingles(cell.as_py(), width), bits), 1)

    return gathered_counts(docs, ["text"], 1 << bits, count, task_most=255)


def need(n: int, percent: int) -> int:
    """Shingles that any partner shares at least: ceil(n * percent / 100)."""
    return -(-n * percent // 100)


def prefix_of(x: np.ndarray, counts: np.ndarray, common: float, bits: int, percent: int) -> tuple[int, np.ndarray]:
    """l and the kept shingles of a set, as ascending keys of the global order: six bits for the estimate,
    57 bits of the hash. ``common`` is what any counter holds by chance."""
    n, least = len(x), need(len(x), percent)
    most = min(MOST_MATCHES, least)
    own = np.maximum(0, counts[counter(x, bits)] - common - 1)
    key = np.minimum(63, 2 * np.log2(1 + own)).astype(np.int64) << 57 | (x.view(np.uint64) >> np.uint64(7)).astype(np.int64)
    order = np.argsort(key)[: n - least + most]
    # expected other documents in each list
    others = np.cumsum(own[order])
    cost = [others[n - least + m - 1] * (1 + VERIFY_COST / m) for m in range(1, most + 1)]
    m = int(np.argmin(cost)) + 1
    return m, key[order[: n - least + m]]


def parity_of(x: np.ndarray) -> np.ndarray:
    """A power of two of bits, 512 and one a shingle at least, as longs; every shingle turns the bit it falls on over."""
    size = max(512, 1 << max(0, len(x) - 1).bit_length())
    odd = np.bincount((x.view(np.uint64) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def folded(parity: np.ndarray) -> np.ndarray:
    """A parity bitmap of 512 bits, out of a larger one."""
    return np.bitwise_xor.reduce(parity.reshape(-1, 8))


def room(differ: Column, percent: int) -> Column:
    """Whether sets of a_n and b_n shingles that differ in at least ``differ`` of them can link."""
    return (100 + percent) * differ <= (100 - percent) * (F.col("a_n") + F.col("b_n"))


def can_link(percent: int) -> Column:
    """Whether columns a_n, b_n, a_parity, b_parity (512 bits each) leave room for a link."""
    return room(reduce(add, [F.bit_count(F.col("a_parity")[i].bitwiseXOR(F.col("b_parity")[i])) for i in range(8)]), percent)


def can_link_wide(percent: int) -> Column:
    """Whether columns a_n, b_n, a_wide, b_wide leave room for a link; the larger bitmap is folded to the size of the other.

    Sets that link have sizes, and so bitmaps, that are a few halvings apart at most; what is further apart goes by size.
    """
    a, b = F.col("a_wide"), F.col("b_wide")
    middle = lambda x: (F.size(x) / 2).cast("int")
    half = lambda x: F.transform(F.slice(x, F.lit(1), middle(x)), lambda v, i: v.bitwiseXOR(x[i + middle(x)]))
    for _ in range((-(-100 // percent) - 1).bit_length()):
        a, b = F.when(F.size(a) > F.size(b), half(a)).otherwise(a), F.when(F.size(b) > F.size(a), half(b)).otherwise(b)
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(F.bit_count(x.bitwiseXOR(y)), F.lit(0))), F.lit(0), add)
    sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    return sizes & room(differ, percent)


def signatures(docs: DataFrame, counts: np.ndarray, width: int, bits: int, percent: int) -> DataFrame:
    """(doc_id, n, set_a, set_b, matches, prefix, parity, wide): set_a and set_b name the whole set."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("matches", pa.int32()), ("prefix", longs), ("parity", longs), ("wide", longs)])
    common = 1.5 * float(np.median(counts))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, rows = batch.slice(at, 1000), []
                for cell in part.column("text"):
                    x = shingles(cell.as_py(), width)
                    name = xxh3_128_intdigest(x.tobytes())
                    m, kept = prefix_of(x, counts, common, bits, percent) if len(x) else (0, x)
                    wide = parity_of(x)
                    rows.append((len(x), (name >> 64) - (1 << 63), (name & (1 << 64) - 1) - (1 << 63), m, kept, folded(wide), wide))
                yield pa.record_batch([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types[1:], strict=True))], schema=schema)

    return docs.mapInArrow(tidy(sign), "doc_id long, n long, set_a long, set_b long, matches int, prefix array<long>, parity array<long>, wide array<long>")


def sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the documents in ``ids`` (node), read again from their texts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.record_batch([part.column("node"), pa.array([shingles(t.as_py(), width) for t in part.column("text")], pa.list_(pa.int64()))], names=["node", "shingles"])

    found = docs.withColumnRenamed("doc_id", "node").join(small(ids), "node")
    return found.select("node", "text").mapInArrow(tidy(read), "node long, shingles array<long>")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, written: by their wide bitmaps first, what is left by their whole sets."""
    of = lambda k: nodes.select(F.col("node").alias(k), F.col("n").alias(f"{k}_n"), F.col("wide").alias(f"{k}_wide"))
    likely = stage(pairs.join(of("a"), "a").join(of("b"), "b").where(can_link_wide(percent)).select("a", "b"))
    ids = stage(likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct())
    sets = stage(sets_of(docs, ids, width))
    of = lambda k: sets.select(F.col("node").alias(k), F.col("shingles").alias(f"{k}_set"))
    both = likely.join(of("a"), "a").join(of("b"), "b")
    common = F.size(F.array_intersect("a_set", "b_set")).cast("long")
    return stage(both.where(100 * common >= percent * (F.size("a_set") + F.size("b_set") - common)).select("a", "b").distinct())


def crossing(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b) for nodes of different components that have a list of ``lists`` (token, node, component) in common and leave room for a link.

    Long lists come along with the node's last tokens before theirs. Where two nodes have one of these in common, they have met
    in its list, so near copies meet a few times and not in each list that they share.
    """
    sizes = lists.groupBy("token", "component").agg(F.count("*").alias("size"))
    heads = sizes.groupBy("token").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.sum("size").alias("listed"))
    at = lists.join(heads, "token").join(nodes.select("node", "n", "parity"), "node")
    before = F.collect_list("token").over(Window.partitionBy("node").orderBy("token").rowsBetween(-LAST, -1))
    at = at.withColumn("before", F.when(F.col("listed") > SHORT, before))
    side = lambda k: [F.col(c).alias(f"{k}_{c}") for c in ("n", "component", "parity", "before")]
    left = at.where("component <> main").select("token", F.col("node").alias("a"), *side("a"))
    right = at.select("token", F.col("node").alias("b"), *side("b"), "main")
    other = F.expr("a_component <> b_component and (b_component = main or a < b)")
    sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    new = ~F.coalesce(F.arrays_overlap("a_before", "b_before"), F.lit(False))
    met = left.join(right, (left["token"] == right["token"]) & other & sizes & can_link(percent) & new)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, hubs: tuple[int, ...] = HUBS, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Null, empty and word-free texts have no shingle and link with nothing. Rows that share a doc_id count as
    one document for links, each with its own number of shingles. Rows without doc_id link with nothing and
    have no component. An empty table gives no row. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counts = estimates(rows, width, bits)
    signed = stage(signatures(rows, counts, width, bits, percent))
    full = signed.where("n > 0 and doc_id is not null")
    # a node is a set; its name is its smallest doc_id
    nodes = full.groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("node"), F.first("matches").alias("matches"), F.first("prefix").alias("prefix"), F.first("parity").alias("parity"), F.first("wide").alias("wide"))
    nodes = stage(nodes)
    lists = nodes.select("node", F.explode("prefix").alias("token"))
    shared = lists.groupBy("token").agg(F.count("*").alias("listed")).where("listed > 1").select("token")
    lists = stage(lists.join(shared, "token"))
    edges = spark.createDataFrame([], "a long, b long")
    labels = components(edges)
    for turn, many in enumerate(hubs):
        at = mixed(with_label(lists, labels)) if turn else lists.withColumn("component", F.col("node"))
        # the nodes that lead a list are drawn anew each turn; in a node's own component they can add nothing
        lead = at.groupBy("token").agg(F.array(*[F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn), F.lit(k))) for k in range(many)]).alias("hubs"))
        best = at.join(lead, "token").select("node", "component", F.posexplode("hubs").alias("draw", "lead"))
        best = best.where("component <> lead.component").select("node", "draw", F.col("lead.node").alias("hub"))
        best = best.groupBy("node", "draw", "hub").agg(F.count("*").alias("shared"))
        best = best.groupBy("node", "draw").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
        pairs = best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        found = verified(pairs, nodes, rows, width, percent)
        edges = edges.union(found)
        labels = stage(components(edges))
    at = stage(mixed(with_label(lists, labels)))
    found = verified(stage(crossing(at, nodes, percent).distinct()), nodes, rows, width, percent)
    labels = components(edges.union(found))
    # back from nodes to rows
    names = nodes.select("set_a", "set_b", "n", "node")
    named = names.join(labels, "node", "left").select("set_a", "set_b", "n", F.coalesce("component", "node").alias("component"))
    members = signed.join(named, ["set_a", "set_b", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return members


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` without all but one of each group of linked documents, all columns kept.

    The document of the smallest doc_id stays. Rows that repeat doc_id and text become one. Documents without
    shingles, and rows without doc_id, all stay.
    """
    found = stage(jaccard_components(docs, **settings))
    gone = stage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct())
    left = docs.join(small(gone), F.col("__gone") == docs["doc_id"], "left_anti")
    again = stage(found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__again")).count().where("count > 1").select("__again"))
    if again.isEmpty():
        return left
    twice = left.join(small(again), F.col("__again") == left["doc_id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(small(again), F.col("__again") == left["doc_id"], "left_anti").unionByName(twice)


def with_label(lists: DataFrame, labels: DataFrame) -> DataFrame:
    return lists.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def mixed(lists: DataFrame) -> DataFrame:
    """Lists that hold more than one component."""
    several = lists.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token")
    return lists.join(several, "token")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, five words a shingle, 80 percent."""
    return jaccard_components(table(spark, sf_dir, "documents"))
