"""Quality rules: word and line statistics, judged by an isolation forest calibrated on labelled rows.

The statistics of every document are computed once, in one pass over the whole texts. Trees of random splits
are grown on a bounded sample of labelled rows; a document that few splits isolate (a short path) is
anomalous. The length at which a document goes is set on the labelled rows, so that hardly any good one goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, stage, table, tidy

SYMBOLS = "#*$%&|<>"
HAS_WORD = re.compile(r"[^\x20\x09-\x0D]").search
#: Rule statistics the forest sees; all are shares or bounded, so texts of any length compare.
FEATURES = ["symbol_share", "upper_share", "mark_share", "digit_share", "dup_line_share", "repeat_share", "odd_word_share", "word_length", "variety"]
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MARKS = "!?;:=@^~_"


def repeated_words(ids: np.ndarray, width: int = 8) -> int:
    """Words in windows of ``width`` (a power of two) words that are found twice or more; exact."""
    n = len(ids)
    if n <= width:
        return 0
    names, step = ids, 1
    while step < width:  # names of runs twice as long, from names of two neighbouring runs
        names = names[:-step].astype(np.int64) * (int(names.max()) + 1) + names[step:]
        names = np.unique(names, return_inverse=True)[1]
        step *= 2
    twice = np.bincount(names)[names] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str | None) -> list[float]:
    """STATS and FEATURES of a whole text; null and word-free texts have zeros."""
    words = [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()] if text else []
    n = len(words)
    if not n:
        return [0] * (len(STATS) + len(FEATURES))
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if HAS_WORD(x)]
    dup_lines = len(lines) - len(set(lines))
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    repeats = repeated_words(ids)
    upper = sum(map(str.isupper, words))
    marks = sum(map(text.count, MARKS))
    digits = sum(map(text.count, "0123456789"))
    odd = sum(c for w, c in zip(index, np.bincount(ids), strict=True) if not w[0].isalpha() or len(w) > 40)
    shares = [symbols / chars, upper / n, marks / chars, digits / chars, dup_lines / len(lines), repeats / n, odd / n, min(chars / n, 40), np.log(len(index)) / np.log(n) if n > 1 else 1.0]
    return [n, chars, symbols, dup_lines, repeats, *shares]


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, copy (a hash that names the text), STATS (long) and FEATURES (double) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), *((s, pa.int64()) for s in STATS), *((f, pa.float64()) for f in FEATURES)])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), batch.column("copy"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types[2:], strict=True))], schema=schema)

    kinds = ", ".join(["doc_id long", "copy long", *(f"{s} long" for s in STATS), *(f"{f} double" for f in FEATURES)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("copy"), "text").mapInArrow(tidy(compute), kinds)


def average_path(n: np.ndarray | int):
    """Mean path length of an unsuccessful search among n rows: what a leaf of n rows adds."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Isolation trees in arrays: split feature (-1: leaf), split value, children, and path length at a leaf.

    A split is drawn inside the node's box, which begins as the range of all labelled rows, and the trees
    are grown on good rows: the space that no good row visits is cut off early, also along a statistic that
    all good rows share, where a split between their own least and largest value could never fall.
    """

    def __init__(self, good: np.ndarray, box: tuple[np.ndarray, np.ndarray], trees: int, rows: int, seed: int):
        rng = np.random.default_rng(seed)
        self.rows = min(rows, len(good))
        depth = int(np.ceil(np.log2(max(2, self.rows))))
        self.trees = [self.grow(good[rng.permutation(len(good))[: self.rows]], box, depth, rng) for _ in range(trees)]

    @staticmethod
    def grow(x: np.ndarray, box: tuple[np.ndarray, np.ndarray], depth: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []

        def node(x: np.ndarray, d: int, low: np.ndarray, high: np.ndarray) -> int:
            at = len(nodes)
            nodes.append([-1, 0, 0, 0, d + float(average_path(len(x)))])
            wide = np.flatnonzero(high > low)
            if d < depth and len(x) and len(wide):
                f = int(rng.choice(wide))
                v = float(rng.uniform(low[f], high[f]))
                left = x[:, f] < v
                below, above = high.copy(), low.copy()
                below[f] = above[f] = v
                nodes[at][:4] = [f, v, node(x[left], d + 1, low, below), node(x[~left], d + 1, above, high)]
            return at

        node(x, 0, *box)
        f, v, a, b, path = map(np.array, zip(*nodes, strict=True))
        return f.astype(np.int64), v, a.astype(np.int64), b.astype(np.int64), path

    def score(self, x: np.ndarray) -> np.ndarray:
        """2^(-mean path / average path): near 1 for rows isolated at once, under 0.5 for common ones."""
        total = np.zeros(len(x))
        for f, v, a, b, path in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := f[at] >= 0).any():
                rows = np.flatnonzero(inner)
                k = at[rows]
                at[rows] = np.where(x[rows, f[k]] < v[k], a[k], b[k])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(average_path(self.rows)), 1e-9))


def calibrated(score: np.ndarray, good: np.ndarray, most_lost: float, times: np.ndarray | None = None) -> float:
    """The score above which a document goes: of all cuts that lose at most a share ``most_lost`` of the good
    labelled rows, the lowest, moved half-way into the gap above the last kept good row. An entry stands for
    ``times`` rows, by default for one."""
    if not good.any() or good.all():
        return np.inf
    order = np.argsort(score[good])
    rows = np.cumsum(np.ones(len(order)) if times is None else times[good][order])
    last = score[good][order][np.searchsorted(rows, max(1, np.ceil(rows[-1] * (1 - most_lost))))]
    above = score[~good & (score > last)]
    return float(last + (above.min() - last) / 2) if len(above) else np.inf


#: Digits of a score: the labelled rows' scores come to the driver as counts of at most 10^4 + 1 values of each label.
DIGITS = 4


def sampled(rows: DataFrame, sample: int, seed: int) -> DataFrame:
    """At most ``sample`` of ``rows``, those of the smallest hashes of doc_id.

    A bound on the hash leaves a little more than the sample, so that no task sends a whole sample of its own.
    """
    name = F.xxhash64("doc_id", F.lit(seed))
    share = 1.2 * (sample + 1000) / max(rows.count(), 1)
    if share < 1:
        rows = rows.where(name <= int(-(2**63) + share * 2.0**64))
    return rows.orderBy(name, "doc_id", *FEATURES, "quality").limit(sample)


def judged(docs: DataFrame, labels: DataFrame, sample: int = 20_000, trees: int = 100, rows: int = 1024, most_lost: float = 0.001, seed: int = 0) -> DataFrame:
    """doc_id, copy, STATS, base_failed, anomaly, kept for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, quality 0 or 1): at most ``sample`` labelled rows of texts that pass the base rules,
    those of the smallest hashes of doc_id, fit the forest; all of them set its threshold. Null text and word-free
    text fail the base rules. Where no or only one kind of label is given, the base rules alone decide. Rows that
    share a doc_id are judged each by itself; labels of such rows count for each, null labels for none.
    """
    stats = stage(rule_statistics(docs))
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    stats = stats.withColumn("base_failed", failed)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)").distinct()
    labelled = stats.where("not base_failed").join(known, "doc_id")
    rows_in = sampled(labelled, sample, seed).select(*FEATURES, "quality").collect()
    x = np.array([r[:-1] for r in rows_in], float)
    good = np.array([r[-1] for r in rows_in]) == 1
    if not good.any():
        return stats.select("doc_id", "copy", *STATS, "base_failed", F.lit(0.0).alias("anomaly"), (~F.col("base_failed")).alias("kept"))
    forest = Forest(x[good], (x.min(0), x.max(0)), trees, rows, seed)

    def scored(df: DataFrame, kept: str) -> DataFrame:
        names = [f.split()[0] for f in kept.split(", ")]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
                yield pa.record_batch([*(batch.column(c) for c in names), pa.array(np.round(forest.score(x), DIGITS))], names=[*names, "anomaly"])

        return df.select(*names, *FEATURES).mapInArrow(tidy(score), f"{kept}, anomaly double")

    counts = scored(labelled, "quality int").groupBy("anomaly", "quality").count().collect()
    value, label, times = (np.array(c) for c in zip(*counts, strict=True))
    limit = calibrated(value, label == 1, most_lost, times)
    out = scored(stats, ", ".join(["doc_id long", "copy long", *(f"{s} long" for s in STATS), "base_failed boolean"]))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= limit))


def good_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept; equal rows stay or go alike."""
    bad = stage(judged(docs, labels, **settings).where("not kept").select(F.col("doc_id").alias("__bad_id"), F.col("copy").alias("__bad_copy")).distinct())
    return docs.join(small(bad), F.col("__bad_id").eqNullSafe(docs["doc_id"].cast("long")) & (F.col("__bad_copy") == F.xxhash64(docs["text"])), "left_anti")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, calibrated on labels.quality."""
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("copy")
