"""Audit of how filters interact: what each order of the filters removes, repeats and loses.

Every filter leaves a table of the ids that fail it. The sets of filters applied so far form a lattice; a level of
it is a table of (prefix, id) rows, alive or gone, and left-anti and left-semi joins with the id tables lead from
one level to the next. All tables are bucketed by id, so that these joins shuffle nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, small, stage, table

#: Ids in a bucket, and buckets at most (Spark's own bound is 100,000).
BUCKET_ROWS, BUCKETS = 1_000_000, 100_000
#: A text of this share of all rows or more has its rows looked up by broadcast; there can be no more such texts than that.
HOT_TEXTS = 1_000


class Bucketed:
    """Tables of ids bucketed alike, in the shared folder, known to this session until ``drop``."""

    def __init__(self, spark: SparkSession, rows: int):
        self.spark, self.names = spark, []
        self.buckets = min(BUCKETS, max(2 * spark.sparkContext.defaultParallelism, -(-rows // BUCKET_ROWS)))

    def store(self, df: DataFrame) -> DataFrame:
        name = f"audit_{uuid.uuid4().hex}"
        self.names.append(name)
        # dealt by the bucket itself, so that a bucket is one file however many partitions the session makes of it
        bucket = F.pmod(F.hash("row"), F.lit(self.buckets))
        writer = df.repartition(self.buckets, bucket).write.bucketBy(self.buckets, "row").sortBy("row")
        writer.option("path", new_folder(self.spark, name)).saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        """Forget the tables; their files stay in the shared folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def later_copies(texts: DataFrame) -> DataFrame:
    """Ids (row) of ``texts`` (row, doc_id, digest) whose text a smaller doc_id has as well; null ids are neither smaller nor larger.

    Minima are combined before they are dealt. A text of a thousandth of the rows meets its minimum by broadcast,
    a rarer one by its digest, so that no task holds a hot text.
    """
    rows = texts.count()
    firsts = stage(texts.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("rows")).where("least < most"))
    hot = F.col("rows") * HOT_TEXTS >= rows
    often = texts.join(F.broadcast(firsts.where(hot).select("digest", "least")), "digest", "left")
    rare = often.where("least IS NULL").drop("least").join(firsts.where(~hot).select("digest", "least"), "digest")
    return often.where("doc_id > least").select("row").union(rare.where("doc_id > least").select("row"))


def levels(everything: DataFrame, failing: dict[str, DataFrame], tables: Bucketed) -> list[DataFrame]:
    """Per number of filters applied, (prefix, row, part, alive) of every set of that many filters, its letters ascending.

    A prefix grows by a later letter only, so each set is made once: those alive that fail the new filter are
    gone (left-semi), the others stay alive (left-anti), and who was gone stays gone.
    """
    at = everything.select(F.lit("").alias("prefix"), "row", "part", F.lit(True).alias("alive"))
    out = [tables.store(at)]
    for _ in failing:
        parts = []
        for letter, ids in failing.items():
            below = "".join(x for x in failing if x >= letter)
            here = out[-1].where(~F.col("prefix").rlike(f"[{below}]"))
            grown = F.concat("prefix", F.lit(letter)).alias("prefix")
            alive, gone = here.where("alive"), here.where("NOT alive")
            parts.append(alive.join(ids, "row", "left_anti").select(grown, "row", "part", F.lit(True).alias("alive")))
            parts.append(alive.join(ids, "row", "left_semi").select(grown, "row", "part", F.lit(False).alias("alive")))
            parts.append(gone.select(grown, "row", "part", "alive"))
        out.append(tables.store(reduce(DataFrame.union, parts)))
    return out


def step_counts(states: list[DataFrame], failing: dict[str, DataFrame], marked: dict[str, DataFrame]) -> DataFrame:
    """(prefix, filter, part) with removed, redundant and one column per table of ``marked``, for the filters not in a prefix.

    Failing ids alive at the prefix are removed by the filter, gone ones are redundant; of the removed, those
    in a marked table are lost.
    """

    def of(letter: str, state: DataFrame) -> DataFrame:
        here = state.where(~F.contains("prefix", F.lit(letter)))
        return here.join(failing[letter], "row", "left_semi").withColumn("filter", F.lit(letter))

    # levels and ids are bucketed alike, so each of these joins stays inside its bucket
    hits = stage(reduce(DataFrame.union, [of(x, state) for state in states for x in failing]))
    removed = hits.where("alive")
    kinds = [hits.select("prefix", "filter", "part", F.when(F.col("alive"), "removed").otherwise("redundant").alias("kind"))]
    kinds += [removed.join(some, "row", "left_semi").select("prefix", "filter", "part", F.lit(name).alias("kind")) for name, some in marked.items()]
    counts = [rows.groupBy("prefix", "filter", "part", "kind").agg(F.count("*").alias("n")) for rows in kinds]
    names = ["removed", "redundant", *marked]
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).cast("long").alias(k) for k in names]
    return reduce(DataFrame.union, counts).groupBy("prefix", "filter", "part").agg(*sums)


def all_orders(spark: SparkSession, letters: str) -> DataFrame:
    """(filter_order, step, filter, prefix, after): the steps of every order, prefixes with their letters ascending."""
    rows = []
    for order in permutations(letters):
        for k, letter in enumerate(order):
            rows.append(("".join(order), k + 1, letter, "".join(sorted(order[:k])), "".join(sorted(order[: k + 1]))))
    return spark.createDataFrame(rows, "filter_order string, step int, filter string, prefix string, after string")


def interactions(rows: DataFrame, failing: dict[str, DataFrame], marked: dict[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, a column per marked table, shapley.

    ``rows`` (row, part) holds each id once, ``failing`` the ids (row) that fail each filter, by one-letter names,
    and ``marked`` ids to count among the removed. A filter's shapley is its removed summed over all orders.
    Every part of ``rows`` has all its rows, zeros included; no part, no rows. The result is computed when this returns: it has
    one row per part, order and step, and the tables it came from are forgotten.
    """
    spark = rows.sparkSession
    letters = "".join(sorted(failing))
    failing = {x: failing[x] for x in letters}
    tables = Bucketed(spark, rows.count())
    try:
        everything = tables.store(rows.select("row", "part"))
        ids = {x: tables.store(df.select("row")) for x, df in failing.items()}
        labels = {x: tables.store(df.select("row")) for x, df in marked.items()}
        at = levels(everything, ids, tables)
        kept = stage(reduce(DataFrame.union, at).groupBy(F.col("prefix").alias("after"), "part").agg(F.count_if("alive").alias("kept")))
        steps = stage(step_counts(at[:-1], ids, labels))
    finally:
        tables.drop()
    orders = F.broadcast(all_orders(spark, letters))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("removed", "redundant", *marked)]
    out = kept.join(orders, "after").join(steps, ["prefix", "filter", "part"], "left").select("part", "filter_order", "step", "filter", "kept", *zero)
    alone = steps.where(F.length("prefix") == len(letters) - 1).select("filter", "part", F.col("removed").alias("unique_fails"))
    total = out.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    out = out.join(alone, ["part", "filter"], "left").join(total, ["part", "filter"]).withColumn("unique_fails", F.coalesce("unique_fails", F.lit(0)).cast("long"))
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *marked, "shapley")



#: SQL conditions of the filters over the words and the text of a document.
RULES = {
    "A": "size(words) < 200",
    "B": "100 * size(array_distinct(words)) < 50 * size(words)",
    "C": "100 * regexp_count(text, '[A-Z]') > 3 * char_length(text)",
    "D": "text RLIKE '[#$%&*|]'",
}
COPIES = "E"
#: Words as in common.WORD, of which an empty or blank text has none.
WORDS = r"""filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"""


def audit(docs: DataFrame, labels: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """Interactions of ``rules`` and of the filter of later copies, E, over ``docs`` (doc_id, text, lang) by lang.

    Labels (doc_id, quality, toxic) say what of the removed is good_lost (quality 1) and toxic_lost (toxic 1); a doc_id labelled
    twice counts once. Null texts are empty ones, a null lang is the part ``''``. Each row is a document of its own, also where
    doc_ids repeat or are null: rows of equal ids are no later copies of each other, and a null id is
    neither smaller nor larger than another and has no labels. Other columns are not read. An empty table gives no rows.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("words", F.expr(WORDS))
    facts = stage(texts.select("row", "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[F.expr(rule).alias(x) for x, rule in rules.items()]))
    failing = {x: facts.where(F.col(x)).select("row") for x in rules}
    failing[COPIES] = later_copies(facts.select("row", "doc_id", "digest"))
    marked = {}
    for name, label in (("good_lost", "quality"), ("toxic_lost", "toxic")):
        ids = small(stage(labels.where(F.col(label) == 1).select("doc_id").distinct()))
        marked[name] = facts.join(ids, "doc_id", "left_semi").select("row")
    return interactions(facts.select("row", "part"), failing, marked)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, all 120 orders, by lang."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT part, concat(
      CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
      CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
      CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails,
    CAST(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS INT) AS good, CAST(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS INT) AS toxic
  FROM d
), g AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT filter_order, step, substr(filter_order, 1, step - 1) AS before, substr(filter_order, step, 1) AS f FROM o, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS step)
), m AS (
  SELECT g.*, s.*, contains(fails, f) AS hit, translate(fails, before, '') <> fails AS gone FROM g, s
), r AS (
  SELECT part, filter_order, step, f,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (hit AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (fails = f), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (hit AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (hit AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM m GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""
