"""Secret scans: named patterns, and a battery of randomness tests for what no pattern names.

All in DataFrame functions. Long tokens outside of pattern matches are candidates. Each gets an encoding (the
smallest alphabet that holds it) and three tests of uniform randomness: chi-squared over the alphabet, runs about the
alphabet's middle, and serial correlation at lag one. The smallest of the three p-values, times three, is the
token's. A token is thrown out as text or structure where Benjamini-Hochberg's rule, within its class of
length, rejects randomness: of what is thrown out, a share ``fdr`` at most is expected to be random. p-values
are rounded up to a grid, so the rule needs a histogram of each class only and stays valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

#: (kind, pattern, group whose length counts, least length); the place is the order of kinds.
KINDS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
]
#: An equals sign is padding at a token's end, and elsewhere stands between a name and its value.
TOKEN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?"
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: (name, pattern, alphabet) from narrow to wide. Letters of one case and plain numbers are no encoding.
ENCODINGS = [
    ("number", r"^[0-9+/_=-]+$", None),
    ("word", r"^([A-Z]?[a-z_=/+-]+|[A-Z_=/+-]+)$", None),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+=*$", LOWER.upper() + "234567"),
    ("upper36", "^[A-Z0-9]+$", DIGITS + LOWER.upper()),
    ("lower36", "^[a-z0-9]+$", DIGITS + LOWER),
    ("base62", "^[A-Za-z0-9]+$", DIGITS + LOWER.upper() + LOWER),
    ("base64url", "^[A-Za-z0-9_-]+=*$", LOWER.upper() + LOWER + DIGITS + "-_"),
    ("base64", "^[A-Za-z0-9+/]+=*$", LOWER.upper() + LOWER + DIGITS + "+/"),
    ("mixed64", "^[A-Za-z0-9+/_-]+=*$", LOWER.upper() + LOWER + DIGITS + "+/-_"),
]
#: Steps of the p-value grid: p is rounded up to exp(-step / GRID).
GRID = 20


def found(text: Column, pattern: str, group: int) -> Column:
    """Array of (start, end, value) of all matches, from left to right, in characters; ``value`` is a group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    # what stands between matches gives their places
    parts = F.zip_with(F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), whole, lambda g, m: F.struct(F.char_length(g).alias("gap"), F.char_length(m).alias("long"))), value, lambda p, v: F.struct(p["gap"].alias("gap"), p["long"].alias("long"), v.alias("value")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("spans"))

    def add(acc, p):
        start = acc["at"] + p["gap"]
        return F.struct((start + p["long"]).alias("at"), F.array_append(acc["spans"], F.struct(start.alias("start"), (start + p["long"]).alias("end"), p["value"].alias("value"))).alias("spans"))

    return F.when(F.size(whole) > 0, F.aggregate(parts, empty, add, lambda acc: acc["spans"])).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def long_enough(least: int):
    return lambda s: F.char_length(s["value"]) >= least


def named(no: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind"))


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def base_spans(text: Column) -> Column:
    """Array of (start, kind_no, end, kind) of the named patterns, in order."""
    arrays = []
    for no, (kind, pattern, group, least) in enumerate(KINDS):
        good = F.filter(found(text, pattern, group), long_enough(least))
        arrays.append(F.transform(good, named(no, kind)))
    return F.array_sort(F.concat(*arrays))


def tail(z: Column) -> Column:
    """Two-sided p-value of a standard normal, by the logistic approximation of its distribution."""
    z = F.least(F.abs(z), F.lit(20.0))
    return F.least(F.lit(1.0), 2 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z)))


def tested(tokens: DataFrame) -> DataFrame:
    """Adds encoding and p (see the module) to rows with a column ``token``; p is null without encoding."""
    name = F.coalesce(*[F.when(F.col("token").rlike(pattern), F.lit(name)) for name, pattern, _ in ENCODINGS])
    letters = F.coalesce(*[F.when(F.col("encoding") == name, F.lit(alphabet)) for name, _, alphabet in ENCODINGS if alphabet])
    body = F.split(F.regexp_replace("token", "=+$", ""), "")
    rows = tokens.withColumn("encoding", name).withColumn("letters", letters)
    rows = rows.withColumn("x", F.when(F.col("letters").isNotNull(), F.transform(body, lambda c: F.instr(F.col("letters"), c) - 1)))
    rows = rows.withColumn("x", F.filter("x", lambda v: v >= 0)).withColumn("k", F.length("letters").cast("double")).withColumn("n", F.size("x").cast("double"))
    squares = F.aggregate(F.transform(F.array_distinct("x"), lambda d: F.size(F.filter("x", lambda v: v == d))), F.lit(0.0), lambda a, c: a + c * c)
    k, n = F.col("k"), F.col("n")
    chi, df = squares * k / n - n, k - 1
    by_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    pairs = F.zip_with(F.slice("x", F.lit(1), F.greatest(F.size("x") - 1, F.lit(0))), F.slice("x", F.lit(2), F.greatest(F.size("x") - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    high = F.size(F.filter("x", lambda v: v >= k / 2)).cast("double")
    low = n - high
    runs = 1 + F.size(F.filter(pairs, lambda p: (p["a"] >= k / 2) != (p["b"] >= k / 2)))
    expected = 2 * high * low / n + 1
    spread = (expected - 1) * (expected - 2) / (n - 1)
    by_runs = F.when(spread > 0, (runs - expected) / F.sqrt(spread)).otherwise(F.lit(20.0))
    mean = F.aggregate("x", F.lit(0.0), lambda a, v: a + v) / n
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
    product = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean))
    by_serial = F.when(square > 0, (product / square + 1 / n) * F.sqrt(n)).otherwise(F.lit(20.0))
    p = F.least(F.lit(1.0), 3 * F.least(tail(by_chi), tail(by_runs), tail(by_serial)))
    return rows.withColumn("p", F.when(F.col("letters").isNotNull(), p)).drop("x", "k", "n", "letters")


def kept_as_random(tokens: DataFrame, fdr: float) -> DataFrame:
    """The rows whose randomness isn't rejected in their class of length (powers of two)."""
    rows = tested(tokens).where("p is not null").withColumn("length_class", F.floor(F.log2(F.length("token"))).cast("int"))
    rows = rows.withColumn("step", F.floor(-F.log(F.greatest("p", F.lit(1e-18))) * GRID).cast("int"))
    bins = rows.groupBy("length_class", "step").agg(F.count("*").alias("tokens"))
    # a class has 18 x 2.3 x GRID bins at most
    smaller = Window.partitionBy("length_class").orderBy(F.desc("step"))
    all_bins = Window.partitionBy("length_class")
    bins = bins.withColumn("rank", F.sum("tokens").over(smaller)).withColumn("all", F.sum("tokens").over(all_bins))
    cut = bins.groupBy("length_class").agg(F.min(F.when(F.exp(-F.col("step") / GRID) <= fdr * F.col("rank") / F.col("all"), F.col("step"))).alias("cut"))
    return rows.join(F.broadcast(cut), "length_class").where("cut is null or step < cut")


def text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, fdr: float = 0.05) -> DataFrame:
    """doc_id, base (spans of the named patterns), spans (those and the random tokens) of every row of ``docs``.

    A span is (start, kind_no, end, kind): characters, end exclusive, ordered by start, then kind. Base spans always stay;
    a random token is added where it meets no base span. Null text is empty, and texts without matches
    have empty arrays. Rows that share a doc_id are scanned each by itself. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spans = rows.select("doc_id", base_spans(F.col("text")).alias("base"), found(F.col("text"), TOKEN, 0).alias("tokens"))
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    # the number of a row of the written table holds its spans together
    scanned = stage(spans.select("doc_id", "base", free.alias("tokens"))).withColumn("row", F.monotonically_increasing_id())
    scanned = stage(scanned)
    tokens = scanned.select("row", F.explode("tokens").alias("t")).select("row", "t.start", "t.end", F.col("t.value").alias("token"))
    random = kept_as_random(tokens, fdr).groupBy("row").agg(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("kind_no"), "end", F.lit("random").alias("kind"))).alias("random"))
    out = scanned.join(random, "row", "left")
    added = F.coalesce("random", F.slice("base", 1, 0))
    return out.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    spans = scan(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", of_kind(kind))).cast("long").alias(f"n_{kind}") for kind, *_ in KINDS]
    return spans.select("doc_id", *counts, F.sha2(text_of(F.col("base")).cast("binary"), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))
