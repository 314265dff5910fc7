"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Two lines are near when few edits make them equal: none below 10 characters, one below 20, else two, by the
shorter line. A line within e edits of another keeps at least one of e + 1 segments of it whole, at a place
that the lengths and the segment's number confine (multi-match-aware windows). So

1. every line gets the hashes of its own segments and of the substrings it has to probe for lines up to two characters
   shorter; its own segments are among them;
2. keys that only one line has are dropped by a pre-aggregated minimum and maximum, so that no hot key meets in one task;
3. lines that share a key meet if their letter counts allow it, and are verified by a banded
   bit-parallel edit distance on what remains between their common ends;
4. near lines are joined to components; every class keeps its first line.

Equal lines are one line from step 2 on, by a 128-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, small, stage, table

#: Lines of fewer characters than the number allow one edit less.
EDITS = [(10, 0), (20, 1)]
MOST = 2


def edits(length: Column) -> Column:
    """Edits that a pair allows whose shorter line has this length."""
    return F.when(length < EDITS[0][0], EDITS[0][1]).when(length < EDITS[1][0], EDITS[1][1]).otherwise(MOST)


def segment(length: Column, e: int, i: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment i (from 0) of e + 1; the last ones are longer."""
    base, extra = F.floor(length / (e + 1)).cast("int"), F.pmod(length, F.lit(e + 1))
    longer = F.greatest(F.lit(0), F.lit(i) - (e + 1 - extra))
    return base * i + longer + 1, base + F.when(F.lit(i) >= e + 1 - extra, 1).otherwise(0)


def keys(line: str, length: str) -> Column:
    """Hashes of a line's own segments, then of the other substrings it probes; nulls where there is none."""
    own, more = [], []
    n = F.col(length)
    for less in range(MOST + 1):
        short = n - less  # the other line's length
        for e in range(1, MOST + 1):
            if less > e:
                continue
            here = edits(short) == e
            for i in range(e + 1):
                start, size = segment(short, e, i)
                low, high = max(-i, less - (e - i)), min(i, less + (e - i))
                for shift in range(low, high + 1):
                    at = start + shift
                    fits = here & (at >= 1) & (at + size - 1 <= n)
                    key = F.when(fits, F.xxhash64(F.lit(i), F.lit(e), short, F.substring(F.col(line), at, size)))
                    (own if less == 0 and shift == 0 else more).append(key)
    return F.array(*own, *more)


#: Places of a line's own segments in ``keys``.
OWN = sum(e + 1 for e in range(1, MOST + 1))


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def banded_distance(a: Column, b: Column, k: int) -> Column:
    """Edit distance of two arrays of characters whose sizes differ by k at most; right where it is k or less,
    else larger than k.

    Column j of the matrix is a band of rows j - k to j + k, one bit a row: ``vp`` and ``vn`` hold where the
    distance rises or falls by one downwards, already moved down a row for the next column. The distance at
    the band's lower end is followed, and the end's column is climbed to the last row of ``a``.
    """
    width = 2 * k + 1
    mask = (1 << width) - 1
    inside = lambda x: x.bitwiseAND(F.lit(mask))

    def step(acc: Column, j: Column) -> Column:
        c = F.get(b, j - 1)
        equal = F.lit(0)
        for t in range(width):
            equal = equal + F.when(F.get(a, j - k + t - 1) == c, 1 << t).otherwise(0)

        def with_equal(pm: Column) -> Column:
            vp, vn = acc["vp"], acc["vn"]
            diagonal = inside(((pm.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(pm).bitwiseOR(vn))

            def with_diagonal(d: Column) -> Column:
                hp = inside(vn.bitwiseOR(F.bitwise_not(d.bitwiseOR(vp))))
                hn = vp.bitwiseAND(d)
                below = F.shiftright(d, 1)
                return let(
                    F.struct(hp.alias("hp"), hn.alias("hn")),
                    lambda h: F.struct(
                        inside(h["hn"].bitwiseOR(F.bitwise_not(below.bitwiseOR(h["hp"])))).alias("vp"),
                        below.bitwiseAND(h["hp"]).alias("vn"),
                        (acc["score"] + 1 - F.shiftright(d, 2 * k)).alias("score"),
                    ),
                )

            return let(diagonal, with_diagonal)

        return let(equal, with_equal)

    first = F.struct(F.lit(mask & ~((1 << k) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(k).alias("score"))
    m, n = F.size(a), F.size(b)

    def climbed(acc: Column) -> Column:
        # rows m + 1 to n + k of the last column are the bits m - n + k to 2k - 1
        above = F.lit((1 << 2 * k) - 1).bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1), m - n + k) - 1))
        return acc["score"] - F.bit_count(acc["vp"].bitwiseAND(above)) + F.bit_count(acc["vn"].bitwiseAND(above))

    return F.when(n == 0, m).otherwise(F.aggregate(F.sequence(F.lit(1), n), first, step, climbed))


def within(a: str, b: str, most: Column) -> Column:
    """Whether two lines are ``most`` (at most MOST) edits apart: common ends go first, the rest is measured."""

    def differ(x: Column, y: Column) -> Column:
        size = F.least(F.size(x), F.size(y))
        same = F.zip_with(F.slice(x, F.lit(1), size), F.slice(y, F.lit(1), size), lambda p, q: p == q)
        at = F.array_position(same, False)
        return F.when(at > 0, at - 1).otherwise(size).cast("int")

    def rest(x: Column, drop: Column, end: Column) -> Column:
        return F.slice(x, drop + 1, F.greatest(F.lit(0), F.size(x) - drop - end))

    def ends(p: Column) -> Column:
        head = differ(p["x"], p["y"])
        return let(F.struct(p["x"].alias("x"), p["y"].alias("y"), head.alias("head")), tails)

    def tails(p: Column) -> Column:
        room = F.least(F.size(p["x"]), F.size(p["y"])) - p["head"]
        tail = F.least(room, differ(F.reverse(p["x"]), F.reverse(p["y"])))
        return let(tail, lambda t: let(F.struct(rest(p["x"], p["head"], t).alias("x"), rest(p["y"], p["head"], t).alias("y")), measured))

    def measured(p: Column) -> Column:
        return F.when(F.abs(F.size(p["x"]) - F.size(p["y"])) > MOST, False).otherwise(banded_distance(p["x"], p["y"], MOST) <= most)

    return let(F.struct(F.split(F.col(a), "").alias("x"), F.split(F.col(b), "").alias("y")), ends)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, line_no, line): lines with a word, from whole texts; ``copy`` names the text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("copy"), "text")
    lines = rows.select("doc_id", "copy", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def hashed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64("line", F.lit(1)))


def letters(line: str) -> Column:
    """Counts of the letters a to z; an edit changes two of them by one at most."""
    return F.array(*[F.char_length(line) - F.char_length(F.replace(F.col(line), F.lit(c))) for c in map(chr, range(97, 123))])


def near_lines(docs: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Written pairs (a, b) of h1 of different lines that are near."""
    listed = occurrences.select("h1", F.explode("keys").alias("key")).where("key is not null")
    shared = listed.groupBy("key").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x <> y").select("key")
    shared = small(stage(shared))
    met = occurrences.select("h1", "h2", F.posexplode("keys").alias("place", "key")).where("key is not null").join(shared, "key")
    met = stage(met.select("key", "h1", (F.col("place") < OWN).alias("own")).distinct())
    wanted = small(stage(met.select("h1").distinct()))
    texts = hashed(lines_of(docs)).join(wanted, "h1", "left_semi").groupBy("h1").agg(F.min("line").alias("line"))
    texts = stage(texts.withColumn("n", F.char_length("line")).withColumn("letters", letters("line")))
    sides = met.join(texts.select("h1", "n", "letters"), "h1")
    short = sides.where("own").select("key", F.col("h1").alias("a"), F.col("n").alias("a_n"), F.col("letters").alias("a_letters"))
    long = sides.select("key", F.col("h1").alias("b"), F.col("n").alias("b_n"), F.col("letters").alias("b_letters"))
    apart = F.aggregate(F.zip_with("a_letters", "b_letters", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    fit = (F.col("b_n") - F.col("a_n") <= edits(F.col("a_n"))) & ((F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b"))))
    pairs = short.join(long, (short["key"] == long["key"]) & fit & (apart <= 2 * edits(F.col("a_n")))).select("a", "b", "a_n").distinct()
    of = lambda k: texts.select(F.col("h1").alias(k), F.col("line").alias(f"{k}_line"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return stage(both.where(within("a_line", "b_line", edits(F.col("a_n")))).select("a", "b"))


def classed(docs: DataFrame) -> DataFrame:
    """One row per line with a word: doc_id, copy, line_no, class_id, n_links, kept.

    ``class_id`` names the line's class, ``n_links`` counts other different lines that are near it, ``kept`` is true for the
    class's first line (the smallest doc_id, nulls last, then text hash, then line number). Null and word-free
    texts have no line. Rows that repeat doc_id and text are one document: their lines are kept or cut alike.
    Whole lines are compared, of any length. Other columns are ignored.
    """
    lines = hashed(lines_of(docs)).withColumn("n", F.char_length("line"))
    occurrences = stage(lines.select("doc_id", "copy", "line_no", "h1", "h2", keys("line", "n").alias("keys")))
    pairs = near_lines(docs, occurrences)
    labels = components(pairs)
    degree = pairs.select(F.col("a").alias("h1")).union(pairs.select(F.col("b").alias("h1"))).groupBy("h1").agg(F.count("*").alias("n_links"))
    labels = stage(labels.withColumnRenamed("node", "h1").join(degree, "h1", "left"))
    rows = occurrences.select("doc_id", "copy", "line_no", "h1", "h2").join(small(labels), "h1", "left")
    rows = stage(rows.withColumn("c1", F.coalesce("component", "h1")).withColumn("c2", F.when(F.col("component").isNull(), F.col("h2")).otherwise(0)).drop("h1", "h2", "component"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("copy"), F.col("line_no"))
    firsts = rows.groupBy("c1", "c2").agg(F.min(place).alias("first"))
    out = rows.join(firsts, ["c1", "c2"])
    return out.select("doc_id", "copy", "line_no", F.xxhash64("c1", "c2").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), (place == F.col("first")).alias("kept"))


def deduped(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines, all columns kept.

    Lines without a word stay. A document all of whose lines with a word go is dropped; one that had none
    (null, empty, blank) stays as it is.
    """
    rows = stage(classed(docs))
    cut = rows.where("not kept").groupBy("doc_id", "copy").agg(F.collect_set("line_no").alias("__cut"))
    left = rows.groupBy("doc_id", "copy").agg(F.max("kept").alias("__any_left"))
    cut = cut.join(left.withColumnRenamed("doc_id", "d").withColumnRenamed("copy", "c"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c"))).select(F.col("d").alias("__cut_id"), F.col("c").alias("__cut_copy"), "__cut", "__any_left")
    same = F.col("__cut_id").eqNullSafe(docs["doc_id"].cast("long")) & (F.col("__cut_copy") == F.xxhash64(docs["text"]))
    joined = docs.join(cut, same, "left").where("__any_left is null or __any_left")
    text = F.array_join(F.filter(F.split(docs["text"], "\n"), lambda line, i: ~F.array_contains("__cut", i)), "\n")
    return joined.select(*[F.when(F.col("__cut").isNull(), docs["text"]).otherwise(text).alias("text") if c == "text" else docs[c] for c in docs.columns])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all documents."""
    return classed(table(spark, sf_dir, "documents")).drop("copy")
