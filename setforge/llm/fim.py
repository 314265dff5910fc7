"""Fill-in-the-middle: texts cut into prefix, middle and suffix at token ends, found eight bytes at a time.

A unit is a run of ASCII letters or any other single code point. A text is seen as 64-bit words; arithmetic on
a whole word marks, in the top bit of every byte, the bytes that end a unit. Counting the marks of each word and
adding them up tells the word that holds the k-th unit's end, and a multiplication finds the byte inside it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import table

#: One byte's value in each of the eight bytes of a word.
ONES = 0x0101010101010101
TOP = np.uint64(0x80 * ONES)
LOW = np.uint64(0x7F * ONES)
CASE = np.uint64(0x20 * ONES)
TO_A = np.uint64((0x80 - ord("a")) * ONES)
PAST_Z = np.uint64((0x80 - ord("z") - 1) * ONES)
#: Words that are marked at once, so that what lies between stays small for long texts too.
BLOCK = 1 << 16
ALL = (1 << 64) - 1

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _marks(words: np.ndarray) -> np.ndarray:
    """Top bits of the bytes that end a unit, for all words but the last, which only tells what follows."""
    continues = words & ~(words << np.uint64(1)) & TOP
    folded = (words | CASE) & LOW
    letter = (folded + TO_A) & ~(folded + PAST_Z) & ~words & TOP

    def following(bits: np.ndarray) -> np.ndarray:
        return (bits[:-1] >> np.uint64(8)) | (bits[1:] << np.uint64(56))

    return TOP & ~following(continues) & ~(letter[:-1] & following(letter))


class Units:
    """Places of the unit ends of one text in UTF-8."""

    def __init__(self, text: bytes):
        size = len(text)
        full = size // 8 + 1
        words = np.zeros(full + 1, "<u8")
        words.view(np.uint8)[:size] = np.frombuffer(text, np.uint8)
        self.marks = np.empty(full, np.uint64)
        for at in range(0, full, BLOCK):
            self.marks[at : at + BLOCK] = _marks(words[at : at + BLOCK + 1])
        self.marks[-1] &= np.uint64((1 << 8 * (size % 8)) - 1)  # no unit ends past the text
        self.ends = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)
        self.count = int(self.ends[-1])

    def end(self, k: int) -> int:
        """Bytes of the first ``k`` units."""
        if k == 0:
            return 0
        at = int(np.searchsorted(self.ends, k))
        rank = k - (int(self.ends[at - 1]) if at else 0)
        # byte j now holds the number of marks in bytes 0 to j; those that reach the rank keep their top bit
        counts = ((int(self.marks[at]) >> 7) * ONES) & ALL
        reached = ((counts | 0x80 * ONES) - rank * ONES) & (0x80 * ONES)
        return 8 * at + 8 - reached.bit_count() + 1


CUT = StructType().add("n", "long").add("prefix_chars", "long").add("middle_chars", "long").add("output", "binary")


def _cut(text: bytes, first: int, second: int, form: str) -> dict:
    units = Units(text)
    if form == "plain":
        return {"n": units.count, "prefix_chars": None, "middle_chars": None, "output": text}
    a, b = (units.end(k) for k in sorted((first % (units.count + 1), second % (units.count + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    before, between = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    left, right = (prefix, suffix) if form == "psm" else (suffix, prefix)
    return {
        "n": units.count,
        "prefix_chars": len(prefix.decode("utf-8", "replace")),
        "middle_chars": len(middle.decode("utf-8", "replace")),
        "output": b"".join([before.encode(), left, between.encode(), right, MIDDLE.encode(), middle]),
    }


@F.arrow_udf(CUT)
def _cuts(text: pa.Array, first: pa.Array, second: pa.Array, form: pa.Array) -> pa.Array:
    kind = pa.struct([("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])
    rows = zip(*(c.to_pylist() for c in (text, first, second, form)), strict=True)
    return pa.array([_cut(*row) for row in rows], kind)


def restored(output: str, form: str) -> Column:
    """The text that was cut, from the columns of output and form. A text that holds a marker stays plain, so each marker is found once."""
    body = f"substring({output}, {len(PREFIX) + 1})"

    def between(left: str, right: str) -> str:
        return f"substring_index(substring_index({body}, '{right}', 1), '{left}', -1)"

    middle = f"substring_index({body}, '{MIDDLE}', -1)"
    psm = f"concat(substring_index({body}, '{SUFFIX}', 1), {middle}, {between(SUFFIX, MIDDLE)})"
    spm = f"concat({between(PREFIX, MIDDLE)}, {middle}, substring_index({body}, '{PREFIX}', 1))"
    return F.expr(f"CASE {form} WHEN 'plain' THEN {output} WHEN 'psm' THEN {psm} ELSE {spm} END")


def transformed(docs: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """``docs`` (doc_id, text) with n, form, prefix_chars, middle_chars and output.

    ``percent`` of the texts are rearranged, ``spm_percent`` of those with the suffix first; the rest, empty and null
    texts and texts that hold a marker are plain: their output is the text, null as empty. Draws
    depend on seed and doc_id only, so reruns agree and rows of one doc_id are cut alike; a null doc_id draws as ``null``.
    Columns of ``docs`` named like a new one are replaced. An empty table gives no rows.
    """
    new = ("n", "form", "prefix_chars", "middle_chars", "output")
    own = [c for c in docs.columns if c not in new]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    drawn = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    text = F.coalesce("text", F.lit(""))
    plain = (text == "") | (F.pmod(drawn[2], F.lit(100)) >= percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain |= F.contains(text, F.lit(marker))
    form = F.when(plain, "plain").when(F.pmod(drawn[3], F.lit(100)) < spm_percent, "spm").otherwise("psm")
    rows = docs.select(*own, _cuts(text.cast("binary"), drawn[0], drawn[1], form).alias("cut"), form.alias("form"))
    return rows.select(*own, "cut.n", "form", "cut.prefix_chars", "cut.middle_chars", F.col("cut.output").cast("string").alias("output"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, seed 1, 90 % rearranged, a fifth of them suffix first; digests of the output and of the text rebuilt from it."""
    rows = transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS d FROM documents
), k AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
    CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4
  FROM h
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM c
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
