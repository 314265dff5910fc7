import hashlib
import re

import numpy as np
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from setforge.llm.fim import Units, restored, transformed

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_way(doc_id, text):
    """n, form, prefix_chars, middle_chars, output by the definition."""
    text = text or ""
    units = UNIT.findall(text)
    h = [int(hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("seed", range(6))
def test_unit_ends(seed):
    rng = np.random.default_rng(seed)
    letters = list("abzAZ@[`{ \n09<>\x00\x7fé߀߿日￿😀")
    for size in [*range(0, 40), 500, 3000]:
        text = "".join(rng.choice(letters, size, p=np.array([3, 3, 3, 3, 3] + [1] * (len(letters) - 5)) / (len(letters) + 10)))
        ends = np.cumsum([0] + [len(u.encode()) for u in UNIT.findall(text)]).tolist()
        units = Units(text.encode())
        assert units.count == len(ends) - 1
        assert [units.end(k) for k in range(len(ends))] == ends


def test_blocks_of_long_texts(monkeypatch):
    from setforge.llm import fim

    text = ("ab é1" * 999 + "x" * 77 + "日" * 50).encode()
    whole = Units(text)
    monkeypatch.setattr(fim, "BLOCK", 3)
    parts = Units(text)
    assert (whole.marks == parts.marks).all() and whole.count == parts.count


TEXTS = ["", "a", "<", "<P", "x <P> y", "no<S>", "<M>", "<<<", "S>M>", "P><S", "ab cd\nef", "é" * 30, "日本 go", "a" * 1000, "1 2 3", "<P<S<M"]


def test_against_definition(spark):
    rows = [(i, TEXTS[i % len(TEXTS)] if i % 3 else TEXTS[i % len(TEXTS)] * (i % 7)) for i in range(600)]
    out = transformed(spark.createDataFrame(rows, "doc_id long, text string"))
    out = out.withColumn("again", restored("output", "form"))
    forms = set()
    for r in out.collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_way(r.doc_id, r.text)
        assert r.again == r.text
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


def test_odd_rows(spark, odd, nothing):
    clash = odd.withColumn("n", F.lit("mine")).withColumn("output", F.lit(1))
    out = transformed(clash)
    assert out.columns == [c for c in odd.columns] + ["n", "form", "prefix_chars", "middle_chars", "output"]
    rows = out.withColumn("rebuilt", restored("output", "form")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_way("null" if r.doc_id is None else r.doc_id, r.text)
        assert r.rebuilt == (r.text or "")
    assert transformed(nothing).count() == 0


def test_shares(spark):
    out = transformed(spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text")))
    counts = {r["form"]: r["count"] for r in out.groupBy("form").count().collect()}
    assert abs(counts["plain"] / 4000 - 0.1) < 0.02 and abs(counts["spm"] / 4000 - 0.18) < 0.02
    assert transformed(spark.range(50).selectExpr("id AS doc_id", "'a b' AS text"), percent=0).where("form <> 'plain'").count() == 0
