from collections import defaultdict

from conftest import SF
from pyspark.sql import functions as F

from setforge.llm.mixing import mixed, op9_mixing, with_copies


def targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what a capped source cannot take is shared again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: left * weight[s] / max(1, sum(weight[x] for x in free)) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in names}
        capped |= over


def test_targets_and_taken_words(spark):
    rows, k = [], 0
    for source, n in (("b", 900), ("a", 40), (None, 60), ("ä", 5), ("c", 300), ("Z", 3)):
        for i in range(n):
            rows.append((k, source, (i * 37) % 50 + 1))
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, source string, words long")
    got = with_copies(df, F.col("words")).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, s, w in rows:
        sizes[s] += w
    want = targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        taken[r.source] += r.size * r.copies
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * want[r.source]
        assert 0 <= r.copies <= 3
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 50 + 1e-6
    again = with_copies(df.repartition(7, "words"), F.col("words"))
    assert sorted((r.doc_id, r.copies) for r in again.collect()) == sorted((r.doc_id, r.copies) for r in got)


def test_query_totals(spark):
    rows = op9_mixing(spark, SF).collect()
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").collect()}
    by_source = defaultdict(set)
    for r, source in ((r, sources[r.doc_id]) for r in rows):
        by_source[source].add((r.source_size, r.target))
    assert all(len(v) == 1 for v in by_source.values())
    sizes, goals = zip(*(next(iter(v)) for v in by_source.values()), strict=True)
    assert abs(sum(goals) - sum(sizes)) < 1e-6 * sum(sizes) and sum(sizes) == sum(r.size for r in rows)
    assert all(r.taken <= 3 * r.size for r in rows)


def test_odd_rows(spark, odd, nothing):
    rows = mixed(odd)
    assert rows.columns == odd.columns
    copies = with_copies(odd, F.lit(2)).collect()
    assert rows.count() > 0 and len(copies) == odd.count()
    assert with_copies(nothing, F.lit(1)).count() == 0 and mixed(nothing).count() == 0
    zero = with_copies(odd, F.lit(0)).collect()
    assert {r.copies for r in zero} == {0} and {r.target for r in zero} == {0.0}


def test_documents_move_once(spark):
    rows = [(i % 700, ("a", "b", None)[i % 3], "w " * (1 + i % 9)) for i in range(1400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = mixed(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # rows are numbered where they were written
    # the copies of a source depend on places in its order alone
    sizes = with_copies(docs, F.expr("size(split(trim(text), ' '))")).collect()
    by = {s: sum(r.copies for r in sizes if r.source == s) for s in ("a", "b", None)}
    for s in by:
        n = sum(r.source == s for r in sizes)
        rate = next(r.target / r.source_size for r in sizes if r.source == s)
        assert abs(by[s] - n * rate) <= 1
