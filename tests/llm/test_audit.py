import random
from collections import Counter
from itertools import permutations

from conftest import ODD
from pyspark.sql import functions as F

from setforge.llm.audit import audit, interactions, later_copies


def by_hand(parts, fails, marks):
    """What interactions() returns, from each id's part, its failing filters and its marks."""
    letters = sorted(fails)
    out = {}
    for part in set(parts.values()):
        ids = [i for i in parts if parts[i] == part]
        shapley, rows = Counter(), {}
        for order in permutations(letters):
            alive = set(ids)
            for step, f in enumerate(order, 1):
                failing = fails[f] & set(ids)
                removed = failing & alive
                shapley[f] += len(removed)
                others = set().union(*(fails[x] for x in letters if x != f))
                lost = tuple(len(removed & m) for m in marks)
                rows["".join(order), step] = (len(alive - failing), len(removed), len(failing - alive), len(failing - others), *lost)
                alive -= failing
        out |= {(part, *k): (*v, shapley[k[0][k[1] - 1]]) for k, v in rows.items()}
    return out


def test_against_sets(spark):
    rng = random.Random(3)
    parts = {i: rng.choice(["", "en", "de"]) for i in range(300)}
    fails = {x: {i for i in parts if rng.random() < p} for x, p in zip("KLMN", (0.5, 0.2, 0.05, 0.0), strict=True)}
    marks = [{i for i in parts if rng.random() < 0.3}, set()]
    rows = spark.createDataFrame(list(parts.items()), "row long, part string")
    ids = lambda some: spark.createDataFrame([(i,) for i in some], "row long")
    got = interactions(rows, {x: ids(f) for x, f in fails.items()}, {"good": ids(marks[0]), "bad": ids(marks[1])})
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good", "bad", "shapley"]
    rows = got.collect()
    want = by_hand(parts, fails, marks)
    assert len(rows) == len(want) == 3 * 24 * 4
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in rows} == want
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("audit_")]


def test_later_copies(spark):
    rows = [(k, k % 50 if k % 7 else None, bytes([k % 3 if k < 2000 else k % 200])) for k in range(4000)]
    got = sorted(r.row for r in later_copies(spark.createDataFrame(rows, "row long, doc_id long, digest binary")).collect())
    least = {}
    for _, i, d in rows:
        if i is not None:
            least[d] = min(i, least.get(d, i))
    assert got == [k for k, i, d in rows if i is not None and i > least[d]]


def test_rules(spark):
    words = [f"w{i}" for i in range(199)]
    texts = [
        (1, " ".join(words)),  # A: 199 words
        (2, "\t" + "\x0b".join([*words, "end"]) + "\n"),
        (3, "same other " * 99 + "w1 w2"),  # B: 4 of 200
        (4, " ".join(f"v{i % 100}" for i in range(200))),  # half are distinct
        (5, "ABC" + "x" * 97 + " " + " ".join(words)),  # 3 of more than 100
        (6, "ABCD" + "é" * 96),  # A, C
        (7, "ABC" + "é" * 97),  # A
        (8, "100 %"),  # A, D
        (9, "100 %"),  # A, D, E
        (10, None),  # A
        (11, ""),  # A, E
    ]
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (9, 1, 1), (9, 1, 1), (3, 0, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    fails = {"A": {1, 6, 7, 8, 9, 10, 11}, "B": {3}, "C": {6}, "D": {8, 9}, "E": {9, 11}}
    got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in audit(docs, labels).collect()}
    assert got == by_hand({i: "en" for i, _ in texts}, fails, [{1, 9}, {9, 3}])


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (6, None, 1)], "doc_id long, quality int, toxic int")
    clash = odd.withColumn("row", F.lit(1)).withColumn("part", F.lit("x")).withColumn("words", F.lit(0)).withColumn("A", F.lit(True))
    rows = audit(clash, labels).collect()
    parts = Counter(r[2] or "" for r in ODD)
    assert len(rows) == 600 * len(parts)
    for r in rows:
        if r.step == 5:
            assert r.kept == 0 and r.part in parts
        if r.step == 1:
            assert r.kept + r.removed == parts[r.part] and r.redundant == 0
    # null and empty text agree; the two rows of id 1 do not make each other later copies
    assert {(r.part, r.removed) for r in rows if r.filter_order[0] == "E" and r.step == 1} == {("", 1), ("en", 0), ("de", 0)}
    assert {r.good_lost for r in rows if r.part == "en" and r.filter_order[0] == "A" and r.step == 1} == {2}
    assert audit(nothing, labels).count() == 0
