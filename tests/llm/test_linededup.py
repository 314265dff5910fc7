import random

from pyspark.sql import functions as F

from setforge.llm.linededup import classed, deduped, within


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        kind, at = rng.random(), rng.randrange(len(out) + 1)
        if kind < 0.34:
            out.insert(at, rng.choice(letters))
        elif out and kind < 0.67:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


def allowed(n):
    return 0 if n < 10 else 1 if n < 20 else 2


def test_verification_against_the_full_matrix(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice("abcü") for _ in range(rng.randint(0, 40)))
        pairs.append((a, changed(rng, a, rng.randint(0, 4), "abx")))
    for r in spark.createDataFrame(pairs, "a string, b string").withColumn("near", within("a", "b", F.lit(2))).collect():
        assert r.near == (distance(r.a, r.b) <= 2), (r.a, r.b)


def test_join_against_all_pairs(spark):
    rng = random.Random(2)
    lines = []
    for _ in range(40):
        text = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 60)))
        lines += [changed(rng, text, rng.randint(0, 3), "yz") for _ in range(5)]
    docs = [(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(40)]
    got = {(r.doc_id, r.line_no): r for r in classed(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    places = [(i, k, line) for i, text in docs for k, line in enumerate(text.split("\n")) if line.strip()]
    distinct = sorted({line for *_, line in places})
    up, degree = {x: x for x in distinct}, dict.fromkeys(distinct, 0)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= allowed(min(len(a), len(b))):
                degree[a] += 1
                degree[b] += 1
                up[top(a)] = top(b)
    first = {}
    for i, k, line in places:
        first.setdefault(top(line), (i, k))
    assert len(got) == len(places)
    for i, k, line in places:
        assert got[i, k].n_links == degree[line] and got[i, k].kept == (first[top(line)] == (i, k))
    classes = {}
    for i, k, line in places:
        assert classes.setdefault(top(line), got[i, k].class_id) == got[i, k].class_id
    assert len(set(classes.values())) == len(classes)


def test_texts_after_dedup(spark, odd, nothing):
    rows = [
        (1, "A line that stays as it is\n\nsecond line of the text", "k"),
        (2, "a new one here\nA line that stays as it was\nsecond line of the text", "k"),
        (3, "second line of the text", "k"),
        (4, None, "k"),
        (5, "", "k"),
        (6, " \n ", "k"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cut string")
    got = {r.doc_id: (r.text, r.cut) for r in deduped(docs).collect()}
    assert got == {1: (rows[0][1], "k"), 2: ("a new one here", "k"), 4: (None, "k"), 5: ("", "k"), 6: (" \n ", "k")}
    out = deduped(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert deduped(nothing).count() == 0 and classed(nothing).count() == 0
