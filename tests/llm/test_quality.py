import re
from collections import Counter

import numpy as np
from conftest import SF

from setforge.llm.quality import FEATURES, STATS, Forest, calibrated, good_documents, judged, op3_quality_rules, repeated_words, sampled, statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, dup = [x for x in (text or "").split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or "") if words else 0, dup, len(covered)]


def test_base_columns_of_all_documents(spark, documents):
    got = {r.doc_id: r for r in op3_quality_rules(spark, SF).collect()}
    for doc_id, text in documents:
        row, want = got[doc_id], base(text)
        assert [row[s] for s in STATS] == want
        assert row.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (row.base_failed and row.kept)


def test_repeats_of_small_alphabets():
    rng = np.random.default_rng(0)
    for n in (0, 7, 8, 9, 40, 200):
        x = rng.integers(0, 2, n)
        text = " ".join("ab"[i] for i in x)
        assert repeated_words(x.astype(np.int64)) == base(text)[4]
    assert statistics("a#b\na#b\n \n")[:5] == base("a#b\na#b\n \n")


def test_forest_finds_what_no_good_row_looks_like():
    rng = np.random.default_rng(0)
    good = np.column_stack([rng.normal(5, 0.3, 800), np.zeros(800)])
    bad = np.column_stack([rng.normal(5, 0.3, 50), rng.uniform(0.2, 0.5, 50)])
    x = np.concatenate([good, bad])
    label = np.arange(850) < 800
    forest = Forest(good, (x.min(0), x.max(0)), 50, 512, 0)
    score = forest.score(x)
    limit = calibrated(score, label, 0.001)
    assert (score[~label] > limit).mean() > 0.95 and (score[label] > limit).mean() <= 0.002
    assert calibrated(score, np.ones(850, bool), 0.001) == np.inf


def test_counted_scores_give_the_threshold_of_their_rows():
    rng = np.random.default_rng(1)
    for _ in range(50):
        score, good = np.round(rng.uniform(0, 1, 400), 2), rng.uniform(size=400) < 0.8
        pairs = Counter(zip(score.tolist(), good.tolist(), strict=True))
        value, label = (np.array(c) for c in zip(*pairs, strict=True))
        assert calibrated(value, label, 0.05, np.array(list(pairs.values()))) == calibrated(score, good, 0.05)
        kept = np.sort(score[good])[: int(np.ceil(good.sum() * 0.95))]
        above = score[~good & (score > kept[-1])]
        assert calibrated(score, good, 0.05) == ((kept[-1] + above.min()) / 2 if len(above) else np.inf)


def test_paths_are_those_of_splits_followed_by_hand():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    forest = Forest(x, (x.min(0), x.max(0)), 5, 64, 0)
    for row, score in zip(x[:40], forest.score(x[:40]), strict=True):
        total = 0.0
        for feature, value, left, right, path in forest.trees:
            k = 0
            while feature[k] >= 0:
                k = left[k] if row[feature[k]] < value[k] else right[k]
            total += path[k]
        m = 64
        assert abs(score - 2 ** (-total / 5 / (2 * (np.log(m - 1) + 0.5772156649015329) - 2 * (m - 1) / m))) < 1e-12
    # grown to the end, every leaf of one row lies as deep as the rows' splits say
    assert all(path[k] >= 0 for _, _, _, _, path in forest.trees for k in range(len(path)))


def test_sample_is_that_of_the_smallest_hashes(spark):
    rows = spark.range(60_000).selectExpr("id AS doc_id", *[f"double(id % 7) AS {f}" for f in FEATURES], "int(id % 2) AS quality").repartition(6)
    want = [r.doc_id for r in rows.selectExpr("doc_id", "xxhash64(doc_id, 0) AS h").orderBy("h").limit(5000).collect()]
    assert [r.doc_id for r in sampled(rows, 5000, 0).collect()] == want
    assert "xxhash64" in str(sampled(rows, 5000, 0)._jdf.queryExecution().optimizedPlan().toString()).split("Sort")[-1]


def test_held_out_labels(spark):
    """A forest fitted on other rows keeps good documents and finds most bad ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = judged(docs, labels.where("doc_id % 3 <> 0")).join(labels.where("doc_id % 3 = 0"), "doc_id").where("not base_failed").collect()
    kept = lambda q: np.mean([r.kept for r in rows if r.quality == q])
    assert kept(1) > 0.97 and kept(0) < 0.35


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (1, None), (9, 0), (None, 1)], "doc_id long, quality int")
    rows = judged(odd, labels).collect()
    assert len(rows) == odd.count()
    assert {r.kept for r in rows if r.doc_id == 1} == {True}
    assert all(r.base_failed for r in rows if r.doc_id in (2, 3, 4, 5))
    kept = good_documents(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert judged(nothing, labels).count() == 0
    assert judged(odd, labels.limit(0)).where("kept = base_failed").count() == 0
