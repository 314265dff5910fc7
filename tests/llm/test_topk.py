import numpy as np

from setforge.llm.topk import best_of, product, top_k

TYPE = "vec_id long, embedding array<float>, label string"


def brute(rows, k, queries):
    good = [(i, [float(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for qi, q in {i: v for i, v in sorted(good, reverse=True) if i in queries}.items():
        scored = sorted((-int(sum(int(a) * int(b) for a, b in zip(q, v))), i) for i, v in good if i != qi)[:k]
        out |= {(qi, r, i, -s) for r, (s, i) in enumerate(scored, 1)}
    return out


def test_random_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 5) / 8]) for i in rng.permutation(300)]  # many ties
    rows += [(1000, None), (1020, [float("nan")] * 5), (1040, [float("inf")] * 5), (1060, [None] * 5), (None, [1.0] * 5), (1080, [0.5, 0.25]), (1100, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], TYPE)
    want = brute(rows, 7, {i for i, _ in rows if i is not None and i % 20 == 0})
    for block, shard in ((1024, 16384), (4, 9)):
        got = {tuple(r) for r in top_k(df.where("vec_id % 20 = 0"), df, 7, block, shard).select("query_id", "rank", "vec_id", "score").collect()}
        assert got == want


def test_no_rows_and_fewer_than_k(spark):
    none = spark.createDataFrame([], TYPE)
    one = spark.createDataFrame([(0, [1.0], "x"), (1, [2.0], "x")], TYPE)
    assert top_k(none, one).count() == 0
    assert top_k(one, none).count() == 0
    assert [tuple(r) for r in top_k(one.where("vec_id = 0"), one).collect()] == [(0, 1, 1, 64 * 128)]


def test_repeated_candidates_all_count(spark):
    rows = spark.createDataFrame([(0, [1.0], "x")] + [(5, [1.0], "x")] * 4, TYPE)
    got = top_k(rows.where("vec_id = 0"), rows, 3, shard=2).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got)] == [(1, 5), (2, 5), (3, 5)]


def test_products_beyond_floats():
    q = np.array([[2.0**40, 1.0]])
    assert product(q, np.array([[2.0**20, 1.0]]))[0, 0] == 2**60 + 1
    assert product(np.array([[2.0**60]]), np.array([[2.0**60]]))[0, 0] == 2**63 - 1
    assert best_of(np.array([1, 3, 3, 2, 3]), 2).tolist() == [1, 2]
