import random

from pyspark.sql import functions as F

from setforge.operators.ordered import RANGE, Order, as_order, count_cuts, prefix_sum, rank_global, with_range, with_row_id


def test_count_cuts(spark):
    cuts = [2, 5, 5 + 2**53, 2**60]
    values = [0, 2, 3, 5, 6, 4 + 2**53, 5 + 2**53, 6 + 2**53, 2**61]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    rows = df.select("v", count_cuts(F.col("v"), cuts, False), count_cuts(F.col("v"), cuts, True)).collect()
    for v, below, upto in rows:
        assert below == sum(c < v for c in cuts)
        assert upto == sum(c <= v for c in cuts)


def test_prefix_sums_with_null_key_and_null_value(spark):
    df = spark.createDataFrame([(None, 5), (1, None), (2, 3), (3, 4)], "k int, q int")
    got = {r.k: r.t for r in prefix_sum(df, "q", "k", out="t", ranges=3).collect()}
    assert got == {None: 5, 1: 5, 2: 8, 3: 12}
    got = {r.k: r.t for r in prefix_sum(df, "q", "k", inclusive=False, out="t", ranges=3).collect()}
    assert got == {None: 0, 1: 5, 2: 5, 3: 8}


def test_rank_with_hot_leading_value(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 1, 1, 1, 2, 7]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, id int").repartition(4)
    for down in (False, True):
        got = {r.id: r.row_id for r in rank_global(df, [Order("k", down), Order("id", down)], ranges=8).collect()}
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=down)
        assert got == {i: n for n, (_, i) in enumerate(order, 1)}


def test_hot_values_are_cut_by_later_columns(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit("x").alias("l"), "id")
    sizes = [r["count"] for r in with_range(df, as_order(["k", "l", "id"]), 8).groupBy(RANGE).count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 250


def test_input_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).repartition(3).mapInArrow(count, "id long")
    assert prefix_sum(df, "id", "id", out="t", ranges=5).agg(F.max("t")).first()[0] == 499500
    assert seen.value == 1000


def test_text_keys_and_plans(spark):
    rows = [(f"k{i:03d}"[::-1], i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, q int")
    got = {r.k: r.t for r in prefix_sum(df, "q", "k", out="t", ranges=4).collect()}
    total, want = 0, {}
    for k, q in sorted(rows):
        total += q
        want[k] = total
    assert got == want
    for result in (prefix_sum(df, "q", "k", ranges=4), rank_global(df, "k", ranges=4)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_row_ids_are_dense(spark):
    df = spark.createDataFrame([(x,) for x in (9, 4, 7)], "x int")
    assert {r.x: r.row_id for r in with_row_id(df, "x").collect()} == {4: 1, 7: 2, 9: 3}
