import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from setforge.operators.asof import as_of_join
from setforge.operators.intervals import cover, interval_overlap
from setforge.operators.merge import KEEP, merge_snapshot, merged_rows, refused_rows
from setforge.operators.rules import apply_rules, match_rules, pick_by_priority, rule_level, wildcard_semi
from setforge.operators.temporal import active_on, latest_as_of
from setforge.session import cut_lineage
from setforge.sources.inline import values
from setforge.sources.tables import append, assert_unique, replace_partitions, require_table

D = date(2017, 6, 15)


def test_latest_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (1, 9, "d")], "k int, ts int, v string")
    assert sorted(r.v for r in latest_as_of(df, ["k"], "ts", F.lit(6)).collect()) == ["a", "b"]


def test_three_rules_for_a_missing_end(spark):
    df = spark.createDataFrame([(1, D, None), (2, D, date(2017, 6, 14)), (3, D, D)], "id int, b date, e date")
    df = df.withColumn("b", F.date_sub("b", 5))

    def ids(**kw):
        return sorted(r.id for r in active_on(df, F.lit(D), "b", "e", **kw).collect())

    assert ids() == [3]
    assert ids(grace_days=1) == [2, 3]
    assert ids(null_end="open") == [1, 3] == ids(null_end="sentinel")
    with pytest.raises(ValueError):
        ids(null_end="x")


def test_later_zero_cancels_fixed_price(spark):
    df = spark.createDataFrame([(1, 10, 5.0), (1, 11, 0.0), (2, 3, 7.0)], "k int, prio int, fix double")
    assert [tuple(r) for r in pick_by_priority(df, ["k"], "prio", F.col("fix") > 0).collect()] == [(2, 3, 7.0)]


def test_rule_levels(spark):
    df = spark.createDataFrame(
        [(1, None, None, None), (None, 1, None, None), (None, 1, 1, None), (None, None, 1, None), (None, None, None, 1), (None, 1, None, 1)],
        "ProductID int, BrandID int, CategoryID int, MGID int",
    )
    assert [r[0] for r in df.select(rule_level()).collect()] == ["product", "brand", "brand_category", "category", "group", None]


def test_exclude_rule_modes(spark):
    items = spark.createDataFrame([(1, 10, "x"), (1, 11, "y"), (1, 12, "z")], "g int, p int, brand string")
    include = spark.createDataFrame([(7, 1, None)], "o int, g int, brand string")
    exclude = spark.createDataFrame([(7, 1, "x"), (7, 1, "y")], "o int, g int, brand string")

    def found(mode, rules=exclude):
        return sorted(r.p for r in apply_rules(items, include, rules, ["g"], ["o"], "p", ["brand"], mode).collect())

    assert found("any") == [12]
    assert found("reference") == [10, 11, 12]  # no item is named by both exclude rules
    assert found("reference", exclude.filter("brand = 'x'")) == [11, 12]


def test_rules_meet_items_in_one_join(spark):
    rng = random.Random(5)
    pick = lambda n: rng.choice([None, *range(n)])
    items = [(i, rng.randrange(3), pick(3), pick(4), pick(2)) for i in range(60)]
    rules = [(r, rng.randrange(4), pick(3), pick(4), pick(2)) for r in range(40)]
    want = sorted((r[0], i[0]) for r in rules for i in items if r[1] == i[1] and all(a is None or a == b for a, b in zip(r[2:], i[2:], strict=True)))
    left = spark.createDataFrame(items, "item int, k int, a int, b int, c int")
    right = spark.createDataFrame(rules, "rule int, k int, a int, b int, c int")
    found = match_rules(left, right, ["k"], ["a", "b", "c"], ["rule"], ["item"])
    assert sorted((r.rule, r.item) for r in found.collect()) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2 and "Union" not in plan
    semi = wildcard_semi(left, right, ["k"], ["a", "b", "c"])
    assert semi.columns == left.columns and sorted({r.item for r in semi.collect()}) == sorted({i for _, i in want})
    keyless = match_rules(left, right, [], ["a", "b"], ["rule", "a"], ["item"]).select("rule", "item").collect()
    assert sorted(tuple(r) for r in keyless) == sorted((r[0], i[0]) for r in rules for i in items if all(x is None or x == y for x, y in zip(r[2:4], i[2:4], strict=True)))


def test_few_rules_move_no_rows(spark, monkeypatch):
    rng = random.Random(6)
    pick = lambda n: rng.choice([None, *range(n)])
    rows = [(i, rng.choice([None, 0, 1, 2, 3]), pick(5), pick(6)) for i in range(300)]
    wanted = [(rng.choice([None, 0, 1, 2]), rng.randrange(5), pick(6)) for _ in range(12)] + [(0, None, 2), (1, None, None), (2, None, 3)]
    left = spark.createDataFrame(rows, "item int, k int, a int, b int")
    right = spark.createDataFrame(wanted, "k int, a int, b int")
    want = sorted(i[0] for i in rows if any(r[0] is not None and r[0] == i[1] and all(x is None or x == y for x, y in zip(r[1:], i[2:], strict=True)) for r in wanted))
    for few in (200_000, 4, 1, 0):  # all masks, some, the widest, none broadcast
        monkeypatch.setattr("setforge.operators.rules.FEW_RULES", few)
        semi = wildcard_semi(left, right, ["k"], ["a", "b"])
        assert semi.columns == left.columns and sorted({r.item for r in semi.collect()}) == want
        if few == 200_000:
            plan = semi._jdf.queryExecution().optimizedPlan().toString()
            assert "Generate" not in plan and "LeftSemi" not in plan and semi.count() == len(want)
    assert wildcard_semi(left, right.where("false"), ["k"], ["a", "b"]).count() == 0


def test_merge_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, 5, 16), (2, 6, 16), (3, 7, 0), (4, None, 16)], "id int, price int, flags int")
    new = spark.createDataFrame([(1, 8, 16), (4, 9, 16), (5, 1, 16)], "id int, price int, flags int")
    ours = F.col("flags").bitwiseAND(F.lit(16)) == 16
    once = merge_snapshot(old, new, ["id"], ["price", "flags"], ours)
    # a missing old price is no difference
    assert {r.id: r.action for r in once.collect()} == {1: "UPDATE", 2: "DELETE", 3: KEEP, 4: KEEP, 5: "INSERT"}
    again = merge_snapshot(merged_rows(once), new, ["id"], ["price", "flags"], ours)
    assert {r.action for r in again.collect()} == {KEEP}


def test_merge_refuses_or_settles_repeated_keys(spark):
    old = spark.createDataFrame([(1, 5, 16), (2, 6, 16), (2, 7, 0), (3, 7, 16)], "id int, price int, flags int")
    new = spark.createDataFrame([(1, 9, 16), (1, 8, 16), (2, 6, 16), (4, 2, 0), (4, 2, 0), (5, 1, 0)], "id int, price int, flags int")
    merged = merge_snapshot(old, new, ["id"], ["price", "flags"], F.col("flags") == 16)
    rows = sorted(tuple(r) for r in merged.collect() if r.id != 4)
    # both rows of a key that the target holds twice are treated alike, and none is doubled
    assert rows == [(1, 5, 16, "REFUSE_UPDATE"), (2, 6, 16, "KEEP"), (2, 6, 16, "UPDATE"), (3, 7, 16, "DELETE"), (5, 1, 0, "INSERT")]
    assert sorted(tuple(r) for r in refused_rows(merged).select("id", "price", "action").collect()) == [(1, 5, "REFUSE_UPDATE"), (4, None, "REFUSE_INSERT")]
    assert sorted(r.id for r in merged_rows(merged).collect()) == [1, 2, 2, 5]
    settled = merge_snapshot(old, new, ["id"], ["price", "flags"], settle=[-F.col("price")])
    assert sorted(tuple(r) for r in settled.collect() if r.id in (1, 4)) == [(1, 9, 16, "UPDATE"), (4, 2, 0, "INSERT")]


def test_replace_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    append(spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string"), path, ["d"])
    changed = spark.read.parquet(path).filter("d = 'a'").select((F.col("v") + 10).alias("v"), "d")
    replace_partitions(changed, path, str(tmp_path / "s"), ["d"])
    assert sorted((r.v, r.d) for r in spark.read.parquet(path).collect()) == [(2, "b"), (11, "a")]


def test_unique_keys_values_and_lineage(spark):
    df = values(spark, [(1, "it's", None), (1, "b\\c", D)], {"k": "int", "t": "string", "d": "date"})
    assert [tuple(r) for r in df.collect()] == [(1, "it's", None), (1, "b\\c", D)]
    assert values(spark, [], {"k": "int"}).count() == 0
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])
    cut = cut_lineage(df.groupBy("k").count())
    assert "Aggregate" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_as_of_join_by_hand(spark):
    rng = random.Random(9)
    left = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["x", "y"]), rng.choice([None, *range(12)])) for i in range(300)]
    right = [(rng.choice([1, 1, 2, 4, None]), rng.choice(["x", "y"]), rng.choice([None, *range(3, 12)]), rng.choice([None, 1, 2]), rng.randrange(9)) for _ in range(120)]
    a = spark.createDataFrame(left + left[:5], "i int, k int, j string, d int")
    b = spark.createDataFrame(right, "k int, j string, d int, v int, w int")
    low = lambda r: (r[3] is not None, r[3] or 0, r[4])

    def best(row):
        ok = [r for r in right if row[1] is not None and row[3] is not None and r[:2] == row[1:3] and r[2] is not None and r[2] <= row[3]]
        last = [r for r in ok if r[2] == max(x[2] for x in ok)]
        return (*row, *(max(last, key=low)[3:] if last else (None, None)))

    got = as_of_join(a, b, ["k", "j"], "d", "d", ["v", "w"])
    assert got.columns == ["i", "k", "j", "d", "v", "w"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(best(r)) for r in left + left[:5])
    assert as_of_join(a.limit(0), b, ["k"], "d", "d", ["w"]).count() == 0
    assert {r.w for r in as_of_join(a, b.limit(0), ["k"], "d", "d", ["w"]).collect()} == {None}


@pytest.mark.parametrize("hot", [1000, 3])
def test_overlaps_by_hand(spark, monkeypatch, hot):
    from setforge.operators import intervals

    monkeypatch.setattr(intervals, "HOT_NODES", hot)
    rng = random.Random(4)

    def spans(n):
        rows = []
        for i in range(n):
            s = rng.choice([None, *range(-40, 40)])
            rows.append((i, rng.choice([1, 1, 1, 2, None]), s, None if s is None or rng.random() < 0.05 else s + rng.randrange(-2, 30)))
        return rows

    x, y = spans(90), spans(70)
    a, b = spark.createDataFrame(x, "i int, k int, s int, e int"), spark.createDataFrame(y, "i int, k int, s int, e int")
    whole = lambda r: None not in r and r[2] <= r[3]
    want = sorted((p[0], q[0]) for p in x for q in y if whole(p) and whole(q) and p[1] == q[1] and p[2] <= q[3] and q[2] <= p[3])
    found = interval_overlap(a, b, ["k"], ("s", "e"), ("s", "e"))
    assert sorted((r.a.i, r.b.i) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_overlap(a.limit(0), b, ["k"], ("s", "e"), ("s", "e")).count() == 0


def test_cover_is_disjoint_and_whole(spark):
    rows = spark.createDataFrame([(s, s + n) for s in (-17, -1, 0, 5, 64) for n in range(0, 40)], "s long, e long")
    for r in rows.select("s", "e", cover(F.col("s"), F.col("e"), range(6)).alias("c")).collect():
        numbers = [v for n in r.c for v in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(numbers) == list(range(r.s, r.e + 1)) and len(r.c) <= 12


def test_missing_sources_are_named(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError, match="t does not exist"):
        require_table(spark, path)
    append(spark.createDataFrame([(1, "a")], "v int, d string"), path)
    assert require_table(spark, path, ["v"]).count() == 1
    with pytest.raises(ValueError, match="no column w, x"):
        require_table(spark, path, ["x", "v", "w"])
