import random

import pytest

from setforge.plans.cycles import ancestor_counts, closure, closure_bounded, cycle_members, find_cycles

SCHEMA = "id int, parent_id int"


def test_known_cycle(spark):
    edges = spark.createDataFrame([(5, None), (11, 13), (13, 17), (17, 11), (20, 11), (21, 5)], SCHEMA)
    assert [tuple(r) for r in find_cycles(edges).collect()] == [(17, "13 -> 11 -> 17"), (13, "11 -> 17 -> 13"), (11, "17 -> 13 -> 11")]
    assert [r.start_id for r in find_cycles(edges, limit=2).collect()] == [17, 13]


@pytest.mark.parametrize("seed", range(2))
def test_equals_walking_every_node(spark, seed):
    rnd = random.Random(seed)
    parent = {i: rnd.choice([None, *range(40)]) for i in range(40)}
    expected = {}
    for start in parent:
        seen, at = [], parent[start]
        while at is not None and at != start and at not in seen:
            seen.append(at)
            at = parent[at]
        if at == start:
            expected[start] = " -> ".join(map(str, [*reversed(seen), start]))
    edges = spark.createDataFrame(list(parent.items()), SCHEMA)
    assert {r.start_id: r.path for r in find_cycles(edges, limit=None).collect()} == expected


def test_self_loop_two_rings_and_a_long_chain(spark):
    rows = [(1, 1), (2, 3), (3, 2), (4, 2)] + [(i, i - 1) for i in range(11, 200)] + [(10, None)]
    edges = spark.createDataFrame(rows, SCHEMA)
    assert {r.start_id: r.path for r in find_cycles(edges).collect()} == {1: "1", 2: "3 -> 2", 3: "2 -> 3"}
    assert {(r.cycle_id, r.pos, r.id) for r in cycle_members(edges).collect()} == {(1, 0, 1), (2, 0, 2), (2, 1, 3)}


def test_star_with_one_hot_parent(spark):
    edges = spark.createDataFrame([(0, None)] + [(i, 0) for i in range(1, 500)], SCHEMA)
    assert find_cycles(edges).count() == 0
    assert closure(edges).count() == 1 + 2 * 499


def test_closure_repeats_rows_by_depth(spark):
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 2)], SCHEMA)
    assert sorted(r.id for r in closure(edges).collect()) == [1, 2, 2, 3, 3, 3]


def test_closure_below_a_hundred_levels_and_on_a_cycle(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(150)], SCHEMA)
    assert max(r.depth for r in ancestor_counts(chain).collect()) == 150
    with pytest.raises(ValueError):
        closure(spark.createDataFrame([(1, 2), (2, 1)], SCHEMA))


def test_bounded_closure_keeps_bags_and_ends_on_cycles(spark):
    rows = [(1, 2), (2, 3), (3, 1), (4, 3), (5, 9), (6, 5), (6, 4), (7, 6)]
    found = closure_bounded(spark.createDataFrame(rows, "id int, parent_id int"), max_depth=4)
    ways = [(i, p, 0) for i, p in rows]
    at = list(rows)
    for level in range(1, 5):
        at = [(i, p) for i, p in rows for up, _ in at if up == p]
        ways += [(i, p, level) for i, p in at]
    assert sorted(tuple(r) for r in found.collect()) == sorted(ways)
