import random

import pytest

from setforge.plans.allocate import allocate

BOX, PEOPLE = [4, 5, 2, 9, 15], [2, 3, 9, 4, 1, 1, 2, 13, 2]
TAKEN = [(1, 1, 2), (1, 2, 2), (2, 2, 1), (2, 3, 4), (3, 3, 2), (4, 3, 3), (4, 4, 4), (4, 5, 1), (4, 6, 1), (5, 7, 2), (5, 8, 13)]


def frames(spark, supply, demand):
    return (
        spark.createDataFrame(list(enumerate(supply, 1)), "boxid int, qty int"),
        spark.createDataFrame(list(enumerate(demand, 1)), "pid int, qty int"),
    )


def theta(supply, demand):
    """The literal overlap test over every pair."""

    def spans(quantities):
        total = 0
        for key, q in enumerate(quantities, 1):
            yield key, total, total + q, q
            total += q

    return sorted(
        (b, p, b0, b1, p0, p1, min(p1, b1) - max(p0, b0), pq, bq)
        for b, b0, b1, bq in spans(supply)
        for p, p0, p1, pq in spans(demand)
        if p0 + 1 <= b1 <= p1 or b0 + 1 <= p1 <= b1
    )


def test_known_case(spark):
    rows = allocate(*frames(spark, BOX, PEOPLE)).collect()
    assert sorted((r.boxid, r.pid, r["get"]) for r in rows) == TAKEN


@pytest.mark.parametrize("seed", range(5))
def test_equals_theta_join(spark, seed):
    rnd = random.Random(seed)
    supply = [rnd.choice([0, 0, 1, 2, 7, 30]) for _ in range(rnd.randint(1, 40))]
    demand = [rnd.choice([0, 0, 0, 1, 3, 11]) for _ in range(rnd.randint(1, 60))]
    rows = [tuple(r) for r in allocate(*frames(spark, supply, demand), ranges=rnd.choice([2, 3, 8])).collect()]
    assert sorted(rows) == theta(supply, demand)
    assert sum(r[6] for r in rows) == min(sum(supply), sum(demand))


def test_one_container_holds_almost_everything(spark):
    supply, demand = [1] * 20 + [500] + [1] * 20, [3] * 100
    rows = [tuple(r) for r in allocate(*frames(spark, supply, demand), ranges=8).collect()]
    assert sorted(rows) == theta(supply, demand)


def test_many_empty_consumers_at_one_place(spark):
    supply, demand = [5, 5], [3] + [0] * 200 + [4]
    rows = [tuple(r) for r in allocate(*frames(spark, supply, demand), ranges=4).collect()]
    assert sorted(rows) == theta(supply, demand)


def test_empty_side_and_negative_quantity(spark):
    supply, demand = frames(spark, [1], [1])
    assert allocate(supply.limit(0), demand).count() == 0
    with pytest.raises(ValueError):
        allocate(*frames(spark, [1, -1], [1]))


def test_no_theta_join_and_no_single_task(spark):
    plan = allocate(*frames(spark, BOX, PEOPLE))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "SinglePartition" not in plan
