"""Micro-batches against plain folds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingweave.operators.batching import batch_numbers, fixed_batches, greedy_batches


def greedy(costs, max_rows, max_cost):
    """The definition: close the open batch when it is full or would grow too costly."""
    numbers, n, total, batch = [], 0, 0, -1
    for cost in costs:
        if n == 0 or n >= max_rows or total + cost > max_cost:
            n, total, batch = 0, 0, batch + 1
        n, total = n + 1, total + cost
        numbers.append(batch)
    return numbers


def groups(seed, sizes, costs):
    random.seed(seed)
    return [(k, i, random.choice(costs)) for k, size in sizes.items() for i in range(size)]


@pytest.mark.parametrize(
    "max_rows, max_cost, chunk_rows, costs",
    [
        (5, 100, 7, range(0, 60)),
        (5, 100, 1000, range(0, 60)),
        (20, 50, 6, range(0, 12)),
        (3, 10, 4, [0, 5, 25]),
        (1, 10, 3, [0, 50]),
        (50, 1_000_000, 5, [1]),
    ],
)
def test_greedy_batches(spark, max_rows, max_cost, chunk_rows, costs):
    data = groups(9, {"hot": 400, "a": 7, "b": 8, "c": 1, None: 30}, list(costs))
    df = spark.createDataFrame(data, "k string, i int, cost int")
    shuffled = df.orderBy(F.rand(1))
    got = greedy_batches(
        shuffled, ["k"], ["i"], F.col("cost"), max_rows, max_cost, chunk=F.floor(F.col("i") / 50), chunk_rows=chunk_rows
    )
    want = []
    for key in ("hot", "a", "b", "c", None):
        rows = [r for r in data if r[0] == key]
        want += [(*r, b) for r, b in zip(rows, greedy([r[2] for r in rows], max_rows, max_cost))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_fixed_batches(spark):
    df = spark.range(25).selectExpr("if(id < 20, 'a', 'b') as k", "id")
    got = {(r.k, r.id): r.batch_no for r in fixed_batches(df, ["k"], ["id"], size=10).collect()}
    assert got == {("a", i): i // 10 for i in range(20)} | {("b", i): 0 for i in range(20, 25)}


def test_batches_of_parts_equal_the_fold():
    rng = np.random.default_rng(3)
    for max_rows, max_cost in [(5, 100), (1, 7), (400, 90), (3, 0)]:
        costs = rng.integers(0, 60, 900)
        got = batch_numbers(np.array([0]), costs, *np.zeros((3, 1), np.int64), max_rows, max_cost)
        assert got.tolist() == greedy(costs.tolist(), max_rows, max_cost)


def test_python_sees_numbers_and_costs_only(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id", "repeat('x', 100) as payload", "if(id % 5 = 0, null, id % 9) as cost")
    got = greedy_batches(df, ["k"], ["id"], F.col("cost"), 7, 20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    into_python = [line for line in plan.split("\n") if "MapInArrow" in line]
    assert into_python and not any("payload" in line for line in into_python)
    want = []
    for k in range(3):
        ids = range(k, 1000, 3)
        want += list(zip(ids, greedy([0 if i % 5 == 0 else i % 9 for i in ids], 7, 20)))
    assert sorted((r.id, r.batch_no) for r in got.collect()) == sorted(want)
