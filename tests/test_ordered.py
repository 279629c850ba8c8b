"""Order checks over runs that many parts share, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import ordered, validate


@pytest.fixture(autouse=True)
def small_parts(spark):
    """Parts are not joined, however small they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows(n, runs, seed):
    rng = random.Random(seed)
    return [(None if runs and rng.random() < 0.1 else rng.randrange(max(1, runs)), i, rng.choice([None, *range(50)]), rng.random() < 0.3) for i in rng.sample(range(10 * n), n)]


SCHEMA = "r int, o long, v int, d boolean"


def by_run(data, use):
    out = {}
    for x in sorted(data, key=lambda x: x[1]):
        out.setdefault(x[0] if use else 0, []).append(x)
    return out.values()


@pytest.mark.parametrize("runs", [0, 1, 3, 200])
def test_previous_and_running(spark, runs):
    data = rows(600, runs, runs)
    df, run = spark.createDataFrame(data, SCHEMA).repartition(3), ["r"] if runs else []
    before, most, least = {}, {}, {}
    for own in by_run(data, bool(runs)):
        for i, x in enumerate(own):
            before[x[1]] = (own[i - 1][2],) if i else None
            most[x[1]] = max((y[2] for y in own[:i] if y[2] is not None), default=None)
            least[x[1]] = min((y[2] for y in own[i + 1 :] if y[2] is not None), default=None)
    assert {r.o: r.before and tuple(r.before) for r in ordered.with_previous(df, run, "o", ["v"]).collect()} == before
    assert {r.o: r.running for r in ordered.with_running(df, run, "o", F.col("v"), "max").collect()} == most
    assert {r.o: r.running for r in ordered.with_running(df, run, "o", F.col("v"), "min", following=True).collect()} == least


def test_a_run_is_many_tasks(spark):
    df = spark.range(4000).selectExpr("id as o", "id % 7 as v")
    parts = ordered.parts_of(df, [], "o").groupBy("__part").count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 2500
    plan = ordered.with_running(df, [], "o", F.col("v"), "max")._jdf.queryExecution().optimizedPlan().toString()
    assert "[__part" in plan


def test_order_of_operations(spark):
    rng = random.Random(3)
    log = [(rng.choice(["insert", "update", "delete"]), i, rng.randrange(4)) for i in range(300)]
    bad, seen = [], {True: None, False: None}
    for kind, i, rank in log:
        delete = kind == "delete"
        if seen[delete] is not None and (rank > seen[delete] if delete else rank < seen[delete]):
            bad.append(i)
        seen[delete] = rank if seen[delete] is None else (min if delete else max)(seen[delete], rank)
    df = spark.createDataFrame(log, "kind string, o int, rank int").repartition(4)
    assert sorted(r.o for r in validate.op_order_violations(df, [], "o", "rank").collect()) == bad


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ordered.with_previous(none, ["r"], "o", ["v"]).collect() == [] and ordered.with_running(none, [], "o", F.col("v"), "max").collect() == []
