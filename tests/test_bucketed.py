"""Bucketed snapshots, ranges by JDBC, and the order of text keys."""

import hashlib
import random
import uuid

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import apply, delta, evidence, validate
from evenkeel.plans.table_plan import Column, TablePlan
from evenkeel.sources import bucketed, jdbc

PLAN = TablePlan("t", (Column("a", "bigint", False), Column("b", "text", False), Column("v", "text")), ("a", "b"))


def sides(spark):
    source = spark.range(500).selectExpr("id as a", "concat('k', id % 3) as b", "concat('v', id) as v")
    target = source.where("a % 7 <> 0").withColumn("v", F.when(F.col("a") % 5 == 0, "old").otherwise(F.col("v"))).unionAll(spark.range(500, 540).selectExpr("id", "'z'", "'gone'"))
    return source, target


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_planning_and_applying_need_no_exchange(spark, tmp_path, no_broadcast):
    source, target = sides(spark)
    root = f"file://{tmp_path}"
    s, t = bucketed.stage_sides(source, target, PLAN, root, 8)
    planned = delta.plan_delta(s, t, PLAN)
    text = plan_of(planned)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert "Exchange" in plan_of(delta.plan_delta(source, target, PLAN))
    ops = bucketed.plan_bucketed(s, t, PLAN, root, 8)
    plain = delta.plan_delta(source, target, PLAN)
    assert sorted(map(tuple, ops.collect()), key=str) == sorted(map(tuple, plain.select(*ops.columns).collect()), key=str)
    after = bucketed.apply_bucketed(s, t, ops, PLAN)
    text = plan_of(after)
    assert text.count("SortMergeJoin") == 3 and "Exchange" not in text
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, apply.apply_delta(source, target, plain, PLAN).collect())) == sorted(map(tuple, source.collect()))


def test_each_bucket_is_one_file(spark, tmp_path):
    source, _ = sides(spark)
    folder = bucketed.stage_bucketed(source, f"file://{tmp_path}", "t", ["a"], 4)
    assert len(list((tmp_path / folder).glob("part-*"))) == 4
    again = bucketed.read_bucketed(spark, f"file://{tmp_path}/{folder}")
    assert again.count() == 500 and "Exchange" not in plan_of(again.groupBy("a").count())


def test_balanced_ranges_by_jdbc(spark):
    """Keys that are far from even; no task has twice the rows of another."""
    rng = random.Random(5)
    rows = [(int(rng.paretovariate(0.4) * 1000) * 10_000 + i, f"v{i}") for i in range(4000)]
    url, plan = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", TablePlan("T", (Column("id", "bigint", False), Column("v", "text")), ("id",))
    spark.createDataFrame(rows, "id long, v string").write.jdbc(url, "T", properties={"createTableColumnTypes": "v varchar(20)"})
    # this database has no NTILE; its rows are numbered instead
    numbered = 'SELECT MIN("id") AS low FROM (SELECT "id", (ROW_NUMBER() OVER () - 1) / (4000 / {n}) AS part FROM (SELECT "id" FROM {table} WHERE "id" IS NOT NULL ORDER BY "id") o) parts GROUP BY part'
    quoted = TablePlan("T", (Column('"id"', "bigint", False),), ('"id"',))
    lows = [r[0] for r in spark.read.jdbc(url, f"({numbered.format(n=8, table='T')}) bounds").collect()]
    df = spark.read.jdbc(url, "T", predicates=jdbc.key_ranges(lows, quoted.key[0], jdbc._literal), properties={})
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert df.count() == 4000 and len(sizes) == 8 and max(sizes) <= 2 * min(sizes)
    assert {tuple(r) for r in df.collect()} == set(rows)


def test_ranges_hold_every_row_once():
    ranges = jdbc.key_ranges([5, 1, 9, 5], "k")
    assert ranges == ["k < 5", "k >= 5 AND k < 9", "k >= 9", "k IS NULL"] and jdbc.key_ranges([], "k") == jdbc.key_ranges([3], "k") == ["1 = 1"]
    assert jdbc.key_ranges(["a", "it's"], "k", jdbc._literal)[0] == "k < 'it''s'"
    assert "MOD(id, 100) = 0 AND id IS NOT NULL" in jdbc.sampled(100).format(key="id", n=4, table="t")


def test_text_keys_are_ordered_by_utf16_units(spark):
    keys = ["a", "x", "￿", "\U0001f600", "\U00010000", "é", "", "ab", "퟿"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    ranked = [r.k for r in df.orderBy(evidence.order_key(F.col("k"), "text")).collect()]
    assert ranked == sorted(keys, key=lambda k: k.encode("utf-16-be"))
    assert ranked != sorted(keys)
    rows = spark.createDataFrame(list(enumerate(ranked)), "o int, k string")
    assert validate.key_order_violations(rows, "o", ["k"], []).isEmpty()
    plan = TablePlan("t", (Column("k", "text", False),), ("k",))
    one = evidence.ordered_digest(df, plan).first()[0]
    hashes = {r.k: r.h for r in df.select("k", evidence.row_hash(plan.columns).alias("h")).collect()}
    assert one == hashlib.sha256("\n".join(hashes[k] for k in ranked).encode()).hexdigest()
