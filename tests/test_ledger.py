"""Evidence that is added up, digest trees, and plans over broken keys."""

import hashlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from evenkeel.operators import delta, digest_tree, evidence, ledger
from evenkeel.operators.violations import ContractError
from evenkeel.plans.table_plan import Column, ForeignKey, TablePlan

PLAN = TablePlan("t", (Column("id", "bigint", False), Column("v", "text"), Column("p", "bigint")), ("id",), foreign_keys=(ForeignKey("t_p", ("p",), "q", ("id",)),))
SCHEMA = "id long, v string, p long"


def tables(spark, n=300, seed=1):
    rng = random.Random(seed)
    old = {i: (i, rng.choice(["a", "b", None]), rng.choice([None, 1, 2])) for i in range(n)}
    new = {i: (i, "new", r[2]) if rng.random() < 0.1 else r for i, r in old.items() if rng.random() > 0.1} | {n + i: (n + i, None, 3) for i in range(20)}
    return spark.createDataFrame(list(new.values()), SCHEMA), spark.createDataFrame(list(old.values()), SCHEMA)


def changed_rows(source, target, ops):
    written, bad = delta.select_planned(source, ops, PLAN)
    replaced, _ = delta.partition_by_keys(target, ops.where("kind <> 'insert'"), PLAN)
    assert bad.isEmpty()
    return written, replaced


def test_the_ledger_follows_from_the_changed_rows(spark):
    source, target = tables(spark)
    ops = delta.plan_delta(source, target, PLAN)
    written, replaced = changed_rows(source, target, ops)
    after = ledger.advance(ledger.measures(target, PLAN), ops, written, replaced, PLAN)
    assert ledger.ledger_violations(ledger.measures(source, PLAN), after).isEmpty()
    got, full = ledger.ledger_evidence(after), evidence.table_evidence(source, PLAN)
    assert evidence.compare_evidence(full, got).isEmpty()
    assert not evidence.compare_evidence(evidence.table_evidence(target, PLAN), got).isEmpty()


def test_rows_that_are_not_the_plans_are_refused(spark):
    source, target = tables(spark)
    ops = delta.plan_delta(source, target, PLAN)
    written, replaced = changed_rows(source, target, ops)
    before = ledger.measures(target, PLAN)
    for w, r in ((written.limit(3), replaced), (written, replaced.withColumn("v", F.lit("other"))), (written, replaced.limit(0))):
        with pytest.raises(ContractError, match="canonical_delta_evidence_drift"):
            ledger.advance(before, ops, w, r, PLAN)


def test_a_digest_of_negative_and_large_parts(spark):
    """The sum modulo 2**256, whatever the signs of its parts and however near they are to a carry."""
    cases = [[-1] * 8, [0] * 7 + [-1], [2**32 - 1] * 8, [5 * 2**32 - 1] * 8, [10**25, -(10**25), 3, -7, 0, 1, 2**63, -(2**40)]]
    for limbs in cases:
        got = spark.range(1).select(evidence.multiset_digest([F.lit(str(x)).cast("decimal(38,0)") for x in limbs]).alias("d")).first()["d"]
        total = sum(x << (32 * (7 - i)) for i, x in enumerate(limbs)) % (1 << 256)
        assert got == hashlib.sha256(total.to_bytes(32, "big")).hexdigest()


def brute_tree(rows):
    leaves = {}
    for key, row in rows:
        leaves.setdefault(key[:4], []).append(int(row, 16))
    nodes = {("leaf", p): (len(x), hashlib.sha256((sum(x) % (1 << 256)).to_bytes(32, "big")).hexdigest()) for p, x in leaves.items()}
    for level, below, size in (("inner", "leaf", 2), ("root", "inner", 0)):
        for prefix in {p[:size] for lv, p in nodes if lv == below}:
            own = sorted((p, *x) for (lv, p), x in nodes.items() if lv == below and p.startswith(prefix))
            nodes[level, prefix] = (sum(n for _, n, _ in own), hashlib.sha256("\n".join(f"{p}|{n}|{d}" for p, n, d in own).encode()).hexdigest())
    return nodes


def test_tree_against_plain_sums(spark):
    source, target = tables(spark)
    prints = delta.fingerprints(source, PLAN)
    tree = digest_tree.table_tree(source, PLAN)
    assert {(r.level, r.prefix): (r.rows, r.sha256) for r in tree.collect()} == brute_tree([(r.key_sha256, r.row_sha256) for r in prints.collect()])
    again = digest_tree.table_tree(source.repartition(7), PLAN)
    assert digest_tree.differing(tree, again).isEmpty()
    other = digest_tree.differing(tree, digest_tree.table_tree(target, PLAN)).collect()
    changed = {r.key_sha256[:4] for r in delta.plan_delta(source, target, PLAN).collect()}
    assert {r.prefix for r in other if r.level == "leaf"} == changed
    assert {r.prefix for r in other if r.level == "inner"} == {p[:2] for p in changed} and sum(r.level == "root" for r in other) == 1


def test_plans_by_ranges(spark):
    source, target = tables(spark)
    plain = sorted(map(tuple, delta.plan_delta(source, target, PLAN).collect()), key=str)
    kept = digest_tree.table_tree(target, PLAN)
    assert sorted(map(tuple, digest_tree.plan_by_ranges(source, target, PLAN).collect()), key=str) == plain
    assert sorted(map(tuple, digest_tree.plan_by_ranges(source, target, PLAN, target_tree=kept).collect()), key=str) == plain
    assert digest_tree.first_difference(source, target, PLAN).first()["id"] == min(r[0] for r in plain)
    assert digest_tree.plan_by_ranges(source, source, PLAN).isEmpty() and digest_tree.first_difference(source, source, PLAN).isEmpty()


def test_only_rows_of_differing_leaves_are_joined(spark):
    target = spark.range(20000).selectExpr("id", "'v' as v", "1L as p")
    source = target.withColumn("v", F.when(F.col("id") == 77, "w").otherwise(F.col("v")))
    leaves = digest_tree.differing(digest_tree.table_tree(source, PLAN), digest_tree.table_tree(target, PLAN)).where("level = 'leaf'")
    assert leaves.count() == 1 and digest_tree._within(source, PLAN, leaves).count() <= 5
    assert [(r.kind, r.id) for r in digest_tree.plan_by_ranges(source, target, PLAN).collect()] == [("update", 77)]


@pytest.mark.parametrize("mode", ["multiset", "tree", "sorted"])
def test_relation_digests(spark, mode):
    rows = spark.createDataFrame([(i % 50, "x" * (i % 3)) for i in range(200)], "a long, b string")
    one = evidence.relation_digest(rows, (), mode).first()
    assert one == evidence.relation_digest(rows.repartition(9), (), mode).first() and one["rows"] == 200
    assert one != evidence.relation_digest(rows.limit(199), (), mode).first()
    assert evidence.relation_digest(rows.where("false"), (), mode).first()["rows"] == 0


@pytest.mark.parametrize("side", ["source", "target"])
@pytest.mark.parametrize("bad, code", [((None, "x", 1), "delta_primary_key_null"), ((7, "x", 1), "delta_duplicate_key")])
def test_no_plan_over_broken_keys(spark, side, bad, code):
    source, target = tables(spark, 20)
    more = spark.createDataFrame([bad, (7, "y", 2)], SCHEMA)
    source, target = (source.where("id <> 7").unionAll(more), target) if side == "source" else (source, target.where("id <> 7").unionAll(more))
    with pytest.raises(PySparkException, match=f"{code}: t, {side}"):
        delta.plan_delta(source, target, PLAN).collect()


def test_checking_keys_costs_no_exchange(spark):
    source, target = tables(spark, 20)
    text = delta.plan_delta(source, target, PLAN)._jdf.queryExecution().sparkPlan().toString()
    plan = delta.plan_delta(source, target, PLAN)
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "FullOuter" in text and final.count("Exchange hashpartitioning") == 2


def test_rows_are_hashed_once_while_they_are_measured(spark):
    source, _ = tables(spark)
    rows, _ = ledger.observed(source, PLAN)
    for df in (rows, ledger.measures(source, PLAN)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1


def test_sums_of_hashes_of_equal_and_largest_parts(spark):
    sums = spark.range(3000).select(F.lit("f" * 64).alias("h")).agg(*evidence.limb_sums(F.col("h"))).first()
    assert [int(x) for x in sums] == [3000 * (2**32 - 1)] * 8
    assert [int(x) for x in spark.range(0).select(F.lit("f" * 64).alias("h")).agg(*evidence.limb_sums(F.col("h"))).first()] == [0] * 8
