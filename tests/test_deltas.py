import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from evenkeel.functions.canonical import fingerprints
from evenkeel.operators import apply, delta, evidence, validate
from evenkeel.operators.violations import ContractError, require_none
from evenkeel.plans.table_plan import Column, TablePlan

PLAN = TablePlan("t", (Column("Id", "integer", False), Column("Name", "text")), ("Id",))


def rows(spark, *values, schema="Id int, Name string"):
    return spark.createDataFrame(list(values), schema)


def kinds(ops):
    return {r["Id"]: r["kind"] for r in ops.collect()}


def test_plan(spark):
    source, target = rows(spark, (1, "same"), (2, "changed"), (4, "new")), rows(spark, (1, "same"), (2, "old"), (3, "removed"))
    assert kinds(delta.plan_delta(source, target, PLAN)) == {2: "update", 3: "delete", 4: "insert"}
    counts = delta.delta_counts(delta.compare_tables(source, target, PLAN), "t").first()
    assert tuple(counts) == ("t", 1, 1, 1, 1)


def test_null_is_a_change_and_key_width_is_none(spark):
    assert kinds(delta.plan_delta(rows(spark, (1, None)), rows(spark, (1, "previous")), PLAN)) == {1: "update"}
    assert kinds(delta.plan_delta(rows(spark, (9, "a")), rows(spark, (9, "a"), schema="Id bigint, Name string"), PLAN)) == {}


def test_keys_are_checked_without_values(spark):
    bad = delta.key_violations(rows(spark, (None, "secret"), (1, "secret"), (1, "secret")), PLAN, "source")
    with pytest.raises(ContractError) as error:
        require_none(bad)
    assert error.value.codes == {"delta_primary_key_null": 1, "delta_duplicate_key": 1}
    assert "secret" not in str(error.value)
    with pytest.raises(ContractError, match="delta_row_shape_invalid"):
        validate.check_shape(rows(spark, (1,), schema="Id int"), PLAN)


def test_resolve_and_apply(spark):
    source, target = rows(spark, (1, "same"), (2, "changed"), (4, "new")), rows(spark, (1, "same"), (2, "old"), (3, "removed"))
    ops = delta.plan_delta(source, target, PLAN)
    good, bad = delta.resolve_ops(ops, source, target, PLAN)
    assert good.count() == 3 and bad.isEmpty()
    after = apply.apply_delta(source, target, good, PLAN)
    assert sorted(map(tuple, after.collect())) == [(1, "same"), (2, "changed"), (4, "new")]
    assert apply.applied_counts(ops, target, after, PLAN).isEmpty()
    moved = rows(spark, (1, "same"), (2, "later"), (4, "new"), (5, "unplanned"))
    codes = sorted(r["code"] for r in delta.resolve_ops(ops, moved, target, PLAN)[1].collect())
    assert codes == ["canonical_delta_source_row_drift", "delta_change_unplanned"]


def test_captured_rows_ignore_later_source_changes(spark):
    source, target = rows(spark, (1, "a"), (4, "new")), rows(spark, (1, "b"))
    ops = delta.plan_delta(source, target, PLAN)
    captured = delta.select_planned(source, ops, PLAN)[0]
    good, bad = delta.resolve_captured(ops, captured, target, PLAN)
    assert good.count() == 2 and bad.isEmpty()
    bad = delta.resolve_captured(ops, captured, rows(spark, (1, "b"), (4, "new")), PLAN)[1]
    assert [r["code"] for r in bad.collect()] == ["delta_capture_target_drift"]


def test_overlay_columns_survive(spark):
    source = rows(spark, (1, "x"), (2, "y"))
    target = rows(spark, (1, "old", "note"), schema="Id int, Name string, Note string")
    after = apply.apply_delta(source, target, delta.plan_delta(source, target, PLAN), PLAN)
    assert sorted(map(tuple, after.collect()), key=str) == [(1, "x", "note"), (2, "y", None)]


def test_adoption(spark):
    schema = "id long, event_key string, v string"
    source = rows(spark, (1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "d", "x"), schema=schema)
    there = rows(spark, (1, "a", "x"), (2, "b", "other"), (3, "z", "x"), (9, "q", "x"), schema=schema)
    inserts, replays, conflicts = delta.adopt(source, there, "id", "event_key")
    assert [r["id"] for r in inserts.collect()] == [4]
    assert [r["id"] for r in replays.collect()] == [1]
    assert {(r["event_key"], r["code"]) for r in conflicts.collect()} == {("b", "event_row_changed"), ("c", "event_id_taken"), ("z", "event_row_absent"), ("q", "event_row_absent")}


def test_evidence_does_not_depend_on_order_or_partitions(spark):
    df = spark.range(1000).selectExpr("cast(id as int) as Id", "if(id % 7 = 0, null, cast(id as string)) as Name")
    one = evidence.table_evidence(df, PLAN).first()
    assert one == evidence.table_evidence(df.repartition(7).orderBy("Name"), PLAN).first()
    assert one["null_counts"] == {"Id": 0, "Name": 143}
    other = evidence.table_evidence(df.selectExpr("Id", "if(Id = 500, 'x', Name) as Name"), PLAN).first()
    assert other["aggregate_sha256"] != one["aggregate_sha256"] and other["row_count"] == one["row_count"]


def test_ordered_digests(spark):
    df = spark.range(2500).selectExpr("cast(id as int) as Id", "cast(id as string) as Name")
    chunked = {evidence.ordered_digest(df.repartition(n), PLAN, "chunked", 100).first()[0] for n in (1, 3, 7)}
    assert len(chunked) == 1
    exact = {evidence.ordered_digest(df.repartition(n), PLAN).first()[0] for n in (1, 5)}
    assert len(exact) == 1


def test_empty_tables(spark):
    none = rows(spark).limit(0)
    assert delta.plan_delta(none, none, PLAN).isEmpty()
    assert evidence.table_evidence(none, PLAN).first()["row_count"] == 0
    assert evidence.ordered_digest(none, PLAN, "chunked").count() == 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 20), st.text(max_size=3)), st.dictionaries(st.integers(0, 20), st.text(max_size=3)))
def test_applying_a_plan_gives_the_source(spark, left, right):
    source, target = rows(spark, *left.items()), rows(spark, *right.items())
    after = apply.apply_delta(source, target, delta.plan_delta(source, target, PLAN), PLAN)
    assert dict(map(tuple, after.collect())) == left


def test_plans_exchange_no_hashes_of_keys(spark):
    source, target = rows(spark, (1, "same"), (2, "changed"), (4, "new")), rows(spark, (1, "same"), (2, "old"), (3, "removed"))
    made = delta.compare_tables(source, target, PLAN)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 3, "a row's on either side, and the key's after the join"
    prints = {r["Id"]: (r["key_sha256"], r["row_sha256"]) for df in (target, source) for r in fingerprints(df, PLAN).collect()}
    assert {r["Id"]: (r["key_sha256"], r["source_row_sha256"] or r["target_row_sha256"]) for r in made.collect()} == prints
