from datetime import datetime, timedelta

import pytest

from evenkeel.plans.table_plan import (
    Check, Column, DatabasePlan, ForeignKey, PlanError, TablePlan, Unique, order_columns, parent_first, require_key, spark_type, target_type, validate_plan,
)


def plan(name="t", key=("id",), **more):
    return TablePlan(name, (Column("id", "integer", False), Column("name", "text")), key, **more)


@pytest.mark.parametrize(
    "source, target",
    [
        ("bigint", "bigint"), ("int", "integer"), ("tinyint", "smallint"), ("bit", "boolean"), ("decimal(18,4)", "numeric(18,4)"), ("money", "numeric(19,4)"),
        ("nvarchar(40)", "character varying(40)"), ("nvarchar(max)", "text"), ("char(3)", "character(3)"), ("datetime2(3)", "timestamp without time zone"),
        ("datetime2(7)", "text"), ("datetimeoffset", "text"), ("uniqueidentifier", "uuid"), ("varbinary(max)", "bytea"), ("float", "double precision"),
    ],
)
def test_types_map(source, target):
    assert target_type(source) == target
    assert spark_type(target)


@pytest.mark.parametrize("source", ["sql_variant", "geography", "hierarchyid"])
def test_unknown_types_are_refused(source):
    with pytest.raises(PlanError, match="source_type_mapping_unsupported"):
        target_type(source)


def test_keys():
    assert require_key(plan()) == ("id",)
    for key in ((), ("id", "id"), ("other",)):
        with pytest.raises(PlanError, match="delta_primary_key_required"):
            require_key(plan(key=key))


def test_order_is_proven_or_the_table_empty():
    assert order_columns(plan(key=(), uniques=(Unique("u", ("id",)),))) == ("id",)
    assert order_columns(plan(key=(), known_empty=True)) == ()
    with pytest.raises(PlanError, match="table_order_unproven"):
        order_columns(plan(key=(), uniques=(Unique("u", ("name",)),)))


def test_parents_come_first():
    a, b = plan("a", foreign_keys=(ForeignKey("f", ("id",), "b", ("id",)),)), plan("b")
    assert parent_first({"a": a, "b": b}) == ["b", "a"]
    with pytest.raises(PlanError, match="delta_execution_fk_target_missing"):
        parent_first({"a": a})
    with pytest.raises(PlanError, match="delta_execution_fk_cycle"):
        parent_first({"a": a, "b": plan("b", foreign_keys=(ForeignKey("g", ("id",), "a", ("id",)),))})


def test_plans_are_checked():
    now = datetime(2025, 1, 1)
    validate_plan(DatabasePlan("d", {"t": plan()}, now), now + timedelta(hours=1))
    with pytest.raises(PlanError, match="schema_plan_stale"):
        validate_plan(DatabasePlan("d", {"t": plan()}, now), now + timedelta(hours=7))
    with pytest.raises(PlanError, match="schema_plan_expression_denied"):
        validate_plan(DatabasePlan("d", {"t": plan(checks=(Check("c", "id > 0; drop table t"),))}))
