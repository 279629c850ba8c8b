"""Schemas as rows: what tables look like, and where two catalogs differ."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.scalars import normal_expression, presence_state
from evenkeel.plans.table_plan import TablePlan

COLUMNS = "table string, ordinal int, column string, type string, nullable boolean, default string, generated string, identity boolean, collation string"
_FACETS = ["type", "nullable", "identity", "default", "generated", "collation"]


def catalog_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """A row for each column of each table, from the tables' schemas."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable, None, None, False, f.metadata.get("collation"))
        for name, df in sorted(tables.items())
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def plan_columns(spark: SparkSession, plans: Mapping[str, TablePlan]) -> DataFrame:
    """The same rows from plans; expressions are put into composed Unicode form."""
    nfc = lambda x: None if x is None else unicodedata.normalize("NFC", x)
    rows = [
        (n, i, c.name, c.type, c.nullable, nfc(c.default), nfc(c.generated), c.identity, c.collation)
        for n, p in sorted(plans.items())
        for i, c in enumerate(p.columns, 1)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def plan_constraints(spark: SparkSession, plans: Mapping[str, TablePlan]) -> DataFrame:
    """``table, kind, name, ordinal, column, detail``: keys, unique sets, checks and foreign keys, a row for each column."""
    rows: list[tuple] = []
    for n, p in sorted(plans.items()):
        rows += [(n, "key", f"{n}_key", i, c, None) for i, c in enumerate(p.key, 1)]
        rows += [(n, "unique", u.name, i, c, u.predicate) for u in p.uniques for i, c in enumerate(u.columns, 1)]
        rows += [(n, "check", c.name, 1, None, c.expression) for c in p.checks]
        rows += [(n, "foreign", f.name, i, c, f"{f.parent}.{q}") for f in p.foreign_keys for i, (c, q) in enumerate(zip(f.columns, f.parent_columns, strict=True), 1)]
    return spark.createDataFrame(rows, "table string, kind string, name string, ordinal int, column string, detail string")


def grouped_constraints(constraints: DataFrame) -> DataFrame:
    """A row for each constraint, its columns and details in order."""
    both = F.array_sort(F.collect_list(F.struct("ordinal", "column", "detail")))
    grouped = constraints.groupBy("table", "kind", "name").agg(both.alias("x"))
    return grouped.select("table", "kind", "name", F.col("x.column").alias("columns"), F.col("x.detail").alias("details"))


def schema_gap(expected: DataFrame, observed: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """``gap, table, column``: tables and columns of one catalog that the other lacks.

    Target-only tables that are ``approved`` (a table of names) count as
    extensions, present or missing, and not as gaps.
    """
    e, o = expected.select("table", "column"), observed.select("table", "column")
    et, ot = e.select("table").distinct(), o.select("table").distinct()
    out = [
        (et.join(ot, "table", "left_anti"), "missing-table", False),
        (ot.join(et, "table", "left_anti"), "target-only-table", False),
        (e.join(ot, "table", "left_semi").join(o, ["table", "column"], "left_anti"), "missing-column", True),
        (o.join(et, "table", "left_semi").join(e, ["table", "column"], "left_anti"), "target-only-column", True),
    ]
    if approved is not None:
        names = approved.select("table").distinct()
        out[1] = (out[1][0].join(names, "table", "left_anti"), "target-only-table", False)
        out.append((names.join(ot, "table", "left_semi"), "extension-present", False))
        out.append((names.join(ot, "table", "left_anti"), "extension-missing", False))
    found = None
    for df, gap, has_column in out:
        one = df.select(F.lit(gap).alias("gap"), "table", F.col("column") if has_column else F.lit(None).cast("string").alias("column"))
        found = one if found is None else found.unionByName(one)
    return found


def column_drift(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """``table, column, state, facets``: match, drift with the facets that changed, missing or target-only."""
    e = expected.select("table", "column", *[F.col(f"`{f}`").alias(f"e_{f}") for f in _FACETS], F.lit(True).alias("e"))
    o = observed.select("table", "column", *[F.col(f"`{f}`").alias(f"o_{f}") for f in _FACETS], F.lit(True).alias("o"))
    both = e.join(o, ["table", "column"], "full_outer")

    def same(f: str):
        a, b = F.col(f"e_{f}"), F.col(f"o_{f}")
        return normal_expression(a).eqNullSafe(normal_expression(b)) if f in ("default", "generated") else a.eqNullSafe(b)

    facets = F.filter(F.array(*[F.when(~same(f), F.lit(f)) for f in _FACETS]), lambda x: x.isNotNull())
    state = F.when(F.col("o").isNull(), "missing").when(F.col("e").isNull(), "target-only").when(F.size(facets) > 0, "drift").otherwise("match")
    return both.select("table", "column", state.alias("state"), F.when(state == "drift", facets).otherwise(F.array().cast("array<string>")).alias("facets"))


def component_hashes(columns: DataFrame, constraints: DataFrame) -> DataFrame:
    """``table, component, sha256``: of columns, constraints, indexes, foreign keys, and of the whole of each table.

    Physical column order does not count; expressions are compared in normal form.
    """
    line = F.concat_ws("|", F.lit("column"), "column", "type", F.col("nullable").cast("string"), F.coalesce(normal_expression(F.col("default")), F.lit("-")), F.coalesce(normal_expression(F.col("generated")), F.lit("-")), F.col("identity").cast("string"), F.coalesce("collation", F.lit("-")))
    facts = columns.select("table", F.lit("columns").alias("component"), line.alias("fact"))
    grouped = grouped_constraints(constraints)
    kind = F.when(F.col("kind") == "foreign", "foreign-keys").when(F.col("kind") == "unique", "indexes").otherwise("constraints")
    text = F.concat_ws("|", "kind", "name", F.array_join("columns", ","), F.array_join(F.transform("details", normal_expression), ","))
    facts = facts.unionByName(grouped.select("table", kind.alias("component"), text.alias("fact")))
    facts = facts.unionByName(facts.select("table", F.lit("whole").alias("component"), "fact"))
    return facts.groupBy("table", "component").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("fact")), "\n"), 256).alias("sha256"))


def schema_fingerprint(hashes: DataFrame) -> DataFrame:
    """One row, ``schema_sha256``, over the whole-table hashes in order of name."""
    from evenkeel.operators.evidence import sorted_sha256

    whole = hashes.where("component = 'whole'").withColumn("__all", F.lit(0))
    digest = sorted_sha256(whole, ["__all"], F.concat_ws("|", "table", "sha256"), "\n")
    return digest.agg(F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("schema_sha256"))  # one row at most


def component_drift(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """``table, component, state`` of component hashes that are not the same on both sides."""
    e, o = expected.withColumnRenamed("sha256", "e"), observed.withColumnRenamed("sha256", "o")
    both = e.join(o, ["table", "component"], "full_outer").where(~F.col("e").eqNullSafe(F.col("o")))
    return both.select("table", "component", F.when(F.col("o").isNull(), "missing").when(F.col("e").isNull(), "target-only").otherwise("drift").alias("state"))


def expression_drift(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """For each table, columns whose default or generated expression is on both sides and differs, and whether other facets do."""
    e = expected.select("table", "column", *[F.col(f"`{f}`").alias(f"e_{f}") for f in _FACETS])
    o = observed.select("table", "column", *[F.col(f"`{f}`").alias(f"o_{f}") for f in _FACETS])
    other = F.lit(False)
    for f in ("type", "nullable", "identity", "collation"):
        other = other | ~F.col(f"e_{f}").eqNullSafe(F.col(f"o_{f}"))
    states = {f: presence_state(F.col(f"e_{f}"), F.col(f"o_{f}")) for f in ("default", "generated")}
    changed = (states["default"] == "present-different") | (states["generated"] == "present-different")
    both = e.join(o, ["table", "column"]).select("table", "column", changed.alias("changed"), other.alias("other"))
    out = both.groupBy("table").agg(F.array_sort(F.collect_list(F.when(F.col("changed"), F.col("column")))).alias("columns"), F.bool_or("other").alias("other_drift"))
    return out.where("size(columns) > 0")


def unplanned_parents(constraints: DataFrame, columns: DataFrame) -> DataFrame:
    """Foreign-key columns whose parent table or column no plan has."""
    parent = F.split("detail", r"\.", 2)
    wanted = constraints.where("kind = 'foreign'").select("table", "name", parent[0].alias("parent"), parent[1].alias("parent_column"))
    known = columns.select(F.col("table").alias("parent"), F.col("column").alias("parent_column"))
    return wanted.join(known, ["parent", "parent_column"], "left_anti")


def declared_gap(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """Gaps that are not declared and declared ones that are not there, with their side."""
    a, d = actual.select("gap", "table", "column"), declared.select("gap", "table", "column")
    return a.exceptAll(d).withColumn("side", F.lit("undeclared")).unionAll(d.exceptAll(a).withColumn("side", F.lit("absent")))


def gap_steps(gaps: DataFrame) -> DataFrame:
    """Declared gaps as steps in a fixed order, with their number."""
    from evenkeel.operators.evidence import ranked_by

    kind = F.when(F.col("gap") == "missing-table", 1).when(F.col("gap") == "missing-column", 2).otherwise(3)
    return ranked_by(gaps.withColumn("kind", kind), ["kind", "table", "column"]).withColumn("step", F.col("rank") + 1).drop("rank", "kind")


def physical_schema(mapped: DataFrame, extensions: DataFrame, overlays: DataFrame) -> DataFrame:
    """The columns that a target must have: those of mapped tables, of target-only tables, and overlays behind their tables."""
    last = mapped.groupBy("table").agg(F.max("ordinal").alias("last"))
    behind = overlays.join(last, "table").withColumn("ordinal", F.col("ordinal") + F.col("last")).drop("last")
    return mapped.unionByName(extensions).unionByName(behind.select(*mapped.columns))
