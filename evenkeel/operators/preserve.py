"""Proofs that a change touched only what it was allowed to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.operators.evidence import relation_digest, stored
from evenkeel.operators.violations import violation


def occurrence_facts(facts: DataFrame, columns: list[str]) -> DataFrame:
    """Number equal facts 1, 2, 3 ..., so that a table of facts with repeats has a key.

    Rows are numbered within each partition, behind the counts of earlier ones,
    so a value that many rows share is not one task.
    """
    parts = stored(facts.withColumn("__part", F.spark_partition_id()), "facts")
    counts = parts.groupBy(*columns, "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*columns).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(columns)], F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy(*columns, "__part").orderBy(*columns))
    same = F.col("__part") == F.col("__p")
    for i, c in enumerate(columns):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"__{i}"))
    numbered = parts.withColumn("__in", within).join(starts, same)
    return numbered.withColumn("occurrence", (F.col("__start") + F.col("__in")).cast("int")).select(*facts.columns, "occurrence")


def preservation_violations(before: DataFrame, after: DataFrame, allowed: DataFrame, keys: list[str], object_col: str) -> DataFrame:
    """Old facts (keys, sha256) that are gone or changed, and new ones whose object is not ``allowed``."""
    b = before.select(*keys, object_col, F.col("sha256").alias("b_sha"))
    a = after.select(*keys, F.col(object_col).alias("a_object"), F.col("sha256").alias("a_sha"))
    both = b.join(a, keys, "full_outer").withColumn(object_col, F.coalesce(object_col, "a_object"))
    both = both.join(allowed.select(F.col(object_col)).distinct().withColumn("allowed", F.lit(True)), object_col, "left")
    code = (
        F.when(F.col("a_sha").isNull(), "fact_removed")
        .when(F.col("b_sha").isNull() & F.col("allowed").isNull(), "fact_added")
        .when(F.col("b_sha").isNotNull() & (F.col("a_sha") != F.col("b_sha")), "fact_changed")
    )
    return both.withColumn("code", code).where("code is not null").select(*keys, object_col, "code")


def relation_violations(before: DataFrame, after: DataFrame, new_and_empty: DataFrame) -> DataFrame:
    """Relations (name, rows, sha256) that changed; new ones must be named and empty."""
    b = before.select("name", F.col("rows").alias("b_rows"), F.col("sha256").alias("b_sha"))
    a = after.select("name", F.col("rows").alias("a_rows"), F.col("sha256").alias("a_sha"))
    named = new_and_empty.select("name").distinct().withColumn("named", F.lit(True))
    both = b.join(a, "name", "full_outer").join(named, "name", "left")
    code = (
        F.when(F.col("a_sha").isNull(), "relation_removed")
        .when(F.col("b_sha").isNull() & F.col("named").isNull(), "relation_added")
        .when(F.col("b_sha").isNull() & (F.col("a_rows") > 0), "relation_new_not_empty")
        .when((F.col("a_sha") != F.col("b_sha")) | (F.col("a_rows") != F.col("b_rows")), "relation_changed")
    )
    both = both.withColumn("code", code).where("code is not null")
    return both.select("name", "code", "b_rows", "a_rows")


def additive_violations(before: DataFrame, after: DataFrame, table: str, added: list[str]) -> DataFrame:
    """A widened table must have its old columns' digest and rows, and only nulls in the new columns."""
    old = relation_digest(before).select(F.col("rows").alias("b_rows"), F.col("sha256").alias("b_sha"))
    new = relation_digest(after.select(*before.columns)).select(F.col("rows").alias("a_rows"), F.col("sha256").alias("a_sha"))
    filled = after.agg(*[F.count_if(F.col(f"`{c}`").isNotNull()).alias(f"f{i}") for i, c in enumerate(added)])
    total = F.lit(0)
    for i in range(len(added)):
        total = total + F.col(f"f{i}")
    one = old.crossJoin(F.broadcast(new)).crossJoin(F.broadcast(filled))  # one row each
    code = F.when(F.col("a_rows") != F.col("b_rows"), "additive_rows_changed").when(F.col("a_sha") != F.col("b_sha"), "additive_content_changed").when(total > 0, "additive_column_not_null")
    return one.withColumn("code", code).where("code is not null").select(F.lit(table).alias("table"), "code")


def emptied_only(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """Violations unless exactly the named relation was emptied and all others are as they were."""
    b = before.select("name", F.col("rows").alias("b_rows"), F.col("sha256").alias("b_sha"))
    a = after.select("name", F.col("rows").alias("a_rows"), F.col("sha256").alias("a_sha"))
    both = b.join(a, "name", "full_outer")
    code = F.when((F.col("name") == name) & ~F.coalesce(F.col("a_rows") == 0, F.lit(False)), "relation_not_emptied").when(
        (F.col("name") != name) & ~(F.col("a_sha").eqNullSafe(F.col("b_sha")) & F.col("a_rows").eqNullSafe(F.col("b_rows"))), "relation_changed"
    )
    return both.withColumn("code", code).where("code is not null").select("name", "code")


def compare_targets(first: DataFrame, second: DataFrame, equal: list[str], empty: list[str]) -> DataFrame:
    """Relations that must be equal on two targets and differ, and ones that must be empty on the second and are not."""
    a = first.select("name", F.col("sha256").alias("a_sha"))
    b = second.select("name", F.col("sha256").alias("b_sha"), "rows")
    both = a.join(b, "name", "full_outer")
    code = F.when(F.col("name").isin(*equal) & ~F.col("a_sha").eqNullSafe(F.col("b_sha")), "targets_differ").when(
        F.col("name").isin(*empty) & ~F.coalesce(F.col("rows") == 0, F.lit(False)), "target_not_empty"
    )
    return both.withColumn("code", code).where("code is not null").select("name", "code")


def paired_ops(first: DataFrame, second: DataFrame) -> DataFrame:
    """Operations (table, key_sha256 ...) that two targets do not share, with the side that has them."""
    names = [c for c in ("table", "kind", "key_sha256", "source_row_sha256") if c in first.columns]
    a, b = first.select(*names), second.select(*names)
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionAll(b.exceptAll(a).withColumn("side", F.lit("second")))


def overlay_violations(before: DataFrame, after: DataFrame, keys: list[str], columns: dict[str, str | None], planned: int, table: str) -> DataFrame:
    """Overlay columns: existing rows keep their values, inserted ones have the default, and as many are inserted as planned."""
    b = before.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("was"))
    a = after.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("is"))
    both = a.join(b, keys, "left")
    kept, fresh = F.lit(False), F.lit(False)
    for c, default in columns.items():
        kept = kept | ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
        fresh = fresh | ~F.col(f"a_{c}").eqNullSafe(F.lit(default))
    one = both.agg(F.count_if(F.col("was") & kept).alias("changed"), F.count_if(F.col("was").isNull() & fresh).alias("filled"), F.count_if(F.col("was").isNull()).alias("inserted"))
    codes = [("overlay_value_changed", F.col("changed"), 0), ("overlay_default_missing", F.col("filled"), 0), ("overlay_insert_count_mismatch", F.col("inserted"), planned)]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("code"), n.alias("n"), F.lit(m).alias("wanted")) for k, n, m in codes]))
    return one.select(each.alias("x")).where("x.n <> x.wanted").select(F.lit(table).alias("table"), F.lit("overlay").alias("check"), "x.code", F.col("x.wanted").cast("string").alias("expected"), F.col("x.n").cast("string").alias("observed"), F.lit(None).cast("string").alias("field"))


def extension_violations(before: DataFrame, after: DataFrame, required: dict[str, list[str]], mandatory: dict[str, list[str]]) -> DataFrame:
    """Target-only tables: evidence as before, nulls no more than rows, none in required columns, no orphans, mandatory references filled.

    ``before`` and ``after`` are evidence tables with ``orphan_counts``.
    """
    from evenkeel.operators.evidence import compare_evidence

    out = compare_evidence(before, after)
    entries = after.select("table", "row_count", F.explode(F.map_entries("null_counts")).alias("e")).select("table", "row_count", F.col("e.key").alias("field"), F.col("e.value").alias("n"))
    need = F.lit(False)
    for t, columns in required.items():
        need = need | ((F.col("table") == t) & F.col("field").isin(*columns))
    bad = entries.where((F.col("n") > F.col("row_count")) | (need & (F.col("n") > 0)))
    out = out.unionByName(bad.select(*violation(F.col("table"), "null-count", "extension_nulls_invalid", F.lit(0), F.col("n"), F.col("field"))))
    orphans = after.select("table", F.explode(F.map_entries("orphan_counts")).alias("e")).where("e.value > 0")
    out = out.unionByName(orphans.select(*violation(F.col("table"), "orphan", "extension_orphans", F.lit(0), F.col("e.value"), F.col("e.key"))))
    refs = after.select("table", "row_count", F.explode(F.map_entries("relationship_counts")).alias("e"))
    must = F.lit(False)
    for t, names in mandatory.items():
        must = must | ((F.col("table") == t) & F.col("e.key").isin(*names))
    refs = refs.where(must & (F.col("e.value") != F.col("row_count")))
    return out.unionByName(refs.select(*violation(F.col("table"), "relationship", "extension_reference_missing", F.col("row_count"), F.col("e.value"), F.col("e.key"))))
