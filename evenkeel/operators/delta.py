"""Planning and resolving the changes that turn a target table into its source.

A plan holds only keys and hashes. Both sides are cut down to these before they
are joined, so payload columns are never shuffled for planning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.canonical import fingerprints, key_hash, row_hash
from evenkeel.operators.violations import violation
from evenkeel.plans.table_plan import TablePlan, require_key, spark_type

OPERATION = ["kind", "key_sha256", "source_row_sha256", "target_row_sha256"]


def typed_keys(df: DataFrame, plan: TablePlan) -> DataFrame:
    """Cast the key columns to the plan's types, so that equal numbers of different widths meet."""
    return df.withColumns({k: F.col(f"`{k}`").cast(spark_type(plan.column(k).type)) for k in require_key(plan)})


def null_keys(df: DataFrame, plan: TablePlan) -> DataFrame:
    """Rows in which a key column is null."""
    any_null = F.lit(False)
    for k in require_key(plan):
        any_null = any_null | F.col(f"`{k}`").isNull()
    return df.where(any_null)


def duplicate_keys(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """The values that stand in more than one row, with their number."""
    return df.groupBy(*[f"`{c}`" for c in columns]).agg(F.count("*").alias("n")).where("n > 1")


def key_violations(df: DataFrame, plan: TablePlan, side: str) -> DataFrame:
    """Null and repeated keys of one side, a row for each code."""
    nulls = null_keys(df, plan).agg(F.count("*").alias("n")).where("n > 0")
    repeated = duplicate_keys(df, require_key(plan)).agg(F.count("*").alias("n")).where("n > 0")
    out = nulls.select(*violation(plan.name, "key", "delta_primary_key_null", F.lit(0), F.col("n"), F.lit(side)))
    return out.unionByName(repeated.select(*violation(plan.name, "key", "delta_duplicate_key", F.lit(0), F.col("n"), F.lit(side))))


def _kind(source: Column, target: Column) -> Column:
    return (
        F.when(target.isNull(), "insert")
        .when(source.isNull(), "delete")
        .when(source != target, "update")
        .otherwise("unchanged")
    )


def compare_tables(source: DataFrame, target: DataFrame, plan: TablePlan) -> DataFrame:
    """Every key of either side with its hashes and kind, unchanged rows included; a null or repeated key stops the job.

    Keys and row hashes as bytes are all that is exchanged; the key's hash follows from the key after the join.
    """
    keys = list(require_key(plan))
    prints = lambda df, side: _sound(typed_keys(df, plan).select(*[f"`{k}`" for k in keys], F.unhex(row_hash(plan.columns)).alias("row_sha256")), plan, side)
    s = prints(source, "source").withColumnRenamed("row_sha256", "__source_row")
    t = prints(target, "target").withColumnRenamed("row_sha256", "__target_row")
    both, text = s.join(t, keys, "full_outer"), lambda c: F.lower(F.hex(c))
    return both.select(
        *[f"`{k}`" for k in keys], _kind(F.col("__source_row"), F.col("__target_row")).alias("kind"), key_hash(plan).alias("key_sha256"),
        text("__source_row").alias("source_row_sha256"), text("__target_row").alias("target_row_sha256"),
    )


def _sound(prints: DataFrame, plan: TablePlan, side: str) -> DataFrame:
    """Fingerprints whose keys are filled and unique. Rows are counted by key in the exchange and sort that the join needs anyway."""
    keys, filled = [F.col(f"`{k}`") for k in require_key(plan)], F.lit(True)
    for k in keys:
        filled = filled & k.isNotNull()
    n = F.count("*").over(Window.partitionBy(*keys))
    bad = F.when(~filled, F.raise_error(F.lit(f"delta_primary_key_null: {plan.name}, {side}"))).when(F.col("__n") > 1, F.raise_error(F.lit(f"delta_duplicate_key: {plan.name}, {side}")))
    return prints.withColumn("__n", n).withColumn("row_sha256", F.coalesce(bad.cast(prints.schema["row_sha256"].dataType), "row_sha256")).drop("__n")


def compare_fingerprints(source: DataFrame, target: DataFrame, plan: TablePlan) -> DataFrame:
    """``compare_tables`` of fingerprints: keys with the hashes of key and row."""
    keys = list(require_key(plan))
    s = _sound(source, plan, "source").withColumnsRenamed({"key_sha256": "__sk", "row_sha256": "source_row_sha256"})
    t = _sound(target, plan, "target").withColumnsRenamed({"key_sha256": "__tk", "row_sha256": "target_row_sha256"})
    both = s.join(t, keys, "full_outer")
    kind = _kind(F.col("source_row_sha256"), F.col("target_row_sha256"))
    return both.select(*[f"`{k}`" for k in keys], kind.alias("kind"), F.coalesce("__sk", "__tk").alias("key_sha256"), "source_row_sha256", "target_row_sha256")


def plan_delta(source: DataFrame, target: DataFrame, plan: TablePlan) -> DataFrame:
    """The operations: key columns, kind, key_sha256, source_row_sha256, target_row_sha256. Unchanged rows have none.

    A plan is not made over null or repeated keys: the job ends with ``delta_primary_key_null`` or ``delta_duplicate_key``.
    """
    return compare_tables(source, target, plan).where("kind <> 'unchanged'")


def delta_counts(compared: DataFrame, table: str) -> DataFrame:
    """One row: table, inserts, updates, deletes, unchanged."""
    counts = [F.count_if(F.col("kind") == k).alias(n) for k, n in (("insert", "inserts"), ("update", "updates"), ("delete", "deletes"), ("unchanged", "unchanged"))]
    return compared.agg(*counts).select(F.lit(table).alias("table"), "*")


def changed_first(counts: DataFrame) -> DataFrame:
    """Tables or databases with most changes first."""
    return counts.withColumn("changes", F.col("inserts") + F.col("updates") + F.col("deletes")).orderBy(F.desc("changes"), "table")


def operation_json(domain: str = "evenkeel-operation") -> Column:
    """An operation as JSON with keys in order; absent hashes are null."""
    return F.concat(
        F.lit(f'{{"Domain":"{domain}","KeySha256":"'), F.col("key_sha256"), F.lit('","Kind":"'), F.col("kind"), F.lit('","SourceRowSha256":'),
        F.coalesce(F.concat(F.lit('"'), F.col("source_row_sha256"), F.lit('"')), F.lit("null")), F.lit(',"TargetRowSha256":'),
        F.coalesce(F.concat(F.lit('"'), F.col("target_row_sha256"), F.lit('"')), F.lit("null")), F.lit("}"),
    )


def operations_hash(ops: DataFrame) -> DataFrame:
    """One row, ``operations_sha256``: the hash of the operations' hashes in key order.

    Operations are hashed by runs of equal first five digits of their key hash,
    runs by their first two, and these 256 together: key hashes are spread
    evenly, so a run holds a millionth of the operations.
    """

    def joined(df: DataFrame, group: list[str], order: str, value: str, name: str) -> DataFrame:
        shown = (lambda x: F.lower(F.hex(x[value]))) if value == "h" else (lambda x: x[value])  # hashes of operations travel as bytes
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), shown), "\n")
        return df.groupBy(*group).agg(F.sha2(text, 256).alias(name))

    one = ops.select(F.substring("key_sha256", 1, 5).alias("run"), "key_sha256", F.unhex(F.sha2(operation_json(), 256)).alias("h"))
    runs = joined(one, ["run"], "key_sha256", "h", "d").withColumn("part", F.substring("run", 1, 2))
    return joined(joined(runs, ["part"], "run", "d", "e"), [], "part", "e", "operations_sha256")


def operations_sha256(ops: Mapping[str, DataFrame]) -> str:
    """One hash of the operations of a database's tables: of ``table:hash`` in order, joined by ``|``."""
    lines = [f"{name}:{operations_hash(df).first()['operations_sha256']}" for name, df in ops.items()]  # a hash for each table
    return hashlib.sha256("|".join(sorted(lines)).encode()).hexdigest()


def shape_violations(ops: DataFrame, table: str) -> DataFrame:
    """Operations whose hashes are not those of their kind, or are not hashes."""
    hashed = lambda c: F.coalesce(F.col(c).rlike("^[0-9a-f]{64}$"), F.lit(False))
    s, t = F.col("source_row_sha256"), F.col("target_row_sha256")
    good = (
        F.when(F.col("kind") == "insert", hashed("source_row_sha256") & t.isNull())
        .when(F.col("kind") == "update", hashed("source_row_sha256") & hashed("target_row_sha256") & (s != t))
        .when(F.col("kind") == "delete", s.isNull() & hashed("target_row_sha256"))
        .otherwise(False)
    )
    bad = ops.where(~(hashed("key_sha256") & F.coalesce(good, F.lit(False))))
    return bad.select(*violation(table, "operation-shape", "delta_operation_invalid", None, F.col("kind"), F.col("key_sha256")))


def resolve_ops(ops: DataFrame, source: DataFrame, target: DataFrame, plan: TablePlan) -> tuple[DataFrame, DataFrame]:
    """Match planned operations with the tables as they are now.

    Returns the operations that still hold, and violations: a planned operation
    that no longer applies, one whose kind or rows changed, and a change that
    was not planned.
    """
    now = plan_delta(source, target, plan).select(*[F.col(c).alias(f"now_{c}") for c in OPERATION])
    both = ops.select(*OPERATION).join(now, F.col("key_sha256") == F.col("now_key_sha256"), "full_outer")
    code = (
        F.when(F.col("now_kind").isNull(), "delta_operation_unused")
        .when(F.col("kind").isNull(), "delta_change_unplanned")
        .when(F.col("kind") != F.col("now_kind"), "delta_operation_kind_mismatch")
        .when(~F.col("source_row_sha256").eqNullSafe(F.col("now_source_row_sha256")), "canonical_delta_source_row_drift")
        .when(~F.col("target_row_sha256").eqNullSafe(F.col("now_target_row_sha256")), "canonical_delta_target_row_drift")
    )
    both = both.withColumn("code", code)
    bad = both.where("code is not null").select(
        F.lit(plan.name).alias("table"), F.lit("resolve").alias("check"), "code", F.col("kind").alias("expected"),
        F.col("now_kind").alias("observed"), F.coalesce("key_sha256", "now_key_sha256").alias("field"),
    )
    return both.where("code is null").select(*OPERATION), bad


def resolve_captured(ops: DataFrame, captured: DataFrame, target: DataFrame, plan: TablePlan) -> tuple[DataFrame, DataFrame]:
    """Like ``resolve_ops`` with captured source rows, which later source changes do not touch.

    The target is checked first; a planned insert that is already there, and a
    planned change of a row that is no longer as planned, is drift.
    """
    c = captured.select(key_hash(plan).alias("c_key"), row_hash(plan.columns).alias("c_row"))
    t = target.select(key_hash(plan).alias("t_key"), row_hash(plan.columns).alias("t_row"))
    o = ops.select(*OPERATION)
    both = o.join(t, F.col("key_sha256") == F.col("t_key"), "left").join(c, F.col("key_sha256") == F.col("c_key"), "full_outer")
    code = (
        F.when(F.col("kind").isNull(), "delta_capture_row_unplanned")
        .when(~F.col("target_row_sha256").eqNullSafe(F.col("t_row")), "delta_capture_target_drift")
        .when((F.col("kind") != "delete") & F.col("c_row").isNull(), "delta_capture_row_missing")
        .when((F.col("kind") == "delete") & F.col("c_row").isNotNull(), "delta_capture_row_unplanned")
        .when(~F.col("source_row_sha256").eqNullSafe(F.col("c_row")), "delta_capture_row_drift")
    )
    both = both.withColumn("code", code)
    bad = both.where("code is not null").select(
        F.lit(plan.name).alias("table"), F.lit("resolve").alias("check"), "code", F.col("kind").alias("expected"),
        F.lit(None).cast("string").alias("observed"), F.coalesce("key_sha256", "c_key").alias("field"),
    )
    return both.where("code is null").select(*OPERATION), bad


def select_planned(source: DataFrame, ops: DataFrame, plan: TablePlan) -> tuple[DataFrame, DataFrame]:
    """The source rows that an insert or update writes, and violations where a row is gone or not as planned."""
    wanted = ops.where("kind <> 'delete'").select("key_sha256", "source_row_sha256")
    rows = source.withColumns({"__key": key_hash(plan), "__row": row_hash(plan.columns)})
    picked = rows.join(wanted.select(F.col("key_sha256").alias("__key")), "__key", "left_semi").select(*source.columns)
    checked = wanted.join(rows.select(F.col("__key").alias("key_sha256"), "__row"), "key_sha256", "left")
    bad = checked.where(~F.col("source_row_sha256").eqNullSafe(F.col("__row")))
    return picked, bad.select(*violation(plan.name, "capture", "canonical_delta_source_row_drift", F.col("source_row_sha256"), F.col("__row"), F.col("key_sha256")))


def survivors(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not among those that are deleted or archived."""
    return df.join(gone.select(*keys).distinct(), keys, "left_anti")


def adopt(source: DataFrame, existing: DataFrame, id_col: str, key_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Match event rows by id and by event key: (rows to insert, replayed rows, conflicts with their code).

    The same row is a replay; a new id with a new key is inserted. A known key
    with other content or another id, an id that another key has, and an
    existing row that the source lacks are conflicts.
    """
    names = source.columns
    s = source.select(F.struct(*names).alias("s"), F.col(id_col).alias("__id"), F.col(key_col).alias("__key"))
    e = existing.select(*names)
    by_key = e.select(F.struct(*names).alias("by_key"), F.col(key_col).alias("__key"))
    by_id = e.select(F.col(key_col).alias("id_key"), F.col(id_col).alias("__id"))
    matched = s.join(by_key, "__key", "left").join(by_id, "__id", "left")
    code = (
        F.when(F.col("by_key").isNotNull() & F.col("by_key").eqNullSafe(F.col("s")), "replay")
        .when(F.col("by_key").isNotNull(), "event_row_changed")
        .when(F.col("id_key").isNotNull(), "event_id_taken")
        .otherwise("insert")
    )
    matched = matched.select("s.*", code.alias("code"))
    gone = e.join(source.select(key_col), key_col, "left_anti").select(*names, F.lit("event_row_absent").alias("code"))
    conflicts = matched.where("code not in ('insert', 'replay')").unionByName(gone)
    return matched.where("code = 'insert'").drop("code"), matched.where("code = 'replay'").drop("code"), conflicts


def partition_drift(declared: DataFrame, inserts: DataFrame, replays: DataFrame, id_col: str, table: str) -> DataFrame:
    """Violations where the declared partition of an adoption (id, ``part``: insert or replay) is not the observed one, a row for each id."""
    seen = inserts.select(F.col(id_col).alias("__id"), F.lit("insert").alias("seen")).unionAll(replays.select(id_col, F.lit("replay")))
    both = declared.select(F.col(id_col).alias("__id"), "part").join(seen, "__id", "full_outer").where(~F.col("part").eqNullSafe(F.col("seen")))
    return both.select(*violation(table, "adoption", "adoption_partition_drift", F.col("part"), F.col("seen"), F.col("__id")))


def partition_by_keys(df: DataFrame, keys: DataFrame, plan: TablePlan) -> tuple[DataFrame, DataFrame]:
    """Rows whose key hash is among ``keys`` (key_sha256), and the others."""
    rows = df.withColumn("key_sha256", key_hash(plan))
    keys = keys.select("key_sha256").distinct()
    return rows.join(keys, "key_sha256", "left_semi").select(*df.columns), rows.join(keys, "key_sha256", "left_anti").select(*df.columns)


def deletes_refused(counts: DataFrame) -> DataFrame:
    """Violations of a plan that may not delete."""
    return counts.where("deletes > 0").select(*violation(F.col("table"), "zero-delete", "delta_delete_refused", F.lit(0), F.col("deletes")))
