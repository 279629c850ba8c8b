"""Checks of rows and of audit tables; what is broken comes back as violation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canonical import order_key
from evenkeel.functions.scalars import row_size
from evenkeel.operators.ordered import with_previous, with_running
from evenkeel.operators.violations import ContractError, empty, violation
from evenkeel.plans.table_plan import ForeignKey, TablePlan, Unique

# The longest large values in bytes.
MOST_BINARY, MOST_TEXT, MOST_ON_TARGET = 1_000_000_000, 500_000_000, 1_000_000_000


def check_shape(df: DataFrame, plan: TablePlan) -> None:
    """The columns must be those of the plan, no more and no fewer."""
    if sorted(df.columns) != sorted(plan.names):
        raise ContractError({"delta_row_shape_invalid": 1})


def require_empty(df: DataFrame, plan: TablePlan) -> None:
    """A table that the plan knows as empty must be empty."""
    if plan.known_empty and not df.isEmpty():
        raise ContractError({"source_empty_table_drift": 1})


def require_at_most(df: DataFrame, n: int, code: str = "row_limit_exceeded") -> DataFrame:
    """``df``, if it has no more than ``n`` rows; one row more than that is read."""
    if df.limit(n + 1).count() > n:
        raise ContractError({code: n + 1})
    return df


def fk_orphans(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Child rows whose key is filled in all columns and has no parent."""
    filled = child.dropna(how="any", subset=list(fk.columns))
    on = [F.col(f"__c.`{c}`") == F.col(f"__p.`{p}`") for c, p in zip(fk.columns, fk.parent_columns, strict=True)]
    return filled.alias("__c").join(parent.select(*fk.parent_columns).distinct().alias("__p"), on, "left_anti")


def fk_relationships(child: DataFrame, fk: ForeignKey) -> DataFrame:
    """One row, ``n``: child rows whose key is filled in all columns."""
    return child.dropna(how="any", subset=list(fk.columns)).agg(F.count("*").alias("n"))


def check_violations(df: DataFrame, name: str, expression: str) -> DataFrame:
    """Rows for which a check is false; a check that is null holds."""
    return df.where(~F.coalesce(F.expr(expression), F.lit(True))).withColumn("check_name", F.lit(name))


def not_null_violations(df: DataFrame, plan: TablePlan) -> DataFrame:
    """Columns that may not be null and are, with the number of rows; one pass."""
    names = [c.name for c in plan.columns if not c.nullable]
    if not names:
        return empty(df.sparkSession)
    one = df.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(f"n{i}") for i, n in enumerate(names)])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"n{i}").alias("n")) for i, n in enumerate(names)]))
    return one.select(each.alias("x")).where("x.n > 0").select(*violation(plan.name, "not-null", "not_null_violation", F.lit(0), F.col("x.n"), F.col("x.field")))


def generated_violations(df: DataFrame, plan: TablePlan) -> DataFrame:
    """Rows in which a stored generated column is not what its expression gives."""
    wrong = F.lit(False)
    for c in plan.columns:
        if c.generated:
            wrong = wrong | ~F.col(f"`{c.name}`").eqNullSafe(F.expr(c.generated))
    return df.where(wrong)


def unique_violations(df: DataFrame, unique: Unique) -> DataFrame:
    """Values that stand more than once: nulls are equal unless the constraint tells them apart."""
    rows = df if unique.predicate is None else df.where(unique.predicate)
    if unique.nulls_distinct:
        rows = rows.dropna(how="any", subset=list(unique.columns))
    strings = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    keys = [F.lower(f"`{c}`").alias(c) if unique.case_insensitive and c in strings else F.col(f"`{c}`") for c in unique.columns]
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def collated(c: Column, collation: str = "UNICODE_CI") -> Column:
    return F.collate(c, collation)


def collation_collisions(df: DataFrame, column: str, collation: str = "UNICODE_CI") -> DataFrame:
    """Values that differ in bytes and are equal under a collation: the smallest of them, how many, and in how many rows."""
    spelled = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    groups = spelled.groupBy(collated(F.col(column), collation).alias("c")).agg(
        F.min(column).alias("value"), F.count("*").alias("spellings"), F.sum("rows").alias("rows")
    )
    return groups.where("spellings > 1").select("value", "spellings", "rows")


def width_violations(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Rows in which a fixed-width text has another number of characters; null is no violation."""
    wrong = F.lit(False)
    for c, n in widths.items():
        wrong = wrong | F.coalesce(F.char_length(f"`{c}`") != n, F.lit(False))
    return df.where(wrong)


def lob_violations(df: DataFrame, plan: TablePlan, planned: dict[str, int]) -> DataFrame:
    """Large columns whose longest value is beyond a limit: of its kind, of the plan, or of the target."""
    names = [c for c in plan.columns if c.large]
    longest = df.agg(*[F.coalesce(F.max(F.octet_length(f"`{c.name}`")), F.lit(0)).cast("bigint").alias(f"n{i}") for i, c in enumerate(names)])
    each = []
    for i, c in enumerate(names):
        binary = c.type == "bytea"
        most = min(MOST_BINARY if binary else 2 * MOST_TEXT, planned.get(c.name, MOST_BINARY) * (1 if binary else 2), MOST_ON_TARGET)
        each.append(F.struct(F.lit(c.name).alias("field"), F.col(f"n{i}").alias("n"), F.lit(most).cast("bigint").alias("most")))
    out = longest.select(F.explode(F.array(*each)).alias("x")).where("x.n > x.most")
    return out.select(*violation(plan.name, "lob-bound", "source_lob_bound_exceeded", F.col("x.most"), F.col("x.n"), F.col("x.field")))


def oversize_rows(df: DataFrame, plan: TablePlan, limit: int) -> DataFrame:
    """Rows whose estimated size is over ``limit``."""
    return df.withColumn("row_bytes", row_size(list(plan.columns))).where(F.col("row_bytes") > limit)


def array_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows whose array holds a null."""
    return df.where(F.exists(F.col(f"`{column}`"), lambda x: x.isNull()))


def coverage(observed: DataFrame, expected: DataFrame, name: str) -> DataFrame:
    """Names that are missing, unexpected or repeated: name, state, n."""
    seen = observed.groupBy(name).agg(F.count("*").alias("n"))
    both = seen.join(expected.select(name).distinct().withColumn("__wanted", F.lit(True)), name, "full_outer")
    state = F.when(F.col("n").isNull(), "missing").when(F.col("__wanted").isNull(), "unexpected").when(F.col("n") > 1, "duplicate")
    return both.withColumn("state", state).where("state is not null").select(name, "state", F.coalesce("n", F.lit(0)).alias("n"))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, repeats counted, with their side; empty if both are equal."""
    right = right.select(*left.columns)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionAll(right.exceptAll(left).withColumn("side", F.lit("right")))


def key_order_violations(df: DataFrame, ordinal: str, keys: list[str], run: list[str]) -> DataFrame:
    """Rows of inputs with an ordinal whose key does not rise: equal keys are duplicates, lower ones out of order.

    ``run`` names the columns that tell inputs (files, logs, their parts) apart, none for a single one. Text is
    ordered by UTF-16 code units.
    """
    own = {f"__key{i}": order_key(F.col(f"`{k}`"), df.schema[k].dataType.simpleString()) for i, k in enumerate(keys)}
    key, before = F.struct(*own), F.col("__before")
    code = F.when(before == key, "delta_duplicate_key").when(before > key, "delta_key_order_invalid")
    return with_previous(df.withColumns(own), run, ordinal, list(own), "__before").withColumn("code", code).where("code is not null").drop("__before", *own)


def read_window_violations(windows: DataFrame, run: list[str], ordinal: str = "ordinal", start: str = "started_at", end: str = "completed_at", low: str = "run_started_at", high: str = "run_completed_at") -> DataFrame:
    """Read windows that end before they start, overlap the one before, or leave their run's interval."""
    code = (
        F.when(F.col(end) < F.col(start), "read_window_invalid")
        .when(F.col("__before")[end] > F.col(start), "read_window_overlap")
        .when((F.col(start) < F.col(low)) | (F.col(end) > F.col(high)), "read_window_outside")
    )
    return with_previous(windows, run, ordinal, [end], "__before").withColumn("code", code).where("code is not null").drop("__before")


def op_order_violations(log: DataFrame, run: list[str], ordinal: str, rank: str, kind: str = "kind") -> DataFrame:
    """Operations out of foreign-key order: ranks must not fall for upserts, nor rise for deletes."""
    delete = F.col(kind) == "delete"
    signed = F.when(delete, -F.col(rank)).otherwise(F.col(rank))  # either way it must not fall
    scanned = with_running(log.withColumn("__delete", delete), [*run, "__delete"], ordinal, signed, "max", "__most")
    return scanned.where(F.col("__most") > signed).drop("__most", "__delete")


def first_by_priority(found: DataFrame, group: list[str], code: str = "code", priority: str = "priority") -> DataFrame:
    """Of each group's broken rules the one of lowest priority number."""
    return found.groupBy(*group).agg(F.min_by(code, F.struct(priority, code)).alias(code), F.min(priority).alias(priority))


def chain_violations(records: DataFrame, chain: list[str], ordinal: str, own: str, previous: str) -> DataFrame:
    """Records that do not carry the hash of the record before, or whose ordinals have a gap; the first carries none or zeros."""
    before, at = F.col("__before")[own], F.col("__before")[ordinal]
    none = F.col(previous).isNull() | F.col(previous).rlike("^0+$")
    code = (
        F.when(at.isNull() & ((F.col(ordinal) != 1) | ~none), "chain_start_invalid")
        .when(at.isNotNull() & (F.col(ordinal) != at + 1), "chain_ordinal_gap")
        .when(at.isNotNull() & ~F.col(previous).eqNullSafe(before), "chain_link_broken")
    )
    return with_previous(records, chain, ordinal, [own, ordinal], "__before").withColumn("code", code).where("code is not null").drop("__before")


def prefix_violations(states: DataFrame, run: list[str], ordinal: str, applied: str = "applied") -> DataFrame:
    """Rows that are not applied while a later one of their run is."""
    scanned = with_running(states, run, ordinal, F.col(applied).cast("int"), "max", "__later", following=True)
    return scanned.where((F.col("__later") == 1) & ~F.col(applied)).drop("__later")


def sequence_next(states: DataFrame) -> DataFrame:
    """Add ``next_value``: the current value, plus the increment if it was handed out."""
    return states.withColumn("next_value", F.when(F.col("is_called"), F.col("current") + F.col("increment")).otherwise(F.col("current")))


def identity_floor(df: DataFrame, column: str, next_value: int, table: str) -> DataFrame:
    """A violation if the next identity value is not above all that are used."""
    low = df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("bigint").alias("low")).where(F.col("low") > next_value)
    return low.select(*violation(table, "identity", "identity_next_value_too_low", F.col("low"), F.lit(next_value), F.lit(column)))


def artifact_violations(manifest: DataFrame, name_pattern: str = r"^[A-Za-z0-9._-]+$") -> DataFrame:
    """Backup artifacts that are not full, badly named, empty, or whose hashes are malformed or differ."""
    good = lambda c: F.coalesce(F.col(c).rlike("^[0-9a-f]{64}$"), F.lit(False))
    code = (
        F.when(~F.col("backup_type").eqNullSafe("full"), "artifact_not_full")
        .when(~F.coalesce(F.col("file_name").rlike(name_pattern), F.lit(False)), "artifact_name_invalid")
        .when(~F.coalesce(F.col("byte_length") > 0, F.lit(False)), "artifact_empty")
        .when(~good("sha256") | ~good("observed_sha256"), "artifact_hash_malformed")
        .when(F.col("sha256") != F.col("observed_sha256"), "artifact_hash_mismatch")
        .when(F.col("cloud_sha256").isNotNull() & (F.col("cloud_sha256") != F.col("sha256")), "artifact_cloud_mismatch")
    )
    return manifest.withColumn("code", code).where("code is not null")


def capture_times(artifacts: DataFrame, run: list[str]) -> DataFrame:
    """For each run: the capture time (the last completion), and artifacts completed outside [observed_at, captured_at]."""
    outside = (F.col("completed_at") < F.col("observed_at")) | (F.col("completed_at") > F.col("captured_at"))
    return artifacts.groupBy(*run).agg(F.max("completed_at").alias("capture_time"), F.count_if(outside).alias("outside"))
