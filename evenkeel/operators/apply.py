"""Applying planned changes as new table versions, once, and only if both sides are as planned."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.canonical import key_hash, row_hash
from evenkeel.operators.delta import adopt, key_violations, operations_sha256, resolve_ops, survivors
from evenkeel.operators.evidence import compare_evidence, compare_values, database_evidence, table_evidence
from evenkeel.operators.history import database_rollup
from evenkeel.operators.ledger import LEDGER, database_ledger, ledger_evidence, ledger_violations, measures, observed
from evenkeel.operators.storage import stored as kept
from evenkeel.operators.validate import fk_orphans, set_difference
from evenkeel.operators.violations import ContractError, empty, require_none, violation
from evenkeel.plans.table_plan import DatabasePlan, TablePlan, parent_first
from evenkeel.sources.snapshots import current_state, current_versions, publish, read_current, stage

JOURNAL = "database string, plan_id string, plan_sha256 string, operations_sha256 string, evidence_sha256 string, committed_at timestamp"
FENCES = "database string, schema_plan_sha256 string, target_schema_sha256 string, target_generation bigint, target_observation_sha256 string"
LEDGERS = f"database string, plan_id string, {LEDGER}"
SEQUENCES = "database string, table string, column string, next_value bigint"


@dataclass(frozen=True)
class Checkpoint:
    """What a plan for a database is known by, and the state of the target that it was made against."""

    database: str
    plan_id: str
    plan_sha256: str
    operations_sha256: str
    schema_plan_sha256: str
    target_schema_sha256: str
    target_generation: int
    target_observation_sha256: str

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([self.__dict__], f"{FENCES}, plan_id string, plan_sha256 string, operations_sha256 string")


def apply_delta(source: DataFrame, target: DataFrame, ops: DataFrame, plan: TablePlan) -> DataFrame:
    """The target with the operations applied: one join by key hash, as bytes.

    Columns that only the target has keep the values of existing rows and are
    null in inserted ones; generated columns are computed anew.
    """
    extra = [c for c in target.columns if c not in plan.names]
    s = source.select(F.unhex(key_hash(plan)).alias("__key"), F.struct(*[f"`{c}`" for c in plan.names]).alias("__s"))
    t = target.select(F.unhex(key_hash(plan)).alias("__key"), F.struct(*[f"`{c}`" for c in [*plan.names, *extra]]).alias("__t"))
    o = ops.select(F.unhex("key_sha256").alias("__key"), "kind")
    planned = s.join(o.where("kind <> 'delete'"), "__key").select("__key", "__s")
    gone = o.where("kind = 'delete'").select("__key")
    both = t.join(gone, "__key", "left_anti").join(planned, "__key", "full_outer")
    fresh = F.col("__s").isNotNull()
    out = both.select(
        *[F.when(fresh, F.col(f"__s.`{c}`")).otherwise(F.col(f"__t.`{c}`")).alias(c) for c in plan.names],
        *[F.col(f"__t.`{c}`").alias(c) for c in extra],
    )
    return out.withColumns({c.name: F.expr(c.generated) for c in plan.columns if c.generated}) if any(c.generated for c in plan.columns) else out


def applied_counts(ops: DataFrame, before: DataFrame, after: DataFrame, plan: TablePlan) -> DataFrame:
    """Violations where the rows that changed, by kind, are not as many as were planned."""
    b = before.select(key_hash(plan).alias("k"), row_hash(plan.columns).alias("b"))
    a = after.select(key_hash(plan).alias("k"), row_hash(plan.columns).alias("a"))
    done = b.join(a, "k", "full_outer").select(
        F.when(F.col("b").isNull(), "insert").when(F.col("a").isNull(), "delete").when(F.col("a") != F.col("b"), "update").alias("kind")
    )
    done = done.where("kind is not null").groupBy("kind").agg(F.count("*").alias("done"))
    planned = ops.groupBy("kind").agg(F.count("*").alias("planned"))
    wrong = planned.join(done, "kind", "full_outer").where(~F.col("planned").eqNullSafe(F.col("done")))
    return wrong.select(*violation(plan.name, "affected-rows", "canonical_delta_affected_rows_mismatch", F.col("planned"), F.col("done"), F.col("kind")))


def replay_state(journal: DataFrame, plans: DataFrame) -> DataFrame:
    """For each plan (database, plan_id, plan_sha256, operations_sha256): new, replay or conflict.

    A plan is replayed if one journal row has its id, hash and operations; a row
    that shares only some of them, or two rows that match, are a conflict.
    """
    j = journal.select("database", *[F.col(c).alias(f"j_{c}") for c in ("plan_id", "plan_sha256", "operations_sha256")])
    same = (F.col("plan_id") == F.col("j_plan_id")) & (F.col("plan_sha256") == F.col("j_plan_sha256")) & (F.col("operations_sha256") == F.col("j_operations_sha256"))
    # plans meet journal rows of their database by id or by hash: two joins by equality, not one by either
    keys = ["database", "plan_id", "plan_sha256", "operations_sha256"]
    by_id = plans.join(j.withColumn("plan_id", F.col("j_plan_id")), ["database", "plan_id"]).select(*keys, same.alias("same"), "j_plan_id", "j_plan_sha256", "j_operations_sha256")
    by_hash = plans.join(j.withColumn("plan_sha256", F.col("j_plan_sha256")), ["database", "plan_sha256"]).select(*keys, same.alias("same"), "j_plan_id", "j_plan_sha256", "j_operations_sha256")
    matches = by_id.where(F.col("plan_sha256") != F.col("j_plan_sha256")).unionByName(by_hash)
    found = matches.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if("same").alias("n_same"))
    state = F.when(F.col("n").isNull(), "new").when((F.col("n") == 1) & (F.col("n_same") == 1), "replay").otherwise("conflict")
    return plans.join(found, keys, "left").withColumn("state", state).drop("n", "n_same")


def fence_violations(fences: DataFrame, expected: DataFrame) -> DataFrame:
    """Databases whose stored fence is not the one that a plan was made against."""
    names = ["schema_plan_sha256", "target_schema_sha256", "target_generation", "target_observation_sha256"]
    f = fences.select("database", *[F.col(n).alias(f"f_{n}") for n in names])
    wrong = F.lit(False)
    for n in names:
        wrong = wrong | ~F.col(n).eqNullSafe(F.col(f"f_{n}"))
    bad = expected.join(f, "database", "left").where(wrong)
    return bad.select(*violation(F.col("database"), "fence", "canonical_delta_fence_stale", F.col("target_generation"), F.col("f_target_generation")))


def upsert_rows(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same key; of several new ones the last wins."""
    if order:
        best = F.max_by(F.struct(*new.columns), F.col(order))
        new = new.groupBy(*keys).agg(best.alias("__row")).select("__row.*")
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


@dataclass(frozen=True)
class CopyResult:
    folder: str
    rows: int


def _copied(source: DataFrame, plan: TablePlan, root: str) -> tuple[str, DataFrame]:
    """Write a new version in one read of the source; its folder, and the ledger of what was read."""
    stored = plan.without([c for c in plan.names if c not in plan.stored])
    rows, said = observed(source.select(*[f"`{c}`" for c in plan.stored]), stored)
    folder = stage(rows, root, plan.name)
    got = measures(source.sparkSession.read.parquet(f"{root}/{folder}"), stored)
    return folder, ledger_violations(said(), got, "shadow_copy_mismatch")


def copy_table(source: DataFrame, plan: TablePlan, root: str) -> CopyResult:
    """Write all stored columns to a new version and hold what was written against what was read.

    The source is read once, by the write itself, which counts rows, nulls and
    references and adds up row hashes; so a source that changes meanwhile does no
    harm, and the copy is the state that was read.
    """
    folder, bad = _copied(source, plan, root)
    require_none(bad)
    return CopyResult(folder, source.sparkSession.read.parquet(f"{root}/{folder}").count())


def copy_database(spark: SparkSession, source: Mapping[str, DataFrame], db: DatabasePlan, root: str) -> dict[str, CopyResult]:
    """Copy every table in one read, and publish all of them only if each is what was read and no reference lost its parent.

    Tables are read one after the other. Where the source does not give all of
    them as of one moment (see ``read_database``), references between them show
    it: a row without a parent raises ``shadow_copy_orphans``.
    """
    done = {name: copy_table(source[name], plan, root) for name, plan in db.tables.items()}
    tables = {n: spark.read.parquet(f"{root}/{done[n].folder}") for n in db.tables}
    orphans = 0
    for name, plan in db.tables.items():
        orphans += sum(fk_orphans(tables[name], tables[fk.parent], fk).count() for fk in plan.foreign_keys if fk.parent in tables)
    if orphans:
        raise ContractError({"shadow_copy_orphans": orphans})
    publish(spark, root, {n: r.folder for n, r in done.items()})
    return done


def require_keys(source: DataFrame, target: DataFrame, plan: TablePlan) -> None:
    """No null and no repeated key on either side."""
    require_none(key_violations(source, plan, "source").unionByName(key_violations(target, plan, "target")))


def apply_and_publish(source: DataFrame, target: DataFrame, ops: DataFrame, plan: TablePlan, root: str) -> str:
    """Resolve, apply, write a version, compare it with the source, publish; raises and publishes nothing on any drift."""
    spark = source.sparkSession
    base = current_versions(spark, root).get(plan.name)
    require_keys(source, target, plan)
    require_none(resolve_ops(ops, source, target, plan)[1])  # all hold, so they need not be resolved again to be applied
    folder = stage(apply_delta(source, target, ops, plan), root, plan.name)
    written = spark.read.parquet(f"{root}/{folder}")
    require_none(compare_evidence(table_evidence(source, plan), table_evidence(written, plan)))
    publish(spark, root, {plan.name: folder}, {plan.name: base})
    return folder


def write_fence(spark: SparkSession, root: str, checkpoint: Checkpoint) -> None:
    """Store the state of a database's target; of several the last stays."""
    old, base = read_current(spark, root, "_fence", FENCES), current_versions(spark, root).get("_fence")
    new = checkpoint.frame(spark).select(*old.columns)
    publish(spark, root, {"_fence": stage(upsert_rows(old, new, ["database"]).coalesce(1), root, "_fence")}, {"_fence": base})


def evidence_hash(tables: DataFrame) -> str:
    """One hash of the evidence of a database's tables."""
    return tables.withColumn("__all", F.lit(1)).transform(lambda df: database_rollup(df, ["__all"])).first()["content_sha256"]


def aligned_sequences(database: str, tables: Mapping[str, tuple[DataFrame, TablePlan]]) -> DataFrame:
    """``database, table, column, next_value`` of all planned identity columns: above every value in use."""
    out = None
    for name in sorted(tables):
        df, plan = tables[name]
        for i in plan.identities:
            after = F.coalesce(F.max(f"`{i.column}`") + i.increment, F.lit(i.start)) if i.increment > 0 else F.coalesce(F.min(f"`{i.column}`") + i.increment, F.lit(i.start))
            one = df.agg(after.cast("bigint").alias("next_value")).select(F.lit(database).alias("database"), F.lit(name).alias("table"), F.lit(i.column).alias("column"), "next_value")
            out = one if out is None else out.unionByName(one)
    return empty(next(iter(tables.values()))[0].sparkSession, SEQUENCES) if out is None else out


def apply_database(spark: SparkSession, root: str, db: DatabasePlan, sources: Mapping[str, DataFrame], ops: Mapping[str, DataFrame], checkpoint: Checkpoint) -> str:
    """Apply the plan of a whole database once: ``applied``, or ``replayed`` if it was applied before.

    In this order: the operations must be those whose hash the checkpoint holds; a plan of the journal is not applied again, and the target
    must still be what was committed; the stored fence must be that of the plan;
    keys must be filled and unique; operations must still hold; the new tables
    must equal their sources. Only then new tables, sequences, fence and journal
    row become visible, by one pointer, and only if nobody published any of them
    meanwhile. A failed run leaves nothing visible and can be run again.
    """
    _, state = current_state(spark, root)
    versions, own = state["versions"], checkpoint.frame(spark)
    stored = lambda name, schema: spark.read.schema(schema).parquet(f"{root}/{versions[name]}") if name in versions else empty(spark, schema)
    at = lambda name: spark.read.parquet(f"{root}/{versions[name]}")
    journal, fences = stored("_journal", JOURNAL), stored("_fence", FENCES)
    if operations_sha256(ops) != checkpoint.operations_sha256:
        raise ContractError({"canonical_delta_plan_conflict": 1})
    known = replay_state(journal, own.select("database", "plan_id", "plan_sha256", "operations_sha256")).first()["state"]
    if known == "conflict":
        raise ContractError({"canonical_delta_plan_conflict": 1})
    if known == "replay":
        said = journal.where((F.col("plan_sha256") == checkpoint.plan_sha256) & (F.col("database") == checkpoint.database)).first()["evidence_sha256"]
        if evidence_hash(database_evidence({n: (at(n), p) for n, p in db.tables.items()}, orphans=False)) != said:
            raise ContractError({"canonical_delta_replay_target_drift": 1})
        return "replayed"
    require_none(fence_violations(fences, own))
    staged = {}
    for name in parent_first(db.tables):
        plan, target = db.tables[name], at(name)
        require_keys(sources[name], target, plan)
        require_none(resolve_ops(ops[name], sources[name], target, plan)[1])  # all hold, so they need not be resolved again to be applied
        staged[name] = stage(apply_delta(sources[name], target, ops[name], plan), root, name)
    written = {n: (spark.read.parquet(f"{root}/{staged[n]}"), p) for n, p in db.tables.items()}
    found = kept(database_evidence(written).coalesce(1), "evidence")  # a row for each table
    require_none(compare_evidence(database_evidence({n: (sources[n], p) for n, p in db.tables.items()}), found))
    said = evidence_hash(found)
    row = own.select("database", "plan_id", "plan_sha256", "operations_sha256", F.lit(said).alias("evidence_sha256"), F.current_timestamp().alias("committed_at"))
    fence = own.select("database", "schema_plan_sha256", "target_schema_sha256", (F.col("target_generation") + 1).alias("target_generation"), F.lit(said).alias("target_observation_sha256"))
    sequences = upsert_rows(stored("_sequences", SEQUENCES), aligned_sequences(checkpoint.database, written), ["database", "table", "column"])
    ledger = database_ledger(written).select(F.lit(checkpoint.database).alias("database"), F.lit(checkpoint.plan_id).alias("plan_id"), "*")
    ledgers = stored("_ledger", LEDGERS).where(F.col("database") != checkpoint.database).unionByName(ledger)
    for name, df in (("_journal", journal.unionByName(row)), ("_fence", upsert_rows(fences, fence, ["database"])), ("_sequences", sequences), ("_ledger", ledgers)):
        staged[name] = stage(df.coalesce(1), root, name)  # a row for each plan, database, identity column
    publish(spark, root, staged, {n: versions.get(n) for n in staged})
    return "applied"


def reconcile(spark: SparkSession, root: str, db: DatabasePlan, checkpoint: Checkpoint, sources: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Violations of a target against its committed plan, or, with ``sources``, against these.

    A live source goes on after a plan is applied, so bound to the checkpoint
    the committed evidence is what counts: the target's tables are added up and
    held against the ledger that was published with the plan, their evidence
    against the journal's hash, and the sequences against the values in use.
    """
    _, state = current_state(spark, root)
    versions = state["versions"]
    stored = lambda name, schema: spark.read.schema(schema).parquet(f"{root}/{versions[name]}") if name in versions else empty(spark, schema)
    mine = (F.col("database") == checkpoint.database) & (F.col("plan_id") == checkpoint.plan_id)
    said = stored("_journal", JOURNAL).where(mine & (F.col("plan_sha256") == checkpoint.plan_sha256) & (F.col("operations_sha256") == checkpoint.operations_sha256)).first()
    if said is None:
        raise ContractError({"canonical_delta_checkpoint_missing": 1})
    tables = {n: (spark.read.parquet(f"{root}/{versions[n]}"), p) for n, p in db.tables.items()}
    if sources is not None:
        bad = compare_evidence(database_evidence({n: (sources[n], p) for n, p in db.tables.items()}), database_evidence(tables))
    else:
        ledger = kept(database_ledger(tables).coalesce(1), "ledger")  # a few rows for each table; its evidence follows from them
        bad = ledger_violations(stored("_ledger", LEDGERS).where(mine).drop("database", "plan_id"), ledger)
        if evidence_hash(ledger_evidence(ledger)) != said["evidence_sha256"]:
            bad = bad.unionByName(spark.range(1).select(*violation(checkpoint.database, "checkpoint", "canonical_delta_checkpoint_drift", F.lit(said["evidence_sha256"]))))
    key = F.concat_ws(".", "table", "column").alias("name")
    used = aligned_sequences(checkpoint.database, tables).select(key, "next_value")
    held = stored("_sequences", SEQUENCES).where(F.col("database") == checkpoint.database).select(key, "next_value")
    return bad.unionByName(compare_values(held, used, "name", "next_value", "sequence"))


def adopt_and_publish(spark: SparkSession, source: DataFrame, plan: TablePlan, root: str, id_col: str, key_col: str) -> tuple[int, int]:
    """Insert what the table lacks of ``source``, prove the result equal to it, set the next identity; (inserted, replayed)."""
    _, state = current_state(spark, root)
    versions = state["versions"]
    existing = spark.read.parquet(f"{root}/{versions[plan.name]}")
    require_keys(source, existing, plan)
    new, replayed, conflicts = adopt(source, existing, id_col, key_col)
    require_none(conflicts)
    staged = {plan.name: stage(existing.unionByName(new.select(*existing.columns)), root, plan.name)}
    written = spark.read.parquet(f"{root}/{staged[plan.name]}")
    require_none(compare_evidence(table_evidence(source, plan), table_evidence(written, plan)))
    old = read_current(spark, root, "_sequences", SEQUENCES)
    sequences = upsert_rows(old, aligned_sequences("", {plan.name: (written, plan)}), ["database", "table", "column"])
    staged["_sequences"] = stage(sequences.coalesce(1), root, "_sequences")
    publish(spark, root, staged, {n: versions.get(n) for n in staged})
    return written.count() - existing.count(), replayed.count()


def archive_rows(df: DataFrame, predicate: str, keys: list[str], folder: str) -> tuple[DataFrame, DataFrame]:
    """Write the rows that meet ``predicate`` to ``folder``, prove the archive equal to them, and return (archive, survivors).

    ``df`` is read more than once: it must be a table version or a capture, which do not change.
    """
    chosen = df.where(predicate)
    chosen.write.mode("errorifexists").parquet(folder)
    archive = df.sparkSession.read.parquet(folder)
    if not set_difference(chosen, archive).isEmpty():
        raise ContractError({"archive_rows_mismatch": 1})
    return archive, survivors(df, archive, keys)
