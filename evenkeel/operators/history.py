"""Checks over the whole history of runs: journals, plans, manifests, captures and states.

Every function takes tables that hold all runs and gives its findings in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.evidence import sorted_sha256

PLAN = ["plan_id", "plan_sha256"]


def committed(journal: DataFrame, plans: DataFrame) -> DataFrame:
    """The journal's checkpoints of the given plans."""
    return journal.join(plans.select("plan_sha256").distinct(), "plan_sha256", "left_semi")


def checkpoint_violations(plans: DataFrame, journal: DataFrame, evidence: DataFrame) -> DataFrame:
    """``run, database, code``: databases without exactly one checkpoint that agrees with plan and evidence.

    plans: run, database, plan_id, plan_sha256, cutoff, operations_sha256;
    journal: run, database, the same and committed_at, evidence_sha256;
    evidence: run, database, evidence_sha256, reconciled_at.
    """
    keys = ["run", "database"]
    j = journal.groupBy(*keys).agg(F.count("*").alias("n"), F.first(F.struct(*PLAN, "cutoff", "operations_sha256", "evidence_sha256", "committed_at")).alias("j"))
    e = evidence.select(*keys, F.col("evidence_sha256").alias("e_sha"), "reconciled_at")
    both = plans.join(j, keys, "full_outer").join(e, keys, "full_outer")
    micros = lambda c: F.date_trunc("microsecond", c)
    code = (
        F.when(F.col("n").isNull(), "checkpoint_missing")
        .when(F.col("plan_id").isNull(), "checkpoint_unplanned")
        .when(F.col("n") > 1, "checkpoint_duplicate")
        .when((F.col("j.plan_id") != F.col("plan_id")) | (F.col("j.plan_sha256") != F.col("plan_sha256")), "checkpoint_plan_mismatch")
        .when(micros(F.col("j.cutoff")) != micros(F.col("cutoff")), "checkpoint_cutoff_mismatch")
        .when(F.col("j.operations_sha256") != F.col("operations_sha256"), "checkpoint_operations_mismatch")
        .when(F.col("e_sha").isNull() | (F.col("j.evidence_sha256") != F.col("e_sha")), "checkpoint_evidence_mismatch")
        .when(F.col("j.committed_at") > F.col("reconciled_at"), "checkpoint_after_reconciliation")
    )
    return both.withColumn("code", code).where("code is not null").select(*keys, "code")


def receipt_violations(receipts: DataFrame, fences: DataFrame, journal: DataFrame) -> DataFrame:
    """``database, code``: fences and journals that do not agree with one receipt for each database, or go on after it."""
    f = fences.select("database", F.col("target_generation").alias("f_generation"))
    latest = journal.groupBy("database").agg(
        F.max("committed_at").alias("last"), F.count("*").alias("n"), F.count_distinct("plan_sha256").alias("n_sha"), F.count_distinct("plan_id").alias("n_id")
    )
    own = journal.select("database", "plan_sha256", F.col("committed_at").alias("own_commit")).groupBy("database", "plan_sha256").agg(F.max("own_commit").alias("own_commit"))
    both = receipts.join(f, "database", "left").join(latest, "database", "left").join(own, ["database", "plan_sha256"], "left")
    code = (
        F.when(F.col("f_generation").isNull() | (F.col("f_generation") != F.col("target_generation")), "receipt_fence_mismatch")
        .when(F.col("own_commit").isNull(), "receipt_not_committed")
        .when(F.col("last") > F.col("own_commit"), "receipt_later_commit")
        .when((F.col("n_sha") < F.col("n")) | (F.col("n_id") < F.col("n")), "receipt_plan_repeated")
    )
    return both.withColumn("code", code).where("code is not null").select("database", "code")


def counted_operations(ops: DataFrame) -> DataFrame:
    """``run, table, again, n_inserts, n_updates, n_deletes``: the hash and the numbers of each table's operations."""
    keys = ["run", "table"]
    line = F.concat_ws("|", "key_sha256", "kind", F.coalesce("source_row_sha256", F.lit("-")), F.coalesce("target_row_sha256", F.lit("-")))
    # key hashes are spread evenly: a run holds a millionth of a table's operations
    runs = ops.withColumn("run_of", F.substring("key_sha256", 1, 5)).groupBy(*keys, "run_of").agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("d"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}s") for k in ("insert", "update", "delete")],
    )
    runs = runs.groupBy(*keys, F.substring("run_of", 1, 2).alias("part")).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run_of", "d"))), lambda x: x["d"]), "\n"), 256).alias("d"),
        *[F.sum(f"n_{k}s").alias(f"n_{k}s") for k in ("insert", "update", "delete")],
    )
    return runs.groupBy(*keys).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "d"))), lambda x: x["d"]), "\n"), 256).alias("again"),
        *[F.sum(f"n_{k}s").alias(f"n_{k}s") for k in ("insert", "update", "delete")],
    )


def plan_count_violations(declared: DataFrame, ops: DataFrame) -> DataFrame:
    """``run, table, code``: declared counts and hashes (inserts, updates, deletes, operations_sha256) against the operations."""
    keys = ["run", "table"]
    again = counted_operations(ops)
    n_declared = declared.groupBy(*keys).agg(F.count("*").alias("times"))
    both = declared.join(again, keys, "full_outer").join(n_declared, keys, "left")
    differ = F.lit(False)
    for k in ("inserts", "updates", "deletes"):
        differ = differ | (F.coalesce(F.col(f"n_{k}"), F.lit(0)) != F.col(k))
    code = (
        F.when(F.col("times").isNull(), "plan_table_undeclared")
        .when(F.col("times") > 1, "plan_table_repeated")
        .when(differ, "plan_count_mismatch")
        .when(F.col("again").isNotNull() & (F.col("again") != F.col("operations_sha256")), "plan_operations_hash_mismatch")
    )
    return both.withColumn("code", code).where("code is not null").select(*keys, "code").distinct()


def capture_violations(manifests: DataFrame, plans: DataFrame, evidence: DataFrame) -> DataFrame:
    """``run, table, code``: captures whose rows are not those that the plan writes, or whose times and ids are wrong.

    manifests: run, table, capture_id, sha256, rows, captured_at; plans: run,
    table, inserts, updates, unchanged, started_at, completed_at; evidence: run, table, row_count.
    """
    keys = ["run", "table"]
    ids = manifests.groupBy("run", "capture_id").agg(F.count("*").alias("n_id"))
    digests = manifests.groupBy("run", "sha256").agg(F.count("*").alias("n_sha"))
    m = manifests.join(ids, ["run", "capture_id"]).join(digests, ["run", "sha256"])
    both = plans.join(m, keys, "full_outer").join(evidence, keys, "left")
    written = F.col("inserts") + F.col("updates")
    code = (
        F.when(F.col("capture_id").isNull(), "capture_missing")
        .when(F.col("inserts").isNull(), "capture_unplanned")
        .when(F.col("rows") != written, "capture_row_count_mismatch")
        .when(F.col("row_count") != written + F.col("unchanged"), "capture_evidence_mismatch")
        .when((F.col("n_id") > 1) | (F.col("n_sha") > 1), "capture_repeated")
        .when((F.col("captured_at") < F.col("started_at")) | (F.col("captured_at") > F.col("completed_at")), "capture_outside_window")
    )
    return both.withColumn("code", code).where("code is not null").select(*keys, "code")


def shared_captures(first: DataFrame, second: DataFrame) -> DataFrame:
    """Captures (table, capture_id, sha256, rows) that two plans do not share, with their side."""
    names = ["table", "capture_id", "sha256", "rows"]
    a, b = first.select(*names), second.select(*names)
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionAll(b.exceptAll(a).withColumn("side", F.lit("second")))


def mixed_state(preimage: DataFrame, facts: DataFrame, markers: DataFrame) -> DataFrame:
    """``run, database, state``: prior, applied or third.

    Prior: the facts' digest is that of the preimage and there is no marker.
    Applied: marker, checkpoint and reconciliation agree. All else is third.
    """
    keys = ["run", "database"]
    both = preimage.withColumnRenamed("sha256", "p_sha").join(facts.withColumnRenamed("sha256", "f_sha"), keys, "full_outer").join(markers, keys, "left")
    agree = (F.col("marker_sha256") == F.col("checkpoint_sha256")) & (F.col("checkpoint_sha256") == F.col("reconciliation_sha256"))
    state = F.when(F.col("marker_sha256").isNull() & F.col("p_sha").eqNullSafe(F.col("f_sha")), "prior").when(F.coalesce(agree, F.lit(False)), "applied").otherwise("third")
    return both.select(*keys, state.alias("state"))


def metadata_state(databases: DataFrame, fences: DataFrame, journal: DataFrame, plans: DataFrame) -> DataFrame:
    """``database, state``: unprovisioned (no fence), pending (fence of the plan, no commit), replayed (committed), settled-prior (another plan's)."""
    f = fences.select("database", F.col("schema_plan_sha256").alias("fence"))
    p = plans.select("database", F.col("schema_plan_sha256").alias("planned"), "plan_sha256")
    done = journal.select("database", "plan_sha256").distinct().withColumn("done", F.lit(True))
    any_done = journal.select("database").distinct().withColumn("any", F.lit(True))
    both = databases.select("database").join(f, "database", "left").join(p, "database", "left").join(done, ["database", "plan_sha256"], "left").join(any_done, "database", "left")
    state = (
        F.when(F.col("fence").isNull() & F.col("any").isNull(), "unprovisioned")
        .when(F.col("done"), "replayed")
        .when((F.col("fence") == F.col("planned")) & F.col("any").isNull(), "pending")
        .otherwise("settled-prior")
    )
    return both.select("database", state.alias("state"))


def database_rollup(evidence: DataFrame, group: list[str]) -> DataFrame:
    """For each group of evidence rows: tables, rows, and the digest of its tables in order of name."""
    line = F.concat_ws("|", "table", F.col("row_count").cast("string"), F.coalesce("content_sha256", F.lit("-")), "aggregate_sha256")
    return evidence.groupBy(*group).agg(
        F.count("*").alias("tables"), F.sum("row_count").alias("rows"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("content_sha256")
    )


def database_operations_hash(tables: DataFrame, group: list[str]) -> DataFrame:
    """For each group: SHA-256 of ``table:hash`` in order, joined by ``|``."""
    line = F.concat_ws(":", "table", "operations_sha256")
    return sorted_sha256(tables, group, line, "|").withColumnRenamed("sha256", "operations_sha256")


def evidence_document(evidence: DataFrame, database: str) -> DataFrame:
    """``database, document``: a JSON report of a database, its tables, their null counts and references."""
    entries = lambda c, k, v: F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias(k), e["value"].alias(v))))
    table = F.struct(
        F.col("table").alias("name"), F.col("row_count").alias("rows"), F.col("aggregate_sha256").alias("aggregate"),
        entries("null_counts", "column", "nulls").alias("columns"), entries("relationship_counts", "name", "rows").alias("foreignKeys"),
    )
    tables = F.array_sort(F.collect_list(table))
    return evidence.agg(tables.alias("t")).select(F.lit(database).alias("database"), F.to_json(F.struct(F.lit(database).alias("database"), F.col("t").alias("tables"))).alias("document"))
