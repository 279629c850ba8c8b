"""Captured rows, exports and files, each with a manifest that proves what they hold."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators.apply import SEQUENCES, aligned_sequences
from evenkeel.operators.evidence import compare_evidence, compare_values, database_evidence, joined_hash, table_evidence
from evenkeel.operators.validate import set_difference
from evenkeel.operators.violations import VIOLATION, ContractError, require_none, violation
from evenkeel.plans.table_plan import TablePlan
from evenkeel.sources.artifacts import scan_artifacts
from evenkeel.sources.snapshots import _fs, _write_new, read_text

MANIFEST = "database string, table string, capture_id string, rows bigint, aggregate_sha256 string, captured_at timestamp"


def capture_table(df: DataFrame, plan: TablePlan, folder: str, database: str = "") -> DataFrame:
    """Write rows and a one-row manifest (rows, digest) that is read from what was written."""
    spark = df.sparkSession
    df.select(*[f"`{c}`" for c in plan.names]).write.mode("errorifexists").parquet(f"{folder}/rows")
    one = table_evidence(spark.read.parquet(f"{folder}/rows"), plan)
    manifest = one.select(
        F.lit(database).alias("database"), "table", F.lit(uuid.uuid4().hex).alias("capture_id"), F.col("row_count").alias("rows"),
        "aggregate_sha256", F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("captured_at"),
    )
    manifest.write.mode("errorifexists").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def replay_capture(spark: SparkSession, folder: str, plan: TablePlan) -> DataFrame:
    """The captured rows, if they are still those of the manifest."""
    rows = spark.read.parquet(f"{folder}/rows")
    said = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").first()
    now = table_evidence(rows, plan).first()
    if said["table"] != plan.name:
        raise ContractError({"capture_identity_mismatch": 1})
    if said["rows"] != now["row_count"] or said["aggregate_sha256"] != now["aggregate_sha256"]:
        raise ContractError({"capture_content_mismatch": 1})
    return rows


def snapshot_violations(source: DataFrame, manifest: DataFrame, plan: TablePlan) -> DataFrame:
    """Where an independent look at the source differs from a capture's manifest in rows or content."""
    now = table_evidence(source, plan).select("table", F.col("row_count").alias("now_rows"), F.col("aggregate_sha256").alias("now_sha"))
    both = manifest.where(F.col("table") == plan.name).join(now, "table", "full_outer")
    code = F.when(F.col("capture_id").isNull(), "capture_missing").when(F.col("rows") != F.col("now_rows"), "capture_source_count_mismatch").when(F.col("aggregate_sha256") != F.col("now_sha"), "capture_source_content_mismatch")
    both = both.withColumn("code", code).where("code is not null")
    return both.select("table", F.lit("capture").alias("check"), "code", F.col("rows").cast("string").alias("expected"), F.col("now_rows").cast("string").alias("observed"), F.lit(None).cast("string").alias("field"))


def export_tables(tables: dict[str, tuple[DataFrame, TablePlan]], folder: str) -> DataFrame:
    """Write tables to a new folder with a sorted manifest of all files and its digest; refused if the folder exists."""
    spark = next(iter(tables.values()))[0].sparkSession
    names = sorted(tables)
    for name in names:
        df, plan = tables[name]
        df.select(*[f"`{c}`" for c in plan.names]).write.mode("errorifexists").parquet(f"{folder}/{name}")
    manifest = None
    for name in names:
        one = scan_artifacts(spark, f"{folder}/{name}", "part-*").withColumn("table", F.lit(name))
        manifest = one if manifest is None else manifest.unionByName(one)
    manifest.write.mode("errorifexists").parquet(f"{folder}/_manifest")
    manifest = spark.read.parquet(f"{folder}/_manifest")
    return manifest.crossJoin(F.broadcast(joined_hash(manifest, [], ["table", "file_name", "byte_length", "observed_sha256"]).withColumnRenamed("sha256", "manifest_sha256")))


def verify_export(spark: SparkSession, folder: str, plans: dict[str, TablePlan], recorded: DataFrame) -> DataFrame:
    """Compare an export, read again, with its plans' tables and columns, its manifest's files, recorded evidence and sequences."""
    fs, path = _fs(spark, folder)
    there = [x.getPath().getName() for x in fs.listStatus(path) if not x.getPath().getName().startswith("_")] if fs.exists(path) else []
    bad = [(n, "coverage", "export_table_missing", None, None, None) for n in plans if n not in there]
    bad += [(n, "coverage", "export_table_unexpected", None, None, None) for n in there if n not in plans]
    for name, plan in sorted(plans.items()):
        if name in there and sorted(spark.read.parquet(f"{folder}/{name}").columns) != sorted(plan.names):
            bad.append((name, "schema", "export_schema_mismatch", None, None, None))
    if bad:
        return spark.createDataFrame(bad, VIOLATION)
    said = spark.read.parquet(f"{folder}/_manifest").select("table", "file_name", "byte_length", "observed_sha256")
    files = None
    for name in sorted(plans):
        one = scan_artifacts(spark, f"{folder}/{name}", "part-*").withColumn("table", F.lit(name))
        files = one if files is None else files.unionByName(one)
    changed = set_difference(said, files).groupBy("table").agg(F.count("*").alias("n")).select(*violation(F.col("table"), "files", "export_file_mismatch", F.lit(0), F.col("n")))
    tables = {n: (spark.read.parquet(f"{folder}/{n}"), p) for n, p in plans.items()}
    found = compare_evidence(recorded, database_evidence(tables)).unionByName(changed)
    _, held = _fs(spark, f"{folder}/_sequences")
    if not fs.exists(held):
        return found
    key = F.concat_ws(".", "table", "column").alias("name")
    sequences = [df.select(key, "next_value") for df in (spark.read.schema(SEQUENCES).parquet(f"{folder}/_sequences"), aligned_sequences("", tables))]
    return found.unionByName(compare_values(*sequences, "name", "next_value", "sequence"))


# ---------------------------------------------------------------- resumable exports


def inventory(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """The number of an export's current inventory (0: none) and what it says: planned, delivered, final."""
    fs, path = _fs(spark, f"{folder}/_inventory")
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit()]
    if not numbers:
        return 0, {"planned": [], "delivered": {}, "final": None}
    return max(numbers), json.loads(read_text(spark, f"{folder}/_inventory/{max(numbers):020d}.json"))


def _next_inventory(spark: SparkSession, folder: str, number: int, said: dict) -> None:
    if not _write_new(spark, f"{folder}/_inventory/{number + 1:020d}.json", json.dumps(said, sort_keys=True)):
        raise ContractError({"export_inventory_conflict": 1})


def _entry_digest(spark: SparkSession, folder: str) -> str:
    manifest = spark.read.parquet(f"{folder}/_manifest")
    return joined_hash(manifest, [], ["table", "file_name", "byte_length", "observed_sha256"]).first()["sha256"]


def deliver(spark: SparkSession, databases: dict[str, dict[str, tuple[DataFrame, TablePlan]]], folder: str, planned: Sequence[str] | None = None) -> dict[str, str]:
    """Export the databases that are not yet delivered, and verify those that are: ``delivered`` or ``verified`` by name.

    An export has a numbered inventory: the planned databases (fixed by the first
    one) and, for each that is delivered, its folder and the digest of its
    manifest. A database is written to a folder of its own with manifest,
    evidence and sequences, and counts as delivered with the next inventory, so
    a run that failed at any step is taken up where it ended. What an inventory
    names is never written again. A final export takes no more databases.
    """
    number, said = inventory(spark, folder)
    if not number:
        said = {"planned": sorted(planned or databases), "delivered": {}, "final": None}
        _next_inventory(spark, folder, 0, said)
        number = 1
    if set(databases) - set(said["planned"]) or (planned is not None and sorted(planned) != said["planned"]):
        raise ContractError({"export_plan_conflict": 1})
    done = {}
    for name, tables in sorted(databases.items()):
        if name in said["delivered"]:
            require_none(verify_delivered(spark, folder, name, {n: p for n, (_, p) in tables.items()}, said))
            done[name] = "verified"
            continue
        if said["final"]:
            raise ContractError({"export_final": 1})
        own = f"{name}/x={uuid.uuid4().hex}"
        export_tables(tables, f"{folder}/{own}")
        written = {n: (spark.read.parquet(f"{folder}/{own}/{n}"), p) for n, (_, p) in tables.items()}
        database_evidence(written).write.parquet(f"{folder}/{own}/_evidence")
        aligned_sequences("", written).coalesce(1).write.parquet(f"{folder}/{own}/_sequences")  # a row for each identity column
        said["delivered"][name] = {"folder": own, "manifest_sha256": _entry_digest(spark, f"{folder}/{own}")}
        _next_inventory(spark, folder, number, said)
        number, done[name] = number + 1, "delivered"
    return done


def verify_delivered(spark: SparkSession, folder: str, name: str, plans: dict[str, TablePlan], said: dict | None = None) -> DataFrame:
    """Violations of a delivered database against the inventory, its manifest, evidence and sequences."""
    said = inventory(spark, folder)[1] if said is None else said
    entry = said["delivered"].get(name)
    if entry is None:
        raise ContractError({"export_not_delivered": 1})
    own = f"{folder}/{entry['folder']}"
    if _entry_digest(spark, own) != entry["manifest_sha256"]:
        return spark.createDataFrame([(name, "manifest", "export_manifest_mismatch", None, None, None)], VIOLATION)
    return verify_export(spark, own, plans, spark.read.parquet(f"{own}/_evidence"))


def finalise(spark: SparkSession, folder: str, plans: dict[str, dict[str, TablePlan]]) -> str:
    """Make an export final: every planned database delivered, none besides, all verified once more; returns its digest.

    A final export is verified against its digest when this is called again, and changes no more.
    """
    number, said = inventory(spark, folder)
    if not number or sorted(said["delivered"]) != said["planned"] or sorted(plans) != said["planned"]:
        raise ContractError({"export_coverage_incomplete": len(set(said["planned"]) ^ set(said["delivered"])) or 1})
    for name in said["planned"]:
        require_none(verify_delivered(spark, folder, name, plans[name], said))
    digest = hashlib.sha256(json.dumps([said["planned"], said["delivered"]], sort_keys=True).encode()).hexdigest()
    if said["final"] is None:
        _next_inventory(spark, folder, number, said | {"final": digest})
    elif said["final"] != digest:
        raise ContractError({"export_inventory_mismatch": 1})
    return digest
