"""Keyed tables in hash buckets: base files, change files merged when they are read, and compaction by size.

A row's bucket is a hash of its key. A batch of changes writes one file for each
bucket that it touches and nothing else; deletes are rows with a mark. A manifest
lists each bucket's base and change files, and the pointer of ``snapshots`` names
the manifest, with the last batch that it holds. Reading merges only buckets that
have changes: of a key's changes the last batch counts, other rows come from the
base. Compaction rewrites the buckets whose changes weigh much against their
base, so a row is written again about as often as its bucket doubles.

Appending and compacting at once do no harm: each publishes a manifest made from
the one it saw, and if another came between, the files that it wrote are put
into that one. Changes come after what a compaction has merged, in either order.

Null keys are keys. The manifest is read by the driver: buckets times the few
files that compaction leaves of each.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators.violations import ContractError
from evenkeel.sources.snapshots import _fs, _write_new, current_state, publish, read_text

BASE, CHANGE = "base", "change"
_OP, _BATCH, _BUCKET = "__op", "__batch", "__bucket"


@dataclass(frozen=True)
class BucketTable:
    """A table below ``root``: its key columns and the number of its buckets, which stays."""

    root: str
    name: str
    keys: tuple[str, ...]
    buckets: int = 64

    @property
    def pointer(self) -> str:
        return f"{self.name}/manifest"


@dataclass(frozen=True)
class BucketFile:
    """The files of one bucket that one write made: base, or the changes of a batch."""

    bucket: int
    kind: str
    batch: int
    folder: str
    bytes: int


def manifest(spark: SparkSession, table: BucketTable) -> tuple[str | None, int, list[BucketFile]]:
    """The current manifest's name, the last batch in it, and its files."""
    _, state = current_state(spark, table.root)
    at = state["versions"].get(table.pointer)
    if at is None:
        return None, -1, []
    said = json.loads(read_text(spark, f"{table.root}/{at}"))
    if said["buckets"] != table.buckets or said["keys"] != list(table.keys):
        raise ContractError({"bucket_table_mismatch": 1})
    return at, state["batches"].get(table.pointer, -1), [BucketFile(*f) for f in said["files"]]


def _publish(spark: SparkSession, table: BucketTable, based_on: str | None, files: list[BucketFile], batch: int) -> bool:
    """Put a new manifest in place of the one it was made from; false if that is current no more."""
    at = f"{table.name}/manifest-{uuid.uuid4().hex}.json"
    rows = [[f.bucket, f.kind, f.batch, f.folder, f.bytes] for f in sorted(files, key=lambda f: (f.bucket, f.batch, f.folder))]
    _write_new(spark, f"{table.root}/{at}", json.dumps({"buckets": table.buckets, "keys": list(table.keys), "files": rows}))
    try:
        publish(spark, table.root, {table.pointer: at}, {table.pointer: based_on}, {table.pointer: batch})
    except ContractError as error:
        if "snapshot_version_conflict" not in error.codes:
            raise
        return False
    return True


def bucket_of(table: BucketTable) -> Column:
    """A row's bucket; of the key's text, so that whole numbers of any width meet."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in table.keys]), F.lit(table.buckets)).cast("int")


def _write(df: DataFrame, table: BucketTable, kind: str, batch: int) -> list[BucketFile]:
    """Write rows by bucket, a file for each bucket; what stands in the folder afterwards."""
    spark, folder = df.sparkSession, f"{table.name}/{kind}-{uuid.uuid4().hex}"
    df.withColumn(_BUCKET, bucket_of(table)).repartition(_BUCKET).write.mode("errorifexists").partitionBy(_BUCKET).parquet(f"{table.root}/{folder}")
    fs, path = _fs(spark, f"{table.root}/{folder}")
    sizes: dict[int, int] = {}
    found = fs.listFiles(path, True)
    while found.hasNext():
        one = found.next()
        parent = one.getPath().getParent().getName()
        if parent.startswith(f"{_BUCKET}=") and one.getPath().getName().startswith("part-"):
            bucket = int(parent.partition("=")[2])
            sizes[bucket] = sizes.get(bucket, 0) + one.getLen()
    return [BucketFile(b, kind, batch, f"{folder}/{_BUCKET}={b}", n) for b, n in sizes.items()]


def load(df: DataFrame, table: BucketTable) -> None:
    """The first state of a table that is not there yet."""
    at, _, _ = manifest(df.sparkSession, table)
    if at is not None or not _publish(df.sparkSession, table, None, _write(df, table, BASE, -1), -1):
        raise ContractError({"bucket_table_exists": 1})


def append_changes(batch: DataFrame, table: BucketTable, order: str, batch_id: int) -> bool:
    """Add a batch of change rows (the table's columns and ``op``: upsert or delete); false if it was added before.

    Of a key's rows in the batch the one of the highest ``order`` counts, of
    several with that the one of the highest hash.
    """
    spark, written = batch.sparkSession, None
    while True:
        at, last, files = manifest(spark, table)
        if last >= batch_id:
            return False
        if written is None:
            best = F.max_by(F.struct(*[f"`{c}`" for c in batch.columns]), F.struct(order, F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in batch.columns])))
            rows = batch.groupBy(*[f"`{k}`" for k in table.keys]).agg(best.alias("__row")).select("__row.*")
            written = _write(rows.withColumnRenamed("op", _OP).withColumn(_BATCH, F.lit(batch_id).cast("bigint")), table, CHANGE, batch_id)
        if _publish(spark, table, at, files + written, batch_id):
            return True


def _rows(spark: SparkSession, table: BucketTable, files: list[BucketFile]) -> DataFrame | None:
    return spark.read.parquet(*[f"{table.root}/{f.folder}" for f in files]) if files else None


def _same_key(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"__k{i}"]) for i, k in enumerate(keys)])


def _merged(spark: SparkSession, table: BucketTable, files: list[BucketFile]) -> DataFrame:
    """The rows of buckets that have changes."""
    changes, base = (_rows(spark, table, [f for f in files if f.kind == kind]) for kind in (CHANGE, BASE))
    best = F.max_by(F.struct(*[f"`{c}`" for c in changes.columns]), _BATCH)
    latest = changes.groupBy(*[f"`{k}`" for k in table.keys]).agg(best.alias("__row")).select("__row.*")
    kept = latest.where(F.col(_OP) != "delete").drop(_OP, _BATCH)
    if base is None:
        return kept
    keys = latest.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(table.keys)])
    return base.join(keys, _same_key(base, keys, table.keys), "left_anti").unionByName(kept)


def read_buckets(spark: SparkSession, table: BucketTable) -> DataFrame:
    """The table as it is now. Buckets without changes are plain scans; no bucket is read that has none of ``table``'s rows."""
    _, _, files = manifest(spark, table)
    touched = {f.bucket for f in files if f.kind == CHANGE}
    plain = _rows(spark, table, [f for f in files if f.bucket not in touched])
    merged = _merged(spark, table, [f for f in files if f.bucket in touched]) if touched else None
    if plain is None and merged is None:
        raise ContractError({"bucket_table_empty": 1})
    return plain if merged is None else merged if plain is None else plain.unionByName(merged)


def due(files: list[BucketFile], ratio: float, most_changes: int) -> list[int]:
    """Buckets whose change files weigh ``ratio`` of their base or more, or are more than ``most_changes``."""
    weight: dict[int, list[int]] = {}
    for f in files:
        own = weight.setdefault(f.bucket, [0, 0, 0])
        own[0 if f.kind == BASE else 1] += f.bytes
        own[2] += f.kind == CHANGE
    return sorted(b for b, (base, changes, n) in weight.items() if n and (changes >= ratio * base or n > most_changes))


def compact(spark: SparkSession, table: BucketTable, ratio: float = 0.5, most_changes: int = 8) -> list[int]:
    """Rewrite the buckets that are ``due``; their numbers. Others keep their files."""
    _, _, seen = manifest(spark, table)
    buckets = due(seen, ratio, most_changes)
    used = [f for f in seen if f.bucket in buckets]
    if not used:
        return []
    written = _write(_merged(spark, table, used), table, BASE, max(f.batch for f in used))
    while True:
        at, last, files = manifest(spark, table)
        if not set(used) <= set(files):
            raise ContractError({"bucket_table_compacted": 1})
        if _publish(spark, table, at, [f for f in files if f not in used] + written, last):
            return buckets


def unused_folders(spark: SparkSession, table: BucketTable) -> list[str]:
    """Folders and manifests of a table that the current manifest does not name: what compaction left, and failed runs."""
    at, _, files = manifest(spark, table)
    fs, path = _fs(spark, f"{table.root}/{table.name}")
    live = {f.folder.split("/")[1] for f in files} | ({at.split("/")[1]} if at else set())
    return sorted(x.getPath().getName() for x in fs.listStatus(path) if x.getPath().getName() not in live)


def remove_unused(spark: SparkSession, table: BucketTable, folders: list[str]) -> None:
    """Delete what ``unused_folders`` named some time ago, so that no reader or writer of then is still at it."""
    still = set(unused_folders(spark, table))
    for name in folders:
        if name in still:
            fs, path = _fs(spark, f"{table.root}/{table.name}/{name}")
            fs.delete(path, True)
