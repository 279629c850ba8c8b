"""Snapshots in hash buckets by key, sorted: tables that meet by key without an exchange.

Both sides of a comparison and the operations between them are written once with
the same number of buckets; planning and applying then join bucket with bucket.
The files say which bucket they are by name; how many there are and of which
columns is kept beside them, and a session registers a folder as an external
table when it reads it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evenkeel.operators.delta import plan_delta, typed_keys
from evenkeel.operators.violations import ContractError
from evenkeel.plans.table_plan import TablePlan, require_key
from evenkeel.sources.snapshots import _write_new, read_text


def stage_bucketed(df: DataFrame, root: str, name: str, keys: Sequence[str], buckets: int) -> str:
    """Write a new version in buckets, one sorted file each; returns its folder under ``root``."""
    spark, folder = df.sparkSession, f"{name}/b={uuid.uuid4().hex}"
    own = f"stage_{uuid.uuid4().hex}"
    columns = [F.col(f"`{k}`") for k in keys]
    writer = df.repartition(buckets, *columns).sortWithinPartitions(*columns).write.format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{root}/{folder}").saveAsTable(own)
    spark.sql(f"DROP TABLE {own}")  # external: the files stay
    said = {"buckets": buckets, "keys": list(keys), "schema": json.loads(df.schema.json())}
    _write_new(spark, f"{root}/{folder}/_buckets.json", json.dumps(said))
    return folder


def read_bucketed(spark: SparkSession, location: str) -> DataFrame:
    """A staged version as a bucketed table of this session."""
    text = read_text(spark, f"{location}/_buckets.json")
    if text is None:
        raise ContractError({"bucketed_snapshot_missing": 1})
    said = json.loads(text)
    schema, own = StructType.fromJson(said["schema"]), f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in said["keys"])
    spark.sql(f"CREATE TABLE {own} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {said['buckets']} BUCKETS LOCATION '{location}'")
    return spark.table(own)


def stage_sides(source: DataFrame, target: DataFrame, plan: TablePlan, root: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with typed keys, written in the same buckets and read back."""
    keys = require_key(plan)
    return tuple(read_bucketed(df.sparkSession, f"{root}/{stage_bucketed(typed_keys(df, plan), root, plan.name, keys, buckets)}") for df in (source, target))


def plan_bucketed(source: DataFrame, target: DataFrame, plan: TablePlan, root: str, buckets: int) -> DataFrame:
    """The operations between two bucketed sides, kept in the same buckets."""
    ops = plan_delta(source, target, plan)
    return read_bucketed(source.sparkSession, f"{root}/{stage_bucketed(ops, root, f'{plan.name}-ops', require_key(plan), buckets)}")


def apply_bucketed(source: DataFrame, target: DataFrame, ops: DataFrame, plan: TablePlan) -> DataFrame:
    """What ``apply_delta`` gives, by key columns: bucketed sides and operations meet without an exchange."""
    keys = list(require_key(plan))
    extra = [c for c in target.columns if c not in plan.names]
    written = source.join(ops.where("kind <> 'delete'").select(*keys), keys, "left_semi").select(*keys, F.struct(*[f"`{c}`" for c in plan.names]).alias("__s"))
    kept = target.join(ops.where("kind = 'delete'").select(*keys), keys, "left_anti").select(*keys, F.struct(*[f"`{c}`" for c in [*plan.names, *extra]]).alias("__t"))
    both, fresh = kept.join(written, keys, "full_outer"), F.col("__s").isNotNull()
    out = both.select(*[F.when(fresh, F.col(f"__s.`{c}`")).otherwise(F.col(f"__t.`{c}`")).alias(c) for c in plan.names], *[F.col(f"__t.`{c}`").alias(c) for c in extra])
    made = {c.name: F.expr(c.generated) for c in plan.columns if c.generated}
    return out.withColumns(made) if made else out
