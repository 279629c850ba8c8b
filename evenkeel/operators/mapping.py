"""Projections from source rows to target rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canonical import key_hash
from evenkeel.functions.scalars import default_value, offset_to_utc, tick, to_micros
from evenkeel.operators.violations import violation
from evenkeel.plans.table_plan import PlanError, TablePlan, spark_type

TICKS = "SubMicrosecondTicks"


def cast_to_plan(df: DataFrame, plan: TablePlan) -> DataFrame:
    """The planned columns in the plan's types; in ANSI mode a value that does not fit raises."""
    return df.select(*[F.col(f"`{c.name}`").cast(spark_type(c.type)).alias(c.name) for c in plan.columns])


def normal_time(c: Column, source: str) -> Column:
    """A source time as the target stores it: seven-digit times and offsets stay text, others are cut to microseconds."""
    kind = source.lower()
    if kind in ("datetime2(7)", "datetimeoffset"):
        return c.cast("string")
    if kind == "datetimeoffset->utc":
        return offset_to_utc(c)
    if kind == "date":
        return c.cast("date")
    if kind.startswith(("datetime", "smalldatetime")):
        return c.cast("timestamp_ntz")
    raise PlanError("source_type_mapping_unsupported", source)


def split_ticks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Seven-digit time texts as timestamps of microseconds, with the seventh digit in ``<column>SubMicrosecondTicks``."""
    out = {c: to_micros(F.col(f"`{c}`")) for c in columns} | {c + TICKS: tick(F.col(f"`{c}`")) for c in columns}
    return df.withColumns(out)


def archive_projection(df: DataFrame, columns: list[str], required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``split_ticks``, and violations: texts that are no such time, and nulls in required columns."""
    bad = []
    for c in columns:
        text = F.col(f"`{c}`")
        bad.append((c, text.isNotNull() & (to_micros(text).isNull() | tick(text).isNull())))
        if c in required:
            bad.append((c, text.isNull()))
    one = df.agg(*[F.count_if(F.coalesce(x, F.lit(False))).alias(f"n{i}") for i, (_, x) in enumerate(bad)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"n{i}").alias("n")) for i, (c, _) in enumerate(bad)]))
    found = one.select(each.alias("x")).where("x.n > 0").select(*violation("", "ticks", "source_timestamp_invalid", F.lit(0), F.col("x.n"), F.col("x.field")))
    return split_ticks(df, columns), found


def map_outcome(df: DataFrame, id_col: str, key_col: str, origin_col: str, time_col: str, most_key: int = 128, most_origin: int = 16) -> tuple[DataFrame, DataFrame]:
    """Rows of an outcome box in canonical form, and the rows that are refused with their code."""
    key, origin = F.col(key_col), F.col(origin_col)
    code = (
        F.when(~F.coalesce(F.col(id_col) > 0, F.lit(False)), "outcome_id_invalid")
        .when(key.isNull() | (F.trim(key) == "") | (F.char_length(key) > most_key), "outcome_key_invalid")
        .when(origin.isNull() | (F.char_length(origin) > most_origin), "outcome_origin_invalid")
        .when(tick(F.col(time_col)).isNull(), "outcome_time_invalid")
    )
    checked = df.withColumn("code", code)
    return split_ticks(checked.where("code is null").drop("code"), [time_col]), checked.where("code is not null")


def dispose(df: DataFrame, disposition: str, mappers: Mapping[str, Callable[[DataFrame], DataFrame]], renamed: Mapping[str, str] | None = None) -> DataFrame:
    """Send a table through the mapper of its disposition and rename its columns."""
    if disposition not in mappers:
        raise PlanError("table_disposition_unknown", disposition)
    return mappers[disposition](df).withColumnsRenamed(dict(renamed or {}))


def map_sequence_keys(evidence: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequence evidence under target names, and the names that either side lacks."""
    both = evidence.join(names, evidence["sequence"] == names["source_name"], "full_outer")
    missing = both.where("sequence is null or source_name is null").select(F.coalesce("sequence", "source_name").alias("name"), F.col("sequence").isNull().alias("unobserved"))
    return both.where("sequence is not null and source_name is not null").select(F.col("target_name").alias("sequence"), "next_value"), missing


def with_defaults(df: DataFrame, plan: TablePlan) -> DataFrame:
    """Add planned columns that the source lacks, by their defaults."""
    missing = [c for c in plan.columns if c.name not in df.columns and c.default]
    return df.withColumns({c.name: default_value(c.default, spark_type(c.type)) for c in missing}) if missing else df


def insert_projection(df: DataFrame, plan: TablePlan) -> DataFrame:
    """What an insert writes: the stored columns in plan order, no generated ones."""
    return df.select(*[f"`{c}`" for c in plan.stored])


def update_projection(df: DataFrame, plan: TablePlan) -> DataFrame:
    """What an update writes: the key's hash that finds the row, and the columns that may change; neither key nor generated ones."""
    return df.select(key_hash(plan).alias("key_sha256"), *[f"`{c}`" for c in plan.updated])


def add_overlay(df: DataFrame, overlay: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Add target-only columns (name to type and default) behind the source's own."""
    return df.withColumns({c: (F.lit(None) if d is None else F.lit(d)).cast(spark_type(t)) for c, (t, d) in overlay.items()})


def migrating(inventory: DataFrame) -> DataFrame:
    return inventory.where(F.col("disposition") == "Migrate")


def mask_volatile(facts: DataFrame) -> DataFrame:
    """Schema facts without what changes by use: the current value of an identity."""
    return facts.withColumn("value", F.when(F.col("attribute") == "identity_current", F.lit("<identity-current>")).otherwise(F.col("value")))
