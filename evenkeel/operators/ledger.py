"""Evidence that is added up: the measures of a table after a plan follow from those before it and from the changed rows.

All that evidence holds of a table is a sum over its rows: their number, the
eight parts of the order-free digest, nulls by column, and filled foreign keys.
A ledger has a row for each (table, measure, name, value). Taking the rows that
a plan replaces or deletes off and putting those that it writes on gives the
ledger of the table as it is afterwards, without reading the other rows. The
changed rows must be those of the plan: their number and digest are held
against its operations.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.canonical import row_hash
from evenkeel.operators.evidence import filled, limb_sums, multiset_digest
from evenkeel.operators.violations import ContractError, violation
from evenkeel.plans.table_plan import TablePlan

LEDGER = "table string, measure string, name string, value decimal(38,0)"
ROWS, LIMB, NULLS, RELATED = "rows", "limb", "null", "related"


def _entry(table: str, measure: str, name: str, value: Column) -> Column:
    return F.struct(F.lit(table).alias("table"), F.lit(measure).alias("measure"), F.lit(name).alias("name"), value.cast("decimal(38,0)").alias("value"))


def _hashed(df: DataFrame, plan: TablePlan) -> DataFrame:
    """``df`` with the hash of each row, made once, which the eight sums take apart."""
    return df.withColumn("__row", row_hash(plan.columns))


def _sums(plan: TablePlan) -> list[Column]:
    """The aggregates of a ledger over hashed rows: n, limb_i, null_i, fk_i."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(plan.names)]
    related = [F.count_if(filled(fk.columns)).alias(f"fk_{i}") for i, fk in enumerate(plan.foreign_keys)]
    return [F.count(F.lit(1)).alias("n"), *limb_sums(F.col("__row")), *nulls, *related]


def observed(df: DataFrame, plan: TablePlan) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df`` that is measured while it is written, and a call that gives its ledger afterwards.

    Put it right before the write: rows are counted by the tasks that write
    them, each task once, and the source is read no second time.
    """
    seen = Observation(f"ledger-{uuid.uuid4().hex}")

    def ledger() -> DataFrame:
        got = seen.get
        values = [(ROWS, "", got["n"]), *[(LIMB, str(i), got[f"limb_{i}"]) for i in range(8)]]
        values += [(NULLS, c, got[f"null_{i}"]) for i, c in enumerate(plan.names)] + [(RELATED, fk.name, got[f"fk_{i}"]) for i, fk in enumerate(plan.foreign_keys)]
        return df.sparkSession.createDataFrame([(plan.name, m, n, Decimal(v)) for m, n, v in values], LEDGER)

    return _hashed(df, plan).observe(seen, *_sums(plan)).drop("__row"), ledger


def measures(df: DataFrame, plan: TablePlan, sign: int = 1) -> DataFrame:
    """The ledger of some rows of a table; with ``sign`` -1, what they take off."""
    one = _hashed(df, plan).agg(*_sums(plan))
    entries = [
        _entry(plan.name, ROWS, "", sign * F.col("n")),
        *[_entry(plan.name, LIMB, str(i), sign * F.col(f"limb_{i}")) for i in range(8)],
        *[_entry(plan.name, NULLS, c, sign * F.col(f"null_{i}")) for i, c in enumerate(plan.names)],
        *[_entry(plan.name, RELATED, fk.name, sign * F.col(f"fk_{i}")) for i, fk in enumerate(plan.foreign_keys)],
    ]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def planned_measures(ops: DataFrame, table: str) -> DataFrame:
    """What operations alone say: the change of the number of rows and of the digest's parts."""
    signed = ops.select(F.explode(F.array(F.struct(F.lit(1).alias("s"), F.col("source_row_sha256").alias("h")), F.struct(F.lit(-1).alias("s"), F.col("target_row_sha256").alias("h")))).alias("x")).select("x.*").where("h is not null")
    part = lambda i: F.col("s") * F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")
    one = signed.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("n"), *[F.coalesce(F.sum(part(i)), F.lit(0)).alias(f"limb_{i}") for i in range(8)])
    entries = [_entry(table, ROWS, "", F.col("n")), *[_entry(table, LIMB, str(i), F.col(f"limb_{i}")) for i in range(8)]]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def added_up(*ledgers: DataFrame) -> DataFrame:
    """The sum of ledgers."""
    out = ledgers[0]
    for more in ledgers[1:]:
        out = out.unionByName(more)
    return out.groupBy("table", "measure", "name").agg(F.sum("value").cast("decimal(38,0)").alias("value"))


def advance(before: DataFrame, ops: DataFrame, written: DataFrame, replaced: DataFrame, plan: TablePlan) -> DataFrame:
    """The ledger after a plan: ``written`` are its inserted and updated rows, ``replaced`` the old rows of its updates and deletes.

    Raises ``canonical_delta_evidence_drift`` if these rows are not those of the operations.
    """
    change = added_up(measures(written, plan), measures(replaced, plan, -1))
    wrong = ledger_violations(planned_measures(ops, plan.name), change.where(F.col("measure").isin(ROWS, LIMB)), "canonical_delta_evidence_drift")
    if n := wrong.count():
        raise ContractError({"canonical_delta_evidence_drift": n})
    return added_up(before, change)


def ledger_violations(expected: DataFrame, observed: DataFrame, code: str = "ledger-mismatch") -> DataFrame:
    """Entries that differ; the parts of the digest count as their sum modulo 2**256."""
    keys = ["table", "measure", "name"]
    values = lambda df, side: ledger_evidence_lines(df).withColumnRenamed("value", side)
    bad = values(expected, "expected").join(values(observed, "observed"), keys, "full_outer").where(~F.col("expected").eqNullSafe(F.col("observed")))
    return bad.select(*violation(F.col("table"), "ledger", code, F.col("expected"), F.col("observed"), F.concat_ws(":", "measure", "name")))


def ledger_evidence_lines(ledger: DataFrame) -> DataFrame:
    """``table, measure, name, value`` as text, with one digest in place of its parts."""
    digest = F.map_from_entries(F.collect_list(F.struct("name", "value")))
    sums = ledger.where(F.col("measure") == LIMB).groupBy("table").agg(digest.alias("m"))
    limbs = [F.coalesce(F.element_at("m", F.lit(str(i))), F.lit(0)).cast("decimal(38,0)") for i in range(8)]
    digests = sums.select("table", F.lit("digest").alias("measure"), F.lit("").alias("name"), multiset_digest(limbs).alias("value"))
    return ledger.where(F.col("measure") != LIMB).select("table", "measure", "name", F.col("value").cast("string").alias("value")).unionByName(digests)


def ledger_evidence(ledger: DataFrame) -> DataFrame:
    """Evidence rows, as ``table_evidence`` makes them from whole tables: row count, digest, null and relationship counts."""
    pairs = lambda measure: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("measure") == measure, F.struct("name", F.col("value").cast("bigint"))))))
    by_table = ledger.groupBy("table").agg(
        F.max(F.when(F.col("measure") == ROWS, F.col("value"))).cast("bigint").alias("row_count"),
        F.map_from_entries(F.collect_list(F.when(F.col("measure") == LIMB, F.struct("name", "value")))).alias("m"),
        pairs(NULLS).alias("null_counts"),
        pairs(RELATED).alias("relationship_counts"),
    )
    limbs = [F.coalesce(F.element_at("m", F.lit(str(i))), F.lit(0)).cast("decimal(38,0)") for i in range(8)]
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    return by_table.select(
        "table", "row_count", multiset_digest(limbs).alias("aggregate_sha256"), "null_counts", "relationship_counts", F.lit(None).cast("string").alias("content_sha256"), none.alias("orphan_counts")
    )


def database_ledger(tables: Mapping[str, tuple[DataFrame, TablePlan]]) -> DataFrame:
    """The ledger of all tables, each read once."""
    return added_up(*[measures(*tables[name]) for name in sorted(tables)])


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)
