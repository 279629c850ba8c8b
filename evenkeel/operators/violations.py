"""Violations as rows: table, check, code, expected, observed, field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIOLATION = "table string, check string, code string, expected string, observed string, field string"


class ContractError(RuntimeError):
    """A contract is broken; the message has codes and counts, and no values of rows."""

    def __init__(self, codes: dict[str, int]) -> None:
        super().__init__(", ".join(f"{c} ({n})" for c, n in sorted(codes.items())))
        self.codes = codes


def empty(spark: SparkSession, schema: str = VIOLATION) -> DataFrame:
    return spark.createDataFrame([], schema)


def violation(table: Column | str, check: str, code: str, expected: Column | None = None, observed: Column | None = None, field: Column | None = None) -> list[Column]:
    """The columns of a violation row."""
    text = lambda c: (F.lit(None) if c is None else c).cast("string")
    return [
        (F.lit(table) if isinstance(table, str) else table).alias("table"), F.lit(check).alias("check"), F.lit(code).alias("code"),
        text(expected).alias("expected"), text(observed).alias("observed"), text(field).alias("field"),
    ]


def require_none(violations: DataFrame) -> None:
    """Raise if there is a violation; only codes and counts reach the driver."""
    codes = {r["code"]: r["count"] for r in violations.groupBy("code").count().collect()}
    if codes:
        raise ContractError(codes)
