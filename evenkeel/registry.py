"""All queries over the given tables, and the SQL that recomputes each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evenkeel.queries import catalogs, checks, commits, deltas, proofs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**deltas.QUERIES, **checks.QUERIES, **catalogs.QUERIES, **commits.QUERIES, **proofs.QUERIES}
ORACLE_SQL: dict[str, str] = {**deltas.ORACLE_SQL, **checks.ORACLE_SQL, **catalogs.ORACLE_SQL, **commits.ORACLE_SQL, **proofs.ORACLE_SQL}
