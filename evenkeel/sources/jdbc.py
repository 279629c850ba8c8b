"""Tables read by JDBC in balanced key ranges, all in one snapshot where the database has one to share.

The database is asked for quantiles of the key; the ranges between them become
the predicates of Spark's partitions, so each task reads about as many rows
whatever the keys look like, and null keys have a range of their own.
``session`` runs on every connection first: there a snapshot is joined that was
exported before (``SET TRANSACTION SNAPSHOT`` and the like), so that all ranges
are read as of one moment.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from evenkeel.plans.table_plan import TablePlan, require_key

#: Asks for the least key of each of ``n`` parts of equal number of rows; most databases have NTILE.
QUANTILES = "SELECT MIN({key}) AS low FROM (SELECT {key}, NTILE({n}) OVER (ORDER BY {key}) AS part FROM {table} WHERE {key} IS NOT NULL) parts GROUP BY part"


def sampled(every: int, modulus: str = "MOD({key}, {every}) = 0") -> str:
    """Quantiles of a sample of the rows, for large tables with numeric keys."""
    where = modulus.replace("{every}", str(every))
    return QUANTILES.replace("WHERE", f"WHERE {where} AND")


def key_ranges(lows: Sequence, key: str, literal: Callable[[object], str] = repr) -> list[str]:
    """Predicates that part all rows by the sorted lower bounds, each row in one: below the second bound, between, from the last on, and null."""
    bounds = [literal(x) for x in sorted(set(lows))[1:]]
    if not bounds:
        return ["1 = 1"]
    ranges = [f"{key} < {bounds[0]}", *[f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:])], f"{key} >= {bounds[-1]}"]
    return [*ranges, f"{key} IS NULL"]


def _literal(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def read_jdbc(spark: SparkSession, url: str, table: str, plan: TablePlan, partitions: int, properties: dict[str, str] | None = None, session: str = "", quantiles: str = QUANTILES) -> DataFrame:
    """The planned columns of a table, in about ``partitions`` balanced ranges of its first key column."""
    key = require_key(plan)[0]
    more = dict(properties or {}) | ({"sessionInitStatement": session} if session else {})
    asked = f"({quantiles.format(key=key, n=partitions, table=table)}) bounds"
    lows = [r[0] for r in spark.read.jdbc(url, asked, properties=more).collect()]  # one for each partition
    df = spark.read.jdbc(url, table, predicates=key_ranges(lows, key, _literal), properties=more)
    names = {c.lower(): c for c in df.columns}
    return df.select(*[df[f"`{names[c.lower()]}`"].alias(c) for c in plan.names])
