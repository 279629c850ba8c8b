"""Fingerprints of typed rows that any engine can recompute.

Every value has one canonical text, led by its type; a row is framed byte by
byte and hashed with SHA-256. All of it is built-in expressions, so it runs in
generated code and never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.plans.table_plan import Column as PlanColumn
from evenkeel.plans.table_plan import TablePlan, require_key

# Fixed values of the row format: marks of a row, a column, a null, a value and the end; how the text of an id array begins.
UUID_ARRAY = "uuid-array-v1:"
ROW, FIELD, NULL, VALUE, END = "52", "46", "00", "01", "45"


def be32(n: Column) -> Column:
    """An unsigned 32-bit number as four bytes, the highest first."""
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 8, "0"))


def be64(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 16, "0"))


def text_bytes(c: Column) -> Column:
    return F.encode(c.cast("string"), "UTF-8")


def large_digest(c: Column, binary: bool = False) -> Column:
    """Byte length and SHA-256 of a large value."""
    raw = c if binary else text_bytes(c)
    return F.concat(be64(F.octet_length(raw)), F.unhex(F.sha2(raw, 256)))


def canonical_text(c: Column, kind: str) -> Column:
    """The one text of a value of the given target type; null stays null."""
    if kind == "boolean":
        return F.when(c, F.lit("true")).otherwise(F.when(~c, F.lit("false")))
    if kind == "date":
        return F.date_format(c.cast("date"), "yyyy-MM-dd")
    if kind == "timestamp without time zone":
        return F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if kind == "timestamp with time zone":
        return F.concat(F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    if kind == "bytea":
        return F.lower(F.hex(c))
    if kind == "uuid[]":
        return F.when(c.isNotNull(), F.concat(F.lit(UUID_ARRAY), F.size(c).cast("string"), F.lit(":"), F.array_join(F.transform(c, F.lower), ",")))
    if kind == "uuid":
        return F.lower(c)
    if kind.startswith("numeric("):
        return c.cast(f"decimal({kind[8:-1]})").cast("string")
    return c.cast("string")


def order_key(c: Column, kind: str) -> Column:
    """What a key column is ordered by: text by its UTF-16 code units, as bytes, all else by itself."""
    return F.encode(c, "UTF-16BE") if kind.startswith(("text", "char", "string")) else c


def _length(n: Column) -> Column:
    """``be32``; of short texts, which most are, without a detour through hex digits."""
    return F.when(n < 128, F.concat(F.lit(bytes(3)), F.char(n).cast("binary"))).otherwise(be32(n))


def _field(c: Column, column: PlanColumn) -> Column:
    kind = column.type.encode()
    head = bytes.fromhex(FIELD) + len(kind).to_bytes(4, "big") + kind
    if column.large:
        payload = large_digest(c, column.type == "bytea")
    else:
        raw = text_bytes(canonical_text(c, column.type))
        payload = F.concat(_length(F.octet_length(raw)), raw)
    # the value first: what a coalesce always evaluates is made once, what only a branch evaluates is made at each use
    return F.coalesce(F.concat(F.lit(head + bytes.fromhex(VALUE)), payload), F.when(c.isNull(), F.lit(head + bytes.fromhex(NULL))))


def row_hash(columns: Iterable[PlanColumn]) -> Column:
    """Lower-case SHA-256 of a row of the given columns."""
    columns = list(columns)
    fields = [_field(F.col(f"`{c.name}`"), c) for c in columns]
    return F.sha2(F.concat(F.unhex(F.lit(ROW)), be32(F.lit(len(columns))), *fields, F.unhex(F.lit(END))), 256)


def key_hash(plan: TablePlan) -> Column:
    """The row hash over the key columns alone."""
    return row_hash(plan.column(k) for k in require_key(plan))


def fingerprints(df: DataFrame, plan: TablePlan, key_name: str = "key_sha256", row_name: str = "row_sha256") -> DataFrame:
    """The key columns with the hashes of key and row; payload columns end here."""
    keys = [F.col(f"`{k}`") for k in require_key(plan)]
    return df.select(*keys, key_hash(plan).alias(key_name), row_hash(plan.columns).alias(row_name))
