"""Scalar expressions: times below a microsecond, names, decimals, sizes and Unicode evidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.plans.table_plan import Column as PlanColumn
from evenkeel.plans.table_plan import PlanError

_ISO7 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{7}"


def to_micros(text: Column) -> Column:
    """The timestamp of an ISO text, cut (not rounded) to microseconds; null if it is none."""
    return F.substring(text, 1, 26).try_cast("timestamp_ntz")


def tick(text: Column) -> Column:
    """The seventh digit of an ISO time with seven digits, as a smallint; null if the text has no such digit."""
    return F.when(text.rlike(_ISO7), F.substring(text, 27, 1).cast("smallint"))


def micros_text(c: Column) -> Column:
    return F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def offset_to_utc(text: Column) -> Column:
    """The UTC time, cut to microseconds, of an ISO text with an offset."""
    at = F.concat(F.substring(text, 1, 26), F.regexp_extract(text, r"(Z|[+-]\d{2}:\d{2})$", 1))
    return F.to_utc_timestamp(at.cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")


def full_name(first: Column, last: Column) -> Column:
    """Two names joined by a blank and trimmed; a null counts as empty."""
    return F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


def day_difference(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def _fit(precision: int, scale: int) -> tuple[int, int]:
    """Fit a decimal into 38 digits: the whole digits stay, the scale shrinks, but not below 6."""
    if precision <= 38:
        return precision, scale
    return 38, max(38 - (precision - scale), min(scale, 6))


def _as(c: Column, kind: tuple[int, int]) -> Column:
    return c.cast(f"decimal({kind[0]},{kind[1]})")


def product_type(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    return _fit(a[0] + b[0] + 1, a[1] + b[1])


def difference_type(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    scale = max(a[1], b[1])
    return _fit(max(a[0] - a[1], b[0] - b[1]) + scale + 1, scale)


def quotient_type(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    scale = max(6, a[1] + b[0] + 1)
    return _fit(a[0] - a[1] + b[1] + scale, scale)


def decimal_product(a: Column, a_type: tuple[int, int], b: Column, b_type: tuple[int, int]) -> Column:
    return _as(_as(a, a_type) * _as(b, b_type), product_type(a_type, b_type))


def decimal_difference(a: Column, a_type: tuple[int, int], b: Column, b_type: tuple[int, int]) -> Column:
    return _as(_as(a, a_type) - _as(b, b_type), difference_type(a_type, b_type))


def discounted_subtotal(price: Column, price_type: tuple[int, int], quantity: Column, quantity_type: tuple[int, int], percent: Column, percent_type: tuple[int, int], result: tuple[int, int]) -> Column:
    """price * quantity less ``percent`` of it, rounded at each step as the staged types say."""
    gross_type = product_type(price_type, quantity_type)
    gross = decimal_product(price, price_type, quantity, quantity_type)
    off_type = product_type(gross_type, percent_type)
    off = _as(gross * _as(percent, percent_type), off_type)
    off = _as(off / F.lit(100).cast("decimal(10,0)"), quotient_type(off_type, (10, 0)))
    return _as(gross - off, result)


def sorted_json(text: Column) -> Column:
    """JSON with the keys of all objects in order; arrays keep theirs, numbers lose spare zeros."""
    return F.to_json(F.parse_json(text))


def row_digest(*columns: str) -> Column:
    """SHA-256 of a row as JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


# Bytes that a value of each kind is taken to need.
_SIZES = {"boolean": 1, "smallint": 2, "integer": 4, "real": 4, "date": 4, "bigint": 8, "double precision": 8}


def row_size(columns: list[PlanColumn]) -> Column:
    """Estimated bytes of a row: 16 and the name for each column, and the value by its type (1 if null). Fixed values of the format to match."""
    total = F.lit(0).cast("bigint")
    for c in columns:
        value = F.col(f"`{c.name}`")
        if c.type == "bytea":
            size = F.octet_length(value)
        elif c.type in ("text", "jsonb", "time without time zone") or c.type.startswith("character"):
            size = F.octet_length(value)
        else:
            size = F.lit(_SIZES.get(c.type, 16))
        total = total + 16 + len(c.name.encode()) + F.when(value.isNull(), 1).otherwise(size)
    return total


def utf16_units(text: Column) -> Column:
    return (F.octet_length(F.encode(text, "UTF-16LE")) / 2).cast("bigint")


def utf16_digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-16LE"), 256)


def type_category(kind: Column) -> Column:
    """A fixed word for the family of a target type."""
    return (
        F.when(kind.rlike("^(bigint|integer|smallint)$"), "integer")
        .when(kind.startswith("numeric"), "decimal")
        .when(kind.isin("double precision", "real"), "floating")
        .when(kind.rlike("^(text|uuid|jsonb)$|^character"), "text")
        .when(kind.rlike("^(date|time)"), "temporal")
        .when(kind == "boolean", "boolean")
        .when(kind == "bytea", "binary")
        .otherwise("other")
    )


def collation_version_state(declared: Column, actual: Column) -> Column:
    return (
        F.when(declared.isNull() & actual.isNull(), "unversioned")
        .when(actual.isNull(), "unverifiable")
        .when(declared.eqNullSafe(actual), "current")
        .otherwise("mismatch")
    )


def normal_expression(text: Column) -> Column:
    """An expression with single blanks, trimmed, and without one outer pair of brackets around bracket-free text."""
    one = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.trim(F.regexp_replace(one, r"^\(([^()]*)\)$", "$1"))


def presence_state(expected: Column, observed: Column) -> Column:
    return (
        F.when(expected.isNull() & observed.isNull(), "absent-both")
        .when(observed.isNull(), "observed-absent")
        .when(expected.isNull(), "unexpected-present")
        .when(normal_expression(expected) == normal_expression(observed), "match")
        .otherwise("present-different")
    )


def default_value(kind: str, result: str) -> Column:
    """The value of a column that the source lacks: a literal, the time now, a new uuid, or zero."""
    if kind == "now":
        return F.current_timestamp().cast(result)
    if kind == "utc-now":
        return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast(result)
    if kind == "uuid":
        return F.uuid()
    if kind == "zero":
        return F.lit(0).cast(result)
    if kind.startswith("literal:"):
        return F.lit(kind[8:]).cast(result)
    raise PlanError("default_unsupported", kind)
