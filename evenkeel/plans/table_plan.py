"""What a table must look like: the metadata that the operators take.

Plans are small Python values on the driver; every operator over rows takes one
and builds DataFrame expressions from it. Type strings are those of the target
(``integer``, ``numeric(18,2)``, ``character varying(40)`` ...) and are part of
the row fingerprint.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta


class PlanError(ValueError):
    """A plan that cannot be used; ``code`` names the rule, and no row value is quoted."""

    def __init__(self, code: str, detail: str = "") -> None:
        super().__init__(f"{code}: {detail}" if detail else code)
        self.code = code


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = True
    large: bool = False  # text or bytes that are hashed by length and digest
    default: str | None = None
    generated: str | None = None
    identity: bool = False
    collation: str | None = None


@dataclass(frozen=True)
class Unique:
    name: str
    columns: tuple[str, ...]
    nulls_distinct: bool = False
    predicate: str | None = None
    case_insensitive: bool = False


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Check:
    name: str
    expression: str


@dataclass(frozen=True)
class Identity:
    column: str
    start: int = 1
    increment: int = 1


@dataclass(frozen=True)
class TablePlan:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    uniques: tuple[Unique, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: tuple[Check, ...] = ()
    identities: tuple[Identity, ...] = ()
    target: str | None = None
    known_empty: bool = False
    batch_rows: int = 10_000

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    @property
    def stored(self) -> list[str]:
        """Columns that an insert writes: all but the generated ones."""
        return [c.name for c in self.columns if c.generated is None]

    @property
    def updated(self) -> list[str]:
        """Columns that an update writes: neither key nor generated."""
        return [c for c in self.stored if c not in self.key]

    def without(self, names: Iterable[str]) -> TablePlan:
        gone = set(names)
        return TablePlan(**{**self.__dict__, "columns": tuple(c for c in self.columns if c.name not in gone)})


@dataclass(frozen=True)
class DatabasePlan:
    name: str
    tables: Mapping[str, TablePlan]
    captured_at: datetime | None = None
    extra: Mapping[str, str] = field(default_factory=dict)


def require_key(plan: TablePlan) -> tuple[str, ...]:
    """The key columns, which must be there, distinct and typed."""
    if not plan.key or len(set(plan.key)) != len(plan.key) or not set(plan.key) <= set(plan.names):
        raise PlanError("delta_primary_key_required", plan.name)
    if any(not plan.column(k).type for k in plan.key):
        raise PlanError("delta_primary_key_required", plan.name)
    return plan.key


def order_columns(plan: TablePlan) -> tuple[str, ...]:
    """What orders the rows of a table: its key, else a unique set of columns without nulls; nothing only if it is empty."""
    if plan.key:
        return require_key(plan)
    for u in plan.uniques:
        if u.predicate is None and all(not plan.column(c).nullable for c in u.columns):
            return u.columns
    if plan.known_empty:
        return ()
    raise PlanError("table_order_unproven", plan.name)


def parent_first(tables: Mapping[str, TablePlan]) -> list[str]:
    """Table names so that every table comes after those that its foreign keys name."""
    waiting = {}
    for name, plan in tables.items():
        parents = {fk.parent for fk in plan.foreign_keys if fk.parent != name}
        if outside := sorted(parents - set(tables)):
            raise PlanError("delta_execution_fk_target_missing", f"{name} -> {outside[0]}")
        waiting[name] = parents
    out: list[str] = []
    while waiting:
        ready = sorted(n for n, parents in waiting.items() if not parents & set(waiting))
        if not ready:
            raise PlanError("delta_execution_fk_cycle", ", ".join(sorted(waiting)))
        out += ready
        waiting = {n: p for n, p in waiting.items() if n not in ready}
    return out


# Words that an expression of a plan must not hold.
DENIED = ("select", "insert", "update", "delete", "drop", "alter", "create", "grant", "exec", "copy")


def validate_plan(db: DatabasePlan, now: datetime | None = None, oldest: timedelta = timedelta(hours=6)) -> None:
    """Names are unique, types are there, foreign keys pair up, expressions are plain, and the plan is fresh."""
    for name, plan in db.tables.items():
        if len(set(plan.names)) != len(plan.names) or not plan.columns:
            raise PlanError("schema_plan_columns_invalid", name)
        if any(not c.type for c in plan.columns):
            raise PlanError("schema_plan_type_missing", name)
        if not 1 <= plan.batch_rows <= 100_000:
            raise PlanError("schema_plan_batch_invalid", name)
        for fk in plan.foreign_keys:
            if not fk.columns or len(fk.columns) != len(fk.parent_columns) or not set(fk.columns) <= set(plan.names):
                raise PlanError("schema_plan_foreign_key_invalid", f"{name}.{fk.name}")
        texts = [c.expression for c in plan.checks] + [e for c in plan.columns for e in (c.default, c.generated) if e]
        for text in texts:
            if ";" in text or any(re.search(rf"\b{w}\b", text, re.IGNORECASE) for w in DENIED):
                raise PlanError("schema_plan_expression_denied", name)
        order_columns(plan)
    parent_first(db.tables)
    if now is not None and (db.captured_at is None or not timedelta(0) <= now - db.captured_at <= oldest):
        raise PlanError("schema_plan_stale", db.name)


# Source types and the target types that hold them without loss.
_TYPES = {
    "bigint": "bigint",
    "int": "integer",
    "smallint": "smallint",
    "tinyint": "smallint",
    "bit": "boolean",
    "money": "numeric(19,4)",
    "smallmoney": "numeric(10,4)",
    "float": "double precision",
    "real": "real",
    "uniqueidentifier": "uuid",
    "sysname": "character varying(128)",
    "text": "text",
    "ntext": "text",
    "xml": "text",
    "date": "date",
    "datetime": "timestamp without time zone",
    "smalldatetime": "timestamp without time zone",
    "datetimeoffset": "text",
    "timestamp": "bytea",
    "rowversion": "bytea",
    "image": "bytea",
}


def target_type(source: str) -> str:
    """The target type of a source type; unknown types and lossy ones are refused."""
    kind, _, rest = source.strip().lower().partition("(")
    kind, size = kind.strip(), rest.rstrip(")").replace(" ", "")
    if kind in ("decimal", "numeric"):
        return f"numeric({size or '18,0'})"
    if kind in ("char", "nchar"):
        return f"character({size or 1})"
    if kind in ("varchar", "nvarchar"):
        return "text" if size == "max" else f"character varying({size or 1})"
    if kind in ("binary", "varbinary"):
        return "bytea"
    if kind == "time":
        return "time without time zone"
    if kind == "datetime2":
        return "text" if (size or "7") == "7" else "timestamp without time zone"
    if kind in _TYPES and (not size or kind in ("float", "datetimeoffset")):
        return _TYPES[kind]
    raise PlanError("source_type_mapping_unsupported", kind)


def spark_type(target: str) -> str:
    """The Spark type that holds a target type."""
    kind, _, rest = target.partition("(")
    plain = {
        "bigint": "bigint", "integer": "int", "smallint": "smallint", "boolean": "boolean", "double precision": "double",
        "real": "float", "uuid": "string", "uuid[]": "array<string>", "text": "string", "jsonb": "string", "date": "date",
        "time without time zone": "string", "timestamp without time zone": "timestamp_ntz", "timestamp with time zone": "timestamp",
        "bytea": "binary", "character varying": "string", "character": "string",
    }
    if kind == "numeric":
        return f"decimal({rest}"
    if kind in plain:
        return plain[kind]
    raise PlanError("source_type_mapping_unsupported", target)
