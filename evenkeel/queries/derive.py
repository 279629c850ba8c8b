"""Second sides, nulls and plans derived from the given tables, in Spark and, the same, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.plans.table_plan import Column, ForeignKey, TablePlan

MONEY, TIME, TEXT = "numeric(18,2)", "timestamp without time zone", "text"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plan(name: str, key: str, columns: dict[str, str], **more) -> TablePlan:
    return TablePlan(name, tuple(Column(c, t.removesuffix("!"), large=t.endswith("!")) for c, t in columns.items()), (key,), **more)


ORDERS = _plan(
    "orders", "o_orderkey",
    {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "character(1)", "o_totalprice": MONEY, "o_orderdate": TIME, "o_orderpriority": TEXT},
    foreign_keys=(ForeignKey("orders_customer", ("o_custkey",), "customer", ("c_custkey",)),),
)
CUSTOMER = _plan("customer", "c_custkey", {"c_custkey": "bigint", "c_name": TEXT, "c_nationkey": "integer", "c_acctbal": MONEY, "c_mktsegment": "character varying(10)"})
PART = _plan("part", "p_partkey", {"p_partkey": "bigint", "p_name": TEXT, "p_brand": TEXT, "p_type": TEXT, "p_size": "integer", "p_retailprice": MONEY})
SUPPLIER = _plan("supplier", "s_suppkey", {"s_suppkey": "bigint", "s_name": TEXT, "s_nationkey": "integer", "s_acctbal": MONEY})
EVENTS = _plan("events", "event_id", {"event_id": "bigint", "ts": TIME, "user_id": "bigint", "event_type": TEXT, "value": MONEY, "props": "jsonb"})
NATION = _plan("nation", "n_nationkey", {"n_nationkey": "integer", "n_name": TEXT, "n_regionkey": "integer"})
DOCUMENTS = _plan("documents", "doc_id", {"doc_id": "bigint", "text": "text!", "lang": TEXT, "source": TEXT, "n_chars": "bigint"})
#: What is added to a key to make a new one, where SQL names it. Tables with keys beyond it can hold the new one already.
SHIFT = 10_000_000
#: Table, the column that the derived side changes, and its new value.
CHANGED = {
    "orders": (ORDERS, "o_orderstatus", "'X'"),
    "customer": (CUSTOMER, "c_mktsegment", "'CHANGED'"),
    "part": (PART, "p_brand", "'Brand#00'"),
    "supplier": (SUPPLIER, "s_name", "'changed'"),
}


def derived(df: DataFrame, key: str, column: str, value: str, shift: int = SHIFT) -> DataFrame:
    """Another side of a table: some rows are gone, some changed in a column, and some are copies under new keys."""
    kept = df.where(F.col(key) % 13 != 0).withColumn(column, F.when(F.col(key) % 7 == 0, F.expr(value)).otherwise(F.col(column)))
    return kept.unionByName(df.where(F.col(key) % 17 == 0).withColumn(key, F.col(key) + shift))


def drifted(df: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """``derived`` for a query whose SQL does not name the new keys: they lie beyond all keys, so none is there twice."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    return derived(df, key, column, value, SHIFT if low is None else max(SHIFT, high - low + 1))


def derived_sql(name: str, key: str, column: str, value: str) -> str:
    changed = f"SELECT * REPLACE (CASE WHEN {key} % 7 = 0 THEN {value} ELSE {column} END AS {column}) FROM {name} WHERE {key} % 13 <> 0"
    return f"({changed} UNION ALL SELECT * REPLACE ({key} + 10000000 AS {key}) FROM {name} WHERE {key} % 17 = 0)"


def both_sides(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame, TablePlan]:
    plan, column, value = CHANGED[name]
    source = table(spark, sf_dir, name).select(*plan.names)
    return source, derived(source, plan.key[0], column, value), plan


def drifted_sides(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame, TablePlan]:
    """``both_sides`` for a query whose SQL does not name the new keys."""
    plan, column, value = CHANGED[name]
    source = table(spark, sf_dir, name).select(*plan.names)
    return source, drifted(source, plan.key[0], column, value), plan


def target_sql(name: str) -> str:
    plan, column, value = CHANGED[name]
    return derived_sql(name, plan.key[0], column, value)


def _text_sql(c: Column, prefix: str) -> str:
    x = f"{prefix}{c.name}"
    if c.type == TIME:
        return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%f')"
    if c.type.startswith("numeric("):
        return f"CAST(CAST({x} AS DECIMAL({c.type[8:-1]})) AS VARCHAR)"
    return f"CAST({x} AS VARCHAR)"


def _be(n: str, width: int) -> str:
    return f"unhex(lpad(to_hex({n}), {width}, '0'))"


def row_hash_sql(plan: TablePlan, prefix: str = "", columns: tuple[str, ...] | None = None) -> str:
    """The row hash, in SQL."""
    chosen = [plan.column(c) for c in columns] if columns else list(plan.columns)
    fields = []
    for c in chosen:
        text = _text_sql(c, prefix)
        if c.large:
            payload = f"{_be(f'octet_length(encode({text}))', 16)} || unhex(sha256({text}))"
        else:
            payload = f"{_be(f'octet_length(encode({text}))', 8)} || encode({text})"
        head = f"unhex('46') || {_be(str(len(c.type)), 8)} || encode('{c.type}')"
        fields.append(f"{head} || CASE WHEN {prefix}{c.name} IS NULL THEN unhex('00') ELSE unhex('01') || {payload} END")
    return f"sha256(unhex('52') || {_be(str(len(chosen)), 8)} || {' || '.join(fields)} || unhex('45'))"


def key_hash_sql(plan: TablePlan, prefix: str = "") -> str:
    return row_hash_sql(plan, prefix, plan.key)


def compared_sql(name: str) -> str:
    """All keys of a table and its derived side, with hashes and kind."""
    plan = CHANGED[name][0]
    key = plan.key[0]
    h = lambda src: f"SELECT {key}, {key_hash_sql(plan)} AS kh, {row_hash_sql(plan)} AS rh FROM {src}"
    return f"""SELECT coalesce(s.{key}, t.{key}) AS {key},
        CASE WHEN t.rh IS NULL THEN 'insert' WHEN s.rh IS NULL THEN 'delete' WHEN s.rh <> t.rh THEN 'update' ELSE 'unchanged' END AS kind,
        coalesce(s.kh, t.kh) AS key_sha256, s.rh AS source_row_sha256, t.rh AS target_row_sha256
        FROM ({h(name)}) s FULL JOIN ({h(target_sql(name))}) t ON s.{key} = t.{key}"""


def evidence_digest_sql(h: str, source: str) -> str:
    """SHA-256 of the sum of row hashes modulo 2**256, from sums of 32-bit parts."""
    limbs = ", ".join(f"coalesce(sum(CAST(('0x' || substr({h}, {8 * i + 1}, 8)) AS UBIGINT)), 0)::HUGEINT AS l{i}" for i in range(8))
    steps, carry, words = [f"SELECT {limbs} FROM {source}"], "0", []
    sql = f"({steps[0]}) q8"
    for i in range(7, -1, -1):
        sql = f"(SELECT *, (l{i} + {carry}) % 4294967296 AS w{i}, (l{i} + {carry}) // 4294967296 AS c{i} FROM {sql}) q{i}"
        carry = f"c{i}"
    for i in range(8):
        words.append(f"lpad(to_hex(w{i}::BIGINT), 8, '0')")
    return f"(SELECT sha256(unhex({' || '.join(words)})) FROM {sql})"
