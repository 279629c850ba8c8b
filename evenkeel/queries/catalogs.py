"""Schemas and preservation: what changed between two catalogs or two states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import scalars
from evenkeel.operators import catalog, evidence, preserve
from evenkeel.queries.derive import derived, derived_sql, drifted_sides, table

QUERIES, ORACLE_SQL = {}, {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _count(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


# A catalog of many objects, made from rows of the given tables: a table for each customer with orders, a column for each order.
def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("t"), F.col("o_custkey")).alias("table"), F.col("o_orderkey").cast("int").alias("ordinal"), F.concat(F.lit("c"), F.col("o_orderkey")).alias("column"),
        F.when(F.col("o_orderstatus") == "O", "text").otherwise("bigint").alias("type"), (F.col("o_orderkey") % 2 == 0).alias("nullable"),
        F.col("o_orderpriority").alias("default"), F.lit(None).cast("string").alias("generated"), F.lit(False).alias("identity"), F.lit(None).cast("string").alias("collation"), F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("t"),
    )


def _observed(expected: DataFrame) -> DataFrame:
    k = F.col("k")
    rows = expected.where("k % 13 <> 0 and t % 11 <> 0")
    rows = rows.withColumns({"type": F.when(k % 7 == 0, "xml").otherwise(F.col("type")), "default": F.when(k % 5 == 0, F.concat(F.lit("( "), "default", F.lit("  )"))).when(k % 3 == 0, F.lit("other")).otherwise(F.col("default"))})
    extra = expected.where("k % 17 = 0 and t % 11 <> 0").withColumn("column", F.concat(F.lit("new"), F.col("k")))
    return rows.unionByName(extra).unionByName(expected.where("k % 19 = 0").withColumn("table", F.concat(F.lit("u"), F.col("t"))))


_E = "(SELECT 't' || o_custkey AS tb, 'c' || o_orderkey AS cl, o_orderkey AS k, o_custkey AS t FROM orders)"
_O = f"(SELECT tb, cl, k, t FROM {_E} WHERE k % 13 <> 0 AND t % 11 <> 0 UNION ALL SELECT tb, 'new' || k, k, t FROM {_E} WHERE k % 17 = 0 AND t % 11 <> 0 UNION ALL SELECT 'u' || t, cl, k, t FROM {_E} WHERE k % 19 = 0)"


@_query(f"""SELECT gap, count(*) AS n FROM (
    SELECT 'missing-table' AS gap FROM (SELECT DISTINCT tb FROM {_E}) WHERE tb NOT IN (SELECT tb FROM {_O})
    UNION ALL SELECT 'target-only-table' FROM (SELECT DISTINCT tb FROM {_O}) WHERE tb NOT IN (SELECT tb FROM {_E})
    UNION ALL SELECT 'missing-column' FROM {_E} e WHERE tb IN (SELECT tb FROM {_O}) AND NOT EXISTS (SELECT 1 FROM {_O} o WHERE o.tb = e.tb AND o.cl = e.cl)
    UNION ALL SELECT 'target-only-column' FROM {_O} o WHERE tb IN (SELECT tb FROM {_E}) AND NOT EXISTS (SELECT 1 FROM {_E} e WHERE o.tb = e.tb AND o.cl = e.cl)) GROUP BY 1""")
def schema_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _catalog(spark, sf_dir)
    return _count(catalog.schema_gap(expected, _observed(expected)), "gap")


@_query(f"""SELECT gap, count(*) AS n FROM (SELECT CASE WHEN p IN (SELECT tb FROM {_O}) THEN 'extension-present' ELSE 'extension-missing' END AS gap FROM (SELECT DISTINCT 'u' || t AS p FROM {_E} WHERE t % 2 = 0)
    UNION ALL SELECT 'target-only-table' FROM (SELECT DISTINCT tb FROM {_O}) WHERE tb NOT IN (SELECT tb FROM {_E}) AND tb NOT IN (SELECT 'u' || t FROM {_E} WHERE t % 2 = 0)) GROUP BY 1""")
def schema_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _catalog(spark, sf_dir)
    approved = expected.where("t % 2 = 0").select(F.concat(F.lit("u"), F.col("t")).alias("table"))
    gaps = catalog.schema_gap(expected, _observed(expected), approved)
    return _count(gaps.where("gap like 'extension%' or gap = 'target-only-table'"), "gap")


@_query(f"""SELECT state, facets, count(*) AS n FROM (SELECT CASE WHEN k % 13 = 0 OR t % 11 = 0 THEN 'missing' WHEN k % 7 = 0 OR (k % 5 <> 0 AND k % 3 = 0) THEN 'drift' ELSE 'match' END AS state,
    CASE WHEN k % 13 = 0 OR t % 11 = 0 THEN '' ELSE concat_ws(',', CASE WHEN k % 7 = 0 THEN 'type' END, CASE WHEN k % 5 <> 0 AND k % 3 = 0 THEN 'default' END) END AS facets FROM {_E}
    UNION ALL SELECT 'target-only', '' FROM {_O} o WHERE tb LIKE 'u%' OR cl LIKE 'new%') GROUP BY 1, 2""")
def column_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _catalog(spark, sf_dir)
    drift = catalog.column_drift(expected, _observed(expected))
    return _count(drift.select("state", F.array_join("facets", ",").alias("facets")), "state", "facets")


@_query(f"SELECT count(*) AS tables, sum(n)::BIGINT AS columns FROM (SELECT tb, count(*) AS n FROM {_E} WHERE k % 13 <> 0 AND t % 11 <> 0 AND k % 5 <> 0 AND k % 3 = 0 GROUP BY 1)")
def expression_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _catalog(spark, sf_dir)
    found = catalog.expression_drift(expected, _observed(expected))
    return found.agg(F.count("*").alias("tables"), F.sum(F.size("columns")).alias("columns"))


def _no_constraints(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "table string, kind string, name string, ordinal int, column string, detail string")


@_query(f"""WITH e AS (SELECT tb, string_agg(cl || '|' || CASE WHEN s = 'O' THEN 'text' ELSE 'bigint' END, ',' ORDER BY cl) AS d FROM (SELECT 't' || o_custkey AS tb, 'c' || o_orderkey AS cl, o_orderstatus AS s FROM orders) GROUP BY 1),
    o AS (SELECT tb, string_agg(cl || '|' || CASE WHEN k % 7 = 0 THEN 'xml' WHEN s = 'O' THEN 'text' ELSE 'bigint' END, ',' ORDER BY cl) AS d FROM (SELECT 't' || o_custkey AS tb, 'c' || o_orderkey AS cl, o_orderstatus AS s, o_orderkey AS k FROM orders) GROUP BY 1)
    SELECT component, 'drift' AS state, count(*) AS n FROM (SELECT unnest(['columns', 'whole']) AS component FROM e JOIN o USING (tb) WHERE e.d <> o.d) GROUP BY 1""")
def component_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _catalog(spark, sf_dir)
    moved = expected.withColumn("type", F.when(F.col("k") % 7 == 0, "xml").otherwise(F.col("type")))
    none = _no_constraints(spark)
    return _count(catalog.component_drift(catalog.component_hashes(expected, none), catalog.component_hashes(moved, none)), "component", "state")


_WHOLE = """SELECT tb, sha256(string_agg(fact, chr(10) ORDER BY fact)) AS d FROM (SELECT 't' || o_custkey AS tb, 'column|c' || o_orderkey || '|' || CASE WHEN o_orderstatus = 'O' THEN 'text' ELSE 'bigint' END
    || '|' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END || '|' || o_orderpriority || '|-|false|-' AS fact FROM orders) GROUP BY 1"""


@_query(f"SELECT sha256(string_agg(tb || '|' || d, chr(10) ORDER BY tb || '|' || d)) AS schema_sha256, 2::BIGINT AS orders FROM ({_WHOLE})")
def schema_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical order does not count: two orders of the same columns have one fingerprint."""
    expected, none = _catalog(spark, sf_dir), _no_constraints(spark)
    one = catalog.schema_fingerprint(catalog.component_hashes(expected, none))
    two = catalog.schema_fingerprint(catalog.component_hashes(expected.withColumn("ordinal", -F.col("ordinal")), none))
    return one.unionAll(two).groupBy("schema_sha256").agg(F.count("*").alias("orders"))


@_query("SELECT 't' || o_custkey AS \"table\", o_orderstatus AS name, string_agg('c' || o_orderkey, ',' ORDER BY o_orderkey) AS columns FROM orders GROUP BY 1, 2")
def grouped_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("t"), F.col("o_custkey")).alias("table"), F.lit("unique").alias("kind"), F.col("o_orderstatus").alias("name"),
        F.col("o_orderkey").cast("int").alias("ordinal"), F.concat(F.lit("c"), F.col("o_orderkey")).alias("column"), F.lit(None).cast("string").alias("detail"),
    )
    return catalog.grouped_constraints(rows).select("table", "name", F.array_join("columns", ",").alias("columns"))


@_query(f"SELECT count(*) AS n FROM {_E} WHERE k % 13 = 0 OR t % 11 = 0")
def unplanned_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _catalog(spark, sf_dir)
    keys = expected.select(F.lit("child").alias("table"), F.lit("foreign").alias("kind"), F.col("column").alias("name"), F.lit(1).alias("ordinal"), F.lit("x").alias("column"), F.concat_ws(".", "table", "column").alias("detail"))
    return catalog.unplanned_parents(keys, _observed(expected)).agg(F.count("*").alias("n"))


@_query(f"SELECT side, count(*) AS n FROM (SELECT 'absent' AS side FROM {_E} WHERE k % 23 = 0 AND NOT (k % 13 = 0 AND t % 11 <> 0) UNION ALL SELECT 'undeclared' FROM {_E} WHERE k % 13 = 0 AND t % 11 <> 0 AND k % 23 <> 0) GROUP BY 1")
def declared_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _catalog(spark, sf_dir)
    observed = expected.where("k % 13 <> 0 or t % 11 = 0")
    e = expected.select("table", "column")
    actual = e.join(observed.select("table", "column"), ["table", "column"], "left_anti").withColumn("gap", F.lit("missing-column"))
    declared = expected.where("k % 23 = 0").select("table", "column", F.lit("missing-column").alias("gap"))
    return _count(catalog.declared_gap(actual, declared), "side")


@_query("SELECT 't' || o_custkey AS \"table\", 'c' || o_orderkey AS \"column\", 'missing-column' AS gap, row_number() OVER (ORDER BY 't' || o_custkey, 'c' || o_orderkey) AS step FROM orders WHERE o_orderkey % 13 = 0")
def gap_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = _catalog(spark, sf_dir).where("k % 13 = 0").select("table", "column", F.lit("missing-column").alias("gap"))
    return catalog.gap_steps(gaps)


@_query("SELECT o_orderkey AS k, CASE WHEN a IS NULL AND o IS NULL THEN 'absent-both' WHEN o IS NULL THEN 'observed-absent' WHEN a IS NULL THEN 'unexpected-present' WHEN a = o THEN 'match' ELSE 'present-different' END AS state FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS a, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'zz' ELSE o_orderstatus END AS o FROM orders)")
def presence_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    expected = F.when(k % 3 != 0, F.concat(F.lit(" ("), s, F.lit(")")))
    observed = F.when(k % 4 == 0, None).when(k % 5 == 0, "zz").otherwise(s)
    return table(spark, sf_dir, "orders").select(k.alias("k"), scalars.presence_state(expected, observed).alias("state"))


@_query("SELECT CASE WHEN event_id % 3 = 0 THEN 'decimal' WHEN event_id % 3 = 1 THEN 'text' ELSE 'temporal' END AS category, CASE WHEN event_id % 4 = 0 THEN 'unverifiable' WHEN event_id % 5 = 0 THEN 'mismatch' ELSE 'current' END AS state, count(*) AS n FROM events GROUP BY 1, 2")
def type_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    kind = F.when(k % 3 == 0, "numeric(18,2)").when(k % 3 == 1, "character varying(9)").otherwise("timestamp without time zone")
    state = scalars.collation_version_state(F.lit("153"), F.when(k % 4 == 0, None).when(k % 5 == 0, "150").otherwise("153"))
    return _count(table(spark, sf_dir, "events").select(scalars.type_category(kind).alias("category"), state.alias("state")), "category", "state")


@_query("SELECT quality, toxic, max(r) AS n, sum(r)::BIGINT AS total FROM (SELECT quality, toxic, row_number() OVER (PARTITION BY quality, toxic) AS r FROM labels) GROUP BY 1, 2")
def occurrence_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = preserve.occurrence_facts(table(spark, sf_dir, "labels").select("quality", "toxic"), ["quality", "toxic"])
    return facts.groupBy("quality", "toxic").agg(F.max("occurrence").alias("n"), F.sum("occurrence").alias("total"))


@_query("""SELECT code, count(*) AS n FROM (SELECT CASE WHEN k % 13 = 0 THEN 'fact_removed' WHEN k % 7 = 0 THEN 'fact_changed' END AS code FROM (SELECT o_orderkey AS k FROM orders)
    UNION ALL SELECT 'fact_added' FROM orders WHERE o_orderkey % 17 = 0 AND o_orderpriority <> '1-URGENT') WHERE code IS NOT NULL GROUP BY 1""")
def preservation_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target, _ = drifted_sides(spark, sf_dir, "orders")
    fact = lambda df: df.select("o_orderkey", "o_orderpriority", F.sha2(F.concat_ws("|", "o_orderstatus", F.col("o_custkey").cast("string")), 256).alias("sha256"))
    allowed = source.where("o_orderpriority = '1-URGENT'").select("o_orderpriority")
    return _count(preserve.preservation_violations(fact(source), fact(target), allowed, ["o_orderkey"], "o_orderpriority"), "code")


def _relations(df: DataFrame, by: str) -> DataFrame:
    sums = df.groupBy(F.col(by).cast("string").alias("name")).agg(F.count("*").alias("rows"), *evidence.limb_sums(F.sha2(F.to_json(F.struct(*df.columns)), 256)))
    return sums.select("name", "rows", evidence.multiset_digest([F.col(f"limb_{i}") for i in range(8)]).alias("sha256"))


@_query(f"""WITH b AS (SELECT o_custkey AS n, count(*) AS r, sum(hash(o_orderkey, o_orderstatus)::HUGEINT) AS s FROM orders GROUP BY 1), a AS (SELECT o_custkey AS n, count(*) AS r, sum(hash(o_orderkey, o_orderstatus)::HUGEINT) AS s FROM {derived_sql('orders', 'o_custkey', 'o_orderstatus', "'X'")} GROUP BY 1)
    SELECT code, count(*) AS c FROM (SELECT CASE WHEN a.n IS NULL THEN 'relation_removed' WHEN b.n IS NULL THEN 'relation_added' WHEN a.r <> b.r OR a.s <> b.s THEN 'relation_changed' END AS code FROM b FULL JOIN a ON a.n = b.n) WHERE code IS NOT NULL GROUP BY 1""")
def relation_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    before, after = _relations(rows, "o_custkey"), _relations(derived(rows, "o_custkey", "o_orderstatus", "'X'"), "o_custkey")
    named = before.limit(0).select("name")
    return preserve.relation_violations(before, after, named).groupBy("code").agg(F.count("*").alias("c"))


@_query("SELECT 'relation_changed' AS code, count(DISTINCT o_orderpriority) AS n FROM orders WHERE o_orderkey % 7 = 0 AND o_orderpriority <> '1-URGENT' HAVING count(*) > 0")
def emptied_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    after = rows.where("o_orderpriority <> '1-URGENT'").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    after = _relations(after, "o_orderpriority").unionByName(rows.limit(1).select(F.lit("1-URGENT").alias("name"), F.lit(0).cast("bigint").alias("rows"), F.lit("-").alias("sha256")))
    return _count(preserve.emptied_only(_relations(rows, "o_orderpriority"), after, "1-URGENT"), "code")


@_query("SELECT 'targets_differ' AS code, CAST(n AS VARCHAR) AS name FROM (SELECT DISTINCT c_nationkey AS n FROM customer WHERE c_custkey % 29 = 0 AND c_nationkey < 10) UNION ALL SELECT 'target_not_empty', CAST(n AS VARCHAR) FROM (SELECT DISTINCT c_nationkey AS n FROM customer WHERE c_nationkey BETWEEN 20 AND 24)")
def compare_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    other = rows.withColumn("c_name", F.when(F.col("c_custkey") % 29 == 0, "x").otherwise(F.col("c_name")))
    return preserve.compare_targets(_relations(rows, "c_nationkey"), _relations(other, "c_nationkey"), [str(i) for i in range(10)], [str(i) for i in range(20, 25)])


@_query("SELECT side, count(*) AS n FROM (SELECT unnest(['first', 'second']) AS side FROM orders WHERE o_orderkey % 7 = 0) GROUP BY 1")
def paired_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.lit("orders").alias("table"), F.lit("insert").alias("kind"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("key_sha256"), F.sha2("o_orderstatus", 256).alias("source_row_sha256"), "o_orderkey")
    other = rows.withColumn("source_row_sha256", F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise(F.col("source_row_sha256")))
    return _count(preserve.paired_ops(rows, other), "side")


@_query("SELECT 'supplier' AS \"table\", 'additive_column_not_null' AS code FROM supplier HAVING count(*) > 0")
def additive_preservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = table(spark, sf_dir, "supplier")
    after = before.withColumns({"note": F.lit(None).cast("string"), "rank": F.when(F.col("s_suppkey") % 2 == 0, 1)})
    return preserve.additive_violations(before, after, "supplier", ["note", "rank"])


@_query("SELECT 'overlay_value_changed' AS code, '0' AS expected, CAST(count(*) FILTER (c_custkey % 13 <> 0 AND c_custkey % 6 = 0) AS VARCHAR) AS observed FROM customer UNION ALL SELECT 'overlay_insert_count_mismatch', '1', CAST(count(*) FILTER (c_custkey % 13 = 0) AS VARCHAR) FROM customer")
def overlay_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    before = rows.where("c_custkey % 13 <> 0").withColumn("note", F.lit("kept"))
    after = before.withColumn("note", F.when(F.col("c_custkey") % 6 == 0, "x").otherwise(F.col("note"))).unionByName(rows.where("c_custkey % 13 = 0").withColumn("note", F.lit(None).cast("string")))
    return preserve.overlay_violations(before, after, ["c_custkey"], {"note": None}, 1, "customer").select("code", "expected", "observed")


@_query("SELECT code, count(*) AS n FROM (SELECT unnest(CASE WHEN c_nationkey % 5 = 0 THEN ['extension_orphans'] ELSE [] END || CASE WHEN c_nationkey % 7 = 0 THEN ['extension_reference_missing'] ELSE [] END || CASE WHEN c_nationkey % 3 = 0 THEN ['extension_nulls_invalid'] ELSE [] END) AS code FROM (SELECT DISTINCT c_nationkey FROM customer)) GROUP BY 1")
def extension_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_nationkey")
    one = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("row_count")).select(
        F.concat(F.lit("t"), n).alias("table"), "row_count", F.lit(None).cast("string").alias("content_sha256"), F.sha2(n.cast("string"), 256).alias("aggregate_sha256"),
        F.create_map(F.lit("a"), (n % 3 == 0).cast("bigint")).alias("null_counts"), F.create_map(F.lit("fk"), F.col("row_count") - (n % 7 == 0).cast("bigint")).alias("relationship_counts"),
        F.create_map(F.lit("fk"), (n % 5 == 0).cast("bigint")).alias("orphan_counts"),
    )
    names = [f"t{i}" for i in range(25)]
    return _count(preserve.extension_violations(one, one, {t: ["a"] for t in names}, {t: ["fk"] for t in names}), "code")


@_query("SELECT 'events' AS \"table\", 1 AS ordinal, 'event_id' AS \"column\", 'bigint' AS type FROM events HAVING count(*) > 0 UNION ALL SELECT 'events', 2, 'event_type', 'string' FROM events HAVING count(*) > 0")
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    found = catalog.catalog_columns(spark, {"events": events})
    return found.join(F.broadcast(events.groupBy(F.lit("events").alias("table")).agg(F.count("*").alias("n"))), "table").select("table", "ordinal", "column", "type")


@_query("SELECT \"table\", count(*) AS n, max(o) AS last FROM (SELECT 't' || o_custkey AS \"table\", o_orderkey::INTEGER AS o FROM orders UNION ALL SELECT 't' || o_custkey, max(o_orderkey)::INTEGER + 1 FROM orders GROUP BY 1) GROUP BY 1")
def physical_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = _catalog(spark, sf_dir).drop("k", "t")
    overlays = mapped.select("table").distinct().withColumns({"ordinal": F.lit(1), "column": F.lit("note"), "type": F.lit("text"), "nullable": F.lit(True), "default": F.lit(None).cast("string"), "generated": F.lit(None).cast("string"), "identity": F.lit(False), "collation": F.lit(None).cast("string")})
    return catalog.physical_schema(mapped, mapped.limit(0), overlays).groupBy("table").agg(F.count("*").alias("n"), F.max("ordinal").alias("last"))
