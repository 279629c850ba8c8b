"""Whole-database work (keys, orphans, captures, sequences, adoption, applying a plan once), and contracts of single values and tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import scalars
from evenkeel.functions.canonical import row_hash
from evenkeel.operators import apply, catalog, delta, evidence, history, mapping, validate
from evenkeel.plans.table_plan import Column, DatabasePlan, ForeignKey, Identity, TablePlan
from evenkeel.queries.derive import CUSTOMER, ORDERS, derived, drifted, evidence_digest_sql, row_hash_sql, table, target_sql
from evenkeel.sources import buckets, captures, snapshots
from evenkeel.streaming.upsert import upsert_batch

QUERIES, ORACLE_SQL = {}, {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_LINES = TablePlan("lineitem", (Column("a", "bigint", False), Column("b", "integer", False)), ("a", "b"))


@_query("""WITH x AS (SELECT nullif(l_orderkey % 97, 0) AS a, l_linenumber AS b FROM lineitem)
    SELECT 'delta_primary_key_null' AS code, count(*)::VARCHAR AS observed FROM x WHERE a IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'delta_duplicate_key', count(*)::VARCHAR FROM (SELECT a, b FROM x GROUP BY a, b HAVING count(*) > 1) HAVING count(*) > 0""")
def key_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and repeated keys, which stop a plan."""
    rows = table(spark, sf_dir, "lineitem").select(F.nullif(F.col("l_orderkey") % 97, F.lit(0)).alias("a"), F.col("l_linenumber").alias("b"))
    return delta.key_violations(rows, _LINES, "source").select("code", "observed")


def _with_parents(spark: SparkSession, sf_dir: str, parents: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where(parents)
    return evidence.database_evidence({"orders": (orders, ORDERS), "customer": (customers, CUSTOMER)})


@_query("SELECT 'orders' AS \"table\", 'orders_customer' AS name, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0)")
def orphan_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_parents(spark, sf_dir, "c_custkey % 11 <> 0").select("table", F.explode("orphan_counts").alias("name", "n"))


@_query("SELECT 'orders' AS \"table\", 'orphan-mismatch' AS code, '0' AS expected, count(*)::VARCHAR AS observed FROM orders WHERE o_custkey % 11 = 0 HAVING count(*) > 0")
def compare_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evidence.compare_evidence(_with_parents(spark, sf_dir, "true"), _with_parents(spark, sf_dir, "c_custkey % 11 <> 0"))
    return found.where("check = 'orphan'").select("table", "code", "expected", "observed")


@_query(f"""WITH s AS (SELECT count(*) AS n, {evidence_digest_sql('h', f"(SELECT {row_hash_sql(ORDERS)} AS h FROM orders)")} AS d FROM orders),
    t AS (SELECT count(*) AS n, {evidence_digest_sql('h', f"(SELECT {row_hash_sql(ORDERS)} AS h FROM {target_sql('orders')})")} AS d FROM {target_sql('orders')})
    SELECT CASE WHEN s.n <> t.n THEN 'capture_source_count_mismatch' ELSE 'capture_source_content_mismatch' END AS code, t.n AS expected, s.n AS observed FROM s, t WHERE s.n <> t.n OR s.d <> t.d""")
def capture_against_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture of another state than the source has now."""
    orders = table(spark, sf_dir, "orders")
    said = evidence.table_evidence(derived(orders, "o_orderkey", "o_orderstatus", "'X'"), ORDERS)
    manifest = said.select("table", F.lit("c").alias("capture_id"), F.col("row_count").alias("rows"), "aggregate_sha256")
    found = captures.snapshot_violations(orders, manifest, ORDERS)
    return found.select("code", F.col("expected").cast("bigint").alias("expected"), F.col("observed").cast("bigint").alias("observed"))


@_query("SELECT 'customer' AS \"table\", max(c_custkey) + 1 AS next_value FROM customer UNION ALL SELECT 'orders', max(o_orderkey) + 10 FROM orders")
def next_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = TablePlan("customer", CUSTOMER.columns, CUSTOMER.key, identities=(Identity("c_custkey"),))
    o = TablePlan("orders", ORDERS.columns, ORDERS.key, identities=(Identity("o_orderkey", increment=10),))
    return apply.aligned_sequences("main", {"customer": (table(spark, sf_dir, "customer"), c), "orders": (table(spark, sf_dir, "orders"), o)}).select("table", "next_value")


def _root(spark: SparkSession) -> str:
    """A new folder for a small database, in the cluster's shared folder."""
    folder = evidence.shared_folder(spark)
    return f"{folder}/{spark.sparkContext.applicationId}/database-{uuid.uuid4().hex}"


_PLANS = {
    "customer": CUSTOMER,
    "orders": TablePlan("orders", ORDERS.columns, ORDERS.key, foreign_keys=(ForeignKey("orders_customer", ("o_custkey",), "customer", ("c_custkey",)),), identities=(Identity("o_orderkey"),)),
}


@_query("""SELECT 'customer' AS "table", count(*) AS rows, sum(c_custkey)::BIGINT AS keys, 'applied' AS first, 'replayed' AS second, 1::BIGINT AS journal FROM customer
    UNION ALL SELECT 'orders', count(*), sum(o_orderkey)::BIGINT, 'applied', 'replayed', 1 FROM orders""")
def database_applied_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database whose copy has drifted is brought to its source; the second run changes nothing."""
    root, db = _root(spark), DatabasePlan("main", _PLANS)
    source = {n: table(spark, sf_dir, n).select(*p.names) for n, p in _PLANS.items()}
    old = {"customer": drifted(source["customer"], "c_custkey", "c_mktsegment", "'CHANGED'"), "orders": drifted(source["orders"], "o_orderkey", "o_orderstatus", "'X'")}
    snapshots.publish(spark, root, {n: snapshots.stage(df, root, n) for n, df in old.items()})
    now = snapshots.read_database(spark, root, db)
    ops = {n: evidence.stored(delta.plan_delta(source[n], now[n], p), "ops") for n, p in _PLANS.items()}
    check = apply.Checkpoint("main", "plan-1", "1" * 64, delta.operations_sha256(ops), "3" * 64, "4" * 64, 1, "5" * 64)
    apply.write_fence(spark, root, check)
    states = [apply.apply_database(spark, root, db, source, ops, check) for _ in range(2)]
    journal = snapshots.read_current(spark, root, "_journal", apply.JOURNAL).count()
    out = None
    for name, df in snapshots.read_database(spark, root, db).items():
        one = df.agg(F.count("*").alias("rows"), F.sum(_PLANS[name].key[0]).alias("keys"))
        one = one.select(F.lit(name).alias("table"), "rows", "keys", F.lit(states[0]).alias("first"), F.lit(states[1]).alias("second"), F.lit(journal).cast("bigint").alias("journal"))
        out = one if out is None else out.unionByName(one)
    return out


@_query("SELECT count(*) FILTER (c_custkey % 3 = 0) AS inserted, count(*) FILTER (c_custkey % 3 <> 0) AS replayed, max(c_custkey) + 1 AS next_value FROM customer")
def adopted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _root(spark)
    source = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    plan = TablePlan("customer", CUSTOMER.columns, CUSTOMER.key, identities=(Identity("c_custkey"),))
    snapshots.publish(spark, root, {"customer": snapshots.stage(source.where("c_custkey % 3 <> 0"), root, "customer")})
    inserted, replayed = apply.adopt_and_publish(spark, source, plan, root, "c_custkey", "c_name")
    after = snapshots.read_current(spark, root, "_sequences", apply.SEQUENCES)
    return after.select(F.lit(inserted).cast("bigint").alias("inserted"), F.lit(replayed).cast("bigint").alias("replayed"), "next_value")


@_query("SELECT count(*) FILTER (event_type <> 'error') AS survivors, count(*) FILTER (event_type = 'error') AS archived FROM events")
def archive_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive, left = apply.archive_rows(table(spark, sf_dir, "events"), "event_type = 'error'", ["event_id"], _root(spark))
    return left.agg(F.count("*").alias("survivors")).crossJoin(F.broadcast(archive.agg(F.count("*").alias("archived"))))  # one row and one row


def _rollup_line(name: str, plan: TablePlan) -> str:
    digest = evidence_digest_sql("h", f"(SELECT {row_hash_sql(plan)} AS h FROM {name})")
    return f"SELECT '{name}|' || (SELECT count(*) FROM {name}) || '|-|' || {digest} AS line, (SELECT count(*) FROM {name}) AS n"


@_query(f"SELECT 2 AS tables, sum(n)::BIGINT AS rows, sha256(string_agg(line, chr(10) ORDER BY line)) AS content_sha256 FROM ({_rollup_line('orders', ORDERS)} UNION ALL {_rollup_line('customer', CUSTOMER)})")
def database_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evidence.database_evidence({"orders": (table(spark, sf_dir, "orders"), ORDERS), "customer": (table(spark, sf_dir, "customer"), CUSTOMER)})
    return history.database_rollup(found.withColumn("g", F.lit(1)), ["g"]).select(F.col("tables").cast("int").alias("tables"), "rows", "content_sha256")


@_query("""SELECT code, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 6 = 0 THEN 'plan_count_mismatch' WHEN c_custkey % 10 = 0 THEN 'plan_operations_hash_mismatch' WHEN c_custkey % 14 = 0 THEN 'plan_table_repeated' END AS code
    FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)) WHERE code IS NOT NULL GROUP BY 1""")
def plan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = table(spark, sf_dir, "orders").select(
        F.lit("r").alias("run"), F.col("o_custkey").alias("table"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("key_sha256"),
        F.lit("insert").alias("kind"), F.sha2("o_orderpriority", 256).alias("source_row_sha256"), F.lit(None).cast("string").alias("target_row_sha256"),
    )
    t = F.col("table")
    said = history.counted_operations(ops).select(
        "run", "table", (F.col("n_inserts") + (t % 6 == 0).cast("int")).alias("inserts"), F.col("n_updates").alias("updates"), F.col("n_deletes").alias("deletes"),
        F.when(t % 10 == 0, F.lit("0" * 64)).otherwise(F.col("again")).alias("operations_sha256"),
    )
    said = said.unionAll(said.where((t % 14 == 0) & (t % 6 != 0) & (t % 10 != 0)))
    return history.plan_count_violations(said, ops).groupBy("code").agg(F.count("*").alias("n"))


@_query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || (event_id % 10) AS kept, ts AS cut, CAST(ts AS DATE) AS day FROM events""")
def normal_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-digit times stay text; others are timestamps or dates."""
    events = table(spark, sf_dir, "events")
    seven = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), (F.col("event_id") % 10).cast("string"))
    kept, cut, day = mapping.normal_time(seven, "datetime2(7)"), mapping.normal_time(F.col("ts"), "datetime2(6)"), mapping.normal_time(F.col("ts"), "date")
    return events.select("event_id", kept.alias("kept"), cut.alias("cut"), day.alias("day"))


@_query("SELECT c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN '<identity-current>' ELSE c_name END AS value, count(*) AS n FROM customer GROUP BY 1, 2")
def masked_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "customer").select("c_nationkey", F.when(F.col("c_custkey") % 3 == 0, "identity_current").otherwise("type").alias("attribute"), F.col("c_name").alias("value"))
    return mapping.mask_volatile(facts).groupBy("c_nationkey", "value").agg(F.count("*").alias("n"))


@_query("""SELECT p_partkey, sha256('{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","brand":' || CASE WHEN p_partkey % 4 = 0 THEN 'null' ELSE '"' || p_brand || '"' END || '}') AS digest FROM part""")
def row_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("brand", F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")))
    return part.select("p_partkey", scalars.row_digest("p_partkey", "p_name", "brand").alias("digest"))


@_query("""SELECT s_suppkey, sha256(unhex('52') || unhex('00000002') || unhex('46') || unhex('00000005') || encode('bytea') || unhex('01') || unhex(lpad(to_hex(2 * octet_length(encode(s_name))), 8, '0')) || encode(lower(hex(encode(s_name))))
    || unhex('46') || unhex('00000006') || encode('uuid[]') || CASE WHEN s_suppkey % 5 = 0 THEN unhex('00') ELSE unhex('01') || unhex(lpad(to_hex(octet_length(encode('uuid-array-v1:2:' || lower(s_name) || ',b'))), 8, '0')) || encode('uuid-array-v1:2:' || lower(s_name) || ',b') END || unhex('45')) AS row_sha256 FROM supplier""")
def row_fingerprint_binary_and_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.encode("s_name", "UTF-8").alias("raw"), F.when(F.col("s_suppkey") % 5 != 0, F.array(F.col("s_name"), F.lit("B"))).alias("ids"))
    columns = (Column("raw", "bytea"), Column("ids", "uuid[]"))
    return rows.select("s_suppkey", row_hash(columns).alias("row_sha256"))


@_query("SELECT r_regionkey, r_name FROM region")
def bounded_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that may not have more rows than a limit, and one that must be empty."""
    plan = TablePlan("absent", (Column("r_regionkey", "integer"),), known_empty=True)
    region = table(spark, sf_dir, "region")
    validate.require_empty(region.where("r_regionkey < 0"), plan)
    return validate.require_at_most(region, 5)


@_query("SELECT DISTINCT 't' || o_custkey AS \"table\", 'schema-hash' AS \"check\", 'schema-hash-mismatch' AS code FROM orders WHERE o_orderkey % 7 = 0 AND o_orderstatus <> 'X'")
def compare_schema_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of a catalog, a column for each order, whose hash differs after some types changed."""
    orders = table(spark, sf_dir, "orders")

    def hashes(kind) -> DataFrame:
        columns = orders.select(
            F.concat(F.lit("t"), "o_custkey").alias("table"), F.col("o_orderkey").cast("int").alias("ordinal"), F.concat(F.lit("c"), "o_orderkey").alias("column"), kind.alias("type"), F.lit(True).alias("nullable"),
            *[F.lit(None).cast("string").alias(c) for c in ("default", "generated", "collation")], F.lit(False).alias("identity"),
        )
        none = spark.createDataFrame([], "table string, kind string, name string, ordinal int, column string, detail string")
        return catalog.component_hashes(columns, none).where("component = 'whole'")

    before, after = hashes(F.col("o_orderstatus")), hashes(F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return evidence.compare_values(before, after, "table", "sha256", "schema-hash").select("table", "check", "code")


@_query(f"""WITH old AS (SELECT o_orderkey, o_orderstatus, 0 AS at FROM {target_sql('orders')}),
    one AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE 'V' END AS o_orderstatus, 2 AS at FROM orders WHERE o_orderkey % 5 < 2),
    two AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 11 = 0),
    first AS (SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM one) UNION ALL SELECT * FROM one WHERE o_orderkey % 5 = 0)
    SELECT * FROM first WHERE o_orderkey NOT IN (SELECT o_orderkey FROM two)""")
def upserts_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in buckets after two batches of changes (of a key's rows in a batch the last counts), one of them delivered twice."""
    names = ["o_orderkey", "o_orderstatus", "at"]
    orders = table(spark, sf_dir, "orders")
    held = buckets.BucketTable(_root(spark), "orders", ("o_orderkey",), 16)
    buckets.load(derived(orders, "o_orderkey", "o_orderstatus", "'X'").withColumn("at", F.lit(0)).select(*names), held)
    some = orders.where("o_orderkey % 5 < 2")
    early = some.select("o_orderkey", F.lit("W").alias("o_orderstatus"), F.lit(1).alias("at"), F.lit("upsert").alias("op"))
    late = some.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "U").otherwise("V").alias("o_orderstatus"), F.lit(2).alias("at"), F.when(F.col("o_orderkey") % 5 == 0, "upsert").otherwise("delete").alias("op"))
    gone = orders.where("o_orderkey % 11 = 0").select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus"), F.lit(3).alias("at"), F.lit("delete").alias("op"))
    for batch, df in ((0, early.unionAll(late)), (1, gone), (0, early)):
        upsert_batch(df, batch, held, "at")
    return buckets.read_buckets(spark, held).select(*names)
