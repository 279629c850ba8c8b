"""Checks of rows, values, order and history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import scalars
from evenkeel.operators import evidence, history, mapping, validate
from evenkeel.plans.table_plan import Check, Column, TablePlan, Unique
from evenkeel.queries.derive import DOCUMENTS, EVENTS, ORDERS, evidence_digest_sql, row_hash_sql, table

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


@_query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE NOT coalesce(l_quantity * nullif(l_linenumber - 1, 0) < 100, true) GROUP BY 1")
def check_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Check("quantity", "l_quantity * nullif(l_linenumber - 1, 0) < 100")
    return _count(validate.check_violations(table(spark, sf_dir, "lineitem"), rule.name, rule.expression), "l_returnflag")


_NULLED = "(SELECT nullif(user_id % 5, 0) AS u, event_type, value FROM events)"


@_query(f"SELECT u, event_type, count(*) AS n FROM {_NULLED} GROUP BY 1, 2 HAVING count(*) > 1")
def unique_violations_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.nullif(F.col("user_id") % 5, F.lit(0)).alias("u"), "event_type")
    return validate.unique_violations(rows, Unique("u", ("u", "event_type")))


@_query(f"SELECT u, event_type, count(*) AS n FROM {_NULLED} WHERE u IS NOT NULL AND event_type IS NOT NULL AND value > 50 GROUP BY 1, 2 HAVING count(*) > 1")
def unique_violations_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.nullif(F.col("user_id") % 5, F.lit(0)).alias("u"), "event_type", "value")
    return validate.unique_violations(rows, Unique("u", ("u", "event_type"), nulls_distinct=True, predicate="value > 50"))


@_query("SELECT lower(e) AS event_type, count(*) AS n FROM (SELECT CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS e FROM events) GROUP BY 1 HAVING count(*) > 1")
def unique_violations_caseless(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("event_type"))
    return validate.unique_violations(rows, Unique("e", ("event_type",), case_insensitive=True))


@_query("SELECT min(v) AS value, count(DISTINCT v) AS spellings, count(*)::BIGINT AS rows FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS v FROM orders) GROUP BY lower(v) HAVING count(DISTINCT v) > 1")
def collated_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 2 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority")).alias("v"))
    return validate.collation_collisions(rows, "v")


@_query("SELECT 'events' AS \"table\", 'not-null' AS \"check\", 'not_null_violation' AS code, '0' AS expected, CAST(count(*) AS VARCHAR) AS observed, 'user_id' AS field FROM events WHERE user_id % 5 = 0 HAVING count(*) > 0")
def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = TablePlan("events", (Column("event_id", "bigint", False), Column("user_id", "bigint", False), Column("value", "real")))
    rows = table(spark, sf_dir, "events").withColumn("user_id", F.nullif(F.col("user_id") % 5, F.lit(0)))
    return validate.not_null_violations(rows, plan)


@_query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE length(c_mktsegment) <> 10 GROUP BY 1")
def width_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count(validate.width_violations(table(spark, sf_dir, "customer"), {"c_mktsegment": 10}), "c_mktsegment")


@_query("SELECT vec_id FROM embeddings WHERE vec_id % 9 = 0")
def array_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x, i: F.when((F.col("vec_id") % 9 == 0) & (i == 2), None).otherwise(x)).alias("e"))
    return validate.array_violations(rows, "e").select("vec_id")


@_query("SELECT max(octet_length(encode(text)))::BIGINT AS text, max(octet_length(encode(source)))::BIGINT AS source FROM documents")
def max_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.max_lengths(table(spark, sf_dir, "documents"), ["text", "source"])


@_query("SELECT 'documents' AS \"table\", 'lob-bound' AS \"check\", 'source_lob_bound_exceeded' AS code, '2000' AS expected, CAST(max(octet_length(encode(text))) AS VARCHAR) AS observed, 'text' AS field FROM documents HAVING max(octet_length(encode(text))) > 2000")
def lob_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.lob_violations(table(spark, sf_dir, "documents"), DOCUMENTS, {"text": 1000})


_SIZE = "(16 * 5 + length('doc_id' || 'text' || 'lang' || 'source' || 'n_chars') + 8 + 8 + octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source)))"


@_query(f"SELECT doc_id, {_SIZE}::BIGINT AS row_bytes FROM documents WHERE {_SIZE} > 4000")
def oversize_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.oversize_rows(table(spark, sf_dir, "documents"), DOCUMENTS, 4000).select("doc_id", "row_bytes")


@_query("SELECT count(*) AS rows, sum(octet_length(encode('{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"}')))::BIGINT AS json_bytes FROM events")
def size_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.size_probe(table(spark, sf_dir, "events").select("event_id", "event_type"))


@_query("SELECT doc_id, length(text)::BIGINT AS units FROM documents")
def unicode_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    checked = rows.select("doc_id", scalars.utf16_units(F.col("text")).alias("units"), scalars.utf16_digest(F.col("text")).alias("sha256"))
    return checked.where("length(sha256) = 64").select("doc_id", "units")


@_query("SELECT event_id, ts, (event_id % 10)::SMALLINT AS \"tsSubMicrosecondTicks\" FROM events")
def split_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(scalars.micros_text(F.col("ts")), (F.col("event_id") % 10).cast("string"))
    return mapping.split_ticks(table(spark, sf_dir, "events").select("event_id", text.alias("ts")), ["ts"])


@_query("SELECT 'ts' AS field, CAST(count(*) AS VARCHAR) AS observed FROM events WHERE event_id % 6 = 0")
def archive_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 6 != 0, F.concat(scalars.micros_text(F.col("ts")), F.lit("3"))).otherwise(scalars.micros_text(F.col("ts")))
    return mapping.archive_projection(table(spark, sf_dir, "events").select("event_id", text.alias("ts")), ["ts"], ("ts",))[1].select("field", "observed")


@_query("SELECT code, count(*) AS n FROM (SELECT CASE WHEN event_id % 5 = 0 THEN 'outcome_id_invalid' WHEN event_id % 7 = 0 THEN 'outcome_key_invalid' WHEN length(event_type) > 6 THEN 'outcome_origin_invalid' ELSE 'good' END AS code FROM events) GROUP BY 1")
def map_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        (F.when(F.col("event_id") % 5 == 0, -1).otherwise(1) * (F.col("event_id") + 1)).alias("id"),
        F.when(F.col("event_id") % 7 == 0, " ").otherwise(F.col("event_id").cast("string")).alias("key"),
        F.col("event_type").alias("origin"), F.concat(scalars.micros_text(F.col("ts")), F.lit("1")).alias("at"),
    )
    good, bad = mapping.map_outcome(rows, "id", "key", "origin", "at", most_origin=6)
    return _count(bad.select("code").unionAll(good.select(F.lit("good").alias("code"))), "code")


_PRICE, _QUANTITY, _PERCENT = "CAST(l_extendedprice AS DECIMAL(10,2))", "CAST(l_quantity AS DECIMAL(6,2))", "CAST(l_discount * 100 AS DECIMAL(5,2))"


@_query(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CAST({_PRICE} * {_QUANTITY} AS DECIMAL(17,4)) AS product, CAST({_PRICE} - {_QUANTITY} AS DECIMAL(11,2)) AS difference, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS days,
    CAST(CAST({_PRICE} * {_QUANTITY} AS DECIMAL(17,4)) - CAST(CAST({_PRICE} * {_QUANTITY} AS DECIMAL(17,4)) * {_PERCENT} AS DECIMAL(23,6)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS subtotal, l_orderkey + l_linenumber AS total FROM lineitem""")
def generated_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, quantity = F.col("l_extendedprice").cast("decimal(10,2)"), F.col("l_quantity").cast("decimal(6,2)")
    percent = (F.col("l_discount") * 100).cast("decimal(5,2)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        scalars.decimal_product(price, (10, 2), quantity, (6, 2)).alias("product"),
        scalars.decimal_difference(price, (10, 2), quantity, (6, 2)).alias("difference"),
        scalars.day_difference(F.lit("1995-01-01"), F.col("l_shipdate")).cast("bigint").alias("days"),
        scalars.discounted_subtotal(price, (10, 2), quantity, (6, 2), percent, (5, 2), (18, 2)).alias("subtotal"),
        (F.col("l_orderkey") + F.col("l_linenumber")).alias("total"),
    )


@_query("SELECT o_orderkey FROM orders WHERE o_orderkey % 9 = 0")
def generated_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = TablePlan("orders", (Column("o_orderkey", "bigint"), Column("doubled", "bigint", generated="o_orderkey * 2")), ("o_orderkey",))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") * 2 + (F.col("o_orderkey") % 9 == 0).cast("bigint")).alias("doubled"))
    return validate.generated_violations(rows, plan).select("o_orderkey")


@_query("SELECT c_custkey, trim(coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, '') || ' ' || coalesce(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END, '')) AS full_name FROM customer")
def full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.when(F.col("c_custkey") % 3 != 0, F.col("c_name"))
    last = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.full_name(first, last).alias("full_name"))


@_query("SELECT event_id, '{\"a\":' || event_id || ',\"z\":' || props || '}' AS props FROM events")
def canonical_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('{"z": '), F.col("props"), F.lit(', "a": '), F.col("event_id").cast("string"), F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", scalars.sorted_json(text).alias("props"))


ORACLE_SQL["canonical_json_props"] = "SELECT event_id, '{\"a\":' || event_id || ',\"z\":' || replace(props, ' ', '') || '}' AS props FROM events"


@_query("SELECT l_suppkey, 'delta_duplicate_key' AS code, sum(CASE WHEN p = k THEN 1 ELSE 0 END)::BIGINT AS n FROM (SELECT l_suppkey, k, lag(k) OVER (PARTITION BY l_suppkey ORDER BY o, l_partkey, l_linenumber) AS p FROM (SELECT l_suppkey, l_partkey, l_linenumber, l_orderkey AS k, l_orderkey AS o FROM lineitem)) WHERE p = k GROUP BY 1")
def key_order_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("o", F.struct("l_orderkey", "l_partkey", "l_linenumber"))
    return _count(validate.key_order_violations(rows, "o", ["l_orderkey"], ["l_suppkey"]), "l_suppkey", "code")


_SWAPPED = "(SELECT event_id, user_id, CASE WHEN event_id % 19 = 0 THEN event_id + 100 ELSE event_id END AS k FROM events)"


@_query(f"SELECT code, count(*) AS n FROM (SELECT CASE WHEN lag(k) OVER w = k THEN 'delta_duplicate_key' WHEN lag(k) OVER w > k THEN 'delta_key_order_invalid' END AS code FROM {_SWAPPED} WINDOW w AS (ORDER BY event_id)) WHERE code IS NOT NULL GROUP BY 1")
def key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over all events."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 19 == 0, F.col("event_id") + 100).otherwise(F.col("event_id")).alias("k"))
    return _count(validate.key_order_violations(rows, "event_id", ["k"], []), "code")


_WINDOWS = "(SELECT user_id AS run, event_id AS ordinal, ts AS started_at, ts + INTERVAL 6 HOUR AS completed_at FROM events)"


@_query(f"SELECT code, count(*) AS n FROM (SELECT CASE WHEN completed_at < started_at THEN 'read_window_invalid' WHEN lag(completed_at) OVER (PARTITION BY run ORDER BY ordinal) > started_at THEN 'read_window_overlap' WHEN completed_at > (SELECT max(ts) FROM events) THEN 'read_window_outside' END AS code FROM {_WINDOWS}) WHERE code IS NOT NULL GROUP BY 1")
def read_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = events.select(F.col("user_id").alias("run"), F.col("event_id").alias("ordinal"), F.col("ts").alias("started_at"), F.expr("ts + interval 6 hours").alias("completed_at"))
    low = events.agg(F.min("ts").alias("run_started_at"), F.max("ts").alias("run_completed_at"))
    return _count(validate.read_window_violations(rows.crossJoin(F.broadcast(low)), ["run"]), "code")


@_query("SELECT code, count(*) AS n FROM (SELECT CASE WHEN conv_id % 7 = 0 AND turn = 2 THEN 'chain_link_broken' END AS code FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn FROM conversations)) WHERE code IS NOT NULL GROUP BY 1")
def hash_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.row_number().over(w).alias("at"), F.sha2("text", 256).alias("own"), F.lag(F.sha2("text", 256)).over(w).alias("before"))
    rows = rows.withColumn("before", F.when((F.col("conv_id") % 7 == 0) & (F.col("at") == 2), "f00").otherwise(F.col("before")))
    return _count(validate.chain_violations(rows, ["conv_id"], "at", "own", "before"), "code")


@_query("SELECT conv_id, count(*) AS n FROM (SELECT conv_id, turn, max(CASE WHEN turn % 3 <> 1 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM conversations) WHERE later = 1 AND turn % 3 = 1 GROUP BY 1")
def applied_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") % 3 != 1).alias("applied"))
    return _count(validate.prefix_violations(rows, ["conv_id"], "turn"), "conv_id")


@_query("SELECT delete, count(*) AS n FROM (SELECT event_type = 'error' AS delete, CASE WHEN event_type = 'error' THEN min(event_id % 8) OVER w < event_id % 8 ELSE max(event_id % 8) OVER w > event_id % 8 END AS bad FROM events WINDOW w AS (PARTITION BY user_id, event_type = 'error' ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE bad GROUP BY 1")
def op_log_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") % 8).alias("rank"), F.when(F.col("event_type") == "error", "delete").otherwise("insert").alias("kind"))
    bad = validate.op_order_violations(rows, ["user_id"], "event_id", "rank")
    return _count(bad.select((F.col("kind") == "delete").alias("delete")), "delete")


@_query("SELECT user_id, arg_min(event_type, (priority, event_type)) AS code, min(priority) AS priority FROM (SELECT user_id, event_type, event_id % 4 AS priority FROM events) GROUP BY 1")
def first_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("code"), (F.col("event_id") % 4).alias("priority"))
    return validate.first_by_priority(rows, ["user_id"])


ORACLE_SQL["first_by_priority"] = "SELECT user_id, code, priority FROM (SELECT user_id, event_type AS code, event_id % 4 AS priority, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 4, event_type) AS r FROM events) WHERE r = 1"


@_query("SELECT c_name AS name, CASE WHEN s.n IS NULL THEN 'missing' ELSE 'duplicate' END AS state, coalesce(s.n, 0) AS n FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) s ON c.c_custkey = s.o_custkey WHERE s.n IS NULL OR s.n > 1")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    seen = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("name")
    return validate.coverage(seen, customers, "name")


@_query("SELECT 'left' AS side, s, n FROM (SELECT c_mktsegment AS s, c_nationkey AS n FROM customer EXCEPT ALL SELECT c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 9 <> 0) UNION ALL SELECT 'right', s, n FROM (SELECT c_mktsegment AS s, c_nationkey AS n FROM customer WHERE c_custkey % 9 <> 0 EXCEPT ALL SELECT c_mktsegment, c_nationkey FROM customer)")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("s"), F.col("c_nationkey").alias("n"), "c_custkey")
    return validate.set_difference(rows.select("s", "n"), rows.where("c_custkey % 9 <> 0").select("s", "n"))


@_query("SELECT c_nationkey, CASE WHEN max(c_custkey) % 2 = 0 THEN max(c_custkey) + 5 ELSE max(c_custkey) END AS next_value FROM customer GROUP BY 1")
def sequence_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.max("c_custkey").alias("current"))
    states = states.withColumns({"increment": F.lit(5), "is_called": F.col("current") % 2 == 0})
    return validate.sequence_next(states).select("c_nationkey", "next_value")


@_query("SELECT 'orders' AS \"table\", 'identity' AS \"check\", 'identity_next_value_too_low' AS code, CAST(max(o_orderkey) + 1 AS VARCHAR) AS expected, '10' AS observed, 'o_orderkey' AS field FROM orders")
def identity_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.identity_floor(table(spark, sf_dir, "orders"), "o_orderkey", 10, "orders")


@_query("""SELECT code, count(*) AS n FROM (SELECT CASE WHEN doc_id % 11 = 0 THEN 'artifact_not_full' WHEN lang = 'fr' THEN 'artifact_name_invalid' WHEN n_chars <= 100 THEN 'artifact_empty' WHEN doc_id % 7 = 0 THEN 'artifact_hash_mismatch' END AS code FROM documents) WHERE code IS NOT NULL GROUP BY 1""")
def artifact_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = F.sha2("text", 256)
    rows = table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 11 == 0, "log").otherwise("full").alias("backup_type"),
        F.when(F.col("lang") == "fr", "a b").otherwise("a.bak").alias("file_name"),
        F.when(F.col("n_chars") <= 100, 0).otherwise(F.col("n_chars")).alias("byte_length"),
        sha.alias("sha256"), F.when(F.col("doc_id") % 7 == 0, F.sha2("source", 256)).otherwise(sha).alias("observed_sha256"), F.lit(None).cast("string").alias("cloud_sha256"),
    )
    return _count(validate.artifact_violations(rows), "code")


@_query("SELECT user_id, max(ts) AS capture_time, count(*) FILTER (ts < TIMESTAMP '2024-01-05' OR ts > TIMESTAMP '2024-01-20') AS outside FROM events GROUP BY 1")
def capture_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.col("ts").alias("completed_at"), F.expr("timestamp_ntz'2024-01-05'").alias("observed_at"), F.expr("timestamp_ntz'2024-01-20'").alias("captured_at"))
    return validate.capture_times(rows, ["user_id"])


def _checkpoints(spark: SparkSession, sf_dir: str):
    sha = lambda c: F.sha2(c.cast("string"), 256)
    plans = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("run"), F.col("o_orderkey").alias("database"), F.col("o_orderkey").cast("string").alias("plan_id"),
        sha(F.col("o_orderkey")).alias("plan_sha256"), F.col("o_orderdate").alias("cutoff"), sha(F.col("o_custkey")).alias("operations_sha256"),
    )
    k = F.col("database")
    journal = plans.where(k % 10 != 0).withColumns({"evidence_sha256": sha(k + 1), "committed_at": F.col("cutoff")})
    journal = journal.withColumn("operations_sha256", F.when(k % 7 == 0, "x").otherwise(F.col("operations_sha256"))).unionByName(journal.where(k % 11 == 0))
    evidence_rows = plans.where(k % 13 != 0).select("run", "database", sha(k + 1).alias("evidence_sha256"), F.when(k % 3 == 0, F.expr("cutoff - interval 1 day")).otherwise(F.col("cutoff")).alias("reconciled_at"))
    return plans, journal, evidence_rows


@_query("""SELECT code, count(*) AS n FROM (SELECT CASE WHEN k % 10 = 0 THEN 'checkpoint_missing' WHEN k % 11 = 0 THEN 'checkpoint_duplicate' WHEN k % 7 = 0 THEN 'checkpoint_operations_mismatch'
    WHEN k % 13 = 0 THEN 'checkpoint_evidence_mismatch' WHEN k % 3 = 0 THEN 'checkpoint_after_reconciliation' END AS code FROM (SELECT o_orderkey AS k FROM orders)) WHERE code IS NOT NULL GROUP BY 1""")
def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count(history.checkpoint_violations(*_checkpoints(spark, sf_dir)), "code")


@_query("SELECT count(*) AS n FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 4 = 0")
def committed_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans, journal, _ = _checkpoints(spark, sf_dir)
    return history.committed(journal.dropDuplicates(["database"]), plans.where("database % 4 = 0")).agg(F.count("*").alias("n"))


@_query("""SELECT code, count(*) AS n FROM (SELECT CASE WHEN k % 6 = 0 THEN 'receipt_fence_mismatch' WHEN k % 10 = 0 THEN 'receipt_not_committed' WHEN k % 9 = 0 THEN 'receipt_later_commit' WHEN k % 11 = 0 THEN 'receipt_plan_repeated' END AS code FROM (SELECT o_orderkey AS k FROM orders)) WHERE code IS NOT NULL GROUP BY 1""")
def receipt_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans, journal, _ = _checkpoints(spark, sf_dir)
    k = F.col("database")
    later = journal.where((k % 9 == 0) & (k % 10 != 0)).dropDuplicates(["database"]).withColumns({"plan_id": F.lit("later"), "plan_sha256": F.lit("later"), "committed_at": F.expr("committed_at + interval 1 day")})
    fences = plans.select("database", F.when(k % 6 == 0, -1).otherwise(k).alias("target_generation"))
    receipts = plans.select("database", "plan_sha256", k.alias("target_generation"))
    return _count(history.receipt_violations(receipts, fences, journal.unionByName(later)), "code")


@_query("""SELECT code, count(*) AS n FROM (SELECT CASE WHEN k % 5 = 0 THEN 'capture_missing' WHEN k % 7 = 0 THEN 'capture_row_count_mismatch' WHEN k % 9 = 0 THEN 'capture_evidence_mismatch' WHEN k % 11 = 0 THEN 'capture_outside_window' END AS code FROM (SELECT o_orderkey AS k FROM orders)) WHERE code IS NOT NULL GROUP BY 1""")
def capture_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("run"), k.alias("table"), "o_orderdate", (k % 4).alias("inserts"), (k % 3).alias("updates"), (k % 100).alias("unchanged"))
    t = F.col("table")
    plans = orders.select("run", "table", "inserts", "updates", "unchanged", F.col("o_orderdate").alias("started_at"), F.expr("o_orderdate + interval 1 hour").alias("completed_at"))
    rows = F.col("inserts") + F.col("updates")
    manifests = orders.where(t % 5 != 0).select(
        "run", "table", t.cast("string").alias("capture_id"), F.sha2(t.cast("string"), 256).alias("sha256"), (rows + (t % 7 == 0).cast("int")).alias("rows"),
        F.when(t % 11 == 0, F.expr("o_orderdate - interval 1 hour")).otherwise(F.col("o_orderdate")).alias("captured_at"),
    )
    seen = orders.select("run", "table", (rows + F.col("unchanged") + (t % 9 == 0).cast("int")).alias("row_count"))
    return _count(history.capture_violations(manifests, plans, seen), "code")


@_query("SELECT side, count(*) AS n FROM (SELECT CASE WHEN event_id % 4 = 0 THEN 'second' END AS side FROM events UNION ALL SELECT CASE WHEN event_id % 4 = 0 OR event_id % 6 = 0 THEN 'first' END FROM events) WHERE side IS NOT NULL GROUP BY 1")
def shared_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").select(F.col("event_type").alias("table"), F.col("event_id").alias("capture_id"), F.sha2("props", 256).alias("sha256"), F.col("user_id").alias("rows"))
    second = first.withColumn("rows", F.when(F.col("capture_id") % 4 == 0, -1).otherwise(F.col("rows"))).where("capture_id % 6 <> 0 or capture_id % 4 = 0")
    return _count(history.shared_captures(first, second), "side")


@_query("SELECT state, count(*) AS n FROM (SELECT CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 THEN 'applied' WHEN event_id % 3 = 0 THEN 'third' WHEN event_id % 7 = 0 THEN 'third' ELSE 'prior' END AS state FROM events) GROUP BY 1")
def mixed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("database")
    facts = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("database"), F.sha2("props", 256).alias("sha256"))
    now = facts.withColumn("sha256", F.when(e % 7 == 0, "changed").otherwise(F.col("sha256")))
    markers = facts.where(e % 3 == 0).select("run", "database", F.col("sha256").alias("marker_sha256"), F.col("sha256").alias("checkpoint_sha256"), F.when(e % 5 == 0, "x").otherwise(F.col("sha256")).alias("reconciliation_sha256"))
    return _count(history.mixed_state(facts, now, markers), "state")


@_query("SELECT state, count(*) AS n FROM (SELECT CASE WHEN k % 5 = 0 THEN 'unprovisioned' WHEN k % 3 = 0 THEN 'replayed' WHEN k % 7 = 0 THEN 'settled-prior' ELSE 'pending' END AS state FROM (SELECT event_id AS k FROM events)) GROUP BY 1")
def metadata_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").select(F.col("event_id").alias("database"))
    k = F.col("database")
    plans = d.select("database", F.lit("p").alias("schema_plan_sha256"), F.lit("q").alias("plan_sha256"))
    fences = d.where(k % 5 != 0).select("database", F.when(k % 7 == 0, "old").otherwise("p").alias("schema_plan_sha256"))
    journal = d.where((k % 3 == 0) & (k % 5 != 0)).select("database", F.lit("q").alias("plan_sha256"))
    return _count(history.metadata_state(d, fences, journal, plans), "state")


@_query("SELECT o_orderstatus AS run, sha256(string_agg(o_orderkey || ':' || o_orderpriority, '|' ORDER BY o_orderkey || ':' || o_orderpriority)) AS operations_sha256 FROM orders GROUP BY 1")
def database_operations_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("run"), F.col("o_orderkey").cast("string").alias("table"), F.col("o_orderpriority").alias("operations_sha256"))
    return history.database_operations_hash(rows, ["run"])


@_query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE coalesce(value::DECIMAL(18,2), 0) END AS value, event_type FROM events")
def cast_to_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = TablePlan("events", (Column("event_id", "bigint"), Column("value", "numeric(18,2)"), Column("event_type", "text")))
    rows = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 5 != 0, F.col("value")))
    return mapping.cast_to_plan(rows, plan)


@_query("SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS note, 'new' AS state, 0::INTEGER AS visits FROM supplier")
def overlay_and_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = TablePlan("supplier", (Column("s_suppkey", "bigint"), Column("s_name", "text"), Column("visits", "integer", default="zero")), ("s_suppkey",))
    rows = mapping.with_defaults(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), plan)
    return mapping.add_overlay(rows, {"note": ("text", None), "state": ("text", "new")})


@_query("SELECT c_custkey, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING'")
def dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mapping.migrating(table(spark, sf_dir, "customer").withColumn("disposition", F.when(F.col("c_mktsegment") == "BUILDING", "Migrate").otherwise("Ignore")))
    return mapping.dispose(rows, "copy", {"copy": lambda df: df.select("c_custkey", "c_name")}, {"c_name": "name"})


@_query("SELECT 'target_' || n_name AS sequence, n_nationkey::BIGINT AS next_value FROM nation WHERE n_nationkey % 4 <> 0")
def sequence_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    seen = nation.select(F.col("n_name").alias("sequence"), F.col("n_nationkey").cast("bigint").alias("next_value"))
    names = nation.where("n_nationkey % 4 <> 0").select(F.col("n_name").alias("source_name"), F.concat(F.lit("target_"), "n_name").alias("target_name"))
    return mapping.map_sequence_keys(seen, names)[0]


def _document_sql(plan: TablePlan) -> str:
    """A table's part of the report, as text."""
    columns = " || ',' || ".join(f"'{{\"column\":\"{c}\",\"nulls\":' || (SELECT count(*) FILTER ({c} IS NULL) FROM {plan.name}) || '}}'" for c in sorted(plan.names))
    keys = " || ',' || ".join(f"'{{\"name\":\"{k.name}\",\"rows\":' || (SELECT count({k.columns[0]}) FROM {plan.name}) || '}}'" for k in plan.foreign_keys) or "''"
    digest = evidence_digest_sql("h", f"(SELECT {row_hash_sql(plan)} AS h FROM {plan.name})")
    return f"""'{{"name":"{plan.name}","rows":' || (SELECT count(*) FROM {plan.name}) || ',"aggregate":"' || {digest} || '","columns":[' || {columns} || '],"foreignKeys":[' || {keys} || ']}}'"""


@_query(f"""SELECT 'main' AS database, '{{"database":"main","tables":[' || {_document_sql(EVENTS)} || ',' || {_document_sql(ORDERS)} || ']}}' AS document""")
def evidence_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"orders": (table(spark, sf_dir, "orders"), ORDERS), "events": (table(spark, sf_dir, "events"), EVENTS)}
    return history.evidence_document(evidence.database_evidence(parts), "main")


@_query("SELECT s.c AS next_key, 'key-mismatch' AS code FROM (SELECT 1 AS c) s WHERE false")
def compare_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.max("c_custkey").alias("v")).select(F.col("c_nationkey").cast("string").alias("table"), "v")
    moved = nation.withColumn("v", F.when(F.col("table").cast("int") % 5 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return evidence.compare_values(nation, moved, "table", "v", "sequence").select("table", "code")


ORACLE_SQL["compare_sequences"] = "SELECT CAST(c_nationkey AS VARCHAR) AS \"table\", 'sequence-mismatch' AS code FROM customer WHERE c_nationkey % 5 = 0 GROUP BY 1"
