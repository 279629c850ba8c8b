"""Digest trees, evidence that follows from changed rows, checkpoints, and other proofs, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import scalars
from evenkeel.functions.canonical import order_key
from evenkeel.operators import apply, catalog, delta, digest_tree, evidence, ledger, mapping, validate
from evenkeel.operators.violations import ContractError
from evenkeel.plans.table_plan import Column, DatabasePlan, ForeignKey, TablePlan
from evenkeel.queries.commits import _PLANS, _root
from evenkeel.queries.derive import CUSTOMER, ORDERS, both_sides, compared_sql, derived, drifted, drifted_sides, evidence_digest_sql, key_hash_sql, row_hash_sql, table, target_sql
from evenkeel.sources import artifacts, bucketed, captures, snapshots

QUERIES, ORACLE_SQL = {}, {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _tree_sql(hashes: str) -> str:
    """CTEs ``leaves`` and ``inner_nodes`` of a digest tree over ``hashes`` (r: range hash, h: content hash)."""
    sums = ", ".join(f"sum(CAST(('0x' || substr(h, {8 * i + 1}, 8)) AS UBIGINT))::HUGEINT AS l{i}" for i in range(8))
    sql, carry = f"(SELECT substr(r, 1, 4) AS prefix, count(*) AS n, {sums} FROM ({hashes}) GROUP BY 1)", "0"
    for i in range(7, -1, -1):
        sql = f"(SELECT *, (l{i} + {carry}) % 4294967296 AS w{i}, (l{i} + {carry}) // 4294967296 AS c{i} FROM {sql})"
        carry = f"c{i}"
    words = " || ".join(f"lpad(to_hex(w{i}::BIGINT), 8, '0')" for i in range(8))
    return f"""leaves AS (SELECT prefix, n AS rows, sha256(unhex({words})) AS sha256 FROM {sql}),
    inner_nodes AS (SELECT substr(prefix, 1, 2) AS prefix, sum(rows)::BIGINT AS rows, sha256(string_agg(prefix || '|' || rows || '|' || sha256, chr(10) ORDER BY prefix)) AS sha256 FROM leaves GROUP BY 1)"""


_ROOT_SQL = "coalesce(sum(rows), 0)::BIGINT AS rows, sha256(coalesce(string_agg(prefix || '|' || rows || '|' || sha256, chr(10) ORDER BY prefix), '')) AS sha256 FROM inner_nodes"


def _relation_sql(text: str, source: str) -> str:
    return f"WITH {_tree_sql(f'SELECT sha256({text}) AS r, r AS h FROM {source}')} SELECT {_ROOT_SQL}"


@_query(_relation_sql("'{\"s_suppkey\":' || s_suppkey || ',\"s_nationkey\":' || s_nationkey || '}'", "supplier"))
def relation_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return evidence.relation_digest(rows, ("s_name",), "tree")


@_query(_relation_sql("'{\"c_custkey\":' || c_custkey || ',\"c_mktsegment\":\"' || hex(c_mktsegment) || '\"}'", "customer"))
def literal_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.relation_digest(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), (), "tree", ("c_mktsegment",))


def _hashes_sql(source: str) -> str:
    return f"SELECT {key_hash_sql(ORDERS)} AS r, {row_hash_sql(ORDERS)} AS h FROM {source}"


@_query(f"""WITH {_tree_sql(_hashes_sql('orders'))}
    SELECT 'leaf' AS level, prefix, rows, sha256 FROM leaves UNION ALL SELECT 'inner', prefix, rows, sha256 FROM inner_nodes UNION ALL SELECT 'root', '', {_ROOT_SQL}""")
def orders_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of a table's digest tree."""
    return digest_tree.table_tree(table(spark, sf_dir, "orders"), ORDERS)


_CHANGED_SQL = f"SELECT substr(key_sha256, 1, 4) AS prefix, count(source_row_sha256) AS l, count(target_row_sha256) AS r, count(*) FILTER (kind <> 'unchanged') AS n FROM ({compared_sql('orders')}) GROUP BY 1"


@_query(f"SELECT prefix, l AS left_rows, r AS right_rows FROM ({_CHANGED_SQL}) WHERE n > 0")
def differing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaves in which a table and its other side differ, found from the root down."""
    source, target, plan = both_sides(spark, sf_dir, "orders")
    found = digest_tree.differing(digest_tree.table_tree(source, plan), digest_tree.table_tree(target, plan))
    return found.where("level = 'leaf'").drop("level")


@_query(f"SELECT * FROM ({compared_sql('orders')}) WHERE kind <> 'unchanged'")
def delta_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_tree.plan_by_ranges(*both_sides(spark, sf_dir, "orders"))


@_query(f"SELECT * FROM ({compared_sql('customer')}) WHERE kind <> 'unchanged' ORDER BY c_custkey LIMIT 1")
def first_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_tree.first_difference(*both_sides(spark, sf_dir, "customer"))


@_query(f"""SELECT 'orders' AS "table", (SELECT count(*) FROM orders) AS row_count, {evidence_digest_sql('h', f"(SELECT {row_hash_sql(ORDERS)} AS h FROM orders)")} AS aggregate_sha256,
    (SELECT count(*) - count(o_orderpriority) FROM orders) AS null_priorities, (SELECT count(o_custkey) FROM orders) AS related""")
def evidence_after_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of a table after a plan, from that before it and the changed rows alone; the SQL counts the table anew."""
    source, target, plan = both_sides(spark, sf_dir, "orders")
    before, ops = evidence.stored(ledger.measures(target, plan), "ledger"), evidence.stored(delta.plan_delta(source, target, plan), "ops")
    written, _ = delta.select_planned(source, ops, plan)
    replaced, _ = delta.partition_by_keys(target, ops.where("kind <> 'insert'"), plan)
    after = ledger.ledger_evidence(ledger.advance(before, ops, evidence.stored(written, "written"), evidence.stored(replaced, "replaced"), plan))
    return after.select("table", "row_count", "aggregate_sha256", F.col("null_counts")["o_orderpriority"].alias("null_priorities"), F.col("relationship_counts")["orders_customer"].alias("related"))


@_query("""SELECT * FROM (VALUES ('other operations', 'canonical_delta_plan_conflict', 0::BIGINT), ('before', 'canonical_delta_checkpoint_missing', 0), ('at the checkpoint', 'equal', 0)) AS v(step, outcome, differences)
    UNION ALL SELECT 'source went on', 'row-count-mismatch', count(*) FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT 'target drifted', 'ledger-mismatch', count(*) FROM orders WHERE o_orderkey % 9 = 0""")
def checkpoint_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan with other operations is refused; a committed one is the measure of its target when its source has gone on."""
    root, db = _root(spark), DatabasePlan("main", _PLANS)
    source = {n: table(spark, sf_dir, n).select(*p.names) for n, p in _PLANS.items()}
    old = {"customer": drifted(source["customer"], "c_custkey", "c_mktsegment", "'CHANGED'"), "orders": drifted(source["orders"], "o_orderkey", "o_orderstatus", "'X'")}
    snapshots.publish(spark, root, {n: snapshots.stage(df, root, n) for n, df in old.items()})
    now = snapshots.read_database(spark, root, db)
    ops = {n: evidence.stored(delta.plan_delta(source[n], now[n], p), "ops") for n, p in _PLANS.items()}
    check = apply.Checkpoint("main", "plan-1", "1" * 64, delta.operations_sha256(ops), "3" * 64, "4" * 64, 1, "5" * 64)
    apply.write_fence(spark, root, check)
    steps = []

    def refused(step: str, run) -> None:
        try:
            run()
            steps.append((step, "not refused", 0))
        except ContractError as error:
            steps.append((step, ",".join(sorted(error.codes)), 0))

    refused("other operations", lambda: apply.apply_database(spark, root, db, source, ops | {"orders": ops["orders"].where("kind <> 'delete'")}, check))
    refused("before", lambda: apply.reconcile(spark, root, db, check))
    apply.apply_database(spark, root, db, source, ops, check)
    bad = apply.reconcile(spark, root, db, check).count()
    steps.append(("at the checkpoint", "different" if bad else "equal", bad))
    later = source | {"customer": source["customer"].where("c_custkey % 5 <> 0")}
    row = apply.reconcile(spark, root, db, check, later).where("check = 'row-count'").first()
    steps.append(("source went on", row["code"], int(row["observed"]) - int(row["expected"])))
    snapshots.publish(spark, root, {"orders": snapshots.stage(source["orders"].where("o_orderkey % 9 <> 0"), root, "orders")})
    row = apply.reconcile(spark, root, db, check).where("field = 'rows:'").first()
    steps.append(("target drifted", row["code"], int(row["expected"]) - int(row["observed"])))
    return spark.createDataFrame(steps, "step string, outcome string, differences bigint")


_LINES_SQL = "SELECT o_custkey % 64 AS part, o_orderkey, o_orderkey || '|' || o_orderpriority || chr(10) AS line FROM orders"


@_query(f"SELECT part, sum(strlen(line))::BIGINT AS byte_length, sha256(string_agg(line, '' ORDER BY o_orderkey)) AS observed_sha256 FROM ({_LINES_SQL}) GROUP BY 1")
def artifact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of exported lines, read back in blocks: each file's length and hash."""
    folder = _root(spark)
    lines = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 64).alias("part"), "o_orderkey", F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").drop("o_orderkey").write.partitionBy("part").text(folder)
    files = artifacts.scan_files(spark, folder, "part-*")
    return files.select(F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint").alias("part"), "byte_length", "observed_sha256")


def _evidence_sql(name: str, plan: TablePlan, source: str | None = None) -> str:
    source = source or name
    return f"SELECT '{name}' AS \"table\", (SELECT count(*) FROM {source}) AS rows, {evidence_digest_sql('h', f'(SELECT {row_hash_sql(plan)} AS h FROM {source})')} AS aggregate_sha256"


_BOTH_SQL = f"{_evidence_sql('orders', ORDERS)} UNION ALL {_evidence_sql('customer', CUSTOMER)}"


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n).select(*p.names) for n, p in _PLANS.items()}


@_query(_BOTH_SQL)
def observed_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database copied in one read of each table, proved by what was counted while writing."""
    root, db = _root(spark), DatabasePlan("main", _PLANS)
    apply.copy_database(spark, _sources(spark, sf_dir), db, root)
    written = snapshots.read_database(spark, root, db)
    found = ledger.ledger_evidence(ledger.database_ledger({n: (written[n], p) for n, p in _PLANS.items()}))
    return found.select("table", F.col("row_count").alias("rows"), "aggregate_sha256")


@_query(f"""SELECT 'one' AS database, 'verified' AS state, t.* FROM ({_evidence_sql('orders', ORDERS)}) t
    UNION ALL SELECT 'two', 'verified', t.* FROM ({_evidence_sql('orders', ORDERS, target_sql('orders'))}) t UNION ALL SELECT 'two', 'verified', t.* FROM ({_evidence_sql('customer', CUSTOMER)}) t""")
def final_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two databases, delivered one by one under one inventory, made final and verified again; their recorded evidence."""
    folder, source = _root(spark), _sources(spark, sf_dir)
    one, two = {"orders": (source["orders"], ORDERS)}, {"orders": (derived(source["orders"], "o_orderkey", "o_orderstatus", "'X'"), ORDERS), "customer": (source["customer"], CUSTOMER)}
    captures.deliver(spark, {"one": one}, folder, ["one", "two"])
    captures.deliver(spark, {"two": two}, folder)
    captures.finalise(spark, folder, {"one": {"orders": ORDERS}, "two": {"orders": ORDERS, "customer": CUSTOMER}})
    states, out = captures.deliver(spark, {"one": one, "two": two}, folder), None
    for name, entry in captures.inventory(spark, folder)[1]["delivered"].items():
        said = spark.read.parquet(f"{folder}/{entry['folder']}/_evidence").select(F.lit(name).alias("database"), F.lit(states[name]).alias("state"), "table", F.col("row_count").alias("rows"), "aggregate_sha256")
        out = said if out is None else out.unionAll(said)
    return out


@_query(f"""SELECT 'replayed' AS outcome, rows, aggregate_sha256 FROM ({_evidence_sql('orders', ORDERS)})
    UNION ALL SELECT 'capture_content_mismatch', count(*), NULL FROM orders WHERE o_orderkey % 3 = 0""")
def capture_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured rows come back as they were; after rows were lost the capture is refused."""
    folder, orders = _root(spark), _sources(spark, sf_dir)["orders"]
    captures.capture_table(orders, ORDERS, folder, "main")
    good = evidence.table_evidence(captures.replay_capture(spark, folder, ORDERS), ORDERS).select(F.lit("replayed").alias("outcome"), F.col("row_count").alias("rows"), "aggregate_sha256")
    said = spark.read.parquet(f"{folder}/manifest")
    broken, outcome = f"{folder}-broken", "replayed"
    orders.where("o_orderkey % 3 <> 0").write.parquet(f"{broken}/rows")
    said.write.parquet(f"{broken}/manifest")
    try:
        captures.replay_capture(spark, broken, ORDERS)
    except ContractError as error:
        outcome = ",".join(error.codes)
    lost = said.select("rows").crossJoin(F.broadcast(spark.read.parquet(f"{broken}/rows").agg(F.count("*").alias("n"))))  # one row and one row
    return good.unionAll(lost.select(F.lit(outcome), F.col("rows") - F.col("n"), F.lit(None).cast("string")))


@_query("SELECT * FROM (VALUES ('same', ''), ('column missing', 'delta_row_shape_invalid'), ('column more', 'delta_row_shape_invalid')) AS v(shape, code), (SELECT count(*) AS rows FROM orders)")
def exact_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, out = _sources(spark, sf_dir)["orders"], None
    for shape, df in (("same", orders), ("column missing", orders.drop("o_orderdate")), ("column more", orders.withColumn("extra", F.lit(1)))):
        code = ""
        try:
            validate.check_shape(df, ORDERS)
        except ContractError as error:
            code = ",".join(error.codes)
        one = df.agg(F.count("*").alias("rows")).select(F.lit(shape).alias("shape"), F.lit(code).alias("code"), "rows")
        out = one if out is None else out.unionAll(one)
    return out


_FILLED = TablePlan("supplier", (Column("s_suppkey", "bigint"), Column("level", "integer", default="literal:7"), Column("word", "text", default="literal:new"), Column("visits", "numeric(18,2)", default="zero"), Column("made", "timestamp without time zone", default="utc-now"), Column("seen", "timestamp with time zone", default="now"), Column("id", "uuid", default="uuid")), ("s_suppkey",))


@_query("SELECT s_suppkey, 7 AS level, 'new' AS word, 0::DECIMAL(18,2) AS visits, true AS timely, true AS same_moment, true AS unique_id FROM supplier")
def default_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds of defaults: literals and zero by value, both clocks within a day and a moment of each other, ids by form and number."""
    rows = mapping.with_defaults(table(spark, sf_dir, "supplier").select("s_suppkey"), _FILLED)
    rows = evidence.stored(rows, "defaults")
    ids = rows.agg(F.count_distinct("id").alias("ids"), F.count("*").alias("n"))
    near = lambda a, b, seconds: F.abs(F.unix_micros(a) - F.unix_micros(b)) <= seconds * 1_000_000
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    made = F.col("made").cast("timestamp")
    form = F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$") & (F.col("ids") == F.col("n"))
    checked = rows.crossJoin(F.broadcast(ids))  # one row
    return checked.select("s_suppkey", "level", "word", "visits", near(made, utc, 86_400).alias("timely"), near(F.to_utc_timestamp("seen", F.current_timezone()), made, 60).alias("same_moment"), form.alias("unique_id"))


_WRITTEN = TablePlan("customer", (Column("c_custkey", "bigint"), Column("c_name", "text"), Column("c_acctbal", "numeric(18,2)"), Column("twice", "numeric(18,2)", generated="c_acctbal * 2")), ("c_custkey",))


@_query(f"SELECT {key_hash_sql(CUSTOMER)} AS key_sha256, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer")
def update_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update names its row by the key's hash and writes neither key nor generated columns."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), F.lit(0).alias("twice"))
    return mapping.update_projection(rows, _WRITTEN)


@_query("""WITH s AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'insert' WHEN event_id % 7 <> 0 THEN 'replay' END AS seen, CASE WHEN event_id % 4 = 0 THEN 'replay' WHEN event_id % 6 <> 1 THEN CASE WHEN event_id % 13 = 0 THEN 'insert' ELSE 'replay' END END AS part FROM events)
    SELECT event_id, part AS expected, seen AS observed FROM s WHERE part IS DISTINCT FROM seen""")
def adoption_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared partition into inserts and replays against the observed one, id by id."""
    key, k = F.concat_ws("-", "event_type", F.col("event_id").cast("string")), F.col("event_id")
    source = table(spark, sf_dir, "events").select("event_id", key.alias("event_key"), "user_id", "value", "ts")
    existing = source.where("event_id % 13 <> 0").withColumn("user_id", F.when(k % 7 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    inserts, replays, _ = delta.adopt(source, existing, "event_id", "event_key")
    declared = source.select("event_id", F.when(k % 4 == 0, "replay").when(k % 6 != 1, F.when(k % 13 == 0, "insert").otherwise("replay")).alias("part")).where("part is not null")
    return delta.partition_drift(declared, inserts, replays, "event_id", "events").select(F.col("field").cast("bigint").alias("event_id"), "expected", "observed")


_UTF16 = "string_agg(CASE WHEN c < 65536 THEN lpad(to_hex((c % 256) * 256 + c // 256), 4, '0') ELSE lpad(to_hex((h % 256) * 256 + h // 256), 4, '0') || lpad(to_hex((l % 256) * 256 + l // 256), 4, '0') END, '' ORDER BY i)"


@_query(f"""WITH t AS (SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 0 THEN 'é' WHEN 1 THEN chr(128512) WHEN 2 THEN chr(57344) ELSE '' END AS s FROM part),
    u AS (SELECT p_partkey, unnest(string_split(s, '')) AS x, unnest(range(length(s))) AS i FROM t),
    v AS (SELECT p_partkey, i, unicode(x)::BIGINT AS c, 55296 + (unicode(x)::BIGINT - 65536) // 1024 AS h, 56320 + (unicode(x)::BIGINT - 65536) % 1024 AS l FROM u)
    SELECT p_partkey, sum(CASE WHEN c < 65536 THEN 1 ELSE 2 END)::BIGINT AS units, sha256(unhex({_UTF16})) AS sha256 FROM v GROUP BY 1""")
def unicode_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code units and digest of texts in UTF-16, beyond the basic plane as well."""
    k = F.col("p_partkey") % 4
    text = F.concat("p_name", F.when(k == 0, "é").when(k == 1, "\U0001f600").when(k == 2, "\ue000").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.utf16_units(text).alias("units"), scalars.utf16_digest(text).alias("sha256"))


_CHECKED = {
    "orders": TablePlan("orders", ORDERS.columns, ("o_orderkey",), foreign_keys=(ForeignKey("orders_customer", ("o_custkey",), "customer", ("c_custkey",)),)),
    "customer": TablePlan("customer", CUSTOMER.columns, ("c_nationkey", "c_mktsegment")),
}


@_query("""SELECT 'orders' AS "table", 'key' AS kind, 'orders_key' AS name, 'o_orderkey' AS columns, 0::BIGINT AS broken
    UNION ALL SELECT 'customer', 'key', 'customer_key', 'c_nationkey,c_mktsegment', (SELECT count(*) FROM (SELECT 1 FROM customer WHERE c_custkey % 11 <> 0 GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1))
    UNION ALL SELECT 'orders', 'foreign', 'orders_customer', 'o_custkey', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0))""")
def constraints_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constraints that plans declare, each with the number of cases in which the tables break it."""
    tables = _sources(spark, sf_dir)
    tables["customer"] = tables["customer"].where("c_custkey % 11 <> 0")
    found = None
    for name, plan in _CHECKED.items():
        repeated = delta.duplicate_keys(tables[name], plan.key).agg(F.count("*").alias("broken"))
        ones = [repeated.select(F.lit(f"{name}_key").alias("name"), "broken")]
        ones += [validate.fk_orphans(tables[name], tables[fk.parent], fk).agg(F.count("*").alias("broken")).select(F.lit(fk.name).alias("name"), "broken") for fk in plan.foreign_keys]
        for one in ones:
            found = one if found is None else found.unionAll(one)
    declared = catalog.grouped_constraints(catalog.plan_constraints(spark, _CHECKED))
    return declared.join(found, "name", "left").select("table", "kind", "name", F.array_join("columns", ",").alias("columns"), "broken")


@_query("""WITH t AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN chr(128512) WHEN 1 THEN chr(57344) WHEN 2 THEN chr(65533) WHEN 3 THEN chr(65536) ELSE 'z' END || p_name AS k FROM part),
    u AS (SELECT p_partkey, unnest(string_split(k, '')) AS x, unnest(range(length(k))) AS i FROM t),
    v AS (SELECT p_partkey, i, unicode(x)::BIGINT AS c FROM u),
    h AS (SELECT p_partkey, string_agg(CASE WHEN c < 65536 THEN lpad(to_hex(c), 4, '0') ELSE lpad(to_hex(55296 + (c - 65536) // 1024), 4, '0') || lpad(to_hex(56320 + (c - 65536) % 1024), 4, '0') END, '' ORDER BY i) AS k FROM v GROUP BY 1)
    SELECT p_partkey, row_number() OVER (ORDER BY lower(k), p_partkey) - 1 AS rank FROM h""")
def text_key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys within and beyond the basic plane in the order of their UTF-16 code units."""
    first = F.element_at(F.array(*[F.lit(x) for x in ("\U0001f600", "\ue000", "\ufffd", "\U00010000", "z")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    rows = table(spark, sf_dir, "part").select("p_partkey", order_key(F.concat(first, "p_name"), "text").alias("k"))
    return evidence.ranked_by(rows, ["k", "p_partkey"]).select("p_partkey", "rank")


@_query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::DECIMAL(18,2) AS o_totalprice, o_orderdate, o_orderpriority FROM orders")
def bucketed_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drifted copy brought to its source, with both sides and the operations in buckets by key."""
    source, target, plan = drifted_sides(spark, sf_dir, "orders")
    root = _root(spark)
    source, target = bucketed.stage_sides(source, target, plan, root, 16)
    after = bucketed.apply_bucketed(source, target, bucketed.plan_bucketed(source, target, plan, root, 16), plan)
    return after.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


@_query("SELECT * FROM (VALUES ('limit', 'row_limit_exceeded'), ('known empty', 'source_empty_table_drift')) AS v(rule, code), (SELECT count(*) AS rows FROM customer)")
def refused_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of more rows than its limit, and one that should be empty."""
    customer, out = table(spark, sf_dir, "customer"), None
    known = TablePlan("customer", CUSTOMER.columns, CUSTOMER.key, known_empty=True)
    for rule, run in (("limit", lambda: validate.require_at_most(customer, 5)), ("known empty", lambda: validate.require_empty(customer, known))):
        code = "accepted"
        try:
            run()
        except ContractError as error:
            code = ",".join(error.codes)
        one = customer.agg(F.count("*").alias("rows")).select(F.lit(rule).alias("rule"), F.lit(code).alias("code"), "rows")
        out = one if out is None else out.unionAll(one)
    return out
