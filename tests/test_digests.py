import hashlib

from pyspark.sql import functions as F

from evenkeel.functions.canonical import row_hash
from evenkeel.operators import catalog, evidence, history, preserve
from evenkeel.plans.table_plan import Column, TablePlan


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sorted_digest_has_no_limit_of_rows(spark, monkeypatch):
    monkeypatch.setattr(evidence, "EXACT_ROWS", 10)
    rows = [i % 30 for i in range(50)] + [7] * 40
    df = spark.createDataFrame([(i,) for i in rows], "a int").repartition(5)
    got = evidence.relation_digest(df, mode="sorted").first()
    assert (got["rows"], got["sha256"]) == (90, sha("".join(sorted(sha(f'{{"a":{i}}}') for i in rows))))
    assert tuple(evidence.relation_digest(df.limit(0), mode="sorted").first()) == (0, sha(""))


def test_joined_hashes_gather_no_group(spark):
    rows = [("a" if i % 3 else None, f"t{i % 40}", "h") for i in range(90)]
    df = spark.createDataFrame(rows, "run string, table string, operations_sha256 string").repartition(4)
    found = history.database_operations_hash(df, ["run"])
    assert "collect_list" not in plan(found)
    want = {g: sha("|".join(sorted(f"{t}:{h}" for r, t, h in rows if r == g))) for g in ("a", None)}
    assert {r["run"]: r["operations_sha256"] for r in found.collect()} == want
    hashes = df.select("table", F.lit("whole").alias("component"), F.lit("x").alias("sha256"))
    found = catalog.schema_fingerprint(hashes)
    assert "collect_list" not in plan(found) and found.first()[0] == sha("\n".join(sorted(f"{t}|x" for _, t, _ in rows)))
    assert catalog.schema_fingerprint(hashes.limit(0)).first()[0] == sha("")


def test_occurrences_are_numbered_by_partition(spark):
    df = spark.createDataFrame([(1, None)] * 30 + [(None, 2)] * 11 + [(3, 3)], "a int, b int").repartition(4)
    found = preserve.occurrence_facts(df, ["a", "b"])
    assert "__part" in plan(found) and found.columns == ["a", "b", "occurrence"]
    got = sorted((r["a"] or 0, r["occurrence"]) for r in found.collect())
    assert got == sorted([(1, i + 1) for i in range(30)] + [(0, i + 1) for i in range(11)] + [(3, 1)])


def test_a_chunked_digest_has_two_levels_for_any_number_of_chunks(spark):
    keyed = TablePlan("t", (Column("id", "bigint"), Column("v", "text")), ("id",))
    df = spark.range(1403).selectExpr("id", "cast(id * 7 as string) as v")
    hashes = [r["h"] for r in df.select("id", row_hash(keyed.columns).alias("h")).orderBy("id").collect()]
    for rows in (10, 100, 2000):
        chunks = [sha("\n".join(hashes[i : i + rows])) for i in range(0, len(hashes), rows)]
        assert evidence.ordered_digest(df.repartition(5), keyed, "chunked", rows).first()[0] == sha("\n".join(chunks)), f"{len(chunks)} chunks of {rows}"
    assert evidence.ordered_digest(df.limit(0), keyed, "chunked", 10).first()[0] == sha("")
