"""Tables in hash buckets: what a batch writes, what is read, compaction, crashes and replays."""

import random

import pytest

from evenkeel.operators.violations import ContractError
from evenkeel.sources import buckets, snapshots
from evenkeel.sources.buckets import BucketTable, append_changes, compact, load, manifest, read_buckets
from evenkeel.streaming.upsert import upsert_batch, upsert_stream

SCHEMA = "id long, v string, at int"
CHANGES = "id long, v string, at int, op string"


def rows_of(spark, table):
    return sorted(tuple(r) for r in read_buckets(spark, table).select("id", "v", "at").collect())


def files_below(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("part-*")}


def test_a_batch_writes_touched_buckets_only(spark, tmp_path):
    table = BucketTable(f"file://{tmp_path}", "t", ("id",), 256)
    load(spark.range(5000).selectExpr("id", "concat('v', id) as v", "0 as at"), table)
    before = files_below(tmp_path)
    assert len(before) == 256
    changed = spark.range(20).selectExpr("id * 211 as id", "'new' as v", "1 as at", "'upsert' as op")
    touched = {r.b for r in changed.select(buckets.bucket_of(table).alias("b")).collect()}
    assert append_changes(changed, table, "at", 0)
    after = files_below(tmp_path)
    new = set(after) - set(before)
    assert {k: after[k] for k in before} == before, "no base file is written again"
    assert len(new) == len(touched) < 30 and all("/change-" in f"/{x}" for x in new)
    assert rows_of(spark, table) == sorted((i, "new" if i % 211 == 0 and i < 20 * 211 else f"v{i}", 1 if i % 211 == 0 and i < 20 * 211 else 0) for i in range(5000))
    state = snapshots.current_state(spark, table.root)
    assert not append_changes(changed, table, "at", 0)
    assert files_below(tmp_path) == after and snapshots.current_state(spark, table.root) == state, "a batch that comes again changes nothing"


def test_untouched_buckets_are_plain_scans(spark, tmp_path):
    table = BucketTable(f"file://{tmp_path}", "t", ("id",), 16)
    load(spark.range(100).selectExpr("id", "'v' as v", "0 as at"), table)
    assert "Join" not in read_buckets(spark, table)._jdf.queryExecution().executedPlan().toString()
    append_changes(spark.createDataFrame([(5, "x", 1, "delete")], CHANGES), table, "at", 0)
    _, _, files = manifest(spark, table)
    touched = {f.bucket for f in files if f.kind == "change"}
    merged = buckets._merged(spark, table, [f for f in files if f.bucket in touched])
    assert len(touched) == 1 and merged.count() < 20 and read_buckets(spark, table).count() == 99


@pytest.mark.parametrize("ratio", [0.0, 0.6, 1e9])
def test_any_history_against_a_dictionary(spark, tmp_path, ratio):
    rng, known = random.Random(7), {}
    table = BucketTable(f"file://{tmp_path}", "t", ("id",), 8)
    for batch in range(6):
        rows, latest = [], {}
        for at in range(rng.randint(0, 30)):
            row = (rng.choice([None, *range(25)]), f"{batch}-{at}", at, rng.choice(["upsert", "upsert", "delete"]))
            rows.append(row)
            latest[row[0]] = row
        for key, row in latest.items():
            known.pop(key, None)
            if row[3] == "upsert":
                known[key] = row[:3]
        for _ in range(2):
            upsert_batch(spark.createDataFrame(rows, CHANGES), batch, table, "at", ratio, 3)
        if known or batch > 2:
            assert sorted((tuple(r) for r in read_buckets(spark, table).collect()), key=str) == sorted(known.values(), key=str)
    _, last, files = manifest(spark, table)
    assert last == 5 and max(sum(f.bucket == b and f.kind == "change" for f in files) for b in range(8)) <= 3
    if ratio == 0.0:
        assert {f.kind for f in files} == {"base"}


def test_compaction_takes_heavy_buckets(spark, tmp_path):
    table = BucketTable(f"file://{tmp_path}", "t", ("id",), 8)
    load(spark.range(4000).selectExpr("id", "concat('value ', id) as v", "0 as at"), table)
    one = spark.range(4000).selectExpr("id", "concat('other ', id) as v", "1 as at", "'upsert' as op").where(buckets.bucket_of(table) == 3)
    few = spark.createDataFrame([(i, "x", 1, "upsert") for i in range(8)], CHANGES)
    append_changes(one, table, "at", 0)
    append_changes(few, table, "at", 1)
    before = rows_of(spark, table)
    assert compact(spark, table) == [3]
    _, _, files = manifest(spark, table)
    assert [f.kind for f in files if f.bucket == 3] == ["base"] and "change" in {f.kind for f in files}
    assert rows_of(spark, table) == before and compact(spark, table) == []
    unused = buckets.unused_folders(spark, table)
    buckets.remove_unused(spark, table, unused)
    assert any(x.startswith("manifest-") for x in unused) and rows_of(spark, table) == before


def test_appending_while_compacting(spark, tmp_path, monkeypatch):
    table = BucketTable(f"file://{tmp_path}", "t", ("id",), 2)
    load(spark.range(10).selectExpr("id", "'v' as v", "0 as at"), table)
    append_changes(spark.createDataFrame([(1, "a", 1, "upsert"), (2, "a", 1, "delete")], CHANGES), table, "at", 0)
    write = buckets._write

    def slow(df, *args):
        out = write(df, *args)
        if args[1] == "base":
            monkeypatch.setattr(buckets, "_write", write)
            assert append_changes(spark.createDataFrame([(1, "b", 2, "upsert"), (2, "b", 2, "upsert")], CHANGES), table, "at", 1)
        return out

    monkeypatch.setattr(buckets, "_write", slow)
    assert compact(spark, table, 0.0)
    assert [r for r in rows_of(spark, table) if r[0] in (1, 2)] == [(1, "b", 2), (2, "b", 2)]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """A manifest that another writer put in between is taken up, and no change is lost."""
    table = BucketTable(f"file://{tmp_path}", "t", ("id",), 2)
    load(spark.range(10).selectExpr("id", "'v' as v", "0 as at"), table)
    append_changes(spark.createDataFrame([(1, "a", 1, "upsert")], CHANGES), table, "at", 0)
    put = buckets._publish

    def late(*args):
        monkeypatch.setattr(buckets, "_publish", put)
        assert compact(spark, table, 0.0)
        return put(*args)

    monkeypatch.setattr(buckets, "_publish", late)
    assert append_changes(spark.createDataFrame([(1, "b", 2, "upsert"), (3, "b", 2, "delete")], CHANGES), table, "at", 1)
    assert [r for r in rows_of(spark, table) if r[0] in (1, 2, 3)] == [(1, "b", 2), (2, "v", 0)]


def test_a_run_that_fails_leaves_nothing(spark, tmp_path, monkeypatch):
    table = BucketTable(f"file://{tmp_path}", "t", ("id",), 4)
    load(spark.range(10).selectExpr("id", "'v' as v", "0 as at"), table)
    before = rows_of(spark, table)
    changed = spark.createDataFrame([(1, "a", 1, "upsert")], CHANGES)
    with monkeypatch.context() as m:
        m.setattr(buckets, "publish", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            append_changes(changed, table, "at", 0)
    assert rows_of(spark, table) == before
    assert append_changes(changed, table, "at", 0) and (1, "a", 1) in rows_of(spark, table)


def test_wrong_keys_and_tables(spark, tmp_path):
    table = BucketTable(f"file://{tmp_path}", "t", ("id",), 4)
    with pytest.raises(ContractError, match="bucket_table_empty"):
        read_buckets(spark, table)
    load(spark.range(10).selectExpr("id", "'v' as v", "0 as at"), table)
    with pytest.raises(ContractError, match="bucket_table_exists"):
        load(spark.range(10).selectExpr("id", "'v' as v", "0 as at"), table)
    with pytest.raises(ContractError, match="bucket_table_mismatch"):
        read_buckets(spark, BucketTable(table.root, "t", ("id",), 8))


def test_stream(spark, tmp_path):
    table, inbox = BucketTable(f"file://{tmp_path}/root", "t", ("id",), 4), f"{tmp_path}/in"
    rows = spark.createDataFrame([(1, "a", 1, "upsert"), (2, "b", 1, "upsert")], CHANGES)
    rows.write.parquet(inbox)
    changes = spark.readStream.schema(rows.schema).parquet(inbox)
    for _ in range(2):  # the second run finds nothing new
        upsert_stream(changes, table, "at", f"{tmp_path}/cp").awaitTermination(60)
    assert rows_of(spark, table) == [(1, "a", 1), (2, "b", 1)]
    spark.createDataFrame([(2, "b", 3, "delete"), (3, "c", 3, "upsert")], CHANGES).write.mode("append").parquet(inbox)
    upsert_stream(changes, table, "at", f"{tmp_path}/cp").awaitTermination(60)
    assert rows_of(spark, table) == [(1, "a", 1), (3, "c", 3)]
