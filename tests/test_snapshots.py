import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import apply, delta, evidence
from evenkeel.operators.violations import ContractError
from evenkeel.plans.table_plan import Column, DatabasePlan, ForeignKey, Identity, TablePlan
from evenkeel.sources import captures, snapshots

PLAN = TablePlan("t", (Column("id", "bigint", False), Column("v", "text")), ("id",))


def table(spark, n, text="x"):
    return spark.range(n).select("id", F.concat(F.lit(text), "id").alias("v"))


def test_copy_apply_and_publish(spark, tmp_path):
    root, db = f"file://{tmp_path}", DatabasePlan("d", {"t": PLAN})
    apply.copy_database(spark, {"t": table(spark, 10)}, db, root)
    first = snapshots.read_database(spark, root, db)["t"]
    assert first.count() == 10
    source = table(spark, 12).where("id <> 3")
    ops = delta.plan_delta(source, first, PLAN)
    apply.apply_and_publish(source, first, ops, PLAN, root)
    assert first.count() == 10, "readers keep their version"
    now = snapshots.read_database(spark, root, db)["t"]
    assert delta.plan_delta(source, now, PLAN).isEmpty()
    with pytest.raises(ContractError):
        apply.apply_and_publish(source, now, ops, PLAN, root)
    assert snapshots.read_database(spark, root, db)["t"].count() == 11


def test_captures_prove_their_rows(spark, tmp_path):
    folder = f"file://{tmp_path}/capture"
    manifest = captures.capture_table(table(spark, 5), PLAN, folder, "d").first()
    assert manifest["rows"] == 5 and captures.replay_capture(spark, folder, PLAN).count() == 5
    table(spark, 6).write.mode("overwrite").parquet(f"{folder}/rows")
    with pytest.raises(ContractError, match="capture_content_mismatch"):
        captures.replay_capture(spark, folder, PLAN)


def test_export_and_verify(spark, tmp_path):
    folder = f"file://{tmp_path}/export"
    manifest = captures.export_tables({"t": (table(spark, 5), PLAN)}, folder)
    assert manifest.select("manifest_sha256").distinct().count() == 1
    recorded = evidence.database_evidence({"t": (table(spark, 5), PLAN)})
    assert captures.verify_export(spark, folder, {"t": PLAN}, recorded).isEmpty()
    assert not captures.verify_export(spark, folder, {"t": PLAN}, evidence.database_evidence({"t": (table(spark, 6), PLAN)})).isEmpty()
    with pytest.raises(Exception, match="(?i)exist"):
        captures.export_tables({"t": (table(spark, 5), PLAN)}, folder)


def test_archive(spark, tmp_path):
    archive, left = apply.archive_rows(table(spark, 10), "id < 4", ["id"], f"file://{tmp_path}/archive")
    assert archive.count() == 4 and left.count() == 6


def test_pointers_survive_a_crash_and_other_publishers(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    publish = lambda name, **more: snapshots.publish(spark, root, {name: f"{name}/v"}, **more)
    assert publish("a") == 1 and publish("b") == 2
    with monkeypatch.context() as m:  # the file is written, and the run ends before it gets its number
        m.setattr(snapshots.json, "dumps", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish("c")
    (tmp_path / "_pointers" / "00000000000000000003.json.x.tmp").write_text("{")
    assert set(snapshots.current_versions(spark, root)) == {"a", "b"}
    assert not snapshots._write_new(spark, f"{root}/_pointers/{2:020d}.json", "{}"), "a number is given once"
    names = [f"t{i}" for i in range(8)]
    threads = [threading.Thread(target=lambda part=part: [publish(n) for n in part]) for part in (names[:4], names[4:])]
    [t.start() for t in threads]
    [t.join() for t in threads]
    number, state = snapshots.current_state(spark, root)
    assert number == 10 and set(state["versions"]) == {"a", "b", *names}
    with pytest.raises(ContractError, match="snapshot_version_conflict"):
        publish("a", based_on={"a": "a/older"})


PARENT = TablePlan("p", (Column("id", "bigint", False), Column("v", "text")), ("id",), identities=(Identity("id"),))
CHILD = TablePlan("c", (Column("id", "bigint", False), Column("p_id", "bigint")), ("id",), foreign_keys=(ForeignKey("c_p", ("p_id",), "p", ("id",)),))
DB = DatabasePlan("d", {"c": CHILD, "p": PARENT})


def sides(spark, n, text):
    return {"p": table(spark, n, text), "c": spark.range(n).select("id", (F.col("id") % 3).alias("p_id"))}


def test_a_plan_is_applied_once(spark, tmp_path):
    root = f"file://{tmp_path}"
    apply.copy_database(spark, sides(spark, 5, "old"), DB, root)
    now = snapshots.read_database(spark, root, DB)
    source = sides(spark, 7, "new")
    ops = {n: delta.plan_delta(source[n], now[n], p) for n, p in DB.tables.items()}
    ops = {n: spark.createDataFrame(df.collect(), df.schema) for n, df in ops.items()}
    bound = delta.operations_sha256(ops)
    check = apply.Checkpoint("d", "plan-1", "1" * 64, bound, "3" * 64, "4" * 64, 1, "5" * 64)
    run = lambda c=check, s=source, o=ops: apply.apply_database(spark, root, DB, s, o, c)
    with pytest.raises(ContractError, match="canonical_delta_fence_stale"):
        run()  # no fence yet
    apply.write_fence(spark, root, replace(check, target_generation=9))
    with pytest.raises(ContractError, match="canonical_delta_fence_stale"):
        run()
    apply.write_fence(spark, root, check)
    with pytest.raises(ContractError, match="delta_duplicate_key"):
        run(s=source | {"p": source["p"].union(source["p"].limit(1))})
    before = snapshots.current_state(spark, root)
    with pytest.raises(ContractError):
        run(s=sides(spark, 8, "new"))  # the source moved on
    for other in (ops | {"p": ops["p"].where("kind <> 'insert'")}, ops | {"c": ops["p"]}):
        with pytest.raises(ContractError, match="canonical_delta_plan_conflict"):
            run(o=other)  # not the operations of the checkpoint
    with pytest.raises(ContractError, match="canonical_delta_checkpoint_missing"):
        apply.reconcile(spark, root, DB, check)
    assert snapshots.current_state(spark, root) == before, "a failed run leaves nothing visible"
    assert run() == "applied"
    now = snapshots.read_database(spark, root, DB)
    assert all(delta.plan_delta(source[n], now[n], p).isEmpty() for n, p in DB.tables.items())
    journal = snapshots.read_current(spark, root, "_journal", apply.JOURNAL).collect()
    assert [(r["plan_id"], r["operations_sha256"]) for r in journal] == [("plan-1", bound)]
    assert snapshots.read_current(spark, root, "_fence", apply.FENCES).first()["target_generation"] == 2
    assert [tuple(r) for r in snapshots.read_current(spark, root, "_sequences", apply.SEQUENCES).collect()] == [("d", "p", "id", 7)]
    after = snapshots.current_state(spark, root)
    assert run() == "replayed" and snapshots.current_state(spark, root) == after, "a second run changes nothing"
    assert apply.reconcile(spark, root, DB, check).isEmpty() and apply.reconcile(spark, root, DB, check, source).isEmpty()
    codes = lambda df: {r["code"] for r in df.collect()}
    assert "row-count-mismatch" in codes(apply.reconcile(spark, root, DB, check, sides(spark, 9, "new"))), "the source went on, the checkpoint holds"
    for other in (replace(check, operations_sha256="6" * 64), replace(check, plan_id="plan-2"), replace(check, plan_sha256="7" * 64)):
        with pytest.raises(ContractError, match="canonical_delta_plan_conflict"):
            run(other)
    snapshots.publish(spark, root, {"p": snapshots.stage(table(spark, 7, "drift"), root, "p")})
    with pytest.raises(ContractError, match="canonical_delta_replay_target_drift"):
        run()
    assert codes(apply.reconcile(spark, root, DB, check)) == {"ledger-mismatch", "canonical_delta_checkpoint_drift"}
    snapshots.publish(spark, root, {"p": snapshots.stage(table(spark, 3, "new"), root, "p")})
    assert codes(apply.reconcile(spark, root, DB, check)) == {"ledger-mismatch", "canonical_delta_checkpoint_drift", "sequence-mismatch"}


def test_orphans_are_evidence(spark):
    tables = {"c": (spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id long, p_id long"), CHILD), "p": (table(spark, 3), PARENT)}
    found = {r["table"]: r["orphan_counts"] for r in evidence.database_evidence(tables).collect()}
    assert found == {"c": {"c_p": 1}, "p": {}}
    good = evidence.database_evidence(tables | {"c": (spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id long, p_id long"), CHILD)})
    assert "orphan-mismatch" in {r["code"] for r in evidence.compare_evidence(good, evidence.database_evidence(tables)).collect()}


def test_adoption_inserts_and_sets_the_next_identity(spark, tmp_path):
    root = f"file://{tmp_path}"
    snapshots.publish(spark, root, {"p": snapshots.stage(table(spark, 3), root, "p")})
    assert apply.adopt_and_publish(spark, table(spark, 5), PARENT, root, "id", "v") == (2, 3)
    assert apply.adopt_and_publish(spark, table(spark, 5), PARENT, root, "id", "v") == (0, 5)
    assert snapshots.read_current(spark, root, "_sequences", apply.SEQUENCES).first()["next_value"] == 5
    with pytest.raises(ContractError, match="event_row_absent"):
        apply.adopt_and_publish(spark, table(spark, 4), PARENT, root, "id", "v")


def databases_of(spark):
    return {"one": {"p": (table(spark, 3), PARENT)}, "two": {"p": (table(spark, 4), PARENT), "c": (spark.range(4).selectExpr("id", "id % 3 as p_id"), CHILD)}}


PLANS = {"one": {"p": PARENT}, "two": {"p": PARENT, "c": CHILD}}


@pytest.mark.parametrize("step", ["export_tables", "database_evidence", "aligned_sequences", "_entry_digest", "_next_inventory"])
def test_deliveries_go_on_where_they_ended(spark, tmp_path, monkeypatch, step):
    folder, databases = f"file://{tmp_path}/out", databases_of(spark)
    assert captures.deliver(spark, {"one": databases["one"]}, folder, ["two", "one"]) == {"one": "delivered"}
    with pytest.raises(ContractError, match="export_coverage_incomplete"):
        captures.finalise(spark, folder, PLANS)
    before, calls = captures.inventory(spark, folder), []
    with monkeypatch.context() as m:
        m.setattr(captures, step, lambda *a, **k: calls.append(1) or 1 / 0)
        with pytest.raises(ZeroDivisionError):
            captures.deliver(spark, {"two": databases["two"]}, folder)
    assert calls and captures.inventory(spark, folder) == before, "a run that failed leaves nothing in the inventory"
    assert captures.deliver(spark, {"two": databases["two"]}, folder) == {"two": "delivered"}
    assert captures.inventory(spark, folder)[1]["delivered"]["one"] == before[1]["delivered"]["one"]


def test_final_exports(spark, tmp_path):
    folder, databases = f"file://{tmp_path}/out", databases_of(spark)
    captures.deliver(spark, databases, folder)
    with pytest.raises(ContractError, match="export_plan_conflict"):
        captures.deliver(spark, {"three": databases["one"]}, folder)
    with pytest.raises(ContractError, match="export_coverage_incomplete"):
        captures.finalise(spark, folder, {"one": PLANS["one"]})
    digest = captures.finalise(spark, folder, PLANS)
    state = captures.inventory(spark, folder)
    assert state[1]["final"] == digest and captures.finalise(spark, folder, PLANS) == digest
    assert captures.deliver(spark, databases, folder) == {"one": "verified", "two": "verified"} and captures.inventory(spark, folder) == state
    own = state[1]["delivered"]["two"]["folder"]
    codes = lambda: {r["code"] for r in captures.verify_delivered(spark, folder, "two", PLANS["two"]).collect()}
    assert codes() == set()
    spark.createDataFrame([("", "p", "id", 99)], apply.SEQUENCES).write.mode("overwrite").parquet(f"{folder}/{own}/_sequences")
    assert codes() == {"sequence-mismatch"}
    table(spark, 2).write.parquet(f"{folder}/{own}/extra")
    assert codes() == {"export_table_unexpected"}
    table(spark, 2).write.mode("overwrite").parquet(f"{folder}/{state[1]['delivered']['one']['folder']}/p")
    with pytest.raises(ContractError, match="export_file_mismatch"):
        captures.finalise(spark, folder, PLANS)


def test_a_source_may_change_while_it_is_copied(spark, tmp_path, monkeypatch):
    """One read: the copy is the state that was read, and is proved against it."""
    live, root = f"file://{tmp_path}/live", f"file://{tmp_path}/root"
    table(spark, 5).write.parquet(live)
    stage = apply.stage

    def changed_after(df, *args):
        out = stage(df, *args)
        table(spark, 9, "later").write.mode("overwrite").parquet(live)
        return out

    monkeypatch.setattr(apply, "stage", changed_after)
    done = apply.copy_database(spark, {"p": spark.read.parquet(live)}, DatabasePlan("d", {"p": PARENT}), root)
    assert done["p"].rows == 5 and snapshots.read_database(spark, root, DatabasePlan("d", {"p": PARENT}))["p"].count() == 5
    monkeypatch.setattr(apply, "stage", lambda df, root, name: stage(spark.createDataFrame(df.collect()[1:], df.schema), root, name) if df.count() else None)
    with pytest.raises(ContractError, match="shadow_copy_mismatch"):
        apply.copy_table(table(spark, 5), PARENT, root)


def test_a_copy_without_parents_is_not_published(spark, tmp_path):
    root = f"file://{tmp_path}"
    with pytest.raises(ContractError, match="shadow_copy_orphans"):
        apply.copy_database(spark, sides(spark, 7, "x") | {"p": table(spark, 2)}, DB, root)
    assert snapshots.current_versions(spark, root) == {}


def test_a_capture_is_held_against_the_source(spark, tmp_path):
    manifest = captures.capture_table(table(spark, 5), PLAN, f"file://{tmp_path}/c", "d")
    codes = lambda df: [r["code"] for r in captures.snapshot_violations(df, manifest, PLAN).collect()]
    assert codes(table(spark, 5)) == [] and codes(table(spark, 6)) == ["capture_source_count_mismatch"]
    assert codes(table(spark, 5, "y")) == ["capture_source_content_mismatch"]


def test_old_versions_expire(spark, tmp_path):
    root = f"file://{tmp_path}"
    for i in range(5):
        snapshots.publish(spark, root, {"p": snapshots.stage(table(spark, i + 1), root, "p")})
    snapshots.publish(spark, root, {"c": snapshots.stage(table(spark, 1), root, "c")})
    before = snapshots.current_state(spark, root)
    assert len(snapshots.expire(spark, root, 2)) == 4 and snapshots.expire(spark, root, 2) == []
    assert snapshots.current_state(spark, root) == before and len(list((tmp_path / "p").glob("v=*"))) == 1
    assert spark.read.parquet(f"{root}/{before[1]['versions']['p']}").count() == 5
    assert snapshots.publish(spark, root, {"x": "x/v"}) == 7, "numbers go on"


def test_operations_are_resolved_once(spark, tmp_path, monkeypatch):
    root, applied, apply_delta = f"file://{tmp_path}", [], apply.apply_delta
    snapshots.publish(spark, root, {"t": snapshots.stage(table(spark, 10, "old"), root, "t")})
    target, source = snapshots.read_current(spark, root, "t", "id long, v string"), table(spark, 12)
    ops = evidence.stored(delta.plan_delta(source, target, PLAN), "ops")
    monkeypatch.setattr(apply, "apply_delta", lambda s, t, o, p: applied.append(o) or apply_delta(s, t, o, p))
    apply.apply_and_publish(source, target, ops, PLAN, root)
    assert "Join" not in applied[0]._jdf.queryExecution().optimizedPlan().toString(), "what was found to hold is not joined again"
    now = snapshots.read_current(spark, root, "t", "id long, v string")
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, source.collect()))


def test_a_checkpoint_is_read_once(spark, tmp_path, monkeypatch):
    root, db = f"file://{tmp_path}", DatabasePlan("d", {"t": PLAN})
    snapshots.publish(spark, root, {"t": snapshots.stage(table(spark, 10, "old"), root, "t")})
    source, target = {"t": table(spark, 12)}, snapshots.read_database(spark, root, db)
    ops = {"t": evidence.stored(delta.plan_delta(source["t"], target["t"], PLAN), "ops")}
    check = apply.Checkpoint("d", "plan-1", "1" * 64, delta.operations_sha256(ops), "3" * 64, "4" * 64, 1, "5" * 64)
    apply.write_fence(spark, root, check)
    assert apply.apply_database(spark, root, db, source, ops, check) == "applied"
    monkeypatch.setattr(apply, "database_evidence", None)  # the ledger's sums are all that is needed
    assert apply.reconcile(spark, root, db, check).isEmpty()
    snapshots.publish(spark, root, {"t": snapshots.stage(table(spark, 12, "drift"), root, "t")})
    assert {r["code"] for r in apply.reconcile(spark, root, db, check).collect()} == {"ledger-mismatch", "canonical_delta_checkpoint_drift"}
