"""Every query against its SQL, at the smallest scale."""

import os

import duckdb
import pytest

from evenkeel import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(rows):
    return sorted((tuple(None if v is None else v.isoformat() if hasattr(v, "isoformat") else str(v) for v in r) for r in rows), key=str)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sql, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = plain(df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in registry.ORACLE_SQL:
        assert got
        return
    found = sql.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert got == plain([[r[names.index(c)] for c in columns] for r in found.fetchall()])


@pytest.fixture(scope="module")
def far(tmp_path_factory):
    """Orders, customers and events half of whose keys lie beyond ten million, so that a key and ten million are both keys."""
    folder, con = tmp_path_factory.mktemp("far"), duckdb.connect()
    for t, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("events", "event_id")):
        rows = f"read_parquet('{DATA}/{t}.parquet')"
        moved = f"CASE WHEN {key} < n THEN {key} ELSE {key} - n + 10000000 END AS {key}"
        con.execute(f"copy (select * exclude (n) replace ({moved}) from {rows}, (select (max({key}) + 1) // 2 AS n from {rows})) to '{folder}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return str(folder), con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")
@pytest.mark.parametrize("name", ["database_applied_once", "checkpoint_bound", "apply_delta_orders", "bucketed_apply", "adoption_partition", "preservation_diff"])
def test_a_drifted_copy_has_no_key_twice(spark, far, name):
    """Tables whose keys go beyond what the copy's new keys are shifted by."""
    df = registry.QUERIES[name](spark, far[0])
    columns = sorted(df.columns)
    got = plain(df.select(*[f"`{c}`" for c in columns]).collect())
    found = far[1].execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert got == plain([[r[names.index(c)] for c in columns] for r in found.fetchall()])
