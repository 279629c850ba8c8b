import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenkeel.llm import knn


def brute(rows, k):
    """By the contract: whole numbers without bound, every row its own query and candidate."""
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(64 * x) for x in v)]
    out = []
    for at, (q, v) in enumerate(good):
        if q % 20 == 0:
            score = lambda w: min(max(sum(a * b for a, b in zip(v, w)), -(2**63)), 2**63 - 1)  # noqa: E731, B023
            best = sorted((-score(w), i) for other, (i, w) in enumerate(good) if other != at)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_results_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(knn, "BLOCK", block)
    monkeypatch.setattr(knn, "CHUNK", 3)
    rng = random.Random(6)
    rows = [(i, [rng.gauss(i % 5, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [1.0] * 6) for i in range(80)]  # one vector many times: ties go to the smaller id
    rows += [(2000, None), (2020, []), (2040, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2060, [float("nan")] * 6), (2080, [float("inf")] * 6), (None, [1.0] * 6), (2100, [2.0]), (2120, [3e8, -3e8, 1e8, 5.0, 0.1, 0.0]), (20, [9.0] * 6), (20, [9.0] * 6), (21, [2e9, 1.0]), (2140, [2.0**26, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("x"), "cell": F.lit(1), "score": F.lit(0)})
    got = knn.exact_top_k(df, F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 20))


def test_products_beyond_doubles_and_64_bits(spark):
    rows = [(0, [1e15, 1e-2]), (1, [1e15, 1.0]), (2, [1e30, 3.0]), (3, [-1e30, 3.0]), (20, [1e30, 1e30]), (4, [1e30, -1e30, 7.0]), (40, [0.0, 1.0, 1.0]), (5, [1e307, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = knn.exact_top_k(df, F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 20))


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in knn.exact_top_k(df, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 64 * 64 * 11)]
    assert knn.exact_top_k(df.limit(0), F.col("vec_id") % 20 == 0).isEmpty()


def test_batches_are_cut_by_pivots(spark, monkeypatch):
    """With room for a few rows at once, and with a vector of no components, the results are the same."""
    rows = [(i, [float((i * 7 + k * 3) % 11 - 5) for k in range(4)]) for i in range(300)] + [(400, []), (401, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plain = sorted(map(tuple, knn.exact_top_k(df, F.col("vec_id") % 20 == 0, k=5).collect()))
    monkeypatch.setattr(knn, "ENTRIES", 200)
    assert sorted(map(tuple, knn.exact_top_k(df, F.col("vec_id") % 20 == 0, k=5).collect())) == plain and plain
    batch = pa.RecordBatch.from_arrays([pa.array(range(10))], ["x"])
    assert [b.num_rows for b in knn._portions(iter([batch]), 70)] == [2] * 5 and [b.num_rows for b in knn._portions(iter([batch]), 999)] == [1] * 10


def test_a_query_is_copied_for_units_and_not_for_cells(spark, monkeypatch):
    """Where bounds leave out nothing, a query is stored once, with the units that it goes to, of which there are far fewer than cells."""
    rng, stored = random.Random(8), {}
    rows = [(i, [rng.gauss(0, 1) for _ in range(24)]) for i in range(2000)]
    monkeypatch.setattr(knn, "cut", lambda df, name, cut=knn.cut: stored.setdefault(name, cut(df, name)))
    got = knn.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 20))
    assert stored["elsewhere"].count() == 100
    assert stored["elsewhere"].agg(F.max(F.size("units"))).first()[0] <= 2 * 2000 / knn.SMALL_BLOCK
    assert stored["cells"].agg(F.max(F.length("vec"))).first()[0] == 2 * 24, "two bytes for each number"


def test_units_hold_whole_cells_of_about_a_block():
    rng = np.random.default_rng(1)
    pivots, sizes = np.concatenate([rng.normal(0, 1, (200, 5)), rng.normal(9, 1, (200, 5))]), rng.integers(0, 50, 400)
    sizes[7] = 5000
    unit = knn._units(pivots, sizes, 300)
    held = np.bincount(unit, sizes)
    assert unit[7] not in np.delete(unit, 7) and (np.delete(held, unit[7]) <= 300).all() and len(held) <= 3 * sizes.sum() / 300
    assert len(set(unit[:200]) & set(unit[200:])) <= 1, "cells far apart are not of one unit, but for the one where rows are halved"
    assert len(set(knn._units(np.array([[1e307, 0], [-1e307, 1], [0, 1e200], [1, 1]]), np.array([5, 5, 5, 5]), 5))) == 4
    assert list(knn._units(np.zeros((1, 0)), np.array([9]), 3)) == [0]


@pytest.mark.parametrize(("size", "kind"), [(100, "i1"), (1000, "i2"), (2**20, "i4"), (2**40, "f8")])
def test_types_hold_all_numbers(spark, size, kind):
    rng = random.Random(size)
    rows = [(i, [float(rng.randint(-size, size)) / 64 for _ in range(3)]) for i in range(120)]
    assert next(t for t, most in knn.TYPES if size <= most) == kind
    got = knn.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 20))
