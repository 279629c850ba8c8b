from collections import defaultdict

import pytest
from corpus import documents, table, words

from evenkeel.llm import mixing


def water(sizes, weights, most=3):
    total, level, capped = sum(sizes), 0.0, set()
    while True:
        rest = [i for i in range(len(sizes)) if i not in capped]
        if not rest:
            break
        level = (total - sum(most * sizes[i] for i in capped)) / sum(weights[i] for i in rest)
        over = {i for i in range(len(sizes)) if most * sizes[i] <= weights[i] * level}
        if over <= capped:
            break
        capped |= over
    return [min(w * level, most * s) for s, w in zip(sizes, weights)]


def test_targets_and_words(spark):
    rows = documents(200)
    got = mixing.mix_sources(table(spark, rows)).collect()
    assert len(got) == len(rows)
    texts, taken, size, target = dict(rows), defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r["size"] == len(words(texts[r["doc_id"]]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    names = sorted((s for s in size if s is not None), key=lambda s: s) + [None]
    want = water([size[s] for s in names], [1 + i % 3 for i in range(len(names))])
    for s, w in zip(names, want):
        assert target[s] == pytest.approx(w)
        assert abs(taken[s] - w) <= 2
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(table(spark, rows).repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_clamped_sources(spark):
    rows = [(i, "w " * (1000 if i < 3 else 10)) for i in range(12)]
    df = spark.createDataFrame([(i, t, f"s{min(i, 5)}") for i, t in rows], "doc_id long, text string, source string")
    got = {r["source"]: (r["source_size"], r["target"]) for r in mixing.mix_sources(df).collect()}
    sizes = [got[s][0] for s in sorted(got)]
    assert [got[s][1] for s in sorted(got)] == pytest.approx(water(sizes, [1, 2, 3, 1, 2, 3]))
    assert sum(t for _, t in got.values()) == pytest.approx(sum(sizes))


def test_odd_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b", None), (1, None, "s"), (1, "", "s"), (2, "a", "t"), (2, "a", "t")], "doc_id long, text string, source string")
    got = mixing.mix_sources(df)
    assert got.count() == 5 and got.where("taken > 3 * size").isEmpty()
    assert mixing.mix_sources(df.limit(0)).isEmpty()
    assert mixing.mix_sources(df.where("doc_id = 1")).where("taken <> 0").isEmpty()
