import re

import pytest
from corpus import LOWER, documents, table

from evenkeel.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, size):
    windows = {}
    for i, t in items:
        w = split(t)
        k = min(size, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + k]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = split(t), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if items_of := windows.get(tuple(w[a : a + k])):
                    hit.update(range(a, a + k))
                    found |= items_of
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_words", [1 << 20, 60])
def test_hits_are_those_of_all_windows(spark, monkeypatch, part_words):
    monkeypatch.setattr(decontam, "PART_WORDS", part_words)
    rows = documents()
    texts = [t for _, t in rows]
    items = [(1, texts[3]), (2, texts[9][100:300]), (3, "Two, words!"), (4, ""), (5, None), (6, "never seen " * 8), (7, "a " * 12), (8, "changed"), (3, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(table(spark, rows), bench, window=10)
    seen = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=str)
    assert seen == brute(rows, items, 10)


def test_odd_rows_and_empty_tables(spark):
    docs = table(spark, [(1, "x y z"), (1, "x y z"), (None, "x y z"), (2, None)])
    bench = spark.createDataFrame([(None, "x y"), (1, "y z")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["n_hit"], r["items"]) for r in decontam.contamination(docs, bench).collect()), key=str)
    assert got == sorted([(1, 2, ["1"]), (1, 2, ["1"]), (None, 2, ["1"]), (2, 0, [])], key=str)
    assert decontam.contamination(docs.limit(0), bench).isEmpty()
    assert decontam.contamination(docs, bench.limit(0)).where("n_hit > 0").isEmpty()
    left = decontam.without_contaminated(docs, bench)
    assert left.columns == docs.columns and [r["doc_id"] for r in left.collect()] == [2]


def test_proximity(spark):
    docs = table(spark, [(1, "red big fox jumps"), (2, "red fox"), (3, "red one two three fox")])
    bench = spark.createDataFrame([("a", "red fox")], "item_id string, text string")
    assert sorted(r["doc_id"] for r in decontam.contamination(docs, bench, slop=1).where("n_hit > 0").collect()) == [1, 2]
    assert sorted(r["doc_id"] for r in decontam.contamination(docs, bench).where("n_hit > 0").collect()) == [2]
