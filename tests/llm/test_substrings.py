import random
from collections import Counter

import pytest
from corpus import documents, table
from hypothesis import given
from hypothesis import strategies as st

from evenkeel.llm import substrings
from evenkeel.llm.suffixes import suffix_array


@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_order(symbols):
    assert suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p : p + length] for t in raw for p in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, raw):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(gone[p] and not (p and gone[p - 1]) for p in range(len(t)))
        out.append((i, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("many", [2048, 2])
def test_removed_bytes_are_those_of_all_windows(spark, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY", many)
    rng = random.Random(8)
    base = documents(1)[0][1]
    family = []
    for i in range(25):  # near copies, so that contexts of an anchor differ in many ways
        w = base.split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"edit{rng.randint(0, 9)}"
        family.append((500 + i, " ".join(w)))
    rows = [*documents(), *family, (None, base), (None, None), (700, "ab" * 400), (701, "q" * 199), (702, "q" * 200)]
    rows += [(703, "same id and text " * 20), (703, "same id and text " * 20)]
    got = substrings.without_repeats(table(spark, rows), length=200).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got), key=str) == brute(rows, 200)


def test_empty_table(spark):
    assert substrings.without_repeats(table(spark, documents(6)).limit(0)).isEmpty()
