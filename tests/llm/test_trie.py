"""The trie of conversations against plain dictionaries, with any spine."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.llm import trie
from evenkeel.llm.parens import Excess, Forest, subtree_min

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RESULT = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    digest = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest()
    own = {c: [r[1:] for r in sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(*r[1:])))] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        childless = [x for x in below if not any(y[:-1] == x for y in below if y)]
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        saved = sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        children = sum(len(x) == len(node) + 1 for x in below)
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children, len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(n, seed):
    rng, rows = random.Random(seed), []
    for conv in range(-25, n):
        if rng.random() < 0.1:
            continue
        for turn in range(rng.randint(1, 6)):
            text = rng.choice(["hello there", "what now", "", None, "ünï cödé\x1f x", "a \x0b b"]) if rng.random() < 0.7 else f"own {conv} {turn}"
            rows.append((conv, None if rng.random() < 0.1 else turn // rng.choice([1, 2]), rng.choice(["user", "assistant", None, ""]), text))
    rows += [(1000 + i, t, "user", f"same {t} " + "w " * 50) for i in range(40) for t in range(5)]
    rows += [(2000, t, "user", f"long {t}") for t in range(300)] + [(2020, t, "user", f"long {t}") for t in range(301)]
    return rows + [(None, 0, "user", "nobody's"), (3000, 0, "user", "z" * 70000)]


def run(spark, rows, **how):
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(4)
    conv = F.col("conv_id")
    paths = trie.turn_paths(table, leader=conv - conv % 20, head=F.crc32(F.encode(conv.cast("string"), "utf-8")) % 4)
    return trie.prefix_trie(paths, **how)


@pytest.mark.parametrize("how", [{}, {"members": 1}, {"members": 5}, {"members": 1, "most_nodes": 10}])
def test_equal_to_dictionaries(spark, how, monkeypatch):
    monkeypatch.setattr(trie, "STEPS", 64)
    rows = conversations(150, 3)
    found = run(spark, rows, **how)
    assert found.columns == RESULT
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rebuilt(rows))


def test_plain_paths(spark):
    """Without leaders, a conversation is its own turns."""
    rows = [(c, t, "user", f"{t if t < c % 3 else (c, t)}") for c in range(30) for t in range(3)]
    found = trie.prefix_trie(trie.turn_paths(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute({c: [("user", t) for k, _, _, t in rows if k == c] for c in range(30)})


def test_empty(spark):
    assert run(spark, []).collect() == []
    assert run(spark, [(None, 1, "user", "x")]).collect() == []
    turnless = [tuple(r) for r in run(spark, [(c, 0, "u", "x") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4]).collect()]
    assert len(turnless) == 1 and turnless[0][:7] == (1, 0, None, turnless[0][3], 0, 1, 0)


def test_findclose_and_least_of_subtrees():
    rng = np.random.default_rng(4)
    for n in (1, 2, 31, 32, 33, 500, 5000):
        depth = np.ones(n, np.int64)
        for i in range(1, n):
            depth[i] = rng.integers(1, depth[i - 1] + 2) if rng.random() < 0.3 else depth[i - 1] + (rng.random() < 0.6)
        trie_ = Forest.of_depths(depth)
        values = rng.integers(0, 1000, n)
        least = subtree_min(values, trie_.size)
        for i in range(n):
            j = i + 1
            while j < n and depth[j] > depth[i]:
                j += 1
            assert trie_.size[i] == j - i and least[i] == values[i:j].min()
        assert (trie_.leaves == trie_.sums((np.bincount(trie_.parent[trie_.parent >= 0], minlength=n) == 0).astype(int))).all()
    assert Excess(np.array([1, 1, -1, -1])).findclose(np.array([0, 1])).tolist() == [3, 2]
