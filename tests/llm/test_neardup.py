import random

import numpy as np
import pytest
from corpus import documents, table, words

from evenkeel.llm import neardup
from evenkeel.llm.common import cut
from evenkeel.llm.components import components


def sets_of(rows, size):
    out = {}
    for i, t in rows:
        w = words(t)
        out[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    return out


def brute(sets, percent):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def check(spark, rows, size):
    sets = sets_of(rows, size)
    expected = brute(sets, 80)
    got = neardup.near_duplicates(table(spark, rows), size=size).collect()
    assert len(got) == len(rows)
    for r in got:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), expected[i], expected[i] == i), i


def test_components_are_those_of_all_pairs(spark):
    check(spark, documents(), 2)
    check(spark, documents(), 5)


def test_a_family_around_one_text(spark):
    """Copies that are near their original but not each other, as in a large group of edited copies."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 80):
        w = list(base)
        for k in rng.sample(range(0, 120, 2), 6):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    check(spark, rows, 2)


def family(members, edits, rng, words=120, variants=0, new=40):
    base = [f"w{i}" for i in range(words)]
    rows = [(0, " ".join(base))]
    for i in range(1, members):
        w = list(base)
        for k in rng.sample(range(0, words, 2), edits):
            w[k] = f"x{rng.randrange(new)}_{k}"
        if variants:  # what many members have and the base lacks
            w[1 + 2 * (i % variants)] = f"v{i % variants}"
        rows.append((i, " ".join(w)))
    return rows


def test_members_apart_from_the_base_are_linked_with_each_other(spark):
    """Families in which some members are near one another only: by shared edits, by variants, by what both lack."""
    for seed, edits in ((1, 7), (2, 9)):
        rng = random.Random(seed)
        rows = family(60, edits, rng, variants=3)
        for i, text in rows[1:40]:  # a changed copy of a changed copy
            w = text.split()
            w[rng.randrange(len(w))] = f"y{i}"
            rows.append((1000 + i, " ".join(w[: len(w) - rng.randrange(12)])))
        check(spark, rows, 2)


def test_work_on_members_apart_grows_with_their_number(spark, monkeypatch):
    counts = {}

    def counting(df, name):
        out = cut(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(neardup, "cut", counting)
    seen = []
    for members in (300, 1200):
        rows = family(members, 9, random.Random(8), words=160, new=10**6)
        got = neardup.near_duplicates(table(spark, rows), size=2).collect()
        assert len(got) == members
        seen.append((counts["differences"], counts["rare"], counts["candidates"]))
    assert all(late <= 8 * max(early, 200) for early, late in zip(*seen, strict=True)), seen


def test_links_apart_are_those_of_all_pairs(spark):
    """Members of one bucket around a middle that none is linked with: by the sets alone, against all pairs."""
    rng = random.Random(9)
    for trial in range(2):
        c = set(range(1, 101))
        sets, base = {}, {}
        for g in range(6):  # families that share edits, each beyond the middle's reach
            gone, new = rng.sample(range(1, 101), 14), [1000 * (g + 1) + k for k in range(14)]
            base[g] = (c - set(gone)) | set(new)
            for m in range(4):
                own = set(base[g])
                for k in range(rng.randrange(0, 9)):
                    own.discard(rng.choice(sorted(own)))
                    own.add(10_000 + 100 * g + 10 * m + k)
                sets[10 * g + m + 1] = own
        far = lambda a, b: 100 * len(a & b) < 80 * len(a | b)
        assert all(far(c, s) for s in sets.values())
        rows = [(0, i, len(c), len(s), len(s & c), False, sorted(s ^ c)) for i, s in sets.items()]
        pairs = spark.createDataFrame(rows, neardup._DIFFERENCES)
        labels = spark.createDataFrame([], "node long, label long")
        got = {(r["a"], r["b"]) for r in neardup._links_apart(cut(pairs, "pairs"), labels, 80).collect()}
        expected = {(i, k) for i in sets for k in sets if i < k and not far(sets[i], sets[k])}
        assert expected and got <= expected
        # what is certain is given by links with one member: the components are the same
        nodes = {i: i for i in sets}

        def whole(edges):
            parent = dict(nodes)
            for _ in nodes:
                for a, b in edges:
                    parent[a] = parent[b] = min(parent[a], parent[b])
            return parent

        assert whole(got) == whole(expected), trial


def letters(members, seed=4):
    """A form letter, two footers that a third of the rows have each, and own words."""
    rng = random.Random(seed)
    letter, footers = [f"l{i}" for i in range(158)], [[f"f{k}{i}" for i in range(9)] for k in range(2)]
    rows = []
    for i in range(members):
        text = list(letter)
        for k in range(3):
            text[rng.randrange(len(text))] = f"own{i}x{k}"
        for k in range(2):
            text += footers[k] if rng.random() < 1 / 3 else []
        rows.append((i, " ".join(text)))
    return rows


def test_footers_make_no_pairs(spark, monkeypatch):
    """What meets on a shingle of a third of a group grows with the group, not with its square."""
    met, meetings = [], neardup._meetings
    monkeypatch.setattr(neardup, "_meetings", lambda ranked: met.append(meetings(ranked)) or met[-1].where("true"))
    counts = []
    for members in (200, 800):
        monkeypatch.setattr(neardup, "discard", lambda *a: None)
        found = neardup.near_duplicates(table(spark, letters(members)), size=2).collect()
        if members == 200:
            sets = sets_of(letters(members), 2)
            close = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            assert {frozenset(x) for x in _parts(sets, close)} == {frozenset(r["doc_id"] for r in found if r["component_id"] == c) for c in {r["component_id"] for r in found}}
        counts.append(sum(df.count() for df in met))
        met.clear()
    assert counts[1] <= 6 * max(counts[0], 100), counts


@pytest.mark.parametrize("members", [100, 400])
def test_members_with_labels_of_their_own_share_footers(spark, monkeypatch, members):
    """Links apart alone: 179 shingles, 20 apart, eight of them a footer of 40 %; the footer's members are one component."""
    base = set(range(1, 180))
    rng, rows, footer = random.Random(6), [], [900_000 + k for k in range(8)]
    for i in range(members):
        has = rng.random() < 0.4
        new = [1_000_000 + 100 * i + k for k in range(12)] + (footer if has else [1_000_000 + 100 * i + 20 + k for k in range(8)])
        rows.append((0, i + 1, len(base), len(base) + len(new), len(base), False, new))
    met, meetings = [], neardup._meetings
    monkeypatch.setattr(neardup, "_meetings", lambda ranked: met.append(cut(meetings(ranked), "met")) or met[-1])
    pairs = spark.createDataFrame(rows, neardup._DIFFERENCES)
    got = neardup._links_apart(cut(pairs, "pairs"), spark.createDataFrame([], "node long, label long"), 80).collect()
    sets = {r[1]: base | set(r[6]) for r in rows}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert all(linked(r["a"], r["b"]) for r in got) and met[0].count() <= 10 * members and len(got) <= 20 * members
    parts = lambda edges: {frozenset(x) for x in _parts(sets, edges)}
    assert parts([(r["a"], r["b"]) for r in got]) == parts([(a, b) for a in sets for b in sets if a < b and linked(a, b)])


def _parts(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    out = {}
    for n in nodes:
        out.setdefault(root(n), set()).add(n)
    return out.values()


def test_links_between_components_join_them(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (7, 7), (8, 7)], "node long, label long")
    more = spark.createDataFrame([(1, 3), (3, 9)], "a long, b long")
    got = {r["node"]: r["label"] for r in neardup._merged(labels, more).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 9: 1, 7: 7, 8: 7}


def test_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, "  "), (1, "other words here now")]
    got = neardup.near_duplicates(table(spark, rows), size=2).collect()
    seen = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=str)
    assert seen == sorted(
        [(1, 5, 1, True), (1, 5, 1, True), (None, 5, None, True), (2, 5, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (1, 3, 1, True)], key=str
    )
    kept = neardup.one_of_each(table(spark, rows), size=2)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is not None) == [
        (1, "a b c d e f"), (1, "other words here now"), (3, None), (4, ""), (5, "  "),
    ]
    assert neardup.near_duplicates(table(spark, rows).limit(0)).isEmpty()


def test_sketches_fill_and_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    sets = [a, np.concatenate((a[:360], rng.integers(1, 1 << 63, 40).astype(np.uint64))), a[:1], a[:3]]
    first = np.cumsum([0, *map(len, sets)])
    s = neardup.sketch(np.concatenate(sets), first)
    assert (s != np.uint64(2**64 - 1)).all()
    assert abs((s[0] == s[1]).mean() - 360 / 440) < 0.1


def test_components_of_paths(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}
