"""Repaired conversations against a brute force over all edits."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import cache

import numpy as np
import pytest

from evenkeel.llm import repair
from evenkeel.llm.grammar import Grammar, re_pair

sys.setrecursionlimit(20000)
LEGAL = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def first_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(SPACES)[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None)
        seen.add((role, text))
    return out


def moves(state, role):
    """States are the legal role strings so far, cut to what matters: '', 's', 'u', 'a'."""
    return role if (state, role) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")} else None


def cheapest(rows):
    """(cost, audit) by recursion from the end: a letter and the best rest."""
    faults = first_faults(rows)

    @cache
    def best(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            for c in "ua":
                if moves(state, c):
                    cost, rest = best(i, c, inserted + 1)
                    found.append((cost + 2, "I" + rest))
        if i < len(rows):
            cost, rest = best(i + 1, state, 0)
            found.append((cost + 3, "D" + rest))
            if faults[i] in (None, "truncated"):
                more = faults[i] == "truncated"
                own = rows[i][0][:1]
                for c, price, letter in [(own, 0, "K"), ("u", 2, "R"), ("a", 2, "R")]:
                    if moves(state, c):
                        cost, rest = best(i + 1, c, 0)
                        found.append((cost + price + more, letter + rest))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def every_edit(rows):
    """(cost, audit) from all edits of a few rows."""
    faults, found = first_faults(rows), []
    between = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    choices = [[("D", "", 3)] + ([] if f in ("blank", "duplicate") else [(e, c, p + (f == "truncated")) for e, c, p in [("K", r[:1], 0), ("R", "u", 2), ("R", "a", 2)] if c]) for (r, _), f in zip(rows, faults)]
    for edits in itertools.product(*choices):
        for added in itertools.product(between, repeat=len(rows) + 1):
            roles = "".join("".join(a) + c for a, (_, c, _) in zip(added, edits)) + "".join(added[-1])
            if LEGAL.fullmatch(roles):
                audit = "".join("I" * len(a) + e for a, (e, _, _) in zip(added, edits)) + "I" * len(added[-1])
                found.append((sum(p for _, _, p in edits) + 2 * sum(map(len, added)), audit))
    return min(found)


def repaired(rows, audit):
    size, out, i = len(audit) - audit.count("D"), [], 0
    names = (["system"] if size % 2 else []) + ["user", "assistant"] * (size // 2)
    for letter in audit:
        if letter == "I":
            out.append((names[len(out)], "", "insert"))
            continue
        role, text = rows[i]
        i += 1
        if letter != "D":
            out.append((role, text, "keep") if letter == "K" else (names[len(out)], text, "rerole"))
    return out


def summary(rows, turns):
    faults, known = first_faults(rows), [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(rows)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in repaired(rows, audit)).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        at = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        at.extend([(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return out


def ordered(turns):
    return sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))


def conversations(n, seed, most=9):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "u", "", None, "éa"]
    texts = ["One. ", "Two!\n", "cut off", "", " \t", None, "Why?", "x" * 5000, "ünï.", "…"]
    rows = []
    for conv in range(n):
        tame = rng.random() < 0.5
        for turn in range(rng.randint(1, most)):
            role = ("user", "assistant")[turn % 2] if tame else rng.choice(roles)
            text = f"{conv} {turn}." if tame and rng.random() < 0.8 else rng.choice(texts)
            rows.append((conv if conv != 7 else None, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 3]), role, text))
    return rows


def test_plain_recursion_is_all_edits():
    rng = random.Random(1)
    for n in (0, 1, 1, 1, 2, 2, 2, 2, 3, 3):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "c.", "d?"])) for _ in range(n)]
        assert cheapest(rows) == every_edit(rows)


def test_every_short_shape():
    """All shapes of up to three turns, by matrices alone and by rules."""
    strings = [bytes(x) for n in range(4) for x in itertools.product(range(16), repeat=n)]
    s, first = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0, *map(len, strings)])
    names, texts = ["system", "user", "assistant", "tool"], {0: "{}.", 1: "{}", 2: "", 3: None}
    plain = repair.Matrices(Grammar(16)).audits(s.astype(np.int64), first)
    grammar = Grammar(16, [np.array([[1, 2], [5, 6], [0, 4], [3, 3]]), np.array([[16, 16], [17, 2]]), np.array([[16, 2]])])
    ruled = repair.Matrices(grammar).audits(*grammar.rewrite(s, first))
    assert plain[0].tolist() == ruled[0].tolist() and plain[1] == ruled[1]
    for k in range(0, len(strings), 7):
        rows = [(names[x % 4], texts[x // 4].format(i) if x // 4 < 3 else None) for i, x in enumerate(strings[k])]
        if all(t is not None for _, t in rows):
            assert (plain[0][k], plain[1][k]) == cheapest(rows), rows


@pytest.mark.parametrize("most_rules", [0, 5, 4096])
def test_equal_to_brute_force(spark, most_rules):
    rows = conversations(120, 5) + [(500, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(700)] + [(501, 3, "user", "a."), (501, 3, "user", "a."), (501, 3, "user", "b")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, head string").repartition(5)
    found = repair.repair_digests(repair.damage(table), most_rules)
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    expected = {c: summary([r[1:] for r in ordered(t)], [r[0] for r in t]) for c, t in damaged(rows).items()}
    assert got == expected


def test_repaired_turns(spark):
    rows = conversations(40, 8)
    found = repair.repaired_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.place)):
        got.setdefault(r.conv_id, []).append((r.role, r.text, r.edit))
        assert r.place == len(got[r.conv_id]) - 1
    by_conv = {}
    for c, turn, role, text in rows:
        by_conv.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    expected = {c: repaired([r[1:] for r in ordered(t)], cheapest([r[1:] for r in ordered(t)])[1]) for c, t in by_conv.items()}
    assert got == {c: x for c, x in expected.items() if x}


def test_rules_stand_for_what_they_replace(spark):
    rng = random.Random(2)
    strings = [bytes(rng.choice([0, 1, 1, 1, 2]) for _ in range(rng.randint(0, 60))) for _ in range(200)] + [b"", b"\1" * 500]
    grammar = re_pair(spark.createDataFrame([(x,) for x in strings], "s binary").repartition(3), "s", 3)
    assert len(grammar.pairs) > 10

    def expand(x):
        return [x] if x < 3 else [y for part in grammar.pairs[x - 3].tolist() for y in expand(part)]

    s, first = grammar.rewrite(np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0, *map(len, strings)]))
    assert len(s) < sum(map(len, strings)) / 2
    assert [bytes(y for x in s[a:b].tolist() for y in expand(x)) for a, b in zip(first, first[1:])] == strings


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_digests(repair.damage(none)).collect() == [] and repair.repaired_turns(none).collect() == []
