"""Re-Pair over a table of symbol strings: the pairs that stand most often become symbols of their own.

Each round counts neighbouring symbols in all strings by tasks and partial
sums, and turns the most frequent pairs into rules. A round takes several pairs
at once: a symbol may only be the left of its rules or only their right, so
matches never overlap (a pair of one symbol with itself has that symbol alone,
and is matched from the left). Only the most frequent pairs reach the driver,
and the number of rules is bounded: fewer rules make longer strings, never
other results.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import flat

#: Pairs looked at in a round, rules at most, and the share of symbols that a round must save to be worth another.
PAIRS, RULES, LEAST_GAIN = 256, 4096, 0.01


@dataclass
class Grammar:
    """Rules by rounds: symbol ``symbols + i`` stands for the pair ``pairs[i]`` of earlier symbols."""

    symbols: int
    rounds: list[np.ndarray] = field(default_factory=list)

    @property
    def pairs(self) -> np.ndarray:
        return np.concatenate([np.zeros((0, 2), np.int64), *self.rounds])

    def rewrite(self, s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All strings (their symbols, and each string's first) with the rules put in, round by round."""
        s, width, at = s.astype(np.int64), self.symbols + sum(map(len, self.rounds)), self.symbols
        for rules in self.rounds:
            codes = rules[:, 0] * width + rules[:, 1]
            order = np.argsort(codes)
            here = _neighbours(s, first)
            found = s[here] * width + s[here + 1]
            place = np.minimum(np.searchsorted(codes[order], found), len(codes) - 1)
            match = codes[order][place] == found
            here, place = here[match], place[match]
            s[here] = at + order[place]
            gone = np.zeros(len(s) + 1, np.int64)
            gone[here + 2] = 1
            stay = np.ones(len(s), bool)
            stay[here + 1] = False
            s, first = s[stay], first - np.cumsum(gone)[first]
            at += len(rules)
        return s, first


def _neighbours(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places whose symbol and the next are a pair of one string; of a run of one symbol every second place from its start."""
    inner = np.ones(max(0, len(s) - 1), bool)
    inner[first[(first > 0) & (first < len(s))] - 1] = False
    same = inner & (s[1:] == s[:-1])
    start = same.copy()
    start[1:] &= ~same[:-1]
    places = np.arange(len(same))
    return np.flatnonzero(inner & ~(same & ((places - np.maximum.accumulate(np.where(start, places, 0))) % 2 == 1)))


def symbol_strings(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, *flat(batch.column(batch.schema.get_field_index(column)))


def _counted(grammar: Grammar, column: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, buf, first in symbol_strings(batches, column):
            s, first = grammar.rewrite(buf, first)
            here = _neighbours(s, first)
            codes, n = np.unique((s[here] << 32) | s[here + 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(codes, -1)), pa.array(np.append(n, len(s)))], ["pair", "n"])

    return count


def _taken(pairs: Sequence[tuple[int, int]], room: int) -> np.ndarray:
    left, right, alone, out = set(), set(), set(), []
    for a, b in pairs:
        if len(out) >= room or a in alone or b in alone or a in right or b in left or (a == b and (a in left or b in right)):
            continue
        if a == b:
            alone.add(a)
        else:
            left.add(a)
            right.add(b)
        out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def re_pair(strings: DataFrame, column: str, symbols: int, most_rules: int = RULES) -> Grammar:
    """A grammar of the binary ``column``, whose bytes are symbols below ``symbols``."""
    grammar = Grammar(symbols)
    while (room := most_rules - sum(map(len, grammar.rounds))) > 0:
        counts = strings.select(column).mapInArrow(_counted(grammar, column), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        rows = counts.where("n > 1").orderBy(F.col("pair") >= 0, F.desc("n"), "pair").limit(PAIRS + 1).collect()
        total = sum(r.n for r in rows if r.pair < 0)
        best = [(r.pair >> 32, r.pair & 0xFFFFFFFF) for r in rows if r.pair >= 0]
        rules = _taken(best, room)
        chosen = {(a << 32) | b for a, b in rules.tolist()}
        if not len(rules) or sum(r.n for r in rows if r.pair in chosen) < LEAST_GAIN * total:
            break
        grammar.rounds.append(rules)
    return grammar
