"""Repairing the structure of conversations at least cost, with one edit string for each shape of conversation.

A turn is a symbol of role (system, user, assistant, other) and fault (none,
truncated, blank, duplicate). Legal role sequences are those of an automaton
with four states, so a turn is a min-plus matrix: the cheapest edits from state
to state, inserted turns before it included. Matrices of neighbouring turns
multiply; a grammar of all distinct symbol strings (``re_pair``) has one matrix
for each rule, made bottom-up from those of its two symbols and shared by all
conversations. A string is then a short product of rules.

Of equally cheap edits the ASCII-least audit counts. Audits of the same turns
end in the edit of the last turn and have one such letter for each turn, so none
is a prefix of another, and the order of two products is that of their left
parts, then of their right parts. Each matrix therefore keeps the rank of its
entries' audits, and an entry's audit is a rope: the state in the middle says
which entries of the two symbols it joins. No texts are compared.

Turns move twice: first without their texts (role, hash and fault), to find a
conversation's symbols in order; then with them, beside their conversation's
audit, to write the repaired turns. Both passes sort within tasks and stream,
and hold a byte or two for each turn of the conversation at hand: a conversation
of any length takes the memory of its audit, which is one value of the result.

Defined results: null role or text counts as one space; turns of equal number
are ordered by role, then by the MD5 of the text; a conversation without id is
one of its own; a role that is empty or begins with another letter than s, u
and a cannot be kept; texts of any length are hashed turn by turn; repeated turns
are duplicates; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import cut
from evenkeel.llm.grammar import Grammar, re_pair, symbol_strings

_SPACES = " \t\n\x0b\x0c\r"
ROLES, TRUNCATED, BLANK, DUPLICATE = "sua", 1, 2, 3
SYMBOLS = 16
#: Costs of the edits, and of a truncated turn that stays.
RELABEL, DELETE, INSERT, LEFT_CUT = 2, 3, 2, 1
#: States: nothing yet, after system, after user, after assistant. Moves by state and role initial.
_MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPTING = (0, 3)
_FAR = 1 << 40
_CELLS, _WHOLE = 1 << 22, 4096


# ---------------------------------------------------------------- matrices


def _inserts() -> dict[tuple[int, int], int]:
    """Turns to insert, at least, to come from state to state."""
    least = {(i, i): 0 for i in range(4)}
    for n in (1, 2):
        for (i, k), m in list(least.items()):
            for c in "ua":
                if m == n - 1 and (k, c) in _MOVES:
                    least.setdefault((i, _MOVES[k, c]), n)
    return least


def _terminal(symbol: int) -> list[list[tuple[int, str]]]:
    """Cost and audit of the cheapest edits of one turn between any two states."""
    role, fault = symbol % 4, symbol // 4
    out = [[(_FAR, "~")] * 4 for _ in range(4)]
    for (i, k), n in _inserts().items():
        edits = [(k, DELETE, "D")]
        if fault < BLANK:
            left = LEFT_CUT if fault == TRUNCATED else 0
            edits += [(_MOVES[k, c], left + (0 if own else RELABEL), "K" if own else "R") for c in ROLES if (k, c) in _MOVES and ((own := ROLES[role : role + 1] == c) or c != "s")]
        for j, cost, letter in edits:
            out[i][j] = min(out[i][j], (cost + INSERT * n, "I" * n + letter))
    return out


def _ranks(keys: np.ndarray) -> np.ndarray:
    """For each entry of the last axis, the number of lesser ones."""
    return (keys[..., None, :] < keys[..., :, None]).sum(-1)


class Matrices:
    """Cost, audit rank and middle state of all symbols of a grammar."""

    def __init__(self, grammar: Grammar):
        self.symbols, self.pairs = grammar.symbols, grammar.pairs
        n = self.symbols + len(self.pairs)
        self.cost, self.rank, self.via, self.length = np.zeros((n, 4, 4), np.int64), np.zeros((n, 4, 4), np.int64), np.zeros((n, 4, 4), np.int8), np.ones(n, np.int64)
        self.texts: dict[tuple[int, int, int], str] = {}
        for s in range(self.symbols):
            entries = _terminal(s)
            order = sorted(e[1] for row in entries for e in row)
            for i in range(4):
                for j in range(4):
                    self.cost[s, i, j], self.texts[s, i, j] = entries[i][j]
                    self.rank[s, i, j] = order.index(entries[i][j][1])
        at = self.symbols
        for rules in grammar.rounds:  # a round's rules only stand on earlier ones
            a, b = rules.T
            cost, rank, via = self.product(self.cost[a], self.rank[a], b)
            to = slice(at, at + len(rules))
            self.cost[to], self.rank[to], self.via[to], self.length[to] = cost, rank, via, self.length[a] + self.length[b]
            at += len(rules)

    def product(self, cost: np.ndarray, rank: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of states (n, rows, 4) times the matrices of symbols ``b``: costs, ranks in each of the n, and the states in the middle."""
        costs = np.minimum(cost[..., None] + self.cost[b][:, None], _FAR)
        audits = (rank[..., None] << 4) + self.rank[b][:, None]
        via = ((costs << 10) + audits).argmin(2)
        pick = lambda x: np.take_along_axis(x, via[:, :, None], 2)[:, :, 0]
        cost, audits = pick(costs), pick(audits)
        audits = np.where(cost < _FAR, audits, 1 << 20)
        return cost, _ranks(audits.reshape(len(b), -1)).reshape(audits.shape), via

    def text(self, symbol: int, i: int, j: int, out: list[str]) -> None:
        """The audit of an entry, in pieces; short ones are kept."""
        if (got := self.texts.get((symbol, i, j))) is None:
            (a, b), k = self.pairs[symbol - self.symbols].tolist(), int(self.via[symbol, i, j])
            own = [] if self.length[symbol] <= _WHOLE else out
            self.text(a, i, k, own)
            self.text(b, k, j, own)
            if own is out:
                return
            got = self.texts[symbol, i, j] = "".join(own)
        out.append(got)

    def audits(self, s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """Cost and audit of each string of symbols, from the first state to an accepting one."""
        lengths, n = np.diff(first), len(first) - 1
        costs, audits = np.zeros(n, np.int64), [""] * n
        order = np.argsort(lengths, kind="stable")
        at = int(np.searchsorted(lengths[order], 1))
        while at < n:
            top = 1 << int(lengths[order[at]] - 1).bit_length()
            rows = order[at : min(int(np.searchsorted(lengths[order], top, "right")), at + max(1, _CELLS // top))]
            at += len(rows)
            costs[rows] = self._fold(s, first[rows], lengths[rows], rows, audits)
        return costs, audits

    def _fold(self, s: np.ndarray, first: np.ndarray, lengths: np.ndarray, rows: np.ndarray, audits: list[str]) -> np.ndarray:
        most = int(lengths.max())
        cost = np.full((len(rows), 1, 4), _FAR)
        cost[:, 0, 0] = 0
        rank, vias = np.zeros_like(cost), np.zeros((most, len(rows), 4), np.int8)
        for t in range(most):
            live = np.flatnonzero(lengths > t)
            cost[live], rank[live], via = self.product(cost[live], rank[live], s[first[live] + t])
            vias[t, live] = via[:, 0]
        more = _inserts()
        ends = [min((m, i, j) for (i, j), m in more.items() if i == k and j in _ACCEPTING)[0] for k in range(4)]
        final = cost[:, 0] + INSERT * np.array(ends)
        state = ((final << 10) + (rank[:, 0] << 4) + ends).argmin(1)
        for r, (row, k) in enumerate(zip(rows, state.tolist(), strict=True)):
            path = [k]
            for t in range(int(lengths[r]) - 1, -1, -1):
                path.append(int(vias[t, r, path[-1]]))
            path.reverse()
            out: list[str] = []
            for t, symbol in enumerate(s[first[r] : first[r] + lengths[r]].tolist()):
                self.text(symbol, path[t], path[t + 1], out)
            audits[row] = "".join(out) + "I" * ends[k]
        return np.take_along_axis(final, state[:, None], 1)[:, 0]


@lru_cache(4)
def _matrices(symbols: int, rounds: tuple[bytes, ...]) -> Matrices:
    return Matrices(Grammar(symbols, [np.frombuffer(x, np.int64).reshape(-1, 2) for x in rounds]))


def _audited(grammar: Grammar, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    matrices = _matrices(grammar.symbols, tuple(x.tobytes() for x in grammar.rounds))
    for batch, buf, first in symbol_strings(batches, "shape"):
        rows, n = np.repeat(np.arange(batch.num_rows), np.diff(first)), batch.num_rows
        faults = [np.bincount(rows[buf // 4 == f], minlength=n) for f in (BLANK, DUPLICATE, TRUNCATED)]
        roles, within = buf % 4, np.ones(max(0, len(buf) - 1), bool)
        within[first[(first > 0) & (first < len(buf))] - 1] = False
        legal = np.isin(roles[:-1] * 4 + roles[1:], [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
        illegal = np.bincount(rows[:-1][within & ~legal], minlength=n)
        costs, audits = matrices.audits(*grammar.rewrite(buf, first))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (*faults, illegal, costs)), pa.array(audits, pa.string())], _AUDITED)


_AUDITED = ["shape", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


# ---------------------------------------------------------------- conversations


def damage(conversations: DataFrame) -> DataFrame:
    """Seeded damage of (conv_id, turn, role, text): ``dropped`` marks rows that are gone; nulls become one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(text("conv_id"), F.lit(":"), text("turn")), "utf-8")) % 20
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return rows.drop("copy")


def _runs(column: pa.Array) -> tuple[list, np.ndarray]:
    """Values of the runs of equal neighbours, and where they begin (and the end)."""
    runs = pc.run_end_encode(column, run_end_type=pa.int64())
    return runs.values, np.concatenate([[0], runs.run_ends.to_numpy()])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From turns in order: each conversation's symbols, and the numbers that its turns leave out."""
    conv, parts, least, most, last, distinct = None, None, None, None, None, 0
    done: list[tuple] = []

    def close() -> None:
        if parts is not None:
            done.append((conv, b"".join(parts), 0 if least is None else min(most - least + 1 - distinct, (1 << 63) - 1)))

    def table(kind: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array(list(c), t) for c, t in zip(zip(*done, strict=True), (kind, pa.binary(), pa.int64()), strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "shape", "gaps"])

    for batch in batches:
        if not batch.num_rows:
            continue
        kind = batch.column(0).type
        values, begins = _runs(batch.column(0))
        there = ~batch.column(3).to_numpy(zero_copy_only=False)
        symbols = batch.column(2).to_numpy().astype(np.uint8)
        known = there & batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        turns = batch.column(1).fill_null(0).to_numpy()
        for value, a, b in zip(values.to_pylist(), begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            if parts is None or value != conv:
                close()
                conv, parts, least, most, last, distinct = value, [], None, None, None, 0
            parts.append(symbols[a:b][there[a:b]].tobytes())
            if len(own := turns[a:b][known[a:b]]):
                distinct += int((own[1:] != own[:-1]).sum()) + (last is None or last != own[0])
                least, most, last = int(own[0]) if least is None else least, int(own[-1]), own[-1]
        if done:
            yield table(kind)
    close()
    if done:
        yield table(kind)


def shapes(rows: DataFrame) -> DataFrame:
    """(conv_id, shape, gaps): a byte for each turn in order, role and first fault of it."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    end = F.right(F.rtrim(text, F.lit(_SPACES)), F.lit(1))
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), F.unhex(F.md5(text)).alias("print"), fault.alias("fault"), kind.alias("kind"), F.coalesce("dropped", F.lit(False)).alias("dropped"))
    seen = Window.partitionBy("conv_id", "dropped", "role", "print").orderBy(F.col("turn").asc_nulls_first())
    turns = turns.repartition("conv_id").withColumn("fault", F.when((F.col("fault") != BLANK) & (F.row_number().over(seen) > 1), DUPLICATE).otherwise(F.col("fault")))
    ordered = turns.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "print").select("conv_id", "turn", (F.col("fault") * 4 + F.col("kind")).alias("symbol"), "dropped")
    return ordered.mapInArrow(_packed, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, shape binary, gaps long")


_SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(rows: DataFrame, most_rules: int | None = None) -> DataFrame:
    """For each conversation its counts, the least cost of a repair, and the ASCII-least audit of that cost."""
    convs = cut(shapes(rows), "conversation-shapes")
    distinct = cut(convs.select("shape").distinct(), "shapes")
    grammar = re_pair(distinct, "shape", SYMBOLS, **({} if most_rules is None else {"most_rules": most_rules}))
    found = distinct.mapInArrow(partial(_audited, grammar), "shape binary, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    return convs.join(found, "shape").select("conv_id", *_SUMMARY, "audit")


class _Turns:
    """Walks a conversation's turns along its audit; gives the repaired turns one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2

    def role(self) -> str:
        return "user" if self.place % 2 == self.odd else "assistant"

    def inserted(self) -> Iterator[tuple[int, str, str, str]]:
        while self.audit.startswith("I", self.at):
            yield self.place, self.role(), "", "insert"
            self.at, self.place = self.at + 1, self.place + 1

    def turn(self, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            yield (self.place, role, text, "keep") if edit == "K" else (self.place, self.role(), text, "rerole")
            self.place += 1


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, _Turns | None, Iterator]]:
    """Heads (conversations with their audit) and the turns that follow each; an iterator of repaired turns with either."""
    turns = None
    for batch in batches:
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("head", "role", "text", "audit"))
        for i, (head, role, text, audit) in enumerate(zip(*columns, strict=True)):
            if head:
                if turns is not None:
                    yield batch, -1, turns, turns.inserted()
                turns = _Turns(audit)
                yield batch, i, turns, iter(())
            else:
                yield batch, i, None, turns.turn(role, text)
    if turns is not None:
        yield None, -1, turns, turns.inserted()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ["conv_id", *_SUMMARY, "audit"]
    open_, digest, done = None, None, []
    fields: list[pa.DataType] = []

    def table() -> pa.RecordBatch:
        columns = [pa.array(list(c), t) for c, t in zip(zip(*done, strict=True), [*fields, pa.string()], strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, [*kept, "repaired_sha256"])

    for batch, i, turns, repaired in _walked(batches):
        for place, role, text, _ in repaired:
            digest.update(f"{'\n' if place else ''}{role}:{text}".encode())
        if turns is not None and i < 0:
            done.append((*open_, digest.hexdigest()))
            if len(done) >= 4096:
                yield table()
        elif turns is not None:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            fields = [c.type for c in columns]
            open_, digest = tuple(c[i].as_py() for c in columns), hashlib.sha256()
    if done:
        yield table()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, done, size, kind = None, [], 0, None

    def table() -> pa.RecordBatch:
        columns = [pa.array(list(c), t) for c, t in zip(zip(*done, strict=True), (kind, pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "role", "text", "edit"])

    for batch, i, turns, repaired in _walked(batches):
        for turn in repaired:
            done.append((conv, *turn))
            size += len(turn[2])
            if len(done) >= 8192 or size > 1 << 24:
                yield table()
                size = 0
        if turns is not None and i >= 0:
            column = batch.column(batch.schema.get_field_index("conv_id"))
            conv, kind = column[i].as_py(), column.type
    if done:
        yield table()


def _beside_audits(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit, then its turns in order, within one task."""
    turns = rows.where(~F.coalesce("dropped", F.lit(False))).select("conv_id", F.lit(False).alias("head"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    turns = turns.withColumn("print", F.unhex(F.md5("text")))
    heads = audited.withColumn("head", F.lit(True))
    both = heads.unionByName(turns, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("head"), F.col("turn").asc_nulls_first(), "role", "print").drop("turn", "print")


def _with_dropped(rows: DataFrame) -> DataFrame:
    return rows if "dropped" in rows.columns else rows.withColumn("dropped", F.lit(False))


def repair_digests(rows: DataFrame, most_rules: int | None = None) -> DataFrame:
    """Each conversation of ``rows`` (conv_id, turn, role, text) with its counts, cost, audit and the SHA-256 of its repaired turns.

    Rows marked in a column ``dropped`` are not turns, but their conversation stays.
    """
    rows = _with_dropped(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    audited = audits(rows, most_rules)
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in _SUMMARY)}, audit string, repaired_sha256 string"
    return _beside_audits(rows, audited).mapInArrow(_digests, schema)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, role, text, edit), a row for each turn that is kept, relabelled or inserted."""
    rows = _with_dropped(rows)
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place long, role string, text string, edit string"
    return _beside_audits(rows, audits(rows).select("conv_id", "audit")).mapInArrow(_repaired, schema)
