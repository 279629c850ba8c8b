"""Exact removal of long repeated substrings, by suffix arrays of anchored contexts.

Every window of ``length`` bytes has one anchor, the ``ANCHOR`` bytes of smallest
hash in it, so equal windows have equal anchors at equal places. Only anchors
that occur more than once can stand in a repeated window. For each occurrence
of such an anchor, the bytes of all windows that it anchors (its context) go to
the task of the anchor; equal contexts are counted before they move. There the
contexts of an anchor are aligned, the columns in which they differ are kept,
and the rows of kept columns are suffix-sorted (see ``suffixes``): neighbours in
order show how far each context agrees with another from each column on, so
which of its windows stand elsewhere too. Of contexts that stand more than once
all windows are repeated; two different contexts are compared directly. Where an
anchor has more than ``MANY`` different contexts, their single windows are grouped
by distance to the anchor and hash instead, in Spark.

What a task holds is bounded by ``MANY`` contexts of an anchor; documents are
moved whole twice, to take out contexts and to take out what is repeated.

Defined results: a null text is empty; texts shorter than ``length`` stay as
they are; rows with equal id and text are occurrences of their own, so all of
it is repeated if it is long enough; rows with a null id are no exception; an
empty table gives an empty result; a very long text is read whole by one task;
extra columns are not read. Anchors, documents, equal contexts, and windows of
anchors with very many contexts are told apart by 64-bit hashes; other windows are
compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import cut, inverse_powers, prefix_hashes, rows_of, signed, span_hashes, text_slices
from evenkeel.llm.suffixes import common_prefixes, suffix_array

ANCHOR = 48
#: Different contexts of an anchor that one task compares, at most.
MANY = 2048
#: Symbols in one suffix sort, about.
SORTED = 1 << 17

_U = np.uint64


def anchors(buf: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each anchored run of windows: its row, its first window, the number of windows, the anchor's distance and hash."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.view(np.uint64)
    width = length - ANCHOR + 1
    running = prefix_hashes(buf)
    h = running[ANCHOR:] - running[:-ANCHOR]
    h *= inverse_powers(len(h))
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    bits = _U(int(n).bit_length())
    v = h >> bits
    v <<= bits
    v |= np.arange(len(h), dtype=np.uint64)
    padded = np.full(-(-len(v) // width) * width, ~_U(0), np.uint64)
    padded[: len(v)] = v
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - length + 1
    anchor = (np.minimum(onward[:windows], upto[width - 1 : width - 1 + windows]) & ((_U(1) << bits) - _U(1))).astype(np.int64)
    row = rows_of(offs)[:windows]
    start = np.flatnonzero(np.arange(windows) + length <= offs[row + 1])
    anchor, row = anchor[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    return row[first], start[first], count, anchor[first] - start[first], h[anchor[first]]


def _anchor_counts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, buf, offs in text_slices(batches):
            h, n = np.unique(anchors(buf, offs, length)[-1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(n)], names=["anchor", "n"])

    return run


def _anchor_places(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            row, start, count, before, h = anchors(buf, offs, length)
            key = rows.column("key").to_numpy()[row]
            columns = [pa.array(signed(h)), pa.array(key), pa.array(start - offs[row]), pa.array(before.astype(np.int32)), pa.array(count.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "key", "start", "before", "windows"])

    return run


def _contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            places = rows.column("places")
            row = rows_of(places.offsets.to_numpy() - places.offsets[0].as_py())
            field = {f.name: places.flatten().field(i) for i, f in enumerate(places.type.value_type)}
            start = field["start"].to_numpy() + offs[row]
            end = start + field["windows"].to_numpy() + length - 1
            same = span_hashes(prefix_hashes(buf), start, end)
            raw = buf.tobytes()
            context = pa.array([raw[a:b] for a, b in zip(start, end, strict=True)], pa.binary())
            key = rows.column("key").to_numpy()[row]
            columns = [field["anchor"], pa.array(signed(same)), field["before"], field["windows"], context, pa.array(key), field["start"]]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "same", "before", "windows", "context", "key", "start"])

    return run


def _windows(length: int):
    """The single windows of contexts: their distance to the anchor, place in the context, and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, "context"):
            count = rows.column("windows").to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(count)), count)
            at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = offs[row] + at
            h = span_hashes(prefix_hashes(buf), start, start + length)
            same = rows.select(["anchor", "same", "before", "n"]).take(pa.array(row))
            far = rows.column("before").to_numpy()[row] - at
            columns = [*same.columns, pa.array(at.astype(np.int32)), pa.array(far.astype(np.int32)), pa.array(signed(h))]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "same", "before", "n", "at", "far", "h"])

    return run


class Group:
    """The different contexts of one anchor, aligned: a row each, with what lies outside marked by a symbol of its own."""

    def __init__(self, before: np.ndarray, windows: np.ndarray, contexts: list[bytes], length: int) -> None:
        left = int(before.max())
        self.shift = left - before
        size = windows + length - 1
        wide = int((self.shift + size).max())
        m = len(contexts)
        self.rows = np.repeat((256 + np.arange(m, dtype=np.int64))[:, None], wide, axis=1)
        for i, c in enumerate(contexts):
            self.rows[i, self.shift[i] : self.shift[i] + size[i]] = np.frombuffer(c, np.uint8)
        self.columns = np.flatnonzero((self.rows != self.rows[:1]).any(axis=0))
        self.windows, self.wide = windows, wide

    def repeated(self, agreed: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of window starts (row, first, end) whose window stands in another row as well.

        ``agreed``: in how many kept columns, from each on, a row agrees with the
        other row that it agrees with furthest; it leaves all others in the next one.
        """
        columns = self.columns
        ends = np.append(columns, self.wide)[np.arange(len(columns)) + agreed]
        ends = np.append(ends, np.full((len(agreed), 1), self.wide), axis=1)
        start = np.arange(int((self.shift + self.windows).max()))
        good = start + length <= ends[:, np.searchsorted(columns, start)]
        good &= (start >= self.shift[:, None]) & (start < (self.shift + self.windows)[:, None])
        edge = np.diff(np.pad(good.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, first = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1]
        return row, first - self.shift[row], end - self.shift[row]


def agreements(groups: list[Group]) -> list[np.ndarray]:
    """For every row and kept column of each group, in how many kept columns from there on it agrees with its best other row."""
    parts, places, base, place = [], [], 0, 0
    for g in groups:
        m, d = len(g.rows), len(g.columns)
        # symbols of different columns and groups differ, so only aligned suffixes of a group agree
        code = np.arange(d, dtype=np.int64) * (256 + m) + g.rows[:, g.columns] + base + 1
        parts.append(np.append(code, np.zeros((m, 1), np.int64), axis=1).reshape(-1))
        places.append(np.tile(np.append(np.arange(place, place + d), -1), m))
        base += (d + 1) * (256 + m)
        place += d
    symbols, column = np.concatenate(parts), np.concatenate(places)
    rest = np.concatenate([np.tile(np.arange(len(g.columns), -1, -1), len(g.rows)) for g in groups])
    order = suffix_array(np.unique(symbols, return_inverse=True)[1])
    beside = np.flatnonzero((column[order[1:]] == column[order[:-1]]) & (column[order[1:]] >= 0))
    one, other = order[beside], order[beside + 1]
    common = common_prefixes(symbols, one, other, rest[one])
    best = np.zeros(len(symbols), np.int64)
    np.maximum.at(best, one, common)
    np.maximum.at(best, other, common)
    edges = np.cumsum([0, *(len(p) for p in parts)])
    return [best[a:b].reshape(len(g.rows), -1)[:, :-1] for g, a, b in zip(groups, edges[:-1], edges[1:], strict=True)]


_FLAGGED = "anchor long, same long, before int, windows int, runs array<struct<a:int,b:int>>"


def _flag(length: int):
    """Streams contexts in the order of their anchors; an anchor's are taken together."""
    fields = ["anchor", "same", "before", "windows"]

    def solve(rows: pa.RecordBatch) -> pa.RecordBatch:
        """The flagged windows of whole anchors."""
        anchor, n = rows.column("anchor").to_numpy(), rows.column("n").to_numpy()
        before, windows = (rows.column(c).to_numpy().astype(np.int64) for c in ("before", "windows"))
        edges = np.append(np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])), len(anchor))
        # contexts that stand more than once are flagged whole; others need another context of their anchor
        whole = np.flatnonzero(n > 1)
        found = [(whole, np.zeros(len(whole), np.int64), windows[whole])]
        once = np.add.reduceat((n == 1).astype(np.int64), edges[:-1])
        held: list[tuple[int, Group]] = []
        size = 0

        def close() -> None:
            nonlocal held, size
            # of two different rows, each differs from the other in every kept column
            large = [g for _, g in held if len(g.rows) > 2]
            agreed = iter(agreements(large) if large else ())
            for a, g in held:
                row, first, end = g.repeated(next(agreed) if len(g.rows) > 2 else np.zeros((2, len(g.columns)), np.int64), length)
                single = n[a + row] == 1
                found.append((a + row[single], first[single], end[single]))
            held, size = [], 0

        context = rows.column("context")
        for k in np.flatnonzero((once > 0) & (np.diff(edges) > 1)):
            a, b = int(edges[k]), int(edges[k + 1])
            g = Group(before[a:b], windows[a:b], context.slice(a, b - a).to_pylist(), length)
            held.append((a, g))
            size += len(g.rows) * (len(g.columns) + 1) * (len(g.rows) > 2)
            if size > SORTED:
                close()
        close()
        row, first, end = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((first, row))
        row, first, end = row[order], first[order], end[order]
        new = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
        runs = pa.StructArray.from_arrays([pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32))], names=["a", "b"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)).astype(np.int32)), runs)
        return pa.RecordBatch.from_arrays([*rows.select(fields).take(pa.array(row[new])).columns, lists], names=[*fields, "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column("anchor").to_numpy()
            changes = np.flatnonzero(anchor[1:] != anchor[:-1])
            if rest and rest[-1].column("anchor")[-1].as_py() != int(anchor[0]):
                yield solve(pa.concat_batches(rest))
                rest = []
            if len(changes):
                last = int(changes[-1]) + 1
                yield solve(pa.concat_batches([*rest, batch.slice(0, last)]))
                rest = [batch.slice(last)]
            else:
                rest.append(batch)
        if rest:
            yield solve(pa.concat_batches(rest))

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offs in text_slices(batches):
        removed, spans, kept = [], [], []
        for i, runs in enumerate(rows.column("runs").to_pylist()):
            text = buf[offs[i] : offs[i + 1]]
            if not runs:
                removed.append(0)
                spans.append(0)
                kept.append(text.tobytes())
                continue
            edge = np.zeros(len(text) + 1, np.int64)
            for r in runs:
                edge[r["s"]] += 1
                edge[r["e"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1]) + bool(len(gone) and gone[0])))
            kept.append(text[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def without_repeats(docs: DataFrame, *, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: each text's bytes without those in a window that starts elsewhere too."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("doc_id", "text"))
    counts = texts.select("text").mapInArrow(_anchor_counts(length), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    repeated = cut(counts.where("n > 1").select("anchor"), "repeated")
    places = texts.select("key", "text").mapInArrow(_anchor_places(length), "anchor long, key long, start long, before int, windows int")
    places = places.join(repeated, "anchor", "left_semi").groupBy("key").agg(F.collect_set(F.struct("anchor", "start", "before", "windows")).alias("places"))
    schema = "anchor long, same long, before int, windows int, context binary, key long, start long"
    contexts = cut(texts.select("key", "text").join(places, "key").mapInArrow(_contexts(length), schema), "contexts")
    whole = ["anchor", "same", "before", "windows"]
    different = cut(contexts.groupBy(*whole).agg(F.first("context").alias("context"), F.count("*").alias("n")), "different")
    many = cut(different.groupBy("anchor").count().where(F.col("count") > MANY).select("anchor"), "many")
    few = different.join(many, "anchor", "left_anti")
    flagged = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_flag(length), _FLAGGED)
    if not many.isEmpty():
        schema = "anchor long, same long, before int, n long, at int, far int, h long"
        single = cut(different.join(many, "anchor", "left_semi").select(*whole, "context", "n").mapInArrow(_windows(length), schema), "windows")
        again = single.groupBy("anchor", "far", "h").agg(F.sum("n").alias("times")).where("times > 1").select("anchor", "far", "h")
        found = single.join(again, ["anchor", "far", "h"], "left_semi").groupBy("anchor", "same", "before")
        runs = F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b"))).alias("runs")
        flagged = flagged.unionByName(found.agg(runs).withColumn("windows", F.lit(None).cast("int")))
    flagged = flagged.drop("windows")
    found = contexts.select("anchor", "same", "before", "key", "start").join(flagged, ["anchor", "same", "before"])
    found = found.select("key", F.explode("runs").alias("r"), "start")
    runs = found.groupBy("key").agg(
        F.collect_set(F.struct((F.col("start") + F.col("r.a")).alias("s"), (F.col("start") + F.col("r.b") - 1 + length).alias("e"))).alias("runs")
    )
    joined = texts.join(runs, "key", "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
