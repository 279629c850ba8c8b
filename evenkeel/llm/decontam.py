"""Benchmark decontamination with a positional inverted index of the corpus.

The index is partitioned by documents: each row holds a block of documents with
the sorted terms of the block and, for every term, the positions where it
stands, so a phrase is found without moving postings between tasks. The index
is stored in the shared folder and read twice: the first read sums the document
collection's count of every test term, the second intersects, for every window
of a test item, the position lists of its words, shifted by their offsets,
from the rarest word on. Windows that lack a word in a block cost one lookup.

The different test items are sent to the tasks in parts of about ``PART_WORDS``
words, one pass over the index for each part, so what is broadcast is bounded.

Defined results: a null text or item has no words; an item of fewer words than
a window is one window of all its words; an item without words matches nothing;
repeated rows are documents of their own; items with one id are one item; an
item without an id is left out; a very long text is split by one task, slice by
slice; an empty table gives an empty result or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import ALNUM, cut, rows_of, text_slices, unused, words

#: Words of test items that one pass over the index looks for.
PART_WORDS = 1 << 20
#: Words of a piece of an item, about.
PIECE_WORDS = 1 << 15
_INDEX = "block string, docs array<{id}>, starts binary, terms binary, counts binary, positions binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import uuid

    for rows, buf, offs in text_slices(batches, most=4 << 20):
        h, first = words(buf, offs, ALNUM)
        order = np.argsort(h, kind="stable").astype(np.uint32)
        terms, counts = np.unique(h[order], return_counts=True)
        ids = rows.column("doc_id")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().hex]),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                *[pa.array([x.tobytes()], pa.binary()) for x in (first.astype(np.uint32), terms, counts.astype(np.uint32), order)],
            ],
            names=["block", "docs", "starts", "terms", "counts", "positions"],
        )


def positional_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index of ``docs``: a row for each block of about 4 MiB of text."""
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return cut(docs.mapInArrow(_index, _INDEX.format(id=kind)), "index")


def _item_words(window: int, most: int):
    """The words of items; those of a long item in pieces of about ``most`` words that share ``window`` - 1 of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            h, first = words(buf, offs, ALNUM)
            out: tuple[list, list, list] = ([], [], [])
            for i, item in enumerate(rows.column("item").to_pylist()):
                own = h[first[i] : first[i + 1]]
                for at in range(0, max(1, len(own) - window + 1), most):
                    piece = own[at : at + most + window - 1]
                    for x, value in zip(out, (item, len(piece), piece.tobytes()), strict=True):
                        x.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["item", "n", "words"])

    return run


class Windows:
    """The windows of a part of the items: distinct word rows, the items of each, and the part's vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], size: int) -> None:
        found: dict[bytes, set[int]] = {}
        self.items = [item for item, _ in items]
        for i, (_, packed) in enumerate(items):
            n = len(packed) // 8
            width = min(size, n)
            for at in range(n - width + 1 if n else 0):
                found.setdefault(packed[8 * at : 8 * (at + width)], set()).add(i)
        self.of = [sorted(x) for x in found.values()]
        self.width = np.array([len(w) // 8 for w in found], np.int64)
        flat = np.frombuffer(b"".join(found), np.uint64)
        self.vocabulary, self.word = np.unique(flat, return_inverse=True)
        self.at = np.concatenate(([0], np.cumsum(self.width)))
        self.order: list[np.ndarray] = []

    def rarest_first(self, counts: np.ndarray) -> None:
        """Fix the order in which a window's words are intersected."""
        self.order = [np.argsort(counts[self.word[a:b]], kind="stable") for a, b in zip(self.at[:-1], self.at[1:], strict=True)]


def _find(terms: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """The place of each vocabulary word among a block's terms; -1 if it is not there."""
    if not len(terms):
        return np.full(len(vocabulary), -1)
    at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
    return np.where(terms[at] == vocabulary, at, -1)


def _counts(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for rows in batches:
            for terms, counts in zip(rows.column("terms"), rows.column("counts"), strict=True):
                at = _find(np.frombuffer(terms.as_buffer(), np.uint64), vocabulary)
                total[at >= 0] += np.frombuffer(counts.as_buffer(), np.uint32)[at[at >= 0]]
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["word", "n"])

    return run


def match_block(windows: Windows, first: np.ndarray, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, slop: int = 0) -> list[tuple[int, np.ndarray]]:
    """The windows found in a block, each with the positions where it starts.

    With ``slop`` a word may stand up to so many places from where the exact
    phrase has it (a proximity match, placed where its rarest word says).
    """
    place = _find(terms, windows.vocabulary)
    bounds = np.concatenate(([0], np.cumsum(counts.astype(np.int64))))
    missing = np.add.reduceat((place[windows.word] < 0).astype(np.int64), windows.at[:-1]) if len(windows.word) else np.zeros(0)
    found = []
    for w in np.flatnonzero(missing == 0):
        base, width = windows.at[w], windows.width[w]
        starts = None
        for j in windows.order[w]:
            t = place[windows.word[base + j]]
            adjusted = positions[bounds[t] : bounds[t + 1]].astype(np.int64) - j
            if starts is None:
                starts = adjusted[adjusted >= 0]
            else:
                near = np.searchsorted(adjusted, starts - slop)
                ok = near < len(adjusted)
                ok[ok] = adjusted[near[ok]] <= starts[ok] + slop
                starts = starts[ok]
            if not len(starts):
                break
        if starts is not None and len(starts):
            doc = np.searchsorted(first, starts, "right") - 1
            starts = starts[starts + width <= first[doc + 1]]
            if len(starts):
                found.append((int(w), starts))
    return found


def _hits(windows: Windows, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for k in range(rows.num_rows):
                first, terms, counts, positions = (
                    np.frombuffer(rows.column(c)[k].as_buffer(), kind)
                    for c, kind in (("starts", np.uint32), ("terms", np.uint64), ("counts", np.uint32), ("positions", np.uint32))
                )
                first = first.astype(np.int64)
                n = len(first) - 1
                runs: list[list[dict]] = [[] for _ in range(n)]
                items: list[set[int]] = [set() for _ in range(n)]
                edge = np.zeros(len(positions) + 1, np.int64)
                for w, starts in match_block(windows, first, terms, counts, positions, slop):
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + windows.width[w], -1)
                    for d in np.unique(np.searchsorted(first, starts, "right") - 1):
                        items[d].update(windows.of[w])
                inside = np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]))
                inside_doc = rows_of(first)
                begin = np.flatnonzero(np.diff(inside) == 1)
                end = np.flatnonzero(np.diff(inside) == -1)
                for a, b in zip(begin, end, strict=True):
                    while a < b:  # a run may go on in the next document
                        d = inside_doc[a]
                        to = min(b, first[d + 1])
                        runs[d].append({"s": int(a - first[d]), "e": int(to - first[d])})
                        a = to
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rows.column("block")[k].as_py()] * n, pa.string()),
                        pa.array(np.arange(n)),
                        rows.column("docs")[k].values,
                        pa.array(np.diff(first)),
                        pa.array(runs, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                        pa.array([[windows.items[i] for i in sorted(x)] for x in items], pa.list_(pa.string())),
                    ],
                    names=["block", "row", "doc_id", "n_words", "runs", "items"],
                )

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    slop: int = 0,
) -> DataFrame:
    """For each document: doc_id, n_words, runs (of hit words), n_hit, items (found, sorted as strings)."""
    spark = docs.sparkSession
    index = positional_index(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    # equal items are looked for once
    items = items.mapInArrow(_item_words(window, PIECE_WORDS), "item string, n long, words binary").where("n > 0")
    items = cut(items.distinct(), "items")
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // PART_WORDS))
    found = None
    for part in range(parts):
        some = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part).select("item", "words")
        windows = Windows([(r["item"], bytes(r["words"])) for r in some.collect()], window)
        counted = index.select("terms", "counts").mapInArrow(_counts(windows.vocabulary), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        counts = np.zeros(len(windows.vocabulary), np.int64)
        for r in counted.collect():
            counts[r["word"]] = r["n"]
        windows.rarest_first(counts)
        sent = spark.sparkContext.broadcast(windows)
        schema = f"block string, row long, doc_id {kind}, n_words long, runs array<struct<s:long,e:long>>, items array<string>"
        hits = index.mapInArrow(lambda batches, sent=sent: _hits(sent.value, slop)(batches), schema)
        found = hits if found is None else found.union(hits)
    if parts > 1:
        found = found.groupBy("block", "row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"), F.flatten(F.collect_list("items")).alias("items"),
        )
    # the runs are in order; a word in two of them counts once
    covered = F.aggregate(
        "runs",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, r: F.struct((a["n"] + F.greatest(F.lit(0), r["e"] - F.greatest(a["to"], r["s"]))).alias("n"), F.greatest(a["to"], r["e"]).alias("to")),
        lambda a: a["n"],
    )
    return found.select("doc_id", "n_words", "runs", covered.alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 10) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with all their columns."""
    (key,) = unused(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col)))
    found = contamination(keyed, benchmark, id_col=key, text_col=text_col, window=window)
    return keyed.join(found.where("n_hit > 0").select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)
