"""Language-model scores: an interpolated modified Kneser-Ney model in memory-mapped hash arrays.

Counting is a Spark job of two exchanges. Tasks split their texts into words,
count word pairs, and send packed pair lists to shards by the hash of the first
word; pairs of the few words that fill more than a shard alone are dealt by the
hash of the pair. A shard sums its pairs, writes its sorted hash array with the
counts to the shared folder, and sends on what it knows of each word: how often
and after how many different words it stands, and how many words follow it once,
twice, or more often. The second exchange sums that by word into sorted word
arrays. Only the sums of both array kinds, a row for each shard, reach the driver.

Scoring maps the arrays into the workers' memory, so workers of a machine share
the pages and only those that a text needs are read. The number of shards is
bounded, and with it what meets in the second exchange, the list of frequent
words and the files; at 100 TB a shard then holds the pairs of 1.6 GB of text. For
a token w after v

    p(w | v) = max(c(v w) - D, 0) / c(v) + g(v) p(w)
    p(w)     = max(n(. w) - D', 0) / n(. .) + g' / (V + 1)

with discounts for counts of one, two and more, from the counts of counts of
each level, n the number of different words before w, and g the weight that the
discounts leave. Unknown words share the last term. The order is two: arrays of
triples would take more disk than the data itself.

Words are held by 64-bit hashes. The shared folder is read in place if it is a
mounted folder, else its files are copied to a worker once.

Defined results: a null text is empty and has the end token alone; repeated rows
are texts of their own and count each; a row with a null id is learnt from; if
there is nothing to learn from, the score is that of an equal choice of one; an
empty table gives an empty result; extra columns are not read; a very long text is
counted and scored by one task, in memory in proportion to it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import cut, mix, new_path, text_slices, words

#: Text bytes whose pairs one shard holds, about, and array files that a worker keeps mapped at once.
SHARD_BYTES, MAPS = 16 << 20, 4096
#: Bits that name a shard of pairs and of words at most: beyond 65,536 shards (1 TB of text) shards grow instead.
PAIR_BITS, WORD_BITS = 16, 10
#: Tokens whose pairs a task counts before it sends them on.
BUFFER = 3 << 20

_U = np.uint64
BEGIN, END = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)


def token_pairs(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous and present token of every word and end in a slice, and each row's first token."""
    h, first = words(buf, offs)
    rows = len(first) - 1
    at = first + np.arange(rows + 1)
    now = np.full(len(h) + rows, END, np.uint64)
    is_word = np.ones(len(now), bool)
    is_word[at[1:] - 1] = False
    now[is_word] = h
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[at[:-1]] = BEGIN
    return before, now, at


def pair_hash(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before * _U(0xC2B2AE3D27D4EB4F) + (now ^ (now >> _U(29))) * _U(0x165667B19E3779F9))


def shard_of(before: np.ndarray, pair: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(before), np.int64)
    route = mix(before)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, before), len(hot) - 1)
        route = np.where(hot[at] == before, pair, route)
    return (route >> _U(64 - bits)).astype(np.int64)


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of each value."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[start], *(np.add.reduceat(v[order], start) if len(start) else v[:0] for v in values)


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.int64(len(a)).tobytes() + np.int64(len(b)).tobytes() + b for a in arrays for b in [pa.compress(a.tobytes(), "zstd", asbytes=True)]])


def _unpack(packed: bytes, *kinds: type) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        n, size = np.frombuffer(packed, np.int64, 2, at)
        raw = pa.decompress(packed[at + 16 : at + 16 + size], int(n) * np.dtype(kind).itemsize, "zstd", asbytes=True) if n else b""
        out.append(np.frombuffer(raw, kind))
        at += 16 + int(size)
    return out


def _count(hot: np.ndarray, bits: int):
    def flush(pairs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        before, now = (np.concatenate(x) for x in zip(*pairs, strict=True))
        pair = pair_hash(before, now)
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        n = np.diff(np.concatenate((start, [len(pair)]))).astype(np.uint32)
        before, now, pair = before[order[start]], now[order[start]], pair[start]
        shard = shard_of(before, pair, hot, bits)
        order = np.lexsort((before, shard))
        edges = np.searchsorted(shard[order], np.arange((1 << bits) + 1))
        shards, packed = [], []
        for s in np.flatnonzero(np.diff(edges)):
            part = order[edges[s] : edges[s + 1]]
            b = before[part]
            runs = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
            lengths = np.diff(np.concatenate((runs, [len(b)]))).astype(np.uint32)
            shards.append(s)
            packed.append(_pack(b[runs], lengths, now[part], n[part]))
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(packed, pa.binary())], names=["shard", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, held = [], 0
        for _, buf, offs in text_slices(batches):
            before, now, _ = token_pairs(buf, offs)
            pairs.append((before, now))
            held += len(now)
            if held >= BUFFER:
                yield from flush(pairs)
                pairs, held = [], 0
        if pairs:
            yield from flush(pairs)

    return run


def _write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of arrays, each at a multiple of 64 bytes; it appears whole or not at all."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    fs, place = FileSystem.from_uri(path)
    parts, at = [], 64 * (1 + (40 * len(arrays)) // 64)
    head = np.zeros(at // 8, np.int64)
    for i, a in enumerate(arrays.values()):
        head[4 * i : 4 * i + 3] = at, len(a), a.itemsize
        parts.append((at, a.tobytes()))
        at = -(-(at + a.nbytes) // 64) * 64
    own = f"{place}.{uuid.uuid4().hex}"
    if isinstance(fs, LocalFileSystem):
        os.makedirs(os.path.dirname(place), exist_ok=True)
    with fs.open_output_stream(own) as f:
        f.write(head.tobytes())
        done = head.nbytes
        for start, raw in parts:
            f.write(b"\0" * (start - done) + raw)
            done = start + len(raw)
    fs.move(own, place)


_SENT = (np.uint64, np.int64, np.int64, np.uint64, np.int64, np.int64, np.int64)


def _write_pairs(path: str):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = [_unpack(x.as_py(), np.uint64, np.uint32, np.uint64, np.uint32) for x in table.column("pairs")]
        before = np.concatenate([np.repeat(b, runs) for b, runs, _, _ in parts])
        now, n = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
        pair = pair_hash(before, now)
        order = np.argsort(pair, kind="stable")
        start = np.flatnonzero(np.concatenate(([True], np.diff(pair[order]) != 0)))
        n = np.add.reduceat(n[order].astype(np.int64), start)
        before, now, pair = before[order[start]], now[order[start]], pair[order[start]]
        _write(f"{path}/pairs-{shard:06d}", {"pair": pair, "n": n.astype(np.uint32) if n.max() < 1 << 32 else n})
        word, count, different = _sums(now, n, np.ones(len(n), np.int64))
        follow, *followers = _sums(before, *((n == k).astype(np.int64) for k in (1, 2)), (n > 2).astype(np.int64))
        packed = _pack(word, count, different, follow, *followers)
        return pa.table({"shard": pa.array([shard], pa.int32()), "of_counts": [[int((n == k).sum()) for k in (1, 2, 3, 4)]], "words": pa.array([packed], pa.binary())})

    return run


def _deal_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for packed in rows.column("words"):
                word, count, different, follow, *followers = _unpack(packed.as_py(), *_SENT)
                w, f = (x >> _U(64 - bits) if bits else np.zeros(len(x), np.uint64) for x in (word, follow))
                shards, out = np.union1d(w, f), []
                edges = [np.searchsorted(x, shards, side) for x in (w, f) for side in ("left", "right")]
                for a, a_end, b, b_end in zip(*(e.tolist() for e in edges), strict=True):
                    ours, theirs = slice(a, a_end), slice(b, b_end)
                    out.append(_pack(word[ours], count[ours], different[ours], follow[theirs], *(x[theirs] for x in followers)))
                yield pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int32)), pa.array(out, pa.binary())], names=["shard", "words"])

    return run


def _write_words(path: str):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = [_unpack(x.as_py(), *_SENT) for x in table.column("words")]
        word, follow = (np.concatenate([p[k] for p in parts]) for k in (0, 3))
        zero, none = np.zeros(len(word), np.int64), np.zeros(len(follow), np.int64)
        values = [np.concatenate([p[k] for p in parts]) for k in (1, 2, 4, 5, 6)]
        every, count, different, *followers = _sums(
            np.concatenate((word, follow)), *(np.concatenate((x, none)) for x in values[:2]), *(np.concatenate((zero, x)) for x in values[2:])
        )
        arrays = {"word": every, "count": count, "different": different.astype(np.uint32)}
        _write(f"{path}/words-{shard:06d}", arrays | {f"f{k}": x.astype(np.uint32) for k, x in enumerate(followers)})
        known = count > 0
        sums = [int(count.sum()), int(known.sum()), int(different.sum()), *(int((different == k).sum()) for k in (1, 2, 3, 4))]
        return pa.table({"shard": pa.array([shard], pa.int32()), "sums": [sums]})

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and more; without counts of counts to go by, half of each."""
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, *(min(max(x, 1e-3), k) for k, x in enumerate(d, 1))])


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the sums that scoring needs."""

    path: str
    pair_bits: int
    word_bits: int
    hot: np.ndarray
    tokens: int
    vocabulary: int
    texts: int
    different: int
    low: np.ndarray  # discounts of the lower level
    high: np.ndarray
    left: float  # weight that the lower level's discounts leave


def train(texts: DataFrame, text_col: str = "text") -> Model:
    """Count the model over all of ``texts``."""
    spark = texts.sparkSession
    texts = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size, rows = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    bits = min(PAIR_BITS, max(0, int(np.ceil(np.log2(max(1, size / SHARD_BYTES))))))
    path = new_path(spark, "model")
    hot = np.zeros(0, np.uint64)
    if bits > 1:  # only where pairs go depends on this sample
        hot = _frequent(texts.sample(min(1.0, max(4000, 64 << bits) / rows), 1), 0.25 / (1 << bits))
    counted = texts.mapInArrow(_count(hot, bits), "shard int, pairs binary")
    pairs = cut(counted.groupBy("shard").applyInArrow(_write_pairs(path), "shard int, of_counts array<long>, words binary"), "pairs")
    of_counts = [r[0] for r in pairs.agg(*[F.sum(F.element_at("of_counts", k)).alias(f"n{k}") for k in (1, 2, 3, 4)]).select(F.array("n1", "n2", "n3", "n4")).collect()]
    word_bits = min(WORD_BITS, max(0, bits - 2))
    dealt = pairs.select("words").mapInArrow(_deal_words(word_bits), "shard int, words binary")
    sums = cut(dealt.groupBy("shard").applyInArrow(_write_words(path), "shard int, sums array<long>"), "sums")
    total = sums.agg(*[F.coalesce(F.sum(F.element_at("sums", k)), F.lit(0)) for k in range(1, 8)]).first()
    tokens, vocabulary, different, *of_different = total
    low, high = discounts(*of_different), discounts(*(x or 0 for x in of_counts[0]))
    n1, n2 = of_different[:2]
    left = (low[1] * n1 + low[2] * n2 + low[3] * (vocabulary - n1 - n2)) / different if different else 1.0
    return Model(path, bits, word_bits, hot, tokens, vocabulary, rows, different, low, high, float(left))


def _frequent(texts: DataFrame, share: float) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, buf, offs in text_slices(batches):
            before, _, _ = token_pairs(buf, offs)
            word, n = np.unique(before, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

    seen = cut(texts.mapInArrow(run, "word long, n long"), "frequent")
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = seen.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > total * share).select("word").collect()  # 1 / share words at most, so four for each shard
    return np.sort(np.array([r["word"] for r in hot], np.int64).view(np.uint64))


# ---------------------------------------------------------------- scoring

_PAIRS = (("pair", np.uint64), ("n", np.uint32))
_WORDS = (("word", np.uint64), ("count", np.int64), ("different", np.uint32), ("f0", np.uint32), ("f1", np.uint32), ("f2", np.uint32))


class Arrays:
    """A worker's view of the model's files, mapped when they are first needed."""

    def __init__(self, model: Model) -> None:
        self.model, self.open = model, {}

    def get(self, kind: str, shard: int) -> tuple[np.ndarray, ...]:
        key = (kind, shard)
        if key not in self.open:
            if len(self.open) >= MAPS:
                self.open.pop(next(iter(self.open)))  # the one that was mapped first
            self.open[key] = self._map(f"{self.model.path}/{kind}-{shard:06d}", _PAIRS if kind == "pairs" else _WORDS)
        return self.open[key]

    @staticmethod
    def _map(path: str, fields: tuple) -> tuple[np.ndarray, ...]:
        from pyarrow.fs import FileSystem, FileType, LocalFileSystem

        fs, place = FileSystem.from_uri(path)
        if fs.get_file_info(place).type == FileType.NotFound:  # no pair or word fell into this shard
            return tuple(np.zeros(0, kind) for _, kind in fields)
        if not isinstance(fs, LocalFileSystem):
            with tempfile.NamedTemporaryFile() as own, fs.open_input_stream(place) as f:
                while block := f.read(1 << 24):
                    own.write(block)
                own.flush()
                raw = np.memmap(own.name, np.uint8, "r")
        else:
            raw = np.memmap(place, np.uint8, "r")
        head = raw[: 8 * 4 * len(fields)].view(np.int64)
        kinds = [kind if np.dtype(kind).itemsize == size else np.int64 for (_, kind), size in zip(fields, head[2::4], strict=True)]
        return tuple(raw[at : at + n * size].view(kind) for kind, at, n, size in zip(kinds, head[0::4], head[1::4], head[2::4], strict=True))

    def look_up(self, kind: str, shard: np.ndarray, key: np.ndarray, fields: tuple[int, ...]) -> list[np.ndarray]:
        """Values of each key, 0 if it is not there; keys are asked for in the order of the arrays."""
        bits = self.model.pair_bits if kind == "pairs" else self.model.word_bits
        order = np.argsort((key >> _U(bits)) | (shard.astype(np.uint64) << _U(64 - bits)) if bits else key)
        key, edges = key[order], np.searchsorted(shard[order], np.arange((1 << bits) + 1))
        out = [np.zeros(len(key), np.int64) for _ in fields]
        for s in np.flatnonzero(np.diff(edges)):
            arrays = self.get(kind, int(s))
            part = slice(edges[s], edges[s + 1])
            if len(arrays[0]):
                at = np.minimum(np.searchsorted(arrays[0], key[part]), len(arrays[0]) - 1)
                there = arrays[0][at] == key[part]
                for o, k in zip(out, fields, strict=True):
                    o[part] = np.where(there, arrays[k][at], 0)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return [o[back] for o in out]

    def words(self, word: np.ndarray, fields: tuple[int, ...]) -> list[np.ndarray]:
        distinct, which = np.unique(word, return_inverse=True)
        bits = self.model.word_bits
        shard = (distinct >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)
        return [x[which] for x in self.look_up("words", shard, distinct, fields)]

    def score(self, buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base_score and score of each row of a slice."""
        m = self.model
        before, now, first = token_pairs(buf, offs)
        both = np.concatenate((before, now))
        count, different, f0, f1, f2 = self.words(both, (1, 2, 3, 4, 5))
        n = len(now)
        c, different = count[n:], different[n:]
        context = np.where(before == BEGIN, m.texts, count[:n])
        pair = pair_hash(before, now)
        (c_pair,) = self.look_up("pairs", shard_of(before, pair, m.hot, m.pair_bits), pair, (1,))
        low = np.full(n, m.left / (m.vocabulary + 1))
        if m.different:
            low += np.maximum(different - m.low[np.minimum(different, 3)], 0) / m.different
        total = np.maximum(context, 1)
        rest = (m.high[1] * f0[:n] + m.high[2] * f1[:n] + m.high[3] * f2[:n]) / total
        p = np.where(context > 0, np.maximum(c_pair - m.high[np.minimum(c_pair, 3)], 0) / total + rest * low, low)
        base = np.log10((c + 0.5) / (m.tokens + 0.5 * (m.vocabulary + 1)))
        sums = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else x[:0]
        return {"n_tokens": np.diff(first), "n_known": sums((c > 0).astype(np.int64)), "base_score": sums(base), "score": sums(np.log10(p))}


_OPEN: dict[str, Arrays] = {}


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score, perplexity`` of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _OPEN.get(sent.value.path)
        if arrays is None:
            _OPEN.clear()
            arrays = _OPEN[sent.value.path] = Arrays(sent.value)
        for rows, buf, offs in text_slices(batches):
            got = arrays.score(buf, offs)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *[pa.array(x) for x in got.values()]], names=["doc_id", *got])

    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
