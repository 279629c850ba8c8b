"""A quality classifier: similarity-weighted votes of the nearest labelled documents in a latent-semantic space.

Terms are n-grams of character shapes (upper case, lower case, digits, signs,
white space), byte pairs and marks of repetition, hashed to ``TERMS``, and words,
hashed to ``WORDS``. A bounded sample of labelled rows gives the terms' weights
(rare terms count more; of words those that set the two labels apart), the
``DIMENSIONS`` leading directions of its weighted term matrix, and the labelled
vectors in that space, which are broadcast (rows times dimensions numbers, both
parameters). Every document is projected, its cosine with all labelled vectors
is computed exactly by blocked matrix products, and its ``NEIGHBOURS`` nearest
vote with their similarity.

Defined results: a null or empty text has no terms and gets the sample's share
of label 1; so does a text without a similar neighbour; ties in similarity go
to the labelled row that comes first; repeated rows are scored alike; without
labelled rows every score is 0; a very long text is read by one task, in memory
in proportion to it; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import prefix_hashes, rows_of, span_hashes, text_slices, word_spans, words

_U = np.uint64

TERMS, WORDS, DIMENSIONS, NEIGHBOURS = 2048, 1024, 48, 25
#: What words weigh beside the other terms.
WORD_SHARE = 0.5
#: Documents in one product with the labelled vectors.
ROWS = 512

_SHAPE = np.arange(256, dtype=np.int64)
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48


def term_counts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How often each hashed term stands in each row of a slice."""
    n = len(offs) - 1
    row = np.repeat(np.arange(n), np.diff(offs))
    out = np.zeros(n * TERMS, np.float32)

    def add(rows: np.ndarray, code: np.ndarray, kind: int) -> None:
        slot = ((code * 8 + kind) * 0x9E3779B1 & 0xFFFFFFFF) * TERMS >> 32
        out[:] += np.bincount(rows * TERMS + slot, minlength=n * TERMS)

    shape, raw = _SHAPE[buf], buf.astype(np.int64)
    same_2 = row[1:] == row[:-1]
    same_3 = row[2:] == row[:-2]
    add(row, shape, 0)
    add(row[1:][same_2], (shape[:-1] * 256 + shape[1:])[same_2], 1)
    add(row[2:][same_3], (shape[:-2] * 65536 + shape[1:-1] * 256 + shape[2:])[same_3], 2)
    add(row[1:][same_2], (raw[:-1] * 256 + raw[1:])[same_2], 3)
    starts, ends, first = word_spans(buf, offs)
    if len(starts):
        h = span_hashes(prefix_hashes(buf), starts, ends)
        owner = np.repeat(np.arange(n), np.diff(first))
        for back in (1, 2, 4):  # words that stand again soon after
            if len(h) > back:
                again = (h[back:] == h[:-back]) & (owner[back:] == owner[:-back])
                add(owner[back:][again], np.full(int(again.sum()), back), 4)
        line = np.zeros(256, bool)
        line[:] = True
        line[10] = False
        a, b, _ = word_spans(buf, offs, line)
        lines = span_hashes(prefix_hashes(buf), a, b)
        owner = np.searchsorted(offs, a, "right") - 1
        order = np.lexsort((lines, owner))
        again = (lines[order][1:] == lines[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        rows = owner[order][1:][again]
        add(rows, np.zeros(len(rows), np.int64), 5)
    h, first = words(buf, offs)
    slot = (h >> _U(32)).astype(np.int64) * WORDS >> 32
    used = np.bincount(rows_of(first) * WORDS + slot, minlength=n * WORDS).astype(np.float32)
    return np.concatenate((out.reshape(n, TERMS), used.reshape(n, WORDS)), axis=1)


def _hellinger(counts: np.ndarray) -> np.ndarray:
    """Roots of the shares that terms have of all, and words of all words."""
    shares = lambda c: np.sqrt(c / np.maximum(c.sum(axis=1, keepdims=True), 1))
    return np.concatenate((shares(counts[:, :TERMS]), shares(counts[:, TERMS:])), axis=1)


def term_weights(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of terms: the rarer the more; of words times how far the labels' means are apart, in deviations."""
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    one, zero = x[labels == 1, TERMS:], x[labels == 0, TERMS:]
    if not len(one) or not len(zero):
        weights[TERMS:] = 0
        return weights
    deviation = np.sqrt((one.var(axis=0) + zero.var(axis=0)) / 2)
    weights[TERMS:] *= WORD_SHARE * np.abs(one.mean(axis=0) - zero.mean(axis=0)) / (deviation + 1e-3)
    return weights


@dataclass
class Model:
    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        v = (_hellinger(counts) * self.weights) @ self.directions
        return v / np.maximum(np.sqrt((v**2).sum(axis=1, keepdims=True)), 1e-9)

    def score(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(offs) - 1, self.share)
        out = np.empty(len(offs) - 1)
        for at in range(0, len(out), ROWS):
            to = min(at + ROWS, len(out))
            counts = term_counts(buf[offs[at] : offs[to]], offs[at : to + 1] - offs[at])
            near = self.project(counts) @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            best = np.argsort(-near, axis=1, kind="stable")[:, :k] if near.shape[1] <= 64 else self._best(near, k)
            sims = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(float)
            weight = sims.sum(axis=1)
            vote = (sims * self.labels[best]).sum(axis=1) / np.maximum(weight, 1e-12)
            out[at:to] = np.where((weight > 0) & (counts.sum(axis=1) > 0), vote, self.share)
        return np.clip(out, 0, 1)

    @staticmethod
    def _best(near: np.ndarray, k: int) -> np.ndarray:
        """The k nearest; rows in which several share the last place are sorted in full."""
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        last = np.take_along_axis(near, best, axis=1).min(axis=1)
        tied = np.flatnonzero((near >= last[:, None]).sum(axis=1) > k)
        best[tied] = np.argsort(-near[tied], axis=1, kind="stable")[:, :k]
        return best


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offs in text_slices(batches, most=1 << 20):
        packed = [x.tobytes() for x in _hellinger(term_counts(buf, offs)).astype(np.float16)]
        yield pa.RecordBatch.from_arrays([rows.column("__id"), rows.column("label"), pa.array(packed, pa.binary())], names=["id", "label", "terms"])


def fit(sample: DataFrame) -> Model:
    """Fit the space to ``(text, label)`` rows, whose number the caller bounds."""
    kind = sample.schema["__id"].dataType.simpleString()
    rows = sample.mapInArrow(_sample_terms, f"id {kind}, label int, terms binary").orderBy("id", "terms").toArrow()
    if not rows.num_rows:
        return Model(np.ones(TERMS + WORDS), np.zeros((TERMS + WORDS, 1)), np.zeros((0, 1)), np.zeros(0), 0.0)
    x = np.frombuffer(b"".join(v.as_py() for v in rows.column("terms")), np.float16).reshape(-1, TERMS + WORDS).astype(np.float32)
    labels = rows.column("label").to_numpy().astype(float)
    weights = term_weights(x, labels)
    gram = (x * weights).T @ (x * weights)
    _, vectors = np.linalg.eigh(gram)
    model = Model(weights, vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32).copy(), np.zeros((0, 1)), labels, float(labels.mean()))
    v = (x * weights) @ model.directions
    model.vectors = v / np.maximum(np.sqrt((v**2).sum(axis=1, keepdims=True)), 1e-9)
    return model


def quality(docs: DataFrame, sample: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, from the labelled ``sample`` (see ``labelled_sample``)."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, most=1 << 20):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sent.value.score(buf, offs))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
