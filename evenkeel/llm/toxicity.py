"""A toxicity classifier: a linear model over character n-grams, scaled by naive Bayes log-count ratios.

Features are the presence of lower-cased n-grams of ``ORDERS`` characters, hashed
to ``BINS``. The sample of labelled rows is bounded (``most`` of
``labelled_sample``, and ``FIT_BYTES`` of text, in the order of the ids' hashes; a
text that does not fit into what is left of these is passed over), so one task
fits the model to it, in some 17 bytes of memory for each byte of text: it counts in how many
documents of either class each bin is present, which gives every bin the ratio of
its smoothed log frequencies in the two classes, and fits a ridge logistic
regression on the presence of all bins times their ratios. Only the fitted weights
reach the driver. Scoring reads each whole text once and moves nothing between
tasks.

Defined results: a null or empty text has no n-grams and gets the model's base
score; a very long text is read in one piece by one task; repeated rows are
scored alike; without labels of both classes every score is the share of label 1
(0 if there are none); bytes that are no UTF-8 count as unknown characters; an
empty table gives an empty result; extra columns are not read by ``toxicity``
and kept by ``without_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import text_slices

ORDERS = (4, 5, 6)
BITS = 18
#: Bytes of text at most that the model is fitted to.
FIT_BYTES = 32 << 20
BINS = 1 << BITS

_U = np.uint64
#: Lower case of the characters of the basic plane; all white space is a blank.
_PLAIN = np.array([32 if chr(c).isspace() else ord(low) if len(low := chr(c).lower()) == 1 else c for c in range(1 << 16)], np.uint64)


def characters(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased characters of a slice as numbers, and each row's first."""
    raw = buf.tobytes()
    try:
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        at = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[offs]
    except UnicodeDecodeError:
        rows = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)]
        codes = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32)
        at = np.cumsum([0, *map(len, rows)])
    return np.where(codes < len(_PLAIN), _PLAIN[np.minimum(codes, len(_PLAIN) - 1)], codes), at


def present(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bin) pairs of the n-grams in a slice, in order."""
    codes, at = characters(buf, offs)
    kind = np.uint32 if len(offs) <= 1 << (32 - BITS) else _U
    row = np.repeat(np.arange(len(at) - 1, dtype=kind), np.diff(at))
    found, h = [], np.zeros(len(codes), _U)
    for n in range(1, max(ORDERS) + 1):
        if len(codes) < n:
            break
        with np.errstate(over="ignore"):
            h = h[: len(codes) - n + 1] * _U(0x100000001B3) + codes[n - 1 :] + _U(1)
            if n in ORDERS:
                inside = row[: len(h)] == row[n - 1 :]
                bins = ((h + _U(n)) * _U(0x9E3779B97F4A7C15) >> _U(64 - BITS)).astype(kind)
                found.append(((row[: len(h)] << kind(BITS)) | bins)[inside])
    pairs = np.sort(np.concatenate(found)) if found else np.zeros(0, kind)
    if len(pairs):
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
    return (pairs >> kind(BITS)).astype(np.int64), (pairs & kind(BINS - 1)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray
    base: float

    def score(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        row, bins = present(buf, offs)
        z = self.base + np.bincount(row, self.weights[bins], len(offs) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def minimise(value, x: np.ndarray, rounds: int, memory: int = 5) -> np.ndarray:
    """The least of a smooth convex function (``value`` gives it with its slopes), by steps of limited-memory BFGS."""
    f, g = value(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step, used = -g, []
        for s, y in reversed(past):
            used.append(float(s @ step) / float(s @ y))
            step = step - used[-1] * y
        if past:
            step = step * (float(past[-1][0] @ past[-1][1]) / float(past[-1][1] @ past[-1][1]))
        else:
            step = step / max(1.0, float(np.linalg.norm(g)))
        for (s, y), w in zip(past, reversed(used), strict=True):
            step = step + (w - float(y @ step) / float(s @ y)) * s
        size, slope = 1.0, float(g @ step)
        while True:
            new, (f_new, g_new) = x + size * step, value(x + size * step)
            if f_new <= f + 1e-4 * size * slope or size < 1e-3:
                break
            size /= 2
        if float((new - x) @ (g_new - g)) > 0:
            past = [*past, (new - x, g_new - g)][-memory:]
        done = f - f_new < 1e-3 * abs(f)
        x, f, g = new, f_new, g_new
        if done:
            break
    return x


def _fitted(ridge: float, rounds: int, most: int):
    """One task: the whole of a bounded sample in, one row of weights out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, label, held = [], np.zeros(0), 0
        for rows, buf, offs in text_slices(batches, most=1 << 17):
            if held + len(buf) > most:
                continue
            held += len(buf)
            row, bins = present(buf, offs)
            parts.append((len(label), rows.num_rows, row.astype(np.int32), bins.astype(np.int32)))
            label = np.append(label, rows.column("label").to_numpy())
        ones = label.sum()
        zeros = len(label) - ones
        share = min(max(ones / max(1, len(label)), 1e-9), 1 - 1e-9)
        x = np.append(np.zeros(BINS), np.log(share / (1 - share)))
        if ones and zeros:
            counts = np.zeros((2, BINS))
            for at, _, row, bins in parts:
                counts += np.bincount(bins + BINS * label[at + row].astype(np.int64), minlength=2 * BINS).reshape(2, BINS)
            # of bins that the sample lacks there is nothing to learn
            ratio = np.where(counts.any(axis=0), np.log((counts[1] + 1) / (ones + 2)) - np.log((counts[0] + 1) / (zeros + 2)), 0)
            scale, keep = np.append(ratio, 1), np.append(np.full(BINS, ridge), 0)

            def value(w: np.ndarray) -> tuple[float, np.ndarray]:
                weights, slopes, loss = w * scale, np.zeros(BINS + 1), 0.0
                for at, n, row, bins in parts:
                    z = weights[-1] + np.bincount(row, weights[bins], n)
                    own = label[at : at + n]
                    loss += float((np.logaddexp(0, z) - own * z).sum())
                    off = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - own
                    slopes[:-1] += np.bincount(bins, off[row], BINS)
                    slopes[-1] += off.sum()
                return loss + 0.5 * float(keep @ (w * w)), slopes * scale + keep * w

            x = minimise(value, np.zeros(BINS + 1), rounds) * scale
        yield pa.RecordBatch.from_arrays([pa.array([x[:-1].astype(np.float32).tobytes()], pa.binary()), pa.array([float(x[-1])])], names=["weights", "base"])

    return run


def fit(sample: DataFrame, *, ridge: float = 1.0, rounds: int = 15, most_bytes: int = FIT_BYTES) -> Model:
    """Fit the model to ``(text, label)`` rows, whose number the caller bounds, and to ``most_bytes`` of text at most."""
    rows = sample.select("__id", "text", "label").repartition(1).sortWithinPartitions(F.xxhash64("__id"), "__id").select("text", "label")
    found = rows.mapInArrow(_fitted(ridge, rounds, most_bytes), "weights binary, base double").collect()
    if not found:  # no rows, no task
        return Model(np.zeros(BINS, np.float32), float(np.log(1e-9 / (1 - 1e-9))))
    return Model(np.frombuffer(bytes(found[0]["weights"]), np.float32), found[0]["base"])


def toxicity(docs: DataFrame, sample: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, for a model fitted to ``sample`` (see ``labelled_sample``)."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, most=1 << 17):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sent.value.score(buf, offs))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, sample: DataFrame, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, text_col, 1 << 17):
            yield rows.filter(pa.array(sent.value.score(buf, offs) < threshold))

    return docs.mapInArrow(run, docs.schema)
