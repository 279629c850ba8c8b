"""Shared pieces of the training-data operators.

``cut`` stores an intermediate table in the cluster's shared folder, so that a
lost executor costs a re-read and not a recomputation. ``text_slices`` and
``words`` turn Arrow text columns into flat numpy arrays: a whole slice of
documents is split into words and hashed without a Python loop over words.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that one numpy slice holds (a longer document is a slice alone).
SLICE_BYTES = 2 << 20

_OWN_DIRS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; on a local master without it, a new one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _OWN_DIRS[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` returned, when all that reads them is stored itself."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# ---------------------------------------------------------------- text as arrays


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), offs - offs[0]
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def text_slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into row slices of about ``most`` text bytes, each with its bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        buf, offs = flat(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offs, offs[at] + most, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), buf[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
            at = to


_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: all but space and \t\n\v\f\r.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of words made of ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_powers(n: int) -> np.ndarray:
    """Odd factors that tell the places of a sequence apart."""
    return _powers(n)[0]


def inverse_powers(n: int) -> np.ndarray:
    """Factors that take the place of a span out of a difference of ``prefix_hashes``."""
    return _powers(n)[1]


def prefix_hashes(buf: np.ndarray) -> np.ndarray:
    """Running polynomial hashes: ``span_hashes`` gives that of any span from them."""
    out = np.zeros(len(buf) + 1, np.uint64)
    if len(buf):
        np.cumsum(_BYTE[buf] * _powers(len(buf) + 1)[0][:-1], out=out[1:])
    return out


def span_hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _powers(len(running))[1]
    with np.errstate(over="ignore"):
        return mix((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _U(0xD1B54A32D192ED03))


def word_spans(buf: np.ndarray, offs: np.ndarray, member: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in a slice, and each document's first word (one more at the end)."""
    inside = member[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    full = offs[:-1] < offs[1:]
    before[offs[:-1][full]] = False
    after[offs[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offs)


def words(buf: np.ndarray, offs: np.ndarray, member: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words in a slice, and each document's first word."""
    low = LOWER[buf]
    starts, ends, first = word_spans(low, offs, member)
    return span_hashes(prefix_hashes(low), starts, ends), first


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row that each element belongs to, from the rows' first elements."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
