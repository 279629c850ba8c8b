"""Exact top-k search by inner product: a Voronoi kNN join.

Pivots, about as many as the root of the number of vectors, split these into
cells. Each cell is summarised by its size and radius, a table of a row for each
pivot. Cells whose pivots are alike make up units of about a block of rows. A query
is first solved in its own unit; its k-th score there is a bound that every result
must reach. Another cell can hold a result only if
``query . pivot + |query| * radius`` reaches that bound, and the query is sent to
the units of those cells alone: where bounds leave out nothing, that is a copy of
the query for each unit and not for each cell. Units are cut into blocks and the
queries of a unit into chunks by a hash of the row, so a vector that a third of the
rows share fills many blocks and not one task; each (block, chunk) pair is solved by
matrix products of bounded size and returns k rows a query at most. Vectors travel
in the smallest type that holds all of the table's numbers.

Defined results: vectors that are null or hold a null or non-finite component
(also one that is infinite after scaling) take no part, nor do rows with a null
id; a shorter vector, also an empty one, counts as filled up with zeros. Every
row is one of its own, whatever its id: each row that is asked for is answered,
with all other rows as candidates, those of the same id included; ties go to the
smaller id. Scores are exact; one beyond 64 bits counts as the nearest number of 64
bits. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import cut

#: Pivots at least; from its square on, there are as many as the root of the number of vectors.
PIVOTS = 64
#: Rows in a block of a unit, and queries in a chunk, about, at most.
BLOCK, CHUNK = 16384, 16384
#: Blocks that a small table is cut into, and the rows that a block of it has at least.
SPREAD, SMALL_BLOCK = 64, 256
#: Numbers in a matrix (vectors by pivots, the vectors of a block, scores), at most (32 MB).
ENTRIES = 1 << 22
#: Types that vectors are stored in, the smallest first, and the largest size of their numbers.
TYPES = (("i1", 127), ("i2", (1 << 15) - 1), ("i4", (1 << 31) - 1), ("f8", math.inf))
_LEAST = -(1 << 63)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Equal-length vectors, stored as the bytes of numbers of type ``kind``, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]].view(kind).reshape(n, -1) if n and offs[-1] > offs[0] else np.zeros((n, 0), kind)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: as floats or doubles where these are exact, else as 64-bit integers."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    most = a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) if a.size and b.size else 0.0
    if most < 2.0**53:
        kind = np.float32 if most < 2.0**24 else np.float64
        return a.astype(kind) @ b.astype(kind).T
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.abs(a) @ np.abs(b).T
        small = [np.where(np.abs(x) < 2.0**62, x, 0).astype(np.int64) for x in (a, b)]
        out = small[0] @ small[1].T
    for i, k in zip(*np.nonzero(~(size < 2.0**62)), strict=True):
        exact = sum(int(x) * int(y) for x, y in zip(a[i], b[k], strict=True))
        out[i, k] = min(max(exact, _LEAST), -_LEAST - 1)
    return out


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float, asked: Column) -> DataFrame:
    """``(id, ints, asked)``: floor(scale * x) of each component, without the vectors that take no part."""
    scaled = F.transform(F.col(vector_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), scaled.alias("x"), F.coalesce(asked, F.lit(False)).alias("asked"))
    good = ~F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # doubles from 2**53 on are whole
    whole = F.transform("x", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    return rows.where(good).select("id", whole.alias("ints"), "asked")


def _portions(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a matrix of their rows by ``columns`` has ``ENTRIES`` numbers at most (a row's alone, if that is more)."""
    step = max(1, ENTRIES // max(1, columns))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _assign(sent: Broadcast, width: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = sent.value
        with np.errstate(over="ignore"):
            half = (pivots**2).sum(axis=1) / 2
        for rows in _portions(batches, len(pivots)):
            column = rows.column("ints")
            n = pc.list_value_length(column).to_numpy()
            x = np.zeros((len(n), width))
            x[np.arange(width) < n[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                cell = np.argmax(x @ pivots.T - half, axis=1)
                far = np.nan_to_num(np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1)), nan=np.inf, posinf=np.inf)
            stored = x.astype(kind)
            ends = pa.py_buffer(np.arange(len(n) + 1, dtype=np.int32) * np.int32(stored.itemsize * width))
            packed = pa.Array.from_buffers(pa.binary(), len(n), [None, ends, pa.py_buffer(stored)])
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), rows.column("id"), pa.array(cell.astype(np.int32)), pa.array(far), rows.column("asked"), packed],
                names=["row", "id", "cell", "far", "asked", "vec"],
            )

    return run


def _units(pivots: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """A number for each cell: cells of one number have about ``most`` rows together at most, or are one cell, and pivots that are near each other."""
    out, open_, made = np.zeros(len(pivots), np.int32), [np.arange(len(pivots))], 0
    while open_:
        cells = open_.pop()
        if len(cells) == 1 or sizes[cells].sum() <= most:
            out[cells], made = made, made + 1
            continue
        # halves of about as many rows, along the line through two pivots that are far apart
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.nan_to_num(pivots[cells] - pivots[cells[0]])
            far = np.nan_to_num(x @ x[np.argmax(np.nan_to_num((x**2).sum(axis=1)))])
            far = np.nan_to_num((x - x[np.argmin(far)]) @ (x[np.argmax(far)] - x[np.argmin(far)]))
        cells = cells[np.argsort(far, kind="stable")]
        running = np.cumsum(sizes[cells])
        at = int(np.clip(np.searchsorted(running, running[-1] / 2), 1, len(cells) - 1))
        open_ += [cells[at:], cells[:at]]
    return out


def _solve(k: int, kind: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Scores of the queries in ``left`` against the rows in ``right``: k for each at most."""
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            asked, own, least = (left.column(c).to_numpy() for c in ("id", "row", "least"))
            ids, row = right.column("id").to_numpy(), right.column("row").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, row, rows = ids[order], row[order], _matrix(right.column("vec"), kind)[order]
            queries, step = _matrix(left.column("vec"), kind), max(1, ENTRIES // len(rows))
            for begin in range(0, len(asked), step):
                for i, s in enumerate(_products(queries[begin : begin + step], rows), begin):
                    at = np.flatnonzero(s >= least[i])
                    at = at[row[at] != own[i]]
                    if len(at) > k:
                        part = s[at]
                        at = at[part >= np.partition(part, len(part) - k)[len(part) - k]]
                        score = s[at].astype(np.int64)
                        at = at[np.lexsort((ids[at], ~score))[:k]]
                    if len(at):
                        found.append((np.full(len(at), own[i]), np.full(len(at), asked[i]), ids[at], s[at].astype(np.int64)))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("row", "query_id", "vec_id", "score"), columns, strict=True)})

    return run


def _elsewhere(sent: Broadcast, sent_cells: Broadcast, kind: str):
    """For each query the units, but for its own, with a cell that can hold a row which reaches its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, (radius, unit) = sent.value, sent_cells.value
        order = np.argsort(unit, kind="stable")
        names, first = np.unique(unit[order], return_index=True)
        for rows in _portions(batches, len(pivots)):
            x = _matrix(rows.column("vec"), kind).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                most = x @ pivots.T + np.sqrt((x**2).sum(axis=1))[:, None] * np.maximum(radius, 0)
                most += 1e-6 * np.abs(most) + 1e-3  # for rounding
            most[np.isnan(most)] = np.inf
            most = np.maximum(most, _LEAST)
            reach = (most >= rows.column("least").to_numpy()[:, None]) & (radius >= 0)
            reach = np.logical_or.reduceat(reach[:, order], first, axis=1)
            reach[np.arange(len(x)), np.searchsorted(names, rows.column("unit").to_numpy())] = False
            ends = np.concatenate([[0], np.cumsum(reach.sum(axis=1))])
            units = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(names[np.nonzero(reach)[1]], pa.int32()))
            yield rows.select(["row", "id", "vec", "least"]).append_column("units", units)

    return run


def exact_top_k(
    vectors: DataFrame, asked: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for every row that ``asked`` marks."""
    result = "row long, query_id long, vec_id long, score long"
    spark = vectors.sparkSession
    ints = integer_vectors(vectors, id_col, vector_col, scale, asked)
    largest = F.max(F.aggregate("ints", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))))
    n, width, largest = ints.agg(F.count("*"), F.max(F.size("ints")), largest).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    kind = next(t for t, most in TYPES if largest <= most)
    # as many vectors as the root of all
    pivot_rows = ints.select("id", "ints").orderBy(F.xxhash64("id"), "id").limit(max(PIVOTS, math.isqrt(n))).select("ints").toArrow()
    column = pivot_rows.column("ints").combine_chunks()
    pivots = np.zeros((len(column), width))
    pivots[np.arange(width) < pc.list_value_length(column).to_numpy()[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    pivots = np.unique(pivots, axis=0)
    sent = spark.sparkContext.broadcast(pivots)
    cells = ints.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_assign(sent, width, kind), "row long, id long, cell int, far double, asked boolean, vec binary")
    cells = cut(cells, "cells")
    radius, sizes = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    for cell in cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():  # a row for each pivot at most
        radius[cell["cell"]], sizes[cell["cell"]] = cell["far"], cell["n"]
    fit = max(1, ENTRIES // max(1, width))
    block, chunk = min(BLOCK, fit, max(SMALL_BLOCK, n // SPREAD)), min(CHUNK, fit)
    unit = _units(pivots, sizes, block)
    pieces = lambda n, size: F.greatest(F.lit(1), F.ceil(F.col(n) / size)).cast("int")
    deal = lambda salt, n: F.pmod(F.xxhash64("row", F.lit(salt)), n).cast("int")
    of_cell = spark.createDataFrame(pa.table({"cell": pa.array(range(len(pivots)), pa.int32()), "unit": pa.array(unit)}))
    held = cells.join(F.broadcast(of_cell), "cell")  # a row for each pivot
    stats = held.groupBy("unit").agg(F.count("*").alias("n"), F.count_if("asked").alias("q"))
    stats = cut(stats.select("unit", pieces("n", block).alias("blocks"), pieces("q", chunk).alias("chunks")), "unit_sizes")

    def solved(queries: DataFrame, chunks: DataFrame) -> DataFrame:
        """Every query against all blocks of the units that it is sent to; ``chunks``: of a unit's queries."""
        sizes = F.broadcast(stats.select("unit", "blocks").join(F.broadcast(chunks), "unit"))
        data = held.join(sizes, "unit").select(*[F.col(c).alias(c) for c in ("row", "id", "vec", "unit")], deal("block", F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        sent = queries.join(sizes, "unit").select("row", "id", "vec", "least", "unit", deal("chunk", F.col("chunks")).alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        key = ["unit", "block", "chunk"]
        return sent.groupBy(key).cogroup(data.groupBy(key)).applyInArrow(_solve(k, kind), result)

    queries = held.where("asked").select("row", "id", "vec", "unit")
    lowest = F.lit(_LEAST).cast("long")
    own = cut(solved(queries.withColumn("least", lowest), stats.select("unit", "chunks")), "own")
    place = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    bound = own.withColumn("rank", F.row_number().over(place)).where(F.col("rank") == k).select("row", F.col("score").alias("least"))
    bounded = queries.join(bound, "row", "left").withColumn("least", F.coalesce("least", lowest))
    reached = bounded.mapInArrow(_elsewhere(sent, spark.sparkContext.broadcast((radius, unit)), kind), "row long, id long, vec binary, least long, units array<int>")
    reached = cut(reached, "elsewhere")
    sent_to = cut(reached.select(F.explode("units").alias("unit")).groupBy("unit").agg(F.count("*").alias("q")).select("unit", pieces("q", chunk).alias("chunks")), "sent_to")
    found = own.union(solved(reached.select("row", "id", "vec", "least", F.explode("units").alias("unit")), sent_to))
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
