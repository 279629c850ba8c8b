"""Evidence about a table's content, and its comparison with that of another.

One pass gives the row count, an order-free digest, null counts and relationship
counts; all of it is partial sums, so the pass scales with the scan. The ordered
digest has an exact form for small tables and a chunked one, equal for any
partitioning, for large ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.canonical import order_key, row_hash
from evenkeel.operators.storage import shared_folder as shared_folder
from evenkeel.operators.storage import stored
from evenkeel.operators.validate import fk_orphans
from evenkeel.plans.table_plan import TablePlan, order_columns

#: Rows of a table for which the ordered digest is made in one group.
EXACT_ROWS = 100_000

_LIMBS = 8


def limb_sums(h: Column) -> list[Column]:
    """Sums of the eight 32-bit parts of hex hashes, the lowest last; exact for up to 2**47 rows, beyond which they raise.

    Halves of a part are added as 64-bit numbers, which costs less than decimals for each row.
    """

    def whole(i: int) -> Column:
        part = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")
        total = lambda half: F.coalesce(F.sum(half), F.lit(0)).cast("decimal(20,0)")
        return total(F.shiftright(part, 16)) * F.lit(1 << 16).cast("decimal(6,0)") + total(part.bitwiseAND(0xFFFF))

    return [whole(i).cast("decimal(38,0)").alias(f"limb_{i}") for i in range(_LIMBS)]


def multiset_digest(limbs: list[Column]) -> Column:
    """SHA-256 of the 32 bytes of a sum modulo 2**256, from the sums of its parts, which may be negative."""
    carry, words, base = F.lit(0).cast("decimal(38,0)"), [], F.lit(1 << 32).cast("decimal(20,0)")
    for limb in reversed(limbs):
        total = (limb + carry).cast("decimal(38,0)")
        word = F.pmod(total, base)
        carry = ((total - word) / base).cast("decimal(38,0)")  # a whole number: nothing is rounded
        words.append(word.cast("bigint"))
    return F.sha2(F.unhex(F.concat(*[F.lpad(F.hex(w), 8, "0") for w in reversed(words)])), 256)


def table_evidence(df: DataFrame, plan: TablePlan, digest: str = "none", parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row: table, row_count, aggregate_sha256, null_counts, relationship_counts, content_sha256, orphan_counts.

    ``digest``: ``exact`` or ``chunked`` adds the ordered digest; ``none`` leaves it null.
    ``parents``: tables by name; foreign keys into them get their number of rows without a parent.
    """
    hashed = df.select(*[f"`{c}`" for c in plan.names], row_hash(plan.columns).alias("__row"))
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"__null_{i}") for i, c in enumerate(plan.names)]
    related = [F.count_if(filled(fk.columns)).alias(f"__fk_{i}") for i, fk in enumerate(plan.foreign_keys)]
    one = hashed.agg(F.count("*").alias("row_count"), *limb_sums(F.col("__row")), *nulls, *related)
    counts = lambda names, prefix: (
        F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"{prefix}{i}") for i in range(len(names))]))
        if names
        else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    )
    one = one.select(
        F.lit(plan.name).alias("table"),
        "row_count",
        multiset_digest([F.col(f"limb_{i}") for i in range(_LIMBS)]).alias("aggregate_sha256"),
        counts(plan.names, "__null_").alias("null_counts"),
        counts([fk.name for fk in plan.foreign_keys], "__fk_").alias("relationship_counts"),
    )
    one = one.withColumn("content_sha256", F.lit(None).cast("string")) if digest == "none" else one.crossJoin(F.broadcast(ordered_digest(df, plan, digest)))  # one row and one row
    one = one.withColumn("orphan_counts", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>")))
    for fk in plan.foreign_keys:
        if fk.parent in (parents or {}):
            n = fk_orphans(df, parents[fk.parent], fk).agg(F.count("*").alias("__n"))
            one = one.crossJoin(F.broadcast(n))  # one row and one row
            one = one.withColumn("orphan_counts", F.map_concat("orphan_counts", F.create_map(F.lit(fk.name), F.col("__n")))).drop("__n")
    return one


def filled(columns: tuple[str, ...]) -> Column:
    """True where all of ``columns`` have a value."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"`{c}`").isNotNull()
    return out


def ordered_digest(df: DataFrame, plan: TablePlan, mode: str = "exact", chunk_rows: int = 10_000) -> DataFrame:
    """One row, ``content_sha256``: the row hashes in key order (text by UTF-16 code units), joined by line feeds, hashed.

    ``exact`` gathers a small table's hashes in one group and refuses larger
    ones. ``chunked`` ranks rows over range partitions, digests runs of
    ``chunk_rows`` rows, and digests their digests, of which there may be any
    number: one task hashes them as a stream. It does not depend on how the
    table is partitioned, but it is another number than the exact one.
    """
    keys = order_columns(plan)
    rows = df.select(*[order_key(F.col(f"`{k}`"), plan.column(k).type).alias(f"k{i}") for i, k in enumerate(keys)], row_hash(plan.columns).alias("h"))
    names = [f"k{i}" for i in range(len(keys))]
    join = lambda c: F.sha2(F.coalesce(F.concat_ws("\n", c), F.lit("")), 256)
    if mode == "exact":
        if rows.limit(EXACT_ROWS + 1).count() > EXACT_ROWS:
            raise ValueError(f"over {EXACT_ROWS} rows: use the chunked digest")
        ordered = F.transform(F.array_sort(F.collect_list(F.struct(*names, "h"))), lambda x: x["h"])
        return rows.agg(join(ordered).alias("content_sha256"))
    ranked = ranked_by(rows, [*names, "h"])
    chunk = F.floor(F.col("rank") / chunk_rows)
    digest = ranked.groupBy(chunk.alias("chunk")).agg(join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "h"))), lambda x: x["h"])).alias("d"))
    run = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "d"))), lambda x: x["d"])
    runs = digest.groupBy(F.floor(F.col("chunk") / _RUN_DIGESTS).alias("run")).agg(F.array_join(run, "\n").alias("lines"))
    found = runs.repartition(1).sortWithinPartitions("run").select("lines").mapInArrow(_joined_sha256("\n"), "sha256 string")
    return found.agg(F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("content_sha256"))


#: Digests of chunks that are joined to one text before one task hashes these texts as a stream.
_RUN_DIGESTS = 64


def _joined_sha256(separator: str):
    """SHA-256 of texts in the order in which they come, joined; no row for no text."""
    mark = separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            for lines in batch.column("lines"):
                if digest is None:
                    digest = hashlib.sha256()
                else:
                    digest.update(mark)
                digest.update(lines.as_py().encode())
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([digest.hexdigest()])], names=["sha256"])

    return run


def ranked_by(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``rank`` from 0 in the order of ``columns``; sorted by ranges, so no task holds the table."""
    parts = stored(rows.repartitionByRange(*columns).withColumn("__part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__part").orderBy(*columns)
    ranked = parts.withColumn("__in", F.row_number().over(within) - 1).join(F.broadcast(starts), "__part")  # a row for each partition
    return ranked.withColumn("rank", F.col("__start") + F.col("__in")).drop("__part", "__start", "__in")


def database_evidence(tables: Mapping[str, tuple[DataFrame, TablePlan]], digest: str = "none", orphans: bool = True) -> DataFrame:
    """The evidence rows of all tables, with the orphans of the foreign keys between them unless they are not asked for."""
    out, parents = None, {name: df for name, (df, _) in tables.items()} if orphans else {}
    for name in sorted(tables):
        one = table_evidence(*tables[name], digest, parents)
        out = one if out is None else out.unionByName(one)
    return out


#: Hex digits that name a leaf and an inner node of a digest tree: 65,536 leaves, 256 nodes.
LEAF, INNER = 4, 2


def leaf_digests(rows: DataFrame, ranges: str, content: str) -> DataFrame:
    """``prefix, rows, sha256`` of each leaf that has rows."""
    sums = rows.groupBy(F.substring(ranges, 1, LEAF).alias("prefix")).agg(F.count("*").alias("rows"), *limb_sums(F.col(content)))
    return sums.select("prefix", "rows", multiset_digest([F.col(f"limb_{i}") for i in range(_LIMBS)]).alias("sha256"))


def above(nodes: DataFrame, prefix: Column) -> DataFrame:
    """The digests of nodes of a tree, joined by a shorter prefix: at most 256 below each."""
    line = F.concat_ws("|", "prefix", F.col("rows").cast("string"), "sha256")
    return nodes.groupBy(prefix.alias("prefix")).agg(F.sum("rows").alias("rows"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("sha256"))


def root_digest(leaves: DataFrame) -> DataFrame:
    """One row, ``rows, sha256``; the empty text's hash for no rows."""
    inner = above(leaves, F.substring("prefix", 1, INNER))
    line = F.concat_ws("|", "prefix", F.col("rows").cast("string"), "sha256")
    return inner.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("sha256"))


def relation_digest(df: DataFrame, exclude: tuple[str, ...] = (), mode: str = "multiset", hexed: tuple[str, ...] = ()) -> DataFrame:
    """``rows, sha256`` of a table without the columns ``exclude``: rows as JSON, hashed.

    ``multiset`` sums the hashes; ``tree`` is the root of their digest tree, whose
    nodes say where two tables differ; both are partial sums. ``sorted`` hashes
    the sorted hashes as a stream, in bounded memory but in one task. Columns in
    ``hexed`` are taken as their bytes in hex, so that a change of type alone
    leaves the digest as it is.
    """
    names = [c for c in df.columns if c not in exclude]
    columns = [F.hex(F.encode(f"`{c}`", "UTF-8")).alias(c) if c in hexed else F.col(f"`{c}`") for c in names]
    h = df.select(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias("h"))
    if mode == "tree":
        return root_digest(leaf_digests(h, "h", "h"))
    if mode == "sorted":
        counted = h.groupBy().agg(F.count("*").alias("rows"))
        digest = sorted_sha256(h.withColumn("g", F.lit(0)), ["g"], "h", "").select("sha256")
        return counted.join(F.broadcast(digest), how="left").select("rows", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("sha256"))  # one row and one row at most
    sums = h.agg(F.count("*").alias("rows"), *limb_sums(F.col("h")))
    return sums.select("rows", multiset_digest([F.col(f"limb_{i}") for i in range(_LIMBS)]).alias("sha256"))


#: Lines of a chunk of a sorted stream, at most.
_CHUNK_LINES = 4096


def _chunks(group: list[str]):
    """Sorted lines and their numbers, packed: a row for each run of lines of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK_LINES):
                rows = batch.slice(at, _CHUNK_LINES)
                keys = rows.select(group).to_pylist()
                edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    one = rows.slice(a, 1).select(group)
                    lines, n = rows.column("line").slice(a, b - a), rows.column("n").slice(a, b - a)
                    columns = [lines.slice(0, 1), pa.array([lines.to_pylist()], pa.list_(pa.string())), pa.array([n.to_pylist()], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*one.columns, *columns], names=[*group, "line", "lines", "n"])

    return run


def _streamed(group: list[str], separator: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        mark = separator.encode()

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*now.columns, pa.array([digest.hexdigest()])], names=[*group, "sha256"])

        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1).select(group)
                if now is None or not one.equals(now):
                    if now is not None:
                        yield closed()
                    now, digest, first = one, hashlib.sha256(), True
                for line, n in zip(batch.column("lines")[i].as_py(), batch.column("n")[i].as_py(), strict=True):
                    raw = line.encode()
                    if first:
                        digest.update(raw)
                        n, first = n - 1, False
                    while n:  # equal lines, a part at a time
                        part = min(n, _CHUNK_LINES)
                        digest.update((mark + raw) * part)
                        n -= part
        if now is not None:
            yield closed()

    return run


def sorted_sha256(rows: DataFrame, group: list[str], line: str | Column, separator: str) -> DataFrame:
    """For each group, ``sha256`` of its lines, sorted and joined by ``separator``.

    Equal lines are counted, the rest is sorted by ranges and packed into chunks
    in parallel; one task for each group reads chunks in order and holds one
    batch. SHA-256 of a joined text cannot be had from parts, so that last step
    is a stream.
    """
    spark_type = lambda c: f"`{c}` {rows.schema[c].dataType.simpleString()}"
    kinds = ", ".join(spark_type(c) for c in group)
    line = F.col(line) if isinstance(line, str) else line
    counted = rows.select(*group, line.alias("line")).groupBy(*group, "line").agg(F.count("*").alias("n"))
    ranges = counted.repartitionByRange(*group, "line").sortWithinPartitions(*group, "line")
    chunks = ranges.mapInArrow(_chunks(group), f"{kinds}, line string, lines array<string>, n array<bigint>")
    return chunks.repartition(*group).sortWithinPartitions(*group, "line").mapInArrow(_streamed(group, separator), f"{kinds}, sha256 string")


def max_lengths(df: DataFrame, columns: list[str]) -> DataFrame:
    """The longest value of each column in bytes, 0 if there is none."""
    return df.agg(*[F.coalesce(F.max(F.octet_length(f"`{c}`")), F.lit(0)).cast("bigint").alias(c) for c in columns])


def size_probe(df: DataFrame) -> DataFrame:
    """``rows, json_bytes`` of a table."""
    size = F.octet_length(F.to_json(F.struct(*[f"`{c}`" for c in df.columns]), {"ignoreNullFields": "false"}))
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("json_bytes"))


def joined_hash(df: DataFrame, group: list[str], parts: list[str], separator: str = "\n") -> DataFrame:
    """For each group of a small table, SHA-256 of its rows' parts (joined by ``|``), sorted and joined."""
    line = F.concat_ws("|", *[F.col(p).cast("string") for p in parts])
    return df.groupBy(*group).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), separator), 256).alias("sha256"))


_RANKS = {"row-count": 1, "ordered-content": 2, "aggregate": 3, "null-count": 4, "orphan": 5, "relationship": 6}


def compare_evidence(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Violations between two evidence tables; a map entry that is absent is not an entry of 0."""
    one = expected.alias("e").join(observed.alias("o"), F.col("e.table") == F.col("o.table"), "full_outer")
    name = F.coalesce("e.table", "o.table")
    missing = F.col("e.table").isNull() | F.col("o.table").isNull()
    plain = [("row-count", "row_count"), ("ordered-content", "content_sha256"), ("aggregate", "aggregate_sha256")]
    checks = [
        F.struct(F.lit(check).alias("check"), F.col(f"e.{c}").cast("string").alias("expected"), F.col(f"o.{c}").cast("string").alias("observed"), F.lit(None).cast("string").alias("field"))
        for check, c in plain
    ]
    maps = [("null-count", "null_counts"), ("relationship", "relationship_counts")]
    if "orphan_counts" in expected.columns and "orphan_counts" in observed.columns:
        maps.append(("orphan", "orphan_counts"))
    entries = [
        F.transform(
            F.array_union(F.map_keys(F.coalesce(f"e.{c}", F.create_map().cast("map<string,bigint>"))), F.map_keys(F.coalesce(f"o.{c}", F.create_map().cast("map<string,bigint>")))),
            _entry(check, c),
        )
        for check, c in maps
    ]
    found = one.select(name.alias("table"), missing.alias("missing"), F.explode(F.concat(F.array(*checks), *entries)).alias("x"))
    found = found.where((~F.col("x.expected").eqNullSafe(F.col("x.observed")) | (F.col("missing") & (F.col("x.check") == "row-count"))))
    return found.select("table", "x.check", F.concat(F.col("x.check"), F.lit("-mismatch")).alias("code"), "x.expected", "x.observed", "x.field")


def _entry(check: str, column: str):
    def entry(k: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"), F.element_at(f"e.{column}", k).cast("string").alias("expected"),
            F.element_at(f"o.{column}", k).cast("string").alias("observed"), k.alias("field"),
        )

    return entry


def first_mismatch(violations: DataFrame) -> DataFrame:
    """Of each table's violations the first, in the fixed order of the checks."""
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in _RANKS.items() for x in kv]), F.col("check"))
    best = F.min_by(F.struct("check", "code", "expected", "observed", "field"), F.struct(rank, F.coalesce("field", F.lit(""))))
    return violations.groupBy("table").agg(best.alias("x")).select("table", "x.*")


def compare_values(expected: DataFrame, observed: DataFrame, key: str, value: str, check: str) -> DataFrame:
    """Violations between two (key, value) tables: sequences, schema hashes, counts."""
    e = expected.select(F.col(key).alias("table"), F.col(value).cast("string").alias("expected"))
    o = observed.select(F.col(key).alias("table"), F.col(value).cast("string").alias("observed"))
    both = e.join(o, "table", "full_outer").where(~F.col("expected").eqNullSafe(F.col("observed")))
    return both.select("table", F.lit(check).alias("check"), F.lit(f"{check}-mismatch").alias("code"), "expected", "observed", F.lit(None).cast("string").alias("field"))
