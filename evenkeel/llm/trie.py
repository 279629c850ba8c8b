"""The prefix trie of conversations: what they share from their first turn on, and what sharing it saves.

A conversation becomes a path of digests, one for each turn. Nodes that more
than ``SPINE`` conversations pass are the spine: they are counted first, and
each path is cut where it leaves them. What is below one spine node's child is
a light subtree of at most ``SPINE`` paths; light subtrees are dealt to shards
by their tops. A shard writes its sorted paths as balanced parentheses (see
``parens``): findclose delimits subtrees, ranks of ``()`` count leaves, and
running sums give savings. The shards' parts of the shared spine are then
merged by node, and its own parentheses add up the light subtrees below it. Of
the spine there are at most ``NODES`` nodes: ``SPINE`` is doubled until that
holds, so the part that is broadcast, and done in one task, is bounded.

The members that end at a spine node can be any number: their ids are dealt by
ranges, written as text in pieces, and hashed piece by piece.

Defined results: null role or text is empty; rows without conversation id are
in no conversation; turns of equal number are ordered by role, then by the MD5
of role and text; repeated turns are turns; an empty table has no nodes, not even
a root. Texts of any length are digested where they are read and do not move; a
conversation moves as one value of 24 bytes a turn. Other columns are ignored.
Exact up to collisions of 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import cut, flat, mix, prefix_powers
from evenkeel.llm.mixing import word_count
from evenkeel.llm.parens import Forest, subtree_min

#: Members of a light subtree at most, spine nodes at most, and turns that a shard takes at once (more if a subtree has more).
SPINE, NODES, STEPS = 256, 1 << 20, 1 << 18
_ROOT = bytes(16)
_NO_ENDS = hashlib.sha256().hexdigest()
_HIGH = np.iinfo(np.int64).max


# ---------------------------------------------------------------- paths


def turn_paths(turns: DataFrame, leader: Column | None = None, head: Column | None = None) -> DataFrame:
    """(conv_id, path, words): each conversation's turn digests (16 bytes) and word counts (8 bytes) in order.

    With ``leader`` and ``head``, expressions of ``conv_id``, a conversation's
    first ``head`` turns are those of its leader (as many as that has, none if
    there is no such conversation), and its own turns follow from there on.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = F.col("conv_id")
    rows = turns.where(own.isNotNull()).select(
        own.cast("long").alias("conv_id"),
        (own if leader is None else leader).cast("long").alias("leader"),
        (F.lit(0) if head is None else head).cast("int").alias("head"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("print"),
        word_count(text).alias("words"),
    )
    order = [F.col("leader"), F.col("conv_id") != F.col("leader"), F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("print")]
    ordered = rows.repartition("leader").sortWithinPartitions(*order).select("conv_id", "leader", "head", "print", "words")
    return ordered.mapInArrow(_packed, "conv_id long, path binary, words binary")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    led_by, led = None, (b"", b"")
    conv = leads = head = None
    prints: list[bytes] = []
    words: list[bytes] = []
    done: list[tuple[int, bytes, bytes]] = []

    def close() -> None:
        nonlocal led_by, led
        if conv is None:
            return
        path, counts = b"".join(prints), b"".join(words)
        if leads != led_by:
            led_by, led = leads, (b"", b"")
        if conv == leads:
            led = (path, counts)
        done.append((conv, led[0][: 16 * head] + path[16 * head :], led[1][: 8 * head] + counts[8 * head :]))

    def table() -> pa.RecordBatch:
        columns = [pa.array(list(c), t) for c, t in zip(zip(*done, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "path", "words"])

    for batch in batches:
        if not batch.num_rows:
            continue
        convs, leaders, heads = (batch.column(i).to_numpy() for i in range(3))
        buf, _ = flat(batch.column(3))
        counts = np.ascontiguousarray(batch.column(4).to_numpy(), np.int64)
        begins = np.append(np.flatnonzero(np.append(True, convs[1:] != convs[:-1])), len(convs)).tolist()
        for a, b in zip(begins, begins[1:]):
            if conv != convs[a]:
                close()
                conv, leads, head = int(convs[a]), int(leaders[a]), int(heads[a])
                prints, words = [], []
            prints.append(buf[16 * a : 16 * b].tobytes())
            words.append(counts[a:b].tobytes())
        if done:
            yield table()
    close()
    if done:
        yield table()


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of all steps of a batch's paths, each path's first step, and the ids of the nodes that the steps lead to."""
    buf, offs = flat(batch.column(batch.schema.get_field_index("path")))
    digests, first = np.frombuffer(buf.tobytes(), np.uint64).reshape(-1, 2), offs // 16
    lengths = np.diff(first)
    place = np.arange(len(digests)) - np.repeat(first[:-1], lengths)
    with np.errstate(over="ignore"):
        running = np.zeros((len(digests) + 1, 2), np.uint64)
        np.cumsum(digests * prefix_powers(int(lengths.max(initial=0)))[place][:, None], axis=0, out=running[1:])
        ids = mix(running[1:] - np.repeat(running[first[:-1]], lengths, axis=0) + (place[:, None] + np.array([1, 3])).astype(np.uint64))
    return digests, first, ids


def _binary(ids: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(ids), [None, pa.py_buffer(np.ascontiguousarray(ids).tobytes())]).cast(pa.binary())


# ---------------------------------------------------------------- spine


def _grouped(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal ids stand together, and where each begins."""
    order = np.argsort(ids[:, 0], kind="stable")
    return order, np.flatnonzero(np.append(True, (ids[order[1:]] != ids[order[:-1]]).any(1))[: len(order)])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, _, ids = _ids(batch)
        order, starts = _grouped(ids)
        yield pa.RecordBatch.from_arrays([_binary(ids[order[starts]]), pa.array(np.diff(starts, append=len(order)))], ["node", "n"])


class _Spine:
    """Which nodes are on the spine, and how far each path of a batch goes along it."""

    def __init__(self, nodes: bytes):
        both = np.frombuffer(nodes, np.uint64).reshape(-1, 2)
        self.nodes = both[np.argsort(both[:, 0])]

    def depths(self, first: np.ndarray, ids: np.ndarray) -> np.ndarray:
        if not len(self.nodes):
            return np.zeros(len(first) - 1, np.int64)
        at = np.minimum(np.searchsorted(self.nodes[:, 0], ids[:, 0]), len(self.nodes) - 1)
        running = np.concatenate([[0], np.cumsum((self.nodes[at] == ids).all(1))])
        return running[first[1:]] - running[first[:-1]]


def _picked(values: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    """``values[at]`` where ``there``, else 0."""
    out = np.zeros((len(at), *values.shape[1:]), values.dtype)
    out[there] = values[at[there]]
    return out


def _node_at(ids: np.ndarray, first: np.ndarray, depth: np.ndarray) -> np.ndarray:
    return _picked(ids, first[:-1] + depth - 1, depth > 0)


def _spine_parts(spine: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's members of the spine's nodes."""
    on = _Spine(spine.value)
    for batch in batches:
        if not batch.num_rows:
            continue
        _, first, ids = _ids(batch)
        convs = batch.column(0).to_numpy()
        words = np.frombuffer(flat(batch.column(2))[0].tobytes(), np.int64)
        depths = on.depths(first, ids)
        rows = np.repeat(np.arange(len(depths)), depths + 1)
        depth = np.arange(len(rows)) - np.repeat(np.cumsum(depths + 1) - depths - 1, depths + 1)
        steps = first[rows] + depth - 1
        node, parent = (_picked(ids, first[rows] + d - 1, d > 0) for d in (depth, depth - 1))
        order, starts = _grouped(node)
        one, least = order[starts], np.minimum.reduceat(convs[rows][order], starts)
        own = _picked(words, steps[one], depth[one] > 0)
        yield pa.RecordBatch.from_arrays(
            [_binary(node[one]), _binary(parent[one]), pa.array(depth[one]), pa.array(own), pa.array(np.diff(starts, append=len(order))), pa.array(least)],
            ["node", "parent", "depth", "words", "n", "least"],
        )


def _light_paths(spine: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each path has beyond the spine, under its top; its spine node stands with it."""
    on = _Spine(spine.value)
    for batch in batches:
        if not batch.num_rows:
            continue
        _, first, ids = _ids(batch)
        depths = on.depths(first, ids)
        light = np.flatnonzero(np.diff(first) > depths)
        paths, words = batch.column(1).take(pa.array(light)).to_pylist(), batch.column(2).take(pa.array(light)).to_pylist()
        cuts = depths[light].tolist()
        yield pa.RecordBatch.from_arrays(
            [
                _binary(_node_at(ids, first, depths + (np.diff(first) > depths))[light]),
                _binary(_node_at(ids, first, depths)[light]),
                batch.column(0).take(pa.array(light)),
                pa.array(depths[light]),
                pa.array([p[16 * d :] for p, d in zip(paths, cuts, strict=True)], pa.binary()),
                pa.array([w[8 * d :] for w, d in zip(words, cuts, strict=True)], pa.binary()),
            ],
            ["top", "spine", "conv_id", "above", "path", "words"],
        )


def _spine_ends(spine: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    on = _Spine(spine.value)
    for batch in batches:
        if not batch.num_rows:
            continue
        _, first, ids = _ids(batch)
        depths = on.depths(first, ids)
        ends = np.flatnonzero(np.diff(first) == depths)
        yield pa.RecordBatch.from_arrays([_binary(_node_at(ids, first, depths)[ends]), batch.column(0).take(pa.array(ends))], ["node", "conv_id"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) as comma-joined text, a piece for each node of a batch."""
    for batch in batches:
        nodes, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begins = [i for i in range(len(nodes)) if not i or nodes[i] != nodes[i - 1]] + [len(nodes)]
        spans = [(a, b) for a, b in zip(begins, begins[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([nodes[a] for a, _ in spans], pa.binary()), pa.array([convs[a] for a, _ in spans], pa.int64()), pa.array([",".join(map(str, convs[a:b])) for a, b in spans], pa.string())],
            ["node", "at", "piece"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest, done = None, None, []
    for batch in batches:
        for own, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if own != node:
                if digest:
                    done.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(piece.encode())
            else:
                digest.update(f",{piece}".encode())
    if digest:
        done.append((node, digest.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.binary(), pa.string()))], ["node", "ends_sha256"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole spine (at most ``NODES`` rows): light sums and own values, added up along its parentheses."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    nodes, parents = table["node"].to_pylist(), table["parent"].to_pylist()
    below: dict[bytes, list[int]] = {}
    for i, (node, parent) in enumerate(zip(nodes, parents, strict=True)):
        if node != _ROOT:
            below.setdefault(parent, []).append(i)
    order, stack = [], [nodes.index(_ROOT)]
    while stack:
        order.append(i := stack.pop())
        stack.extend(below.get(nodes[i], ()))
    column = {c: table[c].to_numpy()[order] for c in ("depth", "words", "n", "least", "children", "leaves", "saved")}
    spine = Forest.of_depths(column["depth"] + 1)
    children = column["children"] + np.bincount(spine.parent[1:], minlength=len(order))
    parent = np.where(spine.parent < 0, 0, column["least"][spine.parent])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([nodes[i] for i in order], pa.binary()),
            pa.array(column["least"]),
            pa.array(column["depth"]),
            pa.array(parent, mask=spine.parent < 0),
            pa.array(column["n"]),
            pa.array(children),
            pa.array(spine.sums(column["leaves"] + (children == 0))),
            pa.array(spine.sums(column["saved"] + (column["n"] - 1) * column["words"])),
            table["ends_sha256"].take(pa.array(order)).combine_chunks(),
        ],
        ["node", *_RESULT],
    )


# ---------------------------------------------------------------- light subtrees


def _subtries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole subtrees, some ``STEPS`` turns at once: paths come sorted by top, path and id."""
    held: list[pa.RecordBatch] = []
    size, most = 0, STEPS
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += len(flat(batch.column(4))[0]) // 16
        if size >= most:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            tops = _lanes(table.column(0))
            last = int(np.flatnonzero((tops != tops[-1]).any(1)).max(initial=-1)) + 1
            if last:
                yield _solved(table.slice(0, last))
            held = [table.slice(last)]
            size = len(flat(held[0].column(4))[0]) // 16
            most = max(STEPS, 2 * size)
    if held:
        yield _solved(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _lanes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(flat(column)[0].tobytes(), np.uint64).reshape(-1, 2)


def _solved(batch: pa.RecordBatch) -> pa.RecordBatch:
    tops, convs, above = _lanes(batch.column(0)), batch.column(2).to_numpy(), batch.column(3).to_numpy()
    buf, offs = flat(batch.column(4))
    words = np.frombuffer(flat(batch.column(5))[0].tobytes(), np.int64)
    group = np.concatenate([[0], np.cumsum((tops[1:] != tops[:-1]).any(1))])
    trie = Forest(np.frombuffer(buf.tobytes(), np.uint64).reshape(-1, 2), offs // 16, group)
    n = len(trie.depth)
    ends = np.bincount(trie.end, minlength=n)
    last = np.cumsum(ends)  # paths with their end at a node stand together, by id
    least = np.full(n, _HIGH)
    at = np.flatnonzero(ends)
    least[at] = convs[(last - ends)[at]]
    least = subtree_min(least, trie.size)
    members = trie.sums(ends)
    digests = [_NO_ENDS] * n
    names = [str(c) for c in convs.tolist()]
    for i, a, b in zip(at.tolist(), (last - ends)[at].tolist(), last[at].tolist(), strict=True):
        digests[i] = hashlib.sha256(",".join(names[a:b]).encode()).hexdigest()
    top = trie.parent < 0
    path = last - ends  # the first through each node
    spine = batch.column(1).take(pa.array(np.where(top, path, 0)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([s if t else None for s, t in zip(spine.to_pylist(), top.tolist(), strict=True)], pa.binary()),
            pa.array(least),
            pa.array(above[path] + trie.depth),
            pa.array(np.where(top, 0, least[trie.parent]), mask=top),
            pa.array(members),
            pa.array(np.bincount(trie.parent[~top], minlength=n)),
            pa.array(trie.leaves),
            pa.array(trie.sums((members - 1) * words[trie.step])),
            pa.array(digests, pa.string()),
        ],
        ["spine", *_RESULT],
    )


_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_TYPES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def prefix_trie(paths: DataFrame, members: int = SPINE, most_nodes: int = NODES) -> DataFrame:
    """A row for each node of the trie of ``paths`` (see ``turn_paths``).

    conv_id is the node's smallest member, parent_conv_id its parent's; n_convs
    its members, n_children its children, n_leaves the childless nodes of its
    subtree, saved_tokens the words that its subtree's members need not repeat,
    ends_sha256 the SHA-256 of the ids of the members that end there.
    """
    spark = paths.sparkSession
    paths = cut(paths, "paths")
    counts = paths.mapInArrow(_members, "node binary, n long").groupBy("node").agg(F.sum("n").alias("n"))
    counts = cut(counts.where(F.col("n") > members), "spine")
    while counts.where(F.col("n") > members).count() > most_nodes:
        members *= 2
    spine = spark.sparkContext.broadcast(b"".join(bytes(r.node) for r in counts.where(F.col("n") > members).select("node").collect()))

    light = paths.mapInArrow(partial(_light_paths, spine), "top binary, spine binary, conv_id long, above long, path binary, words binary")
    light = light.repartition("top").sortWithinPartitions("top", "path", "conv_id")
    light = cut(light.mapInArrow(_subtries, f"spine binary, {_TYPES}"), "light-nodes")

    parts = paths.mapInArrow(partial(_spine_parts, spine), "node binary, parent binary, depth long, words long, n long, least long")
    parts = parts.groupBy("node", "parent", "depth", "words").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    tops = light.where(F.col("spine").isNotNull()).groupBy(F.col("spine").alias("node")).agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    ends = paths.mapInArrow(partial(_spine_ends, spine), "node binary, conv_id long")
    pieces = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(_pieces, "node binary, at long, piece string")
    hashed = pieces.repartition("node").sortWithinPartitions("node", "at").mapInArrow(_hashed, "node binary, ends_sha256 string")
    merged = parts.join(tops, "node", "left").join(hashed, "node", "left")
    merged = merged.fillna(0, ["children", "leaves", "saved"]).fillna(_NO_ENDS, ["ends_sha256"])
    merged = cut(merged.coalesce(1).mapInArrow(_merged, f"node binary, {_TYPES}"), "spine-nodes")

    above = merged.select(F.col("node").alias("spine"), F.col("conv_id").alias("spine_conv"))
    below = light.join(F.broadcast(above), "spine", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "spine_conv"))
    return below.select(*_RESULT).unionAll(merged.select(*_RESULT))
