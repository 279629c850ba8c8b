"""Near-duplicate detection: fast similarity sketches, banding, exact verification.

A document's set holds its distinct shingles of consecutive words. The sketch
has ``SLOTS`` coordinates; in round i every shingle is hashed into one bin with
value i plus a fraction, and a coordinate keeps its smallest value. After
``SLOTS`` such rounds, ``SLOTS`` further rounds put every shingle into one given
coordinate each, so every coordinate fills; most sets fill in a few rounds.
Coordinates are cut into bands; documents that agree on a band are candidates.

Candidates are confirmed on the full sets. Buckets are never expanded into all
pairs. Every member of a bucket is compared with the bucket's middle, the member
that shares most buckets with others; most groups are one component after that.
Two members a and b that are still in different components can be linked with
each other. Let m be what most members of the bucket have (it need not be any
document's set), D(x) what a set and m do not share, and

    S(x) = |D(x)| - n(x) * (100 - percent) / (100 + percent).

Then a and b are linked if S(a) + S(b) <= 0, and else only if their D share
(S(a) + S(b)) / 2 shingles. The first is settled by the member of least S: all
that are linked with any other by this rule are linked with it. For the second,
the shingles of each D are put in one order, from the most common in the bucket
to the rarest; the rarest one that a linked pair shares stands at place
(S(a) + S(b)) / 2 or later in both. Pairs are formed on such places alone and then
tested on the whole D, which is exact; random edits of one text seldom share
rare shingles. Where a shingle is not rare (a footer that a third of a bucket
has), each of its members first meets the one of least S alone; what is linked
becomes one team, and then no two members of a team meet. Of the rows that share
a shingle, those of the largest team meet only the others. No link between
components of a bucket is lost by that. Documents with equal sets are one node
throughout.

Defined results: a document without words (or null text) has an empty set, is
linked with nothing and is its own component; a row whose id is null is linked
with nothing and has a null component; repeated rows with equal text are links
like any other; an empty table gives an empty result; extra columns are not read
(``one_of_each`` keeps them, whatever their names); a very long text is a set
like others, held by one task while it is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import cut, discard, mix, rows_of, signed, text_slices, unused, words
from evenkeel.llm.components import components

BANDS, ROWS = 40, 5
#: Rows that share a shingle of which each meets the nearest first, and how often.
CROWD, HUB_ROUNDS = 32, 3
SLOTS = BANDS * ROWS

_U = np.uint64
_NEXT = _U(0xC2B2AE3D27D4EB4F)


def shingles(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row in a slice, sorted within the row, and each row's first."""
    h, first = words(buf, offs)
    n = np.diff(first)
    with np.errstate(over="ignore"):
        if len(h):
            roll, width = h.copy(), np.ones(len(h), np.int64)
            left = first[1:][rows_of(first)] - np.arange(len(h))  # words from here to the row's end
            for k in range(1, size):
                room = np.flatnonzero(left > k)
                roll[room] = mix(roll[room] * _NEXT + h[room + k])
                width[room] += 1
            # a row of fewer words is one shingle: its whole sequence
            keep = (width == size) | ((n[rows_of(first)] < size) & (np.arange(len(h)) == first[:-1][rows_of(first)]))
            roll = mix(roll ^ width.astype(np.uint64))[keep]
            row = rows_of(first)[keep]
        else:
            roll, row = h, np.zeros(0, np.int64)
    order = np.lexsort((roll, row))
    roll, row = roll[order], row[order]
    new = np.ones(len(roll), bool)
    new[1:] = (roll[1:] != roll[:-1]) | (row[1:] != row[:-1])
    return roll[new], np.searchsorted(row[new], np.arange(len(offs)))


def sketch(sets: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """A (rows, slots) sketch of each row's set; rows with an empty set stay at the largest value."""
    n = len(first) - 1
    out = np.full(n * slots, ~_U(0), np.uint64)
    row, h = rows_of(first), sets
    for i in range(2 * slots):
        if not len(h):
            break
        with np.errstate(over="ignore"):
            v = mix(h + _U(i + 1) * _NEXT)
        bin_ = (v % _U(slots)).astype(np.int64) if i < slots else np.full(len(v), i - slots)
        np.minimum.at(out, row * slots + bin_, (v >> _U(12)) | (_U(i) << _U(52)))
        if i % 4 == 3 or len(h) > 4096:
            open_ = (out.reshape(n, slots) == ~_U(0)).any(axis=1)
            keep = open_[row]
            row, h = row[keep], h[keep]
    return out.reshape(n, slots)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, most=1 << 20):
            sets, first = shingles(buf, offs, size)
            n = np.diff(first)
            s = sketch(sets, first)
            with np.errstate(over="ignore"):
                band = np.zeros((len(n), BANDS), np.uint64)
                for k in range(ROWS):
                    band = mix(band * _NEXT + s[:, k::ROWS])
                band = mix(band + np.arange(BANDS, dtype=np.uint64))
                run_ = [np.concatenate(([_U(0)], np.cumsum(x))) for x in (mix(sets), mix(sets ^ _NEXT))]
                key, check = (mix(x[first[1:]] - x[first[:-1]] + n.astype(np.uint64)) for x in run_)
            flat_bands = pa.array(signed(band.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(n.astype(np.int64)),
                    pa.array(signed(key)),
                    pa.array(signed(check)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, (len(n) + 1) * BANDS, BANDS, dtype=np.int32)), flat_bands),
                ],
                names=["doc_id", "n_shingles", "node", "check", "bands"],
            )

    return run


def _pairs_of_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[np.ndarray, np.ndarray]]]]:
    """Row slices with the sets of ``text_a`` and ``text_b`` of each row."""
    for rows in batches:
        for part, buf, offs in text_slices([rows], "text_a", 1 << 20):
            ones, first = shingles(buf, offs, size)
            others: list[np.ndarray] = []
            for _, buf_b, offs_b in text_slices([part], "text_b", 1 << 20):
                s, f = shingles(buf_b, offs_b, size)
                others += [s[f[i] : f[i + 1]] for i in range(len(f) - 1)]
            yield part, [(ones[first[i] : first[i + 1]], b) for i, b in enumerate(others)]


def _inside(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of ``b`` are in ``a``; both are sorted."""
    if not len(a):
        return np.zeros(len(b), bool)
    return a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b


_DIFFERENCES = "c long, node long, n_c long, n long, both long, linked boolean, apart array<long>"


def _differences(size: int, percent: int):
    """Of each pair: how many shingles both have, whether that is a link, and the shingles that only one of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, pairs in _pairs_of_sets(batches, size):
            inside = [_inside(a, b) for a, b in pairs]
            both = [int(x.sum()) for x in inside]
            linked = [n > 0 and 100 * n >= percent * (len(a) + len(b) - n) for n, (a, b) in zip(both, pairs, strict=True)]
            apart = [signed(np.concatenate((b[~x], a[~_inside(b, a)]))) for x, (a, b) in zip(inside, pairs, strict=True)]
            columns = [part.column(c) for c in ("c", "node", "n_c", "n")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(both, pa.int64()), pa.array(linked, pa.bool_()), pa.array(apart, pa.list_(pa.int64()))],
                names=["c", "node", "n_c", "n", "both", "linked", "apart"],
            )

    return run


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept, node.

    ``size``: words in a shingle; two documents are linked if 100 times their
    common shingles are at least ``percent`` times those of either. Equal
    ``node`` marks equal sets.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(docs.mapInArrow(_sketches(size), f"doc_id {kind}, n_shingles long, node long, check long, bands array<long>"), "sketches")
    nodes = (
        rows.where("doc_id is not null and n_shingles > 0")
        .groupBy("node", "check")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    )
    nodes = cut(nodes, "nodes")
    bands = nodes.select("node", "n", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    crowded = crowded_rows = cut(bands.join(shared, "band"), "crowded")
    # copies of one text meet it in more bands than they meet each other
    degrees = crowded.groupBy("node").agg(F.sum("members").alias("degree"))
    crowded = crowded.join(degrees, "node")
    middles = crowded.groupBy("band").agg(F.max(F.struct("degree", "node", "n")).alias("c"))
    middles = middles.select("band", F.col("c.node").alias("c"), F.col("c.n").alias("n_c"))
    seen = cut(crowded.join(middles, "band").where("node <> c").select("c", "n_c", "node", "n").distinct(), "seen")
    discard(crowded_rows)

    labels = None
    if not seen.isEmpty():
        texts = cut(_texts(docs, nodes, seen.select(F.explode(F.array("c", "node")).alias("node")).distinct(), size), "texts")
        pairs = seen.join(texts.select(F.col("node").alias("c"), F.col("text").alias("text_a")), "c").join(texts.withColumnRenamed("text", "text_b"), "node")
        pairs = pairs.select("c", "node", "n_c", "n", "text_a", "text_b").mapInArrow(_differences(size, percent), _DIFFERENCES)
        pairs = cut(pairs, "differences")
        discard(texts, seen)
        labels = cut(components(pairs.where("linked").select(F.col("c").alias("a"), F.col("node").alias("b"))), "labels")
        more = _links_apart(pairs, labels, percent)
        discard(pairs)
        if not more.isEmpty():
            labels = cut(_merged(labels, more), "labels")
    if labels is None:
        named = nodes.select("node", "check", F.col("doc_id").alias("component_id"))
    else:
        member = cut(nodes.join(labels, "node", "left").select("node", "check", "doc_id", F.coalesce("label", "node").alias("label")), "members")
        least = cut(member.groupBy("label").agg(F.min("doc_id").alias("component_id")), "least")
        named = member.join(least, "label").select("node", "check", "component_id")
    out = rows.select("doc_id", "n_shingles", "node", "check").join(named, ["node", "check"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), "node").withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels of nodes after links ``a, b`` between components; a node without a label is a component of its own."""
    joined = components(more).select(F.col("node").alias("label"), F.col("label").alias("whole"))
    lone = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    return labels.union(lone).join(joined, "label", "left").select("node", F.coalesce("whole", "label").alias("label"))


def _links_apart(pairs: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``a, b``: labels of components that are linked by members of a bucket other than its middle (see the module)."""
    at = pairs.join(labels.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = at.groupBy("c").agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    groups = cut(groups.select("c", "members"), "groups")
    member = at = cut(at.join(groups.select("c"), "c", "left_semi").select("c", "node", "n", "label", "apart"), "apart")
    often = at.select("c", F.explode("apart").alias("shingle")).groupBy("c", "shingle").agg(F.count("*").alias("k")).join(groups, "c")
    often = cut(often.where("k > 1").withColumn("most", F.expr("2 * k > members")), "often")
    # no more than twice the mean size of D can be in most of them
    usual = often.where("most").groupBy("c").agg(F.collect_list("shingle").alias("usual"))
    at = at.join(usual, "c", "left").withColumn("usual", F.coalesce("usual", F.array().cast("array<long>")))
    at = at.withColumn("apart", F.concat(F.array_except("apart", "usual"), F.array_except("usual", "apart"))).drop("usual")
    whole, gap = 100 + percent, 100 - percent
    at = recentred = cut(at.withColumn("s", F.expr(f"{whole} * size(apart) - {gap} * n")), "recentred")  # S times ``whole``
    discard(member)
    least = at.groupBy("c").agg(F.min("s").alias("s_least"), F.min_by("node", F.struct("s", "node")).alias("nearest"), F.min_by("label", F.struct("s", "node")).alias("label_nearest"))
    least = cut(least, "nearest")
    sure = at.join(least, "c").where("s + s_least <= 0").select(F.col("label").alias("label_a"), F.col("label_nearest").alias("label_b"))

    counted = often.select("c", "shingle", F.expr("if(most, members - k, k)").alias("k")).where("k > 1")
    place = Window.partitionBy("c", "node").orderBy(F.desc("k"), "shingle")
    ranked = at.select("c", "node", F.explode("apart").alias("shingle")).join(counted, ["c", "shingle"]).withColumn("place", F.row_number().over(place))
    sized = at.join(least, "c").select("c", "node", "n", "label", "s", "s_least", F.size("apart").alias("d"))
    # of two members the one with larger S is linked with the nearest only if both are: so that S is over -s_least
    ranked = ranked.join(sized, ["c", "node"]).withColumns(
        {"as_far": F.expr(f"s + s_least > 0 and {2 * whole} * place >= s + s_least"), "as_near": F.expr(f"{whole} * place >= s and {2 * whole} * place > s - s_least")}
    )
    ranked = cut(ranked.where("as_far or as_near").withColumn("team", F.col("label")), "rare")

    known = sure
    sets = at.select("c", "node", "s", "label", "apart")
    for _ in range(HUB_ROUNDS):  # where very many members share a shingle, most are linked with one of them
        hubs = cut(_hub_pairs(ranked), "hubs")
        links = cut(_proved(hubs, sets, whole), "hub-links")
        discard(hubs)
        if links.isEmpty():
            break
        known = cut(known.union(links), "known")
        joined = components(known.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("joined"))
        last = ranked
        ranked = cut(last.drop("team").join(joined, "label", "left").withColumn("team", F.coalesce("joined", "label")).drop("joined"), "rare")
        discard(last)
    found = cut(_close(_meetings(ranked), whole, percent).groupBy("node_a", "node_b").agg(F.min("c").alias("c")), "candidates")
    ends = [F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")]
    links = cut(known.union(_proved(found, sets, whole)).where("label_a <> label_b").select(*ends).distinct(), "links")
    discard(groups, often, recentred, least, ranked, found)
    return links


def _side(df: DataFrame, x: str) -> DataFrame:
    return df.select("c", "shingle", *[F.col(name).alias(f"{name}_{x}") for name in ("node", "n", "label", "team", "s", "d", "place")])


def _shared(ranked: DataFrame) -> DataFrame:
    """``c, shingle, rows, most``: shingles that members of different teams share, with the team that most of them are in."""
    teams = ranked.groupBy("c", "shingle", "team").agg(F.count("*").alias("k"))
    return teams.groupBy("c", "shingle").agg(F.count("*").alias("teams"), F.sum("k").alias("rows"), F.max_by("team", F.struct("k", "team")).alias("most")).where("teams > 1").drop("teams")


def _hub_pairs(ranked: DataFrame) -> DataFrame:
    """``c, node_a, node_b``: where over ``CROWD`` rows share a shingle, each row with that of least S."""
    crowded = _shared(ranked).where(F.col("rows") > CROWD).select("c", "shingle")
    rows = ranked.join(crowded, ["c", "shingle"], "left_semi")
    hub = rows.groupBy("c", "shingle").agg(F.min_by(F.struct("node", "team"), F.struct("s", "node")).alias("hub"))
    met = rows.join(hub, ["c", "shingle"]).where("team <> hub.team")
    return met.select("c", F.col("node").alias("node_a"), F.col("hub.node").alias("node_b")).distinct()


def _meetings(ranked: DataFrame) -> DataFrame:
    """Rows of different teams that share a shingle at places where that can decide: of the team that most are in, no row meets another."""
    rows = ranked.join(_shared(ranked), ["c", "shingle"]).withColumn("own", F.col("team") != F.col("most"))
    far, near = rows.where("as_far"), rows.where("as_near")
    meet = lambda a, b: _side(a, "a").join(_side(b, "b"), ["c", "shingle"])
    return meet(far.where("own"), near.where("own")).union(meet(far.where("own"), near.where("not own"))).union(meet(far.where("not own"), near.where("own"))).where("team_a <> team_b")


def _close(met: DataFrame, whole: int, percent: int) -> DataFrame:
    """Of the rows that meet, those that can be linked."""
    ordered = "(s_a > s_b or s_a = s_b and node_a > node_b)"
    enough = f"least(place_a, place_b) * {2 * whole} >= s_a + s_b and least(d_a, d_b) * {2 * whole} >= s_a + s_b"
    return met.where(f"{ordered} and {enough} and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")


def _proved(found: DataFrame, sets: DataFrame, whole: int) -> DataFrame:
    """``label_a, label_b`` of the pairs that are linked, by their whole sets."""
    side = lambda x: sets.select("c", *[F.col(name).alias(f"{name}_{x}") for name in ("node", "s", "label", "apart")])
    tested = found.join(side("a"), ["c", "node_a"]).join(side("b"), ["c", "node_b"])
    return tested.where(f"{2 * whole} * size(array_intersect(apart_a, apart_b)) >= s_a + s_b").select("label_a", "label_b")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does; of repeated rows one stays."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, size=size, percent=percent)
    gone = found.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    left = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    if found.groupBy("doc_id", "node").count().where("count > 1 and doc_id is not null").isEmpty():
        return left
    (name,) = unused(docs, "text")
    return left.withColumn(name, F.xxhash64(text_col)).dropDuplicates([id_col, name]).select(*docs.columns)


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, text`` of each wanted node: of the row with its id whose set is that node (ids can repeat)."""
    ids = nodes.join(wanted, "node", "left_semi").select("node", "check", "doc_id")
    there = docs.hint("merge").join(ids, "doc_id").select("node", "check", "text")  # one plan for any size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, most=1 << 20):
            sets, first = shingles(buf, offs, size)
            with np.errstate(over="ignore"):
                total = np.concatenate(([_U(0)], np.cumsum(mix(sets))))
                key = signed(mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)))
            yield rows.filter(pa.array(key == rows.column("node").to_numpy())).select(["node", "check", "text"])

    same = there.mapInArrow(run, "node long, check long, text string")
    return same.dropDuplicates(["node"]).select("node", "text")
