"""A tree of digests over fixed ranges of hashes: equal trees prove equal tables, and differing ones say where to look.

A row belongs to the leaf that the first four hex digits of its range hash name,
a leaf to the inner node of the first two. A leaf's digest is the order-free sum
of its rows' hashes, so leaves are partial sums and no task sees more than it
scanned; an inner node digests the lines of its leaves, the root those of the
256 inner nodes. Two trees are compared from the root down, and only rows of
leaves that differ have to be looked at again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canonical import fingerprints, order_key
from evenkeel.operators.delta import compare_fingerprints, typed_keys
from evenkeel.operators.evidence import INNER, LEAF, above, leaf_digests, root_digest, stored
from evenkeel.plans.table_plan import TablePlan, require_key

LEAVES, NODES, ROOT = "leaf", "inner", "root"


def digest_tree(rows: DataFrame, ranges: str, content: str) -> DataFrame:
    """All nodes: ``level`` (leaf, inner, root), ``prefix``, ``rows``, ``sha256``; the table is scanned once."""
    leaves = stored(leaf_digests(rows, ranges, content), "leaves")
    inner = above(leaves, F.substring("prefix", 1, INNER))
    root = root_digest(leaves).select(F.lit("").alias("prefix"), "rows", "sha256")
    return leaves.withColumn("level", F.lit(LEAVES)).unionByName(inner.withColumn("level", F.lit(NODES))).unionByName(root.withColumn("level", F.lit(ROOT))).select("level", "prefix", "rows", "sha256")


def table_tree(df: DataFrame, plan: TablePlan) -> DataFrame:
    """The tree of a table by key hash: a row that changes stays in its leaf."""
    return digest_tree(fingerprints(typed_keys(df, plan), plan), "key_sha256", "row_sha256")


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """``level, prefix, left_rows, right_rows`` of the nodes that differ, leaves only below inner nodes that do."""
    sides = [df.select("level", "prefix", F.col("rows").alias(f"{s}_rows"), F.col("sha256").alias(s)) for df, s in ((left, "left"), (right, "right"))]
    bad = sides[0].join(sides[1], ["level", "prefix"], "full_outer").where(~F.col("left").eqNullSafe(F.col("right")))
    bad = bad.select("level", "prefix", *[F.coalesce(f"{s}_rows", F.lit(0)).alias(f"{s}_rows") for s in ("left", "right")])
    inner = bad.where(F.col("level") == NODES).select(F.col("prefix").alias("__inner"))
    leaves = bad.where(F.col("level") == LEAVES).join(inner, F.substring("prefix", 1, INNER) == F.col("__inner"), "left_semi")
    return bad.where(F.col("level") != LEAVES).unionByName(leaves)


def _within(df: DataFrame, plan: TablePlan, leaves: DataFrame) -> DataFrame:
    """Fingerprints of the rows in the given leaves. There are 65,536 leaves at most, so they are broadcast."""
    rows = fingerprints(typed_keys(df, plan), plan)
    return rows.join(F.broadcast(leaves.select("prefix")), F.substring("key_sha256", 1, LEAF) == F.col("prefix"), "left_semi")


def plan_by_ranges(source: DataFrame, target: DataFrame, plan: TablePlan, source_tree: DataFrame | None = None, target_tree: DataFrame | None = None) -> DataFrame:
    """The operations of ``plan_delta``, with only the rows of differing leaves in the join.

    A tree that was kept from an earlier run saves that side's first scan. Where
    few rows changed, all others stay where they are: no row of an equal leaf
    is shuffled.
    """
    trees = [table_tree(df, plan) if tree is None else tree for df, tree in ((source, source_tree), (target, target_tree))]
    leaves = stored(differing(*trees).where(F.col("level") == LEAVES), "differing")
    compared = compare_fingerprints(_within(source, plan, leaves), _within(target, plan, leaves), plan)
    return compared.where("kind <> 'unchanged'")


def first_difference(source: DataFrame, target: DataFrame, plan: TablePlan) -> DataFrame:
    """The operation of the least key that differs; no row for equal tables."""
    return plan_by_ranges(source, target, plan).orderBy(*[order_key(F.col(f"`{k}`"), plan.column(k).type) for k in require_key(plan)]).limit(1)
