"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source gets a share of the mix in proportion to its weight, but never
more than ``max_epochs`` times its own words: sources above that are clamped,
and what they cannot take is shared again by weight among the others until
none is above. Within a source every document is taken the whole number of
times that the target asks for, and a seeded share of the documents once more;
where the share ends inside a hash bucket, the documents of that bucket are
taken in part, so that a source's words meet its target.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; repeated rows are documents of their own (rows with equal ids
share their draw); a text of any length is counted where it is read; an empty
table gives an empty result; extra columns stay, but for columns named as the
results, which are replaced, and names that begin with two underscores are the
operator's own: rename such columns before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import cut

#: Hash buckets of a source's documents, by which the seeded share is found.
BUCKETS = 1 << 16


def word_count(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")), F.lit(0)).cast("long")


def ranked(sources: DataFrame, column: str, rank: str) -> DataFrame:
    """Number the rows from 0 by ``column``, null last, without one task that holds them all."""
    parts = sources.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("__part", F.spark_partition_id())
    parts = cut(parts, "ranked")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__part").orderBy(F.col(column).asc_nulls_last())
    return parts.join(starts, "__part").withColumn(rank, F.col("__start") + F.row_number().over(within) - 1).drop("__part", "__start")


def water_level(sources: DataFrame, total: int) -> float:
    """Words for each unit of weight, once no source is above its cap.

    ``sources`` has ``__weight`` and ``__cap``. Each round clamps the sources
    whose share is above their cap; only sums reach the driver.
    """
    level, clamped = 0.0, -1
    while True:
        over = F.col("__cap") <= F.col("__weight") * F.lit(level)
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("__cap"))), F.lit(0)).alias("caps"),
            F.coalesce(F.sum(F.when(~over, F.col("__weight"))), F.lit(0)).alias("weights"),
            F.count_if(over).alias("n"),
        ).first()
        if row["n"] == clamped or not row["weights"]:
            return level
        level, clamped = (total - row["caps"]) / row["weights"], row["n"]


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with size, source_size, target (of its source) and taken (words of it in the mix).

    The sources, in order by code point with null last, weigh ``weights`` in
    turn. One pass sums the sizes by source and hash bucket (summed on the map
    side, so a source with most of the rows is no hot key); the join back is to
    one row a source.
    """
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")))
    sized = docs.withColumns(
        {
            "size": word_count(F.col("text")) if size is None else size,
            "__bucket": F.conv(F.substring(draw, 1, 4), 16, 10).cast("int"),
            "__round": F.conv(F.substring(draw, 5, 4), 16, 10).cast("double") / BUCKETS,
        }
    )
    by_bucket = cut(sized.groupBy(F.col(source_col).alias("__source"), "__bucket").agg(F.sum("size").alias("__words")), "mix")
    sources = ranked(by_bucket.groupBy("__source").agg(F.sum("__words").alias("source_size")), "__source", "__rank")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    sources = cut(
        sources.select(
            "__source",
            "source_size",
            F.element_at(turn, (F.col("__rank") % len(weights)).cast("int") + 1).alias("__weight"),
            (F.col("source_size") * max_epochs).alias("__cap"),
        ),
        "mix",
    )
    level = water_level(sources, sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = sources.select(
        "__source",
        "source_size",
        F.least(F.col("__weight") * F.lit(level), F.col("__cap").cast("double")).alias("target"),
    ).withColumn("__whole", whole)
    targets = targets.withColumn("__rest", F.col("target") - F.col("__whole") * F.col("source_size"))
    # the bucket in which the rest of a source's target ends, and the part of that bucket which is still taken
    running = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        by_bucket.withColumn("__upto", F.sum("__words").over(running))
        .join(targets.withColumnRenamed("__source", "__of"), F.col("__source").eqNullSafe(F.col("__of")))
        .where((F.col("__words") > 0) & (F.col("__upto") - F.col("__words") < F.col("__rest")) & (F.col("__upto") >= F.col("__rest")))
        .select(
            F.col("__source").alias("__end_source"),
            F.col("__bucket").alias("__end"),
            ((F.col("__rest") - F.col("__upto") + F.col("__words")) / F.col("__words")).alias("__part"),
        )
    )
    targets = targets.join(ends, F.col("__source").eqNullSafe(F.col("__end_source")), "left").drop("__end_source")
    end = F.coalesce(F.col("__end"), F.lit(-1))
    more = (
        F.when(F.col("__bucket") < end, F.col("size"))
        .when(F.col("__bucket") == end, F.floor(F.col("size") * F.col("__part") + F.col("__round")))
        .otherwise(F.lit(0))
    )
    return (
        sized.drop("source_size", "target", "taken")
        .join(targets, F.col(source_col).eqNullSafe(F.col("__source")))
        .withColumn("taken", (F.col("__whole") * F.col("size") + more).cast("long"))
        .drop("__bucket", "__round", "__source", "__whole", "__rest", "__end", "__part")
    )
