"""Bounded samples of labelled documents, and the check fold of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int, id_col: str, text_col: str) -> DataFrame:
    """``(__id, text, label)`` of at most ``most`` labelled ids, one row for each, the same ones at each run.

    The ids are those of smallest hash, so the sample is spread over the table;
    only these ids are broadcast. Of several labels for an id the least is used, of
    several texts the one of smallest hash.
    """
    ids = (
        labels.where(usable & F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.min(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(most)
    )
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "__id")
    return texts.groupBy("__id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("label").alias("label"))
