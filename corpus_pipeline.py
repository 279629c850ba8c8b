"""From raw documents to a training mix, a stage for each decision.

Every stage takes what its predecessor kept and returns it with the columns of
``documents``; the last adds how many words of each document the mix takes.

In every stage: null texts are empty texts, rows without id are documents (they
are never near duplicates), repeated rows are judged alike (near duplicates keep
one of them), texts of any length are read whole by one task, ties go to the
smaller id, other columns stay, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import decontam, mixing, neardup, pii, queries, toxicity
from evenkeel.llm.common import cut, discard, table
from evenkeel.llm.labelled import in_fold, labelled_sample


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the same labels as the op5 query."""
    usable = ~in_fold("doc_id", 5, 0)
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", usable, queries.TOXICITY_ROWS, "doc_id", "text")
    return toxicity.without_toxic(docs, sample)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; five-word shingles, similarity 0.8."""
    return neardup.one_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and what discloses it, is replaced in the texts."""
    return pii.sanitise(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words that it takes of each (repeats counted)."""
    return mixing.mix_sources(docs).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", sanitise),
    ("mixing", mix),
]

#: The stages score, sketch and sanitise; SQL cannot express them (see tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
        discard(*last)  # the next copy is there
        last = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
