"""The thin queries over the given tables: each applies its operator with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import decontam, knn, lm, mixing, neardup, oracles, pii, quality, repair, substrings, tokencount, toxicity, trie, urls
from evenkeel.llm.common import cut, table
from evenkeel.llm.labelled import in_fold, labelled_sample

#: Labelled rows at most that the classifiers are fitted to.
QUALITY_ROWS, TOXICITY_ROWS = 4096, 8192

ORACLE_SQL: dict[str, str] = {
    "op3_minhash_neardup": oracles.NEAR_DUPLICATES,
    "op6_decontamination": oracles.DECONTAMINATION,
    "op9_exact_top_k": oracles.TOP_K,
    "op10_mix_sources": oracles.MIXING,
    "op11_url_filters": oracles.URL_FILTERS,
    "op12_conversation_repair": oracles.CONVERSATION_REPAIR,
    "op13_conversation_trie": oracles.CONVERSATION_TRIE,
}


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 5, 1)
    model = lm.train(docs.where(~held_out))
    scored = lm.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = pii.plain(F.col("spans"))
    kinds = F.transform(base, lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS[:4])]
    every = F.array_sort(F.concat(base, pii.plain(F.col("terms"))))
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(every).alias("spans"))


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 4, 2)
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", ~held_out, QUALITY_ROWS, "doc_id", "text")
    scored = quality.quality(docs, sample)
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 5, 0)
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out, TOXICITY_ROWS, "doc_id", "text")
    scored = toxicity.toxicity(docs, sample)
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = cut(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("__size")), "sizes")
    mixed = mixing.mix_sources(docs, size=F.col("__size"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: Rules of op11 (verdict, host, path), and the sites whose pages its list holds.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LISTED_SITES = ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(urls.host(F.col("url")).rlike(rf"(^|\.)({'|'.join(LISTED_SITES)})\."))
    return urls.judge_urls(pages, listed, URL_RULES).drop("url")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(repair.damage(table(spark, sf_dir, "conversations")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    paths = trie.turn_paths(table(spark, sf_dir, "conversations"), leader=conv - conv % 20, head=F.crc32(F.encode(conv.cast("string"), "utf-8")) % 4)
    return trie.prefix_trie(paths)


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_pii, op3_minhash_neardup, op4_quality, op5_toxicity, op6_decontamination, op7_token_counts, op8_suffix_dedup, op9_exact_top_k, op10_mix_sources, op11_url_filters, op12_conversation_repair, op13_conversation_trie)}
