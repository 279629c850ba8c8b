"""Verdicts on URLs: rules by host and path first, else a list of URLs behind a blocked Bloom filter.

A listed URL is known by its canonical form. The filter is a small table of
256-bit blocks, one row each; it is broadcast, so its number of blocks is
bounded by a parameter, and a page's form sets or asks four bits of one block.
A longer list only lets more pages pass the filter: those that pass are joined
with the list by the whole canonical form, which takes false positives out.
All other pages never leave their task. The join is left to Spark, which
splits a form that very many pages have.

Only built-in expressions are used.

Null, text without ``://``: host and path are empty, no rule fits and the list
holds no such URL. Repeated and equal URLs get equal verdicts, rows are kept as
they are. An empty list blocks nothing; an empty table stays empty. Columns of
the input that have the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import cut, unused

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parameters of a URL that say where a visitor came from, not what is shown.
TRACKING = r"^(utm_[^=]*|ref|referrer|fbclid|gclid|mc_cid|mc_eid)(=|\z)"
#: Bits of the filter for each listed URL, and blocks of 256 bits at most (32 MB).
BITS, BLOCKS = 10, 1 << 20


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """What URLs of one page have in common: host without ``www.`` and usual ports, path without closing slashes, sorted parameters.

    Null where there is no host. Scheme, fragment and ``TRACKING`` parameters do not count.
    """
    name = F.regexp_replace(host(url), r"^www\.|\.?(:(80|443)?)?\z", "")
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    asked = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    tail = F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise("")
    return F.when(name != "", F.concat(name, F.regexp_replace(path(url), r"/+\z", ""), tail))


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a form, and its bit in each of the block's four words."""
    h = F.xxhash64(key)
    return F.pmod(F.shiftrightunsigned(h, 24), F.lit(blocks)), [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(4)]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row (block, w0 to w3) for each block that ``keys`` set bits in."""
    block, bits = _bits(F.col(key), blocks)
    return keys.select(block.alias("block"), *(b.alias(f"b{i}") for i, b in enumerate(bits))).groupBy("block").agg(*(F.bit_or(f"b{i}").alias(f"w{i}") for i in range(4)))


def blocks_for(n: int, most: int = BLOCKS) -> int:
    return min(most, 1 << max(0, (n * BITS - 1) // 256).bit_length())


def rule_of(rules: Sequence[tuple[str, str, str]], name: Column, where: Column) -> tuple[Column, Column]:
    """The longest of the (verdict, host, path) rules that fits, as text, and its verdict; null where none does.

    A rule fits its host and all subdomains, if the path starts with its own.
    Of rules of one length the first counts.
    """
    text = verdict = F.lit(None).cast("string")
    for says, on, under in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((name == on) | name.endswith("." + on)) & where.startswith(under)
        text, verdict = F.when(fits, on + under).otherwise(text), F.when(fits, says).otherwise(verdict)
    return text, verdict


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = (), url: str = "url", listed_url: str = "url", most_blocks: int = BLOCKS) -> DataFrame:
    """``pages`` with host, path, rule and verdict: the rule's, else block if the URL is listed, else allow."""
    key, form, block, word, rule_says = unused(pages, "key", "form", "block", "word", "says")
    forms = cut(listed.select(canonical(F.col(listed_url)).alias(form)).where(F.col(form).isNotNull()).distinct(), "listed-urls")
    blocks = blocks_for(forms.count(), most_blocks)
    table = bloom_filter(forms, form, blocks)
    table = table.select(F.col("block").alias(block), *(F.col(f"w{i}").alias(f"{word}{i}") for i in range(4)))

    at = F.col(url)
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rule, says = rule_of(rules, F.col("host"), F.col("path"))
    split = pages.select(*kept, host(at).alias("host"), path(at).alias("path"), canonical(at).alias(key))
    split = split.select("*", rule.alias("rule"), says.alias(rule_says)).withColumn(key, F.when(F.col(rule_says).isNull(), F.col(key)))
    own_block, bits = _bits(F.col(key), blocks)
    probed = split.join(F.broadcast(table), F.when(F.col(key).isNotNull(), own_block) == F.col(block), "left")
    hit = reduce(Column.__and__, [F.col(f"{word}{i}").bitwiseAND(b) != 0 for i, b in enumerate(bits)])
    passed = F.coalesce(hit, F.lit(False))
    out = [*kept, "host", "path", "rule"]
    rest = probed.where(~passed).select(*out, F.coalesce(rule_says, F.lit("allow")).alias("verdict"))
    proved = probed.where(passed).join(forms, F.col(key) == F.col(form), "left")
    return rest.unionAll(proved.select(*out, F.when(F.col(form).isNotNull(), "block").otherwise("allow").alias("verdict")))
