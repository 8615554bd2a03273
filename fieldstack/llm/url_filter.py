"""URL filter: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

A url's host stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
its path runs from there to ``?``, ``#`` or the end. A rule (action, host, path) fits its host and all
subdomains if the url's path starts with the rule's; the rule with the longest text wins.

URLs without a rule are looked up in a list. The list is folded into a blocked Bloom filter: one
row of eight 32-bit words for each block, and one bit in each word for a URL, so a look-up touches one block. The filter
has at most ``max_blocks`` rows, which bounds its broadcast. Possible hits alone are shuffled, to an exact join
by canonical URL that removes false positives; everything else is settled in the scan. A list too
long for the filter only sends more URLs to the exact join.

Defined results: a null url, or one without ``://``, has an empty host and path, no canonical form
and the verdict ``allow``. Repeated rows get a verdict each. Repeated or null list entries count once or not at all.
Extra columns pass through; those named uf_.. are replaced. An empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own

WORDS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without trailing slashes, sorted query without tracking parameters, no fragment."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    params = F.array_sort(F.filter(F.split(query, "&", -1), lambda p: ~p.rlike(r"^(utm_|ref=|$)")))
    return F.when(url.contains("://"), F.concat(
        F.regexp_replace(url_host(url), r"^www\.", ""), F.regexp_replace(url_path(url), "/+$", ""),
        F.when(F.array_size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")))


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block, and its bit in each word of the block."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    bits = F.xxhash64(F.lit("bits"), key)
    return block, [F.shiftright(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(uf_block, uf_w0 .. uf_w7): at most ``blocks`` rows."""
    block, bits = _place(F.col(key), blocks)
    masks = [F.call_function("shiftleft", F.lit(1), b).alias(f"m{i}") for i, b in enumerate(bits)]
    return (listed.where(F.col(key).isNotNull()).select(block.alias("uf_block"), *masks)
            .groupBy("uf_block").agg(*[F.bit_or(f"m{i}").alias(f"uf_w{i}") for i in range(WORDS)]))


def filter_blocks(entries: int, max_blocks: int) -> int:
    """16 bits an entry, in blocks of 256 bits."""
    return min(max_blocks, 1 << max(0, (max(entries, 1) * 16 // 256)).bit_length())


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, action) of the longest rule that fits; nulls if none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):   # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, action = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]],
               url: str = "url", max_blocks: int = 1 << 18) -> DataFrame:
    """``pages`` plus uf_host, uf_path, uf_rule, uf_listed and uf_verdict. ``listed`` has one column
    of canonical URLs."""
    entries = listed.select(F.col(listed.columns[0]).alias("uf_entry")).where("uf_entry is not null").distinct()
    blocks = filter_blocks(entries.count(), max_blocks)
    bloom = blocked_bloom(entries, "uf_entry", blocks)

    judged = own(pages, "uf_").withColumns({"uf_host": url_host(F.col(url)), "uf_path": url_path(F.col(url))})
    rule, action = rule_of(F.col("uf_host"), F.col("uf_path"), rules)
    judged = judged.withColumns({"uf_rule": rule, "uf_action": action,
                                 "uf_key": F.when(rule.isNull(), canonical(F.col(url)))})
    block, bits = _place(F.col("uf_key"), blocks)
    probed = judged.withColumn("uf_block", F.when(F.col("uf_key").isNotNull(), block)).join(
        F.broadcast(bloom), "uf_block", "left")
    held = F.lit(True)
    for i, b in enumerate(bits):
        held = held & (F.call_function("shiftright", F.col(f"uf_w{i}"), b).bitwiseAND(F.lit(1)) == 1)
    probed = probed.withColumn("uf_possible", F.coalesce(F.col("uf_w0").isNotNull() & held, F.lit(False))).drop(
        "uf_block", *[f"uf_w{i}" for i in range(WORDS)])

    settled = probed.where("not uf_possible").withColumn("uf_listed", F.lit(False))
    confirmed = probed.where("uf_possible").join(entries, F.col("uf_key") == F.col("uf_entry"), "left").withColumn(
        "uf_listed", F.col("uf_entry").isNotNull()).drop("uf_entry")
    verdict = F.coalesce(F.col("uf_action"), F.when(F.col("uf_listed"), "block").otherwise("allow"))
    return settled.unionByName(confirmed).withColumn("uf_verdict", verdict).drop("uf_action", "uf_key", "uf_possible")
