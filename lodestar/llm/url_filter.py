"""URL filter: rules first, then a list of canonical URLs behind a blocked
Bloom filter.

A rule is (verdict, host, path): it fits its host and all subdomains when the
URL's path starts with the rule's; the longest fitting rule decides (equal
lengths: the alphabetically first).  URLs without a fitting rule are blocked
if their canonical form is listed.

The listed URLs set ``PROBES`` bits each in one block of 512 bits (eight
longs), so a probe reads one row of the filter.  The filter is a table of
blocks, ``BITS_PER_URL`` bits per listed URL, broadcast while it has at most
``BROADCAST_BLOCKS`` blocks and joined by shuffle beyond that.  Only URLs
that pass it go on to the exact hash join with the list, which removes the
false positives.  Everything is DataFrame functions.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; path: from there to ``?``, ``#`` or the end.  Canonical form:
host without default port, path without trailing slashes, query without
tracking parameters, sorted; no scheme, no fragment.

Defined cases: a null URL or one without ``://`` has empty host and path, fits
no rule and is never listed.  Repeated rows give a row each.  Extra columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import written

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
#: host labels whose pages make up the query's list
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
TRACKING = r"^(utm_[^=]*|gclid|fbclid)(=|$)"
BITS_PER_URL = 12
PROBES = 7
BROADCAST_BLOCKS = 500_000  # 32 MB of bits

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Null where there is no host."""
    host = F.regexp_replace(url_host(url), r":(80|443)?$", "")
    path = F.regexp_replace(url_path(url), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest fitting rule, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text, verdict = F.when(fits, rule_host + rule_path).otherwise(text), F.when(fits, own).otherwise(verdict)
    return text, verdict


def _bits(url: Column) -> list[Column]:
    """Bit positions 0..511 of a URL in its block."""
    h = F.xxhash64(url, F.lit(1))
    return [F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(511)).cast("int") for i in range(PROBES)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """block and its eight words, from ``listed`` (canonical)."""
    bits = listed.select(_block(F.col("canonical"), blocks).alias("block"),
                         F.explode(F.array(*_bits(F.col("canonical")))).alias("bit"))
    one = F.lit(1).cast("long")
    return bits.groupBy("block").agg(F.array(*[
        F.coalesce(F.bit_or(F.when(F.shiftright("bit", 6) == w, F.expr("shiftleft(1L, bit & 63)"))), one - one)
        for w in range(8)]).alias("words"))


def passes(words: Column, url: Column) -> Column:
    found = F.lit(True)
    for bit in _bits(url):
        word = F.element_at(words, F.shiftright(bit, 6) + 1)
        found = found & (F.getbit(word, bit.bitwiseAND(F.lit(63))) == 1)
    return F.coalesce(found, F.lit(False))


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, bits_per_url: float = BITS_PER_URL) -> DataFrame:
    """page_id, host, path, rule, verdict of every page; ``listed`` has the
    column canonical."""
    listed = written(listed.where("canonical is not null").select("canonical").distinct(), "listed-urls")
    blocks = max(1, math.ceil(listed.count() * bits_per_url / 512))
    bloom = written(bloom_filter(listed, blocks), "url-bloom")
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = (pages.select("page_id", host.alias("host"), path.alias("path"), canonical(F.col("url")).alias("canonical"))
            .select("*", rule.alias("rule"), verdict.alias("ruled"), _block(F.col("canonical"), blocks).alias("block")))
    columns = ["page_id", "host", "path", "rule"]
    # only URLs that no rule decides are looked up
    open_rows = F.col("ruled").isNull() & F.col("canonical").isNotNull()
    decided = rows.where(~open_rows).select(*columns, F.coalesce("ruled", F.lit("allow")).alias("verdict"))
    probed = rows.where(open_rows).join(F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom, "block", "left")
    probed = probed.select(*columns, "canonical", passes(F.col("words"), F.col("canonical")).alias("possible"))
    clear = probed.where(~F.col("possible")).select(*columns, F.lit("allow").alias("verdict"))
    exact = probed.where("possible").join(
        listed.select("canonical", F.lit("block").alias("hit")).hint("shuffle_hash"), "canonical", "left")
    return decided.unionByName(clear).unionByName(
        exact.select(*columns, F.coalesce("hit", F.lit("allow")).alias("verdict")))


def listed_hosts(pages: DataFrame, labels=LISTED_LABELS) -> DataFrame:
    """canonical: the URLs of the pages on hosts with a listed label."""
    host = F.split(url_host(F.col("url")), r"\.")
    return pages.where(F.arrays_overlap(host, F.array(*[F.lit(x) for x in labels]))).select(
        canonical(F.col("url")).alias("canonical"))


def oracle(rules=RULES, labels=LISTED_LABELS) -> str:
    """DuckDB SQL for ``judge(pages, listed_hosts(pages))``."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))

    def choose(value):
        return "CASE " + " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'"
            for v, h, p in ordered) + " END"

    names = ", ".join(f"'{x}'" for x in labels)
    return rf"""
WITH split AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
parts AS (
  SELECT *, regexp_replace(host, ':(80|443)?$', '') || regexp_replace(path, '/+$', '') AS place,
         array_to_string(list_sort(list_filter(
           string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))), '&') AS query
  FROM split),
canon AS (
  SELECT *, CASE WHEN regexp_replace(host, ':(80|443)?$', '') <> '' THEN
              place || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical
  FROM parts),
listed AS (
  SELECT DISTINCT canonical FROM canon
  WHERE canonical IS NOT NULL AND list_has_any(string_split(host, '.'), [{names}]))
SELECT page_id, host, path, {choose(lambda v, h, p: h + p)} AS rule,
       coalesce({choose(lambda v, h, p: v)}, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM canon LEFT JOIN listed l ON canon.canonical = l.canonical
"""
