"""URL filters: host and path rules, then a list of canonical URLs behind a
blocked Bloom filter.

The list becomes a table of filter blocks of 256 bits (eight 32-bit lanes, one
bit set in each), keyed by block number. A canonical URL of the pages, each once,
hashes to one block, so the filter is applied by an equi-join on the block number:
broadcast while the table is small, shuffled beyond that, never a driver-side
object. What the filter passes goes to an exact hash join with the list, which
removes the false positives; the pages then look up what was found, and a URL that
many of them have is dealt over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import split_join, written

#: Bits of filter for each listed URL; a block has 256 bits.
BITS_PER_URL = 16
LANES = 8
#: (rule as named in results, host, start of the path, verdict)
RULES = (
    ("org/", "org", "/", "allow"),
    ("example.org/es/", "example.org", "/es/", "block"),
    ("example.org/en/1", "example.org", "/en/1", "block"),
    ("com/fr/", "com", "/fr/", "allow"),
    ("com/de/", "com", "/de/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: then up to ``?``, ``#`` or the end. Null or no ``://``:
    both empty."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    tail = F.substr(rest, F.length(host) + 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, r"(?s)^([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """One form for spellings of a page: no scheme, ``www.`` or ``m.``, port,
    fragment, query or trailing slash."""
    host = F.regexp_replace(F.regexp_replace(host, r":[0-9]*$", ""), r"^(?:www|m)\.", "")
    return F.concat(host, F.regexp_replace(path, r"/+$", ""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one. A rule
    fits its host and all subdomains if the path starts with its path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def block_and_lanes(key: Column, blocks: int) -> tuple[Column, Column]:
    """The block of a key, and its mask of one bit in each of eight lanes."""
    one, two = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    mask = F.transform(F.array(two), lambda x: F.array(*[F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(x, 5 * k).bitwiseAND(F.lit(31)).cast("int")) for k in range(LANES)]))[0]
    return F.pmod(one, F.lit(blocks)), mask


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, lanes): the filter of the keys; blocks without a key are absent."""
    block, lanes = block_and_lanes(F.col(key), blocks)
    set_bits = listed.where(F.col(key).isNotNull()).select(block.alias("block"), lanes.alias("m"))
    merged = set_bits.groupBy("block").agg(*[F.bit_or(F.get("m", F.lit(k))).alias(f"l{k}") for k in range(LANES)])
    return merged.select("block", F.array(*[f"l{k}" for k in range(LANES)]).alias("lanes"))


def may_contain(rows: DataFrame, key: str, flt: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with a boolean ``possible``: false means surely not listed."""
    block, lanes = block_and_lanes(F.col(key), blocks)
    probed = rows.withColumn("_block", block).withColumn("_mask", lanes)
    probed = probed.join(flt.toDF("_block", "_lanes"), "_block", "left")
    hit = F.forall(F.zip_with("_mask", "_lanes", lambda a, b: a.bitwiseAND(b) == a), lambda x: x)
    return probed.withColumn("possible", F.coalesce(hit, F.lit(False))).drop("_block", "_mask", "_lanes")


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str, str]] = RULES) -> DataFrame:
    """Per page: (page_id, host, path, rule, verdict).

    ``listed`` has a column ``canonical``; it is written once and read for the
    filter and for the exact join. Where a rule fits, its verdict holds (of
    fitting rules with names of one length the last by name); else ``block`` if
    the page's canonical URL is listed, ``allow`` if not. A null URL or one
    without ``://`` has an empty host and path and is allowed unless the empty
    URL is listed; null entries of the list count for nothing and repeated ones
    once; URLs count whole, however long; repeated pages each give a row; empty
    tables on either side are no special case; other columns are not read. Only the
    pages' distinct URLs meet the filter and the list. Of a URL that many pages
    have, null and scheme-less ones included, the pages are dealt over tasks.
    """
    listed = written(listed.select(F.col("canonical").cast("string").alias("canonical")).where("canonical is not null").distinct())
    blocks = max(1, -(-listed.count() * BITS_PER_URL // 256))
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, ruled = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), ruled.alias("ruled"), canonical(F.col("host"), F.col("path")).alias("canonical"))
    urls = written(rows.groupBy("canonical").agg(F.count("*").alias("n"), F.bool_or(F.col("ruled").isNull()).alias("open")))
    possible = may_contain(urls.where("open").select("canonical"), "canonical", bloom(listed, "canonical", blocks), blocks).where("possible")
    hits = written(possible.join(listed, "canonical").select("canonical", F.lit(True).alias("_listed")))
    found = split_join(rows, hits, "canonical", urls.select("canonical", "n"), F.monotonically_increasing_id(), "left")
    verdict = F.coalesce("ruled", F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow")))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
