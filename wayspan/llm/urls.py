"""URL filters: host and path rules, then a blocked Bloom filter with an exact join.

Listed canonical URLs are hashed into a table of blocks of four 64-bit words.
An URL is a possible hit if its block has all its bits; possible hits meet the
list in a hash join on the canonical URL, which removes the false positives.
All of it is DataFrame operations.

Defined cases: an URL that is null, empty or has no ``://`` has empty host and path,
fits no rule and is allowed; a very long one is judged whole; of rules that fit the
longest wins, of equally long ones the first; an empty list blocks nothing; a list so
long that the filter of ``MAX_BLOCKS`` saturates sends more URLs to the exact join, with
the same result; repeated rows are judged alike, each by itself; an empty table gives
an empty result; extra columns of any name and type are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import scope, settled
from .common import ascii_lower

#: Bits for each listed URL, and the most blocks (of 32 bytes) that are broadcast: 32 MB.
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 20
WORDS = 4
#: ``queries`` lists every canonical URL that at least so many pages name.
LISTED_PAGES = 2


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", False), Rule("example.net", "/en/", True), Rule("example.com", "/de/", False), Rule("org", "/fr/", True))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without user, default port, ``www.`` or final dot; path without final slashes; no query or fragment."""
    h = F.regexp_replace(host, r"(?s)^.*@", "")
    h = F.regexp_replace(F.regexp_replace(h, r":(80|443)?$", ""), r"\.$", "")
    return F.concat(F.regexp_replace(h, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def rule_column(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (of equally long ones the first), and whether it allows; null if none."""
    text = allow = F.lit(None)
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, allow = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.allow)).otherwise(allow)
    return text, allow


def _bits(key: Column) -> list[Column]:
    """One bit in each word of the block."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * j).bitwiseAND(F.lit(63)).cast("int")) for j in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(2)), F.lit(blocks)).cast("int")


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w3) of the listed ``key`` column; blocks without keys are absent."""
    cols = [b.alias(f"b{j}") for j, b in enumerate(_bits(F.col("key")))]
    return listed.select(_block(F.col("key"), blocks).alias("block"), *cols).groupBy("block").agg(*[F.bit_or(f"b{j}").alias(f"w{j}") for j in range(WORDS)])


def block_count(keys: int, bits_per_key: int = BITS_PER_KEY, most: int = MAX_BLOCKS) -> int:
    """Enough blocks for the keys, up to the cap; beyond it more false positives reach the exact join."""
    return max(1, min(most, -(-keys * bits_per_key // (64 * WORDS))))


def possible_hits(urls: DataFrame, filt: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``urls`` (with ``key``) that the filter passes; the filter has MAX_BLOCKS rows at most."""
    h = urls.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(filt), "block")
    test = F.lit(True)
    for j, b in enumerate(_bits(F.col("key"))):
        test &= F.col(f"w{j}").bitwiseAND(b) != 0
    return h.where(test).drop("block", *[f"w{j}" for j in range(WORDS)])


def listed_hits(urls: DataFrame, listed: DataFrame, bits_per_key: int = BITS_PER_KEY, most: int = MAX_BLOCKS) -> DataFrame:
    """Distinct keys of ``urls`` that are in ``listed``: Bloom filter first, then the exact join.

    Keys are made distinct before the join, so a key that many rows share is one row there.
    """
    blocks = block_count(listed.count(), bits_per_key, most)
    hits = possible_hits(urls, bloom(listed, blocks), blocks)
    return hits.select("key").distinct().join(listed.hint("shuffle_hash"), "key", "left_semi")


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict): a rule's verdict, else block if the canonical URL is listed."""
    p = pages.select(F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, allow = rule_column(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule.cast("string"), "allow": allow.cast("boolean")})
    p = p.withColumn("key", F.when(F.col("rule").isNull() & (F.col("host") != ""), canonical(F.col("host"), F.col("path"))))
    # both settled: the list is counted and read again, and the join with all pages can split an URL that many share
    with scope() as kept:
        found = kept.result(listed_hits(p.where("key is not null").select("key"), settled(listed)))
    out = p.join(found.withColumn("listed", F.lit(True)), "key", "left")
    verdict = F.when(F.coalesce("allow", F.col("listed").isNull()), "allow").otherwise("block")
    return out.select(F.col("page_id"), "host", "path", "rule", verdict.alias("verdict"))


def often_named(pages: DataFrame, least: int = LISTED_PAGES) -> DataFrame:
    """A list to filter by: canonical URLs that several pages name (column ``key``)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    keys = pages.select(F.when(host != "", canonical(host, path)).alias("key")).where("key is not null")
    return keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("key")
