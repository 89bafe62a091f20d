"""URL filter: host and path rules, and a blocked Bloom filter over listed canonical URLs that an exact join confirms.

Everything is DataFrame code. The filter is a table of blocks: four 64-bit words a block, in which each listed URL sets one bit a
word. A page looks up the one block of its canonical URL; only pages with all four bits set go to the exact join with the list.
The block table follows the list (about ``URLS_PER_BLOCK`` a block) and is joined by block number, so nothing is broadcast unless
its size, known before, is under ``BROADCAST_BYTES``.

Only pages that no rule has judged and that have a canonical URL go to the join; addresses that many pages share are dealt over
``SALTS`` keys there. The query's list is made from what pages hold, not from how often an address occurs: ``junk_addresses``.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule, has no canonical URL and is allowed;
repeated pages give repeated rows; of rules of equal length the first in ``sorted`` order wins (two rules that fit one URL with
equal length cannot differ in both parts); the query string is part of a canonical URL, the fragment is not; very long URLs are
taken whole; an empty list blocks nothing by itself; null html lists no address; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm.shared import stored, table

#: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
URLS_PER_BLOCK = 16
MAX_BLOCKS = 1 << 31
BLOCK_BYTES = 48
BROADCAST_BYTES = 8 << 20
WORDS = 4
#: Keys over which the pages of one canonical URL are dealt in the last join.
SALTS = 16
#: Runs of symbols that mark a page's text as junk.
JUNK = r"[%*#$]{3}"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for a null one or one without ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_replace(url, r"(?s)\A.*?://", "")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.when(has, F.translate(host, _UPPER, _LOWER)).otherwise(""), F.when(has, path).otherwise("")


def url_query(url: Column) -> Column:
    """The query string of a URL with its question mark; empty without one."""
    return F.regexp_extract(F.regexp_replace(url, r"(?s)\A.*?://", ""), r"\A[^?#]*(\?[^#]+)", 1)


def canonical(host: Column, path: Column, query: Column) -> Column:
    """Host without a leading www. or m., path without trailing slashes, query string; null without a host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"\A(www|m)\.", ""), F.regexp_replace(path, r"/+\z", ""), query))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (as ``host + path``) and its verdict, null without one."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))

    def fits(h: str, p: str) -> Column:
        return ((host == h) | host.endswith("." + h)) & path.startswith(p)

    name = F.coalesce(*(F.when(fits(h, p), F.lit(h + p)) for h, p, _ in order), F.lit(None).cast("string"))
    verdict = F.coalesce(*(F.when(fits(h, p), F.lit(v)) for h, p, v in order), F.lit(None).cast("string"))
    return name, verdict


def _bits(url: Column) -> list[Column]:
    """One bit of 64 in each word of the block, from a second hash of the URL."""
    h = F.xxhash64(url, F.lit("bit"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(WORDS)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """Columns block, w0..w3 from column ``url`` (bit_or combines before and after the shuffle)."""
    bits = _bits(F.col("url"))
    return listed.select(_block(F.col("url"), blocks).alias("block"), *(b.alias(f"w{k}") for k, b in enumerate(bits))).groupBy("block").agg(*(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)))


def listed_urls(candidates: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct values of candidates.url that are in listed.url: the filter first, then the exact join."""
    listed = stored(listed.where("url is not null").select("url").distinct(), "listed")
    n = listed.count()
    blocks = min(MAX_BLOCKS, max(1, -(-n // URLS_PER_BLOCK)))
    bloom = bloom_filter(listed, blocks)
    if blocks * BLOCK_BYTES <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    bits = _bits(F.col("url"))
    probe = candidates.where("url is not null").select("url").distinct().withColumn("block", _block(F.col("url"), blocks))
    passed = probe.join(bloom, "block").where(reduce(Column.__and__, (F.col(f"w{k}").bitwiseAND(b) != 0 for k, b in enumerate(bits)))).select("url")
    return passed.join(listed, "url", "left_semi")


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict: the rule's verdict where one fits, else block for a listed canonical URL, else allow."""
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), url_query(F.col("url")).alias("query"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    address = canonical(F.col("host"), F.col("path"), F.col("query"))
    ruled = parts.select("page_id", "host", "path", name.alias("rule"), verdict.alias("by_rule"), address.alias("canonical"))
    asked = F.col("by_rule").isNull() & F.col("canonical").isNotNull()
    sure = ruled.where(~asked).select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit("allow")).alias("verdict"))
    hits = listed_urls(ruled.where(asked).select(F.col("canonical").alias("url")), listed)
    dealt = hits.select(F.col("url").alias("hit"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("to"))
    salt = F.pmod(F.xxhash64("page_id", "host"), F.lit(SALTS)).cast("int")
    found = ruled.where(asked).withColumn("salt", salt).join(dealt, (F.col("canonical") == F.col("hit")) & (F.col("salt") == F.col("to")), "left")
    return sure.unionByName(found.select("page_id", "host", "path", "rule", F.when(F.col("hit").isNotNull(), F.lit("block")).otherwise("allow").alias("verdict")))


def junk_addresses(pages: DataFrame) -> DataFrame:
    """The list of the query: canonical URLs (column url) of pages whose html holds runs of symbols; other pages there are blocked too."""
    host, path = url_parts(F.col("url"))
    return pages.where(F.col("html").rlike(JUNK)).select(canonical(host, path, url_query(F.col("url"))).alias("url")).where("url is not null")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages.select("page_id", "url"), junk_addresses(pages.select("url", "html")))


ORACLE_SQL = """
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*([?][^#]+)', 1) ELSE '' END AS query,
         coalesce(regexp_matches(html, '[%*#$]{3}'), false) AS junk
  FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '') || query END AS canon
  FROM parts),
listed AS (SELECT DISTINCT canon FROM ruled WHERE junk AND canon IS NOT NULL)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            WHEN rule IN ('com/fr/', 'org/') THEN 'allow'
            WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
