"""URL filter: a blocked Bloom filter of the listed URL rules lets possible hits through to an exact hash join.

A listed rule is (host, path, action). It fits a URL whose host is the rule's or a subdomain and whose path starts
with the rule's path; the longest fitting rule decides. Each URL is turned into the few canonical keys a fitting rule
could have (host suffixes x path prefixes, only for label counts and path lengths that the list holds), the filter
drops nearly all of them, and the join on the key itself removes what the filter let through wrongly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

WORDS = 8  # 64-bit words of a block; a key sets one bit in each
BITS_PER_KEY = 16
MAX_BROADCAST_BLOCKS = 500_000  # 72 bytes each: the filter is broadcast up to 36 MB, beyond that it is hash-joined

#: The rules of the registered query, (action, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """For each word of the block, the one bit that the key sets."""
    h = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(WORDS)]


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row (block, w0 .. w7) for each block that holds a key; the words are or-ed map-side first."""
    aggs = [F.bit_or(b).alias(f"w{i}") for i, b in enumerate(_bits(F.col("key")))]
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*aggs)


def possible_hits(candidates: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """The candidates whose bits are all set in their block: every listed key, and a small share of others."""
    blocks = max(1, -(-n_keys * BITS_PER_KEY // (64 * WORDS)))
    words = bloom_filter(keys, blocks)
    if blocks <= MAX_BROADCAST_BLOCKS:
        words = F.broadcast(words)
    hit = reduce(lambda x, y: x & y, [F.col(f"w{i}").bitwiseAND(b) != 0 for i, b in enumerate(_bits(F.col("key")))])
    return candidates.withColumn("block", _block(F.col("key"), blocks)).join(words, "block").where(hit).select(
        *candidates.columns)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, url, host, path, rule (null if none fits), verdict: one row for each row of ``pages``.

    ``rules`` has the columns action, host, path. Unlisted URLs are allowed. Null, empty and malformed URLs have an
    empty host and are allowed; repeated pages each get a row; an empty list allows all; of fitting rules of equal
    length the one with the longer host wins, then ``allow``.
    """
    rules = rules.select("action", "host", "path", _key(F.col("host"), F.col("path")).alias("key")).groupBy(
        "key", "host", "path").agg(F.min("action").alias("action"))
    shape = rules.agg(F.count("*").alias("n"), F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
                      F.collect_set(F.length("path")).alias("lengths")).first()
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url")).select(
        "page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    if not shape["n"]:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    parts = F.split("host", r"\.")
    suffixes = [F.when(F.size(parts) >= c, F.array_join(F.slice(parts, -c, c), ".")) for c in sorted(shape["labels"])]
    prefixes = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(shape["lengths"])]
    candidates = (
        urls.select("host", "path").distinct()
        .select("host", "path", F.explode(F.array(*suffixes)).alias("suffix"))
        .where("suffix IS NOT NULL")
        .select("host", "path", "suffix", F.explode(F.array(*prefixes)).alias("prefix"))
        .where("prefix IS NOT NULL")
        .select("host", "path", _key(F.col("suffix"), F.col("prefix")).alias("key"))
    )
    listed = rules.select("key", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action")
    confirmed = possible_hits(candidates, rules.select("key"), shape["n"]).join(listed, "key")
    rule = F.concat("rule_host", "rule_path")
    best = confirmed.groupBy("host", "path").agg(F.max(F.struct(
        F.length(rule).alias("length"), F.length("rule_host").alias("host_length"),
        (F.col("action") == "allow").alias("allows"), rule.alias("rule"), F.col("action"))).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit("allow")).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "action string, host string, path string")
    return judge_urls(read_table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM cut
), split AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM split
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
