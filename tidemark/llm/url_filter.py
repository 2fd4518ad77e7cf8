"""URL allow/block lists behind a blocked Bloom filter (DataFrame operations only).

Each url is split into host and path, and every (host suffix, path prefix)
pair that a listed entry could equal is looked up: first in a blocked Bloom
filter, one 64-bit block per key, so a lookup costs one read; the few pairs
that pass then meet the list itself in an exact hash join, which removes the
false positives. Of several fitting entries the longest wins.

Path prefixes are tried only at lengths that occur in the list, so a url makes
(host labels) x (distinct listed path lengths) candidates, whatever the size of
the list.

Null or odd urls: without ``://`` host and path are empty, no entry fits and the
default verdict is given; such rows take part in no join. Of fitting entries of
one length the one of the greater text (host, space, path) wins; of one entry
listed twice the verdict first in the alphabet. Long urls are looked at whole.
Rows are judged each on their own, extra columns are ignored; an empty table
gives an empty result; an empty list gives the default to all. Verdicts of the
distinct (host, path) pairs are written before the pages are joined to them, so
Spark can split the rows of a pair that very many pages have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpointed

#: Blocks of 64 bits; about 16 bits for each listed entry.
BITS_PER_ENTRY = 16
#: Bits set in its block by each entry.
PROBES = 4

RULES_SCHEMA = T.StructType([T.StructField("rule_host", T.StringType()), T.StructField("rule_path", T.StringType()), T.StructField("rule_verdict", T.StringType())])


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _mask(key: Column) -> Column:
    """The bits of a key inside its block."""
    bits = F.lit(0).cast("long")
    for i in range(PROBES):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(key, F.lit(i)), F.lit(64)).cast("int")))
    return bits


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row (block, bits) for each block that a key of ``keys`` falls into."""
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(F.bit_or(_mask(F.col(key))).alias("bits"))


def filter_urls(pages: DataFrame, rules: DataFrame, *, url_col: str = "url", id_col: str = "page_id", default: str = "allow") -> DataFrame:
    """Judge ``pages`` by ``rules`` (rule_host, rule_path, rule_verdict).

    Returns id_col, host, path, rule, verdict. Joins are left to Spark's own
    size checks; a list too large to broadcast is joined by shuffle.
    """
    rules = rules.filter("rule_host is not null and rule_path is not null").withColumn("key", F.concat("rule_host", F.lit(" "), "rule_path")).groupBy("key").agg(F.first("rule_host").alias("rule_host"), F.first("rule_path").alias("rule_path"), F.min("rule_verdict").alias("rule_verdict"))
    shape = rules.agg(F.count("*").alias("n"), F.collect_set(F.length("rule_path")).alias("lengths")).first()
    blocks = max(1, -(-shape["n"] * BITS_PER_ENTRY // 64))
    lengths = sorted(shape["lengths"]) or [0]
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # Verdicts depend on host and path alone: each distinct pair is looked up once.
    places = urls.filter("host <> ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    tried = places.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes)).withColumn("key", F.concat("suffix", F.lit(" "), "prefix"))
    passed = tried.withColumn("block", _block(F.col("key"), blocks)).withColumn("mask", _mask(F.col("key"))).join(bloom_filter(rules, "key", blocks), "block").filter("(bits & mask) = mask")
    hits = passed.join(rules, "key").groupBy("host", "path").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), F.struct(F.length(F.col("rule_host")) + F.length(F.col("rule_path")), F.col("key"))).alias("hit"))
    hits = checkpointed(hits)
    hosted = urls.filter("host <> ''").join(hits, ["host", "path"], "left")
    judged = hosted.unionByName(urls.filter("host = ''"), allowMissingColumns=True)
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"), F.coalesce(F.col("hit.verdict"), F.lit(default)).alias("verdict"))


#: The listed entries of the registered query: verdict, host, path.
LISTED = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def op4_url_filter(spark, sf_dir):
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for v, h, p in LISTED)
    rules = spark.sql(f"SELECT * FROM VALUES {listed} AS rules(rule_host, rule_path, rule_verdict)")
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


ORACLE_SQL = """
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(verdict, h, p) AS (VALUES ('allow','org','/'),('block','example.org','/es/'),('block','example.org','/en/1'),('allow','com','/fr/'),('block','com','/de/')),
j AS (
  SELECT u.*, r.h || r.p AS rule, r.verdict AS v,
    row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.h || r.p) DESC NULLS LAST) AS k
  FROM u LEFT JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM j WHERE k = 1
"""
