"""URL filters: host-suffix and path-prefix expressions joined to rules, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.shared import LOWER, UPPER, materialize, n_partitions, small

#: Hex digits of the digest that the join uses; the full digest is compared after it.
PREFIX = 8
#: What a url that no rule fits gets.
DEFAULT = "allow"

#: The rules of query op10_url_filter: verdict, host, path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first "://" up to /, ? or #, with A-Z lower-cased; then up to ? or #."""
    part = lambda n: F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)([^?#]*)", n), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """Judges each url by the longest rule that fits.

    Returns a row for each row of pages: page_id, host, path, rule (host and path of the rule, else
    null), verdict. A rule fits its host and all subdomains, if the url's path starts with the rule's.
    The longest host and path together win, then the longer host, then block over allow.

    Each different host and path is expanded into every suffix of its host at a dot, times every prefix
    of its path whose length some rule has. The expressions' digests meet the rules' by an equi-join on
    their first hex digits; equal prefixes are then confirmed on the full digests. Rules are broadcast
    if they are few, else the short digests are shuffled.

    A null url, and one without "://", has an empty host and path, which no rule fits. Very long urls and rules are
    compared whole. Rules with a null field are refused. Rules given twice count once, and without rules every url gets
    the default. Repeated pages are judged each, and an empty table gives an empty result. Columns of pages
    other than the two aren't read.
    """
    digest = lambda host, path: F.sha2(F.concat(host, F.lit("\n"), path), 256)
    fails = F.col("host").isNull() | F.col("path").isNull() | F.col("verdict").isNull()
    rules = rules.select(
        F.when(fails, F.raise_error(F.lit("a rule lacks a field"))).otherwise(F.translate("host", UPPER, LOWER)).alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    ).distinct()
    # So many different lengths need rules of half their square of characters: a gigabyte of rules has 45,000 at most.
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    tried = F.split(F.lit(",".join(map(str, lengths))), ",").cast("array<int>") if lengths else F.array().cast("array<int>")
    table = materialize(rules.withColumn("rule_digest", digest(F.col("rule_host"), F.col("rule_path"))).withColumn("key", F.substring("rule_digest", 1, PREFIX)), "rules")

    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    # Pages of a popular url are dealt to several tasks, each of which hears its rule once; urls without a host need none.
    n = n_partitions(pages.sparkSession)
    dealt = parts.filter("host <> ''").withColumn("g_part", F.pmod(F.xxhash64("page_id"), F.lit(n)))
    asked = dealt.select("host", "path", "g_part").distinct()
    different = asked.select("host", "path").repartition(n, "host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    prefixes = F.transform(F.filter(tried, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = (
        different.select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(prefixes).alias("prefix"))
        .withColumn("digest", digest(F.col("suffix"), F.col("prefix")))
        .withColumn("key", F.substring("digest", 1, PREFIX))
    )
    order = F.struct((F.length("rule_host") + F.length("rule_path")).alias("a"), F.length("rule_host").alias("b"), (F.col("verdict") == "block").alias("c"))
    fitting = (
        expressions.join(small(table), "key")
        .filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), order).alias("best"))
    )
    told = dealt.join(asked.join(fitting, ["host", "path"]), ["host", "path", "g_part"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    return told.unionByName(parts.filter("host = ''").select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark, RULES))


ORACLE = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT DISTINCT host, path FROM p),
b AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM p LEFT JOIN b ON p.host = b.host AND p.path = b.path
"""
