"""URL rules by host-suffix and path-prefix expressions.

Each distinct (host, path) is expanded into the expressions ``host suffix + path prefix`` that a rule could equal: the
suffixes of as many labels as some rule has, and the prefixes of as many characters as some rule's path has. The
expressions meet the rules by equi-join on the first ``PREFIX_HEX`` hex digits of their SHA-256; the full digest then
confirms a hit, and the longest rule wins (of equally long ones the longer host, then ``block``).

Defined cases: a null url, or one without ``://``, has empty host and path and fits only a rule that is empty; urls
that fit no rule get the default verdict ``allow``; repeated rows and ids are each returned; other columns are ignored;
an empty rule table gives every url the default;
urls of any length are read whole; no pages give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, table

PREFIX_HEX = 8
#: host, path, verdict
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def split_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    url = F.coalesce("url", F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3)")).otherwise(F.lit(""))
    return (
        pages.select("page_id", rest.alias("rest"))
        .withColumn("raw", F.regexp_extract("rest", r"\A[^/?#]*", 0))
        .select("page_id", lower_ascii(F.col("raw")).alias("host"), F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), r"\A[^?#]*", 0).alias("path"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``rules`` has host, path and verdict."""
    rules = rules.select(
        F.sha2(F.concat("host", "path"), 256).alias("full"),
        F.col("verdict").alias("says"),
        F.concat("host", "path").alias("expression"),
        F.length("host").alias("host_len"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("path_len"),
    )
    # two small sets: label counts and path lengths that rules have
    shape = rules.agg(F.collect_set("labels").alias("labels"), F.collect_set("path_len").alias("lens")).first()
    urls = split_urls(pages)
    if not shape.labels:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    counts = ", ".join(map(str, sorted(shape.labels)))
    suffixes = F.expr(f"transform(filter(array({counts}), k -> k <= size(split(host, '[.]'))), k -> substring_index(host, '.', -k))")
    lens = F.array(*map(F.lit, sorted(shape.lens)))
    prefixes = F.transform(F.filter(lens, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    places = urls.select("host", "path").distinct()
    hits = (
        places.select("host", "path", F.explode(expressions).alias("tried"))
        .select("host", "path", F.sha2("tried", 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
        .join(rules.withColumn("short", F.substring("full", 1, PREFIX_HEX)), "short")
        .where(F.col("digest") == F.col("full"))
    )
    order = F.struct(F.length("expression"), "host_len", (F.col("says") == "block").cast("int"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("expression", "says"), order).alias("won"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("won.expression").alias("rule"), F.coalesce("won.says", F.lit(default)).alias("verdict")
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
), judged AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""
QUERIES = {"op5_url_filter": op5_url_filter}
ORACLES = {"op5_url_filter": ORACLE}
