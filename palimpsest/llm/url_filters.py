"""URL filters: host-suffix and path-prefix expressions against a rule list.

Each distinct (host, path) is expanded into expressions ``suffix + prefix``: every
suffix of the host at a dot, every path prefix as long as some rule's path.  An
expression meets the rules by equality of a 32-bit prefix of its SHA-256; the full
digest confirms, and the longest rule decides.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import table
from palimpsest.session import broadcast_if_small, inline_table

#: Fixed values of the contract: (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow") -> DataFrame:
    """keep columns + host, path, rule, verdict for every row of pages.

    rules has host, path, verdict (lower-case hosts).  A rule fits its host and all
    subdomains if the path starts with the rule's path.  The longest rule (host and
    path together) wins, then the one with the longer host, then the smaller verdict.
    Null urls and urls without ``://`` have an empty host and path, fit no rule and
    get the default, as does every row when there are no rules.  One row comes back
    per input row, repeated rows and null ids included.
    """
    rules = (
        rules.select(
            F.concat("host", "path").alias("rule"), F.length("host").alias("h"), F.length("path").alias("path_chars"),
            F.col("verdict").alias("decision"), _digest(F.concat_ws("\n", "host", "path")).alias("digest"),
        )
        .groupBy("rule", "h", "path_chars", "digest")
        .agg(F.min("decision").alias("decision"))
        .withColumn("short", _short(F.col("digest")))
    )
    seen = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    lengths = [r[0] for r in rules.select("path_chars").distinct().sort("path_chars").collect()]
    sites = seen.select("host", "path").filter("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")])
    expressions = (
        sites.withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(F.filter(F.array_distinct(prefixes), lambda x: x.isNotNull())))
        .select("host", "path", _digest(F.concat_ws("\n", "suffix", "prefix")).alias("full"))
        .withColumn("short", _short(F.col("full")))
    )
    hits = expressions.join(broadcast_if_small(rules), "short").filter("full = digest")
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "h", "rule")).alias("top"),
        F.min_by("decision", F.struct(-F.length("rule"), -F.col("h"), "decision")).alias("decision"),
    )
    return seen.join(best, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("top.rule").alias("rule"), F.coalesce("decision", F.lit(default)).alias("verdict")
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), inline_table(spark, "host, path, verdict", RULES))


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut
), urls AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM parts
), judged AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM urls
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
