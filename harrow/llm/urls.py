"""URL filter: host-suffix and path-prefix expressions looked up by short hashes.

As in public safe-browsing lists, a URL is expanded into expressions (host suffix and
path prefix); those whose short hash is on the list are confirmed by their full digest,
and the longest rule that is left decides.  All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_HEX = 8      # hexadecimal digits of the digest that the join is on
DEFAULT = "allow"   # the verdict on a URL that no rule fits


def url_host(url: Column) -> Column:
    """Host: between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(rest, upper, lower), F.lit(""))


def url_path(url: Column) -> Column:
    """Path: what follows the host, up to ``?`` or ``#``; may be empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A blank line cannot stand in a host suffix, so the two parts cannot be confused.
    return F.sha2(F.concat(host, F.lit("\n\n"), path), 256)


def host_suffixes(host: Column) -> Column:
    """The host and every part of it after a dot, longest first; none of an empty host."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(suffixes)


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``urls`` with host, path, rule and verdict.

    ``rules`` has (host, path, verdict).  A rule fits its host and all subdomains if the
    URL's path starts with the rule's; the longest rule (host and path together) wins,
    then the longer host, then block before allow.  Rules with a null part are ignored.
    A null URL or one without ``://`` has an empty host and path, fits no rule and gets
    the default.  Repeated rows are judged each; columns of the names added are replaced.

    Paths are cut at the lengths that occur among the rules, so a URL has at most (labels
    of its host) x (such lengths) expressions.  They meet the rules on a short hash:
    small lists are broadcast, larger ones joined by shuffle, where Spark splits a hot
    hash.  The expressions of a URL are then reduced to its best rule before the shuffle.
    """
    rules = (rules.select("host", "path", "verdict").dropna()
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().sort(F.length("path")).collect()]
    lengths = F.array(*map(F.lit, lengths)).cast("array<int>")
    listed = rules.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"),
        F.col("verdict").alias("_verdict"), _digest(F.col("host"), F.col("path")).alias("_full"))
    listed = listed.withColumn("_short", F.substring("_full", 1, PREFIX_HEX))

    urls = urls.drop("host", "path", "rule", "verdict", "_row")
    kept = urls.columns
    parts = (urls.withColumn("_row", F.monotonically_increasing_id())
             .withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url"))))
    cuts = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                       lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(host_suffixes(F.col("host")), lambda h: F.transform(
        cuts, lambda p: _digest(h, p))))
    expanded = (parts.withColumn("_digest", F.explode_outer(expressions))
                .withColumn("_short", F.substring("_digest", 1, PREFIX_HEX)))
    met = expanded.join(listed, "_short", "left")
    fits = F.col("_full") == F.col("_digest")
    rank = F.struct((F.length("_host") + F.length("_path")).alias("total"),
                    F.length("_host").alias("own"), F.col("_verdict").alias("verdict"),
                    F.concat("_host", "_path").alias("rule"))
    best = F.max(F.when(fits, rank)).alias("_best")
    judged = met.groupBy("_row", *kept, "host", "path").agg(best)
    return judged.select(*kept, "host", "path", F.col("_best.rule").alias("rule"),
                         F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


# The rules of the query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.col("page_id").cast("long").alias("page_id"), "url")
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE_URLS = f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
split AS (SELECT row_number() OVER () AS r, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (SELECT r, page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
fit AS (SELECT r, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
    arg_max(r_verdict, length(r_host || r_path)) AS verdict
  FROM parts JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host))
    AND starts_with(path, r_path) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict
FROM parts LEFT JOIN fit USING (r)
"""

QUERIES = {"op4_url_filter": op4_url_filter}
ORACLE = {"op4_url_filter": ORACLE_URLS}
