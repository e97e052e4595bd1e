"""URL filter: rules on hosts and path prefixes (DataFrame functions only).

A rule is ``host/path`` with a verdict. It fits its host and all subdomains if
the url's path starts with the rule's path (which begins with ``/``). Each url
is expanded into host-suffix + path-prefix expressions, only of the shapes
(labels, path length) that occur among the rules; expressions and rules are
joined on the first 32 bits of their SHA-256, then the full digests are
compared, and of the rules that fit the longest wins (of equal rules with
different verdicts, block).

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased (port and user stay part of it); the path is what follows
up to ``?``, ``#`` or the end. A null url or one without ``://`` has an empty
host and path and gets the default verdict. Rows stay rows, whatever page_id.
The rules' side is planned by its size: a small list is broadcast by the
optimizer, a large one is shuffled by the short prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Hex digits of the digest that are joined on.
SHORT = 8


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """rule, verdict -> one row per rule with its digest, shape and rank."""
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)")
    df = rules.filter(F.col("rule").isNotNull()).select("rule", "verdict", host.alias("h"), path.alias("p"))
    digest = F.sha2(F.concat("h", F.lit(" "), "p"), 256)
    return df.select(
        "rule", "verdict", digest.alias("digest"), F.substring(digest, 1, SHORT).alias("short"),
        F.size(F.split("h", "\\.")).alias("labels"), F.length("p").alias("path_length"),
        F.length("rule").alias("length"), (F.col("verdict") == "block").cast("int").alias("blocks"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id") -> DataFrame:
    """key, host, path, rule (null: none fits) and verdict of every page."""
    ready = prepared_rules(rules)
    # Numbers only, and as many as there are different shapes of rules.
    shapes = sorted((r[0], r[1]) for r in ready.select("labels", "path_length").distinct().collect())
    pages = pages.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key), host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"))
    labels = F.split("host", "\\.")
    forms = [
        F.when((F.size(labels) >= k) & (F.length("path") >= n),
               F.sha2(F.concat(F.array_join(F.slice(labels, -k, k), "."), F.lit(" "), F.substring("path", 1, n)), 256))
        for k, n in shapes
    ]
    found = pages.withColumn(
        "_digest", F.explode_outer(F.filter(F.array(*forms), lambda d: d.isNotNull())) if forms else F.lit(None).cast("string"))
    found = found.withColumn("_short", F.substring("_digest", 1, SHORT))
    side = ready.select(F.col("short").alias("_short"), F.col("digest").alias("_full"),
                        F.struct("length", "blocks", "rule", "verdict").alias("_fit"))
    met = found.join(side, "_short", "left")
    fit = F.when(F.col("_digest") == F.col("_full"), F.col("_fit"))
    best = met.groupBy("_row", key, "host", "path").agg(F.max(fit).alias("_best"))
    return best.select(key, "host", "path", F.col("_best.rule").alias("rule"),
                       F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))
