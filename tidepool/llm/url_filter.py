"""URL rules matched by hashed host-suffix and path-prefix expressions.

Each distinct (host, path) expands to ``host suffix + path prefix`` strings,
at the label counts and path lengths that occur among the rules; a rule can
fit only if its own string is one of them.  Expressions and rules meet in an
equi-join on the first four bytes of their SHA-256, the full digest confirms,
and the longest confirmed rule wins.  Everything is built-in functions.

Scale: pages are reduced to distinct (host, path) before anything is
expanded; both joins are plain equi-joins, so the rule side is broadcast only
if Spark finds it below its size threshold, and the skew join splits a hot
expression otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, unused

DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """The input rows with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (nulls count as empty).
    A rule fits its host and all subdomains if the url's path starts with its
    path.  The longest rule (characters of host and path) wins, then the one
    with the longer host, then ``block`` before ``allow``.  ``rule`` is the
    winner's host and path, null if none fits; ``verdict`` is the winner's or
    ``default``.  A url that is null or has no ``://`` has an empty host and
    path.  Input columns named like a result column are replaced; repeated
    rows stay repeated.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    at = pages.select(*keep, url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))

    rules = rules.select(F.coalesce("host", F.lit("")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"),
                         F.col("verdict").alias("r_verdict")).distinct()
    # the expressions worth making: bounded by the longest host and path among the rules
    shape = rules.agg(F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"),
                      F.collect_set(F.char_length("r_path")).alias("lengths")).first()
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])
    rules = rules.withColumn("digest", _digest(F.concat("r_host", "r_path"))).withColumn("short", F.substring("digest", 1, 8))

    def numbers(xs: list[int]) -> Column:
        return F.array(*map(F.lit, xs)).cast("array<int>")

    n_labels = F.size(F.split("host", r"\."))
    expressions = (
        at.select("host", "path").distinct()
        .select("host", "path", F.explode(F.filter(numbers(labels), lambda n: n <= n_labels)).alias("n"))
        .select("host", "path",
                F.expr("substring_index(host, '.', -n)").alias("suffix"),
                F.explode(F.filter(numbers(lengths), lambda n: n <= F.char_length("path"))).alias("m"))
        .select("host", "path", _digest(F.concat("suffix", F.expr("substring(path, 1, m)"))).alias("e_digest"))
        .withColumn("short", F.substring("e_digest", 1, 8)))

    best = F.max(F.struct((F.char_length("r_host") + F.char_length("r_path")).alias("size"),
                          F.char_length("r_host").alias("host_size"),
                          (F.col("r_verdict") == "block").alias("blocks"),
                          F.concat("r_host", "r_path").alias("rule"),
                          F.col("r_verdict").alias("verdict"))).alias("best")
    winners = (expressions.join(rules, "short").where(F.col("e_digest") == F.col("digest"))
               .groupBy("host", "path").agg(best)
               .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("r_verdict")))

    won = unused(pages, "verdict")
    return (at.join(winners.withColumnRenamed("r_verdict", won), ["host", "path"], "left")
            .select(*keep, "host", "path", "rule", F.coalesce(won, F.lit(default)).alias("verdict")))
