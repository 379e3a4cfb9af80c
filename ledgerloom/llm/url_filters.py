"""URL rules by host suffix and path prefix, found by hash-prefix equi-join.

Every URL's expressions (a suffix of its host with a prefix of its path, of the sizes that some rule has) meet the rules
on the first hex digits of their digests; the full digest confirms a rule, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8
BROADCAST_RULES = 50_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path up to ``? #``.  Both are empty without one."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id") -> DataFrame:
    """id, host, path, rule, verdict for every row of ``pages`` (id, url; more columns are ignored).

    ``rules`` holds (rule, verdict); a rule is a host, then a path from its first ``/`` on.  It fits its host and every
    subdomain, for paths that start with its own.  The longest rule wins; of equal lengths the one with the longer host,
    then ``block``.  A URL that no rule fits, or that is null or has no ``://``, gets ``default`` and a null rule.  No
    rules at all: everything gets the default.  Up to 50,000 rules are broadcast, more are shuffled on the hash prefix.
    """
    slash = F.instr("rule", "/")
    cut = F.when(slash > 0, slash - 1).otherwise(F.length("rule"))
    rules = (
        rules.where("rule is not null")
        .select("rule", "verdict", F.translate(F.substring("rule", F.lit(1), cut), UPPER, LOWER).alias("rule_host"), F.substring("rule", cut + 1, F.length("rule")).alias("rule_path"))
        .distinct()
    )
    shapes = rules.agg(
        F.collect_set(F.size(F.split("rule_host", "\\."))).alias("labels"), F.collect_set(F.length("rule_path")).alias("lengths"), F.count("*").alias("n")
    ).first()  # numbers of labels and path lengths that occur: bounded by what hosts and paths can be
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    if not shapes["n"]:
        return urls.select(id_column, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    n_labels = F.size(F.split("host", "\\."))
    suffixes = F.array(*(F.when(n_labels >= k, F.substring_index("host", ".", -k)) for k in sorted(shapes["labels"])))
    prefixes = F.array(*(F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in sorted(shapes["lengths"])))
    expressions = (
        urls.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .where("suffix is not null and prefix is not null")
        .withColumn("digest", _digest(F.concat("suffix", "prefix")))
        .select("host", "path", "digest", F.substring("digest", 1, PREFIX_DIGITS).alias("short"))
    )
    keyed = rules.withColumn("rule_digest", _digest(F.concat("rule_host", "rule_path"))).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    keyed = F.broadcast(keyed) if shapes["n"] <= BROADCAST_RULES else keyed
    order = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), F.col("verdict") == "block")
    best = (
        expressions.join(keyed, "short")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    )
    return urls.join(best, ["host", "path"], "left").select(
        id_column, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
