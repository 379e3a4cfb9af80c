"""Private data and secrets in text: rules, and findings that carry hashes of matches only."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule, category, pattern.
RULES = [
    ("email_address", "privacy", "(?iu)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,128}@[A-Za-z0-9.-]{1,253}\\.[A-Za-z]{2,63}(?![A-Za-z0-9._%+-])"),
    ("openai_api_key", "secret", "(?<![A-Za-z0-9_-])sk-[A-Za-z0-9_-]{20,4096}"),
    ("github_token", "secret", "(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{20,1024}"),
    ("aws_access_key", "secret", "(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Z0-9])"),
    ("private_key_header", "secret", "-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"),
    ("bearer_token", "secret", "(?iu)(?<![A-Za-z0-9])Bearer[ \\t]{1,32}[A-Za-z0-9._~+/=-]{20,4096}"),
]


# The address without the guards around it: one before a full stop or behind another's end counts too.
BARE_EMAIL = ("email_address", "privacy", "(?iu)[A-Za-z0-9._%+-]{1,128}@[A-Za-z0-9.-]{1,253}\\.[A-Za-z]{2,63}")
# By pattern, strings of which each match holds one; a text without them is not searched.
HELD = {
    RULES[0][2]: ("@",),
    BARE_EMAIL[2]: ("@",),
    RULES[1][2]: ("sk-",),
    RULES[2][2]: ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    RULES[3][2]: ("AKIA", "ASIA"),
    RULES[4][2]: ("-----BEGIN ",),
}
HELD_IN_ANY_CASE = {RULES[5][2]: "bearer"}


def may_match(text: Column, pattern: str) -> Column:
    """False only where ``pattern`` can't match in ``text``; true of patterns that nothing is known of."""
    if pattern in HELD_IN_ANY_CASE:
        return F.contains(F.lower(text), F.lit(HELD_IN_ANY_CASE[pattern]))
    return functools.reduce(operator.or_, (F.contains(text, F.lit(h)) for h in HELD[pattern])) if pattern in HELD else F.lit(True)


def _hashed(text: Column, rule: str, category: str, pattern: str) -> Column:
    finding = lambda m: F.struct(F.lit(rule).alias("rule_id"), F.lit(category).alias("category"), F.sha2(m, 256).alias("sha256"))
    found = F.when(may_match(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return F.transform(found, finding)


def matches(text: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """Array of (rule_id, category, sha256) of every match in the whole text."""
    return F.concat(*(_hashed(text, *rule) for rule in rules))


def findings(texts: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """path, rule_id, category, sha256, occurrences of ``texts`` (path, text): counted map-side before the shuffle."""
    return texts.select("path", F.explode(matches(F.col("text"), rules)).alias("m")).groupBy("path", "m.rule_id", "m.category", "m.sha256").agg(F.count("*").alias("occurrences"))


def rule_totals(found: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """rule_id, category, occurrences, files of every rule, those without findings included."""
    names = found.sparkSession.createDataFrame([r[:2] for r in rules], "rule_id string, category string")
    per_rule = found.groupBy("rule_id").agg(F.sum("occurrences").alias("occurrences"), F.countDistinct("path").alias("files"))
    return names.join(per_rule, "rule_id", "left").select("rule_id", "category", F.coalesce("occurrences", F.lit(0)).alias("occurrences"), F.coalesce("files", F.lit(0)).alias("files"))


def report(found: DataFrame) -> DataFrame:
    """Per path and rule: occurrences, and the matches' hashes with theirs, sorted."""
    return found.groupBy("path", "rule_id", "category").agg(
        F.sum("occurrences").alias("occurrences"), F.array_sort(F.collect_list(F.struct("sha256", "occurrences"))).alias("matches")
    )


def rule_hashes(spark, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """rule_id, category, rule_sha256, ruleset_sha256: each rule by the hash of its canonical JSON, and all of them, in order, by one."""
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], "place int, rule_id string, category string, pattern string")
    body = F.to_json(F.struct("category", "pattern", "rule_id"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", body.alias("body")))), lambda r: r["body"]), ",")
    one = rows.agg(F.sha2(F.concat(F.lit('{"rules":['), whole, F.lit("]}\n")), 256).alias("ruleset_sha256"))  # a stated list of a few rules
    return rows.select("rule_id", "category", F.sha2(F.concat(body, F.lit("\n")), 256).alias("rule_sha256")).crossJoin(one)
