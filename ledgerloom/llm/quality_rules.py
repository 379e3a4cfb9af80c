"""Quality rules as a short-circuit cascade of native expressions.

Each rule rejects a text by one condition over its words, lines or characters.  What only a rule asks for is computed in its
branch of the cascade, so a text that an earlier rule rejects never pays for it.  One job over a bounded sample, drawn from all rows,
counts each rule's rejections and the characters, lines and words that it would go through; the cascade tries the rules by rejections per cost.
The verdict does not depend on the order, only the work does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.columns import unused

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 1_000
SEED = 7
# seconds that a rule takes for a row by itself, and for each character that it goes through with a pattern
COMPARISON, CHARACTER = 1e-8, 1e-8


@dataclass(frozen=True)
class Rule:
    """``reject`` is a boolean column over ``text`` and what ``with_features`` adds; null does not reject.  ``reads`` is how many
    characters of a row it goes through: the whole text if nothing else is said, none for a comparison of features."""

    name: str
    reject: Column
    reads: Column = field(default_factory=lambda: F.length(F.coalesce("text", F.lit(""))))


@dataclass(frozen=True)
class Measured:
    """A rule with its share of rejections and its estimated seconds a row on the sample."""

    rule: Rule
    share: float
    seconds: float


def lines() -> Column:
    """The \\n-split lines of ``text`` that hold a word."""
    return F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.regexp_replace(line, SPACES, "") != "")


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` (text) with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long).

    Words are runs outside ``\\x20 \\x09-\\x0D`` of the whole text; a null text has none of anything.  Repeated words stand in
    5-word windows that occur twice or more in the text.  Columns of ``docs`` with these names are replaced.
    """
    text = F.coalesce("text", F.lit(""))
    hashes, own_lines, windows, ordered, places = unused(docs.columns, "hashes", "lines", "windows", "sorted", "places")
    staged = docs.withColumns(
        {
            hashes: F.transform(F.array_remove(F.split(text, SPACES), ""), lambda w: F.xxhash64(w)),
            "word_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            own_lines: lines(),
        }
    )
    n = F.size(hashes)
    staged = staged.withColumns(
        {
            "n_words": n.cast("long"),
            "n_lines": F.size(own_lines).cast("long"),
            "n_dup_lines": (F.size(own_lines) - F.size(F.array_distinct(own_lines))).cast("long"),
            windows: F.when(
                n >= WINDOW,
                F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(WINDOW)))),
            ),
        }
    )
    # only texts with a repeated window pay for the sort that finds where
    staged = staged.withColumn(
        ordered,
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
        ),
    )
    same = lambda e, k: F.coalesce(F.get(ordered, k)["w"] == e["w"], F.lit(False))
    staged = staged.withColumn(places, F.sort_array(F.array_compact(F.transform(ordered, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"])))))
    covered = F.aggregate(
        F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b
    )
    return staged.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(hashes, own_lines, windows, ordered, places)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Limits that invented and natural prose keep well within; each is a whole-number comparison."""
    none = F.lit(0)
    bullets = F.size(F.regexp_extract_all("text", F.lit("(?md)^[\\x20\\x09\\x0B-\\x0D]*[-*\u2022]"), F.lit(0)))
    plain = F.size(F.regexp_extract_all("text", F.lit("(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D\\p{L}]++(?![^\\x20\\x09-\\x0D])"), F.lit(0)))
    return [
        Rule("symbols", 100 * F.col("n_symbols") > 20 * F.col("n_words"), none),
        Rule("capitals", 100 * F.length(F.regexp_replace("text", "\\P{Lu}+", "")) > 50 * F.col("word_chars")),
        Rule("short words", F.col("word_chars") < 2 * F.col("n_words"), none),
        Rule("long words", F.col("word_chars") > 15 * F.col("n_words"), none),
        Rule("repeated lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"), none),
        Rule("bullets", 100 * bullets > 90 * F.col("n_lines")),
        Rule("words without letters", 100 * plain > 40 * F.col("n_words")),
    ]


def measured(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Each rule alone, on about ``sample_rows`` rows of ``docs`` (text) drawn over the whole table (all rows of a smaller one): its share of
    rejections, and its seconds a row by what it reads.

    The rows are counted first, then every row is drawn with the same probability, so no task has more than its share of the
    sample; one aggregate of one row counts everything.  No clock is read."""
    drawn = docs.select("text").sample(fraction=min(1.0, sample_rows / max(docs.count(), 1)), seed=SEED)
    parts = [c for i, rule in enumerate(rules) for c in (F.count_if(F.coalesce(rule.reject, F.lit(False))).alias(f"r{i}"), F.sum(rule.reads).cast("double").alias(f"c{i}"))]
    counts = with_features(drawn).agg(F.count("*").alias("n"), *parts).first()
    rows = max(counts["n"], 1)
    return [Measured(rule, counts[f"r{i}"] / rows, COMPARISON + CHARACTER * (counts[f"c{i}"] or 0) / rows) for i, rule in enumerate(rules)]


def cascade_order(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejections per estimated second on a sample of ``docs`` (text)."""
    return [m.rule for m in sorted(measured(docs, rules, sample_rows), key=lambda m: -m.share / m.seconds)]


def judge_quality(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the features, ``base_failed`` and ``kept``.

    A row is kept unless the base rule or one of ``rules`` rejects it; the rules are tried in the measured order and the
    first that rejects ends the row.  An empty table gives an empty result; a null text has no words and fails the base
    rule.  Extra columns stay, but for those of the names that this adds (the features, base_failed, kept), which are replaced.
    """
    rules = default_rules() if rules is None else rules
    failed = F.lit(False)
    for rule in reversed(cascade_order(docs, rules, sample_rows)):
        failed = F.when(rule.reject, True).otherwise(failed)
    return with_features(docs).withColumn("base_failed", base_failed()).withColumn("kept", ~F.when(F.col("base_failed"), True).otherwise(failed))
