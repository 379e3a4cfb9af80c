"""Private data and secrets in bytes of any length: overlapping windows as rows, each match counted where it starts.

A window owns a run of bytes and carries bytes before and behind it.  Matches that start in what it owns are its own, so the windows'
findings together are those of the whole value.  Bytes are read as Latin-1, so places are byte offsets wherever a window is cut."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.privacy import RULES, may_match

#: Bytes around what a window owns; no rule's match with its guards is longer.
SPAN = 8_192
WINDOW = 65_536
# The two letters beyond ASCII that equal an ASCII letter when case is ignored, as their bytes read as Latin-1.
WIDE_LETTERS = ("Å¿", "â\u0084ª")


def byte_windows(files: DataFrame, window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """path, start, lead, own, bytes of ``files`` (path, content binary): ``own`` bytes from ``start`` on, with up to
    ``span`` bytes before (``lead`` of them) and behind.  Null and empty contents have no window."""
    start = F.explode(F.sequence(F.lit(0), F.octet_length("content") - 1, F.lit(window)))
    rows = files.where(F.octet_length("content") > 0).select("path", "content", start.alias("start"))
    lead, left = F.least("start", F.lit(span)), F.octet_length("content") - F.col("start")
    return rows.select(
        "path", F.col("start").cast("bigint").alias("start"), lead.alias("lead"), F.least(left, F.lit(window)).alias("own"),
        F.substring("content", F.col("start") - lead + 1, lead + window + span).alias("bytes"),
    )


def piece_windows(pieces: DataFrame, span: int = SPAN) -> DataFrame:
    """The same of ``pieces`` (source, path, piece, piece_start, content), consecutive parts of members that are too large for one row.

    Each piece sends its first and last ``span`` bytes to its neighbours: a join of small rows on the piece's number.  A piece
    other than the last has ``span`` bytes at least, which is checked."""
    key, n = ["source", "path", "piece"], F.octet_length("content")
    heads = pieces.select("source", "path", (F.col("piece") - 1).alias("piece"), F.substring("content", F.lit(1), F.least(n, F.lit(span))).alias("behind"))
    tails = pieces.select("source", "path", (F.col("piece") + 1).alias("piece"), F.substring("content", F.greatest(n - span + 1, F.lit(1)), F.lit(span)).alias("before"))
    both = pieces.join(heads, key, "left").join(tails, key, "left")
    short = F.col("behind").isNotNull() & (n < span)
    whole = F.when(short, F.raise_error(F.lit("pieces shorter than the span"))).otherwise(F.concat(F.coalesce("before", F.lit(b"")), "content", F.coalesce("behind", F.lit(b""))))
    return both.select("path", F.col("piece_start").alias("start"), F.coalesce(F.octet_length("before"), F.lit(0)).alias("lead"), n.alias("own"), whole.alias("bytes"))


def over_bytes(pattern: str) -> tuple[str, str]:
    """``pattern`` for bytes read as Latin-1: without, and with the letters beyond ASCII that case brings in."""
    if not pattern.startswith("(?iu)"):
        return pattern, pattern
    plain = "(?i)" + pattern[len("(?iu)") :]
    return plain, re.sub(r"\[[^\]]*A-Z[^\]]*\]", lambda c: f"(?:{c.group()}|{'|'.join(WIDE_LETTERS)})", plain)


def _placed(text: Column, pattern: str) -> Column:
    """Array of (at, m): the matches in ``text`` and where they start, from the lengths of what stands between them."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    none = F.array().cast("array<struct<at:int,m:string>>")
    add = lambda state, x: F.struct(
        (state["to"] + F.length(x["gap"]) + F.length(x["m"])).alias("to"), F.concat(state["all"], F.array(F.struct((state["to"] + F.length(x["gap"])).alias("at"), x["m"].alias("m")))).alias("all")
    )
    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("m"))
    return F.when(F.size(found) > 0, F.aggregate(pairs, F.struct(F.lit(0).alias("to"), none.alias("all")), add)["all"]).otherwise(none)


def window_findings(windows: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """path, rule_id, category, sha256, occurrences of ``windows`` (path, lead, own, bytes), as ``privacy.findings`` gives them of whole values.

    They are equal unless matches touch each other without a gap over more than a window's lead: then a window can't tell where
    the first of them began.  A window that is there twice counts once for each (path, start)."""
    text = F.decode("bytes", "ISO-8859-1")
    wide = F.contains(F.col("t"), F.lit(WIDE_LETTERS[0])) | F.contains(F.col("t"), F.lit(WIDE_LETTERS[1]))
    each = []
    for rule, category, pattern in rules:
        plain, more = over_bytes(pattern)
        placed = _placed(F.col("t"), plain) if plain == more else F.when(wide, _placed(F.col("t"), more)).otherwise(_placed(F.col("t"), plain))
        placed = F.when(may_match(F.col("t"), pattern), placed).otherwise(F.array().cast("array<struct<at:int,m:string>>"))
        own = F.filter(placed, lambda x: (x["at"] >= F.col("lead")) & (x["at"] < F.col("lead") + F.col("own")))
        each.append(F.transform(own, lambda x: F.struct(F.lit(rule).alias("rule_id"), F.lit(category).alias("category"), F.sha2(F.encode(x["m"], "ISO-8859-1"), 256).alias("sha256"))))  # noqa: B023
    rows = windows.withColumn("t", text).select("path", F.explode(F.concat(*each)).alias("m"))
    return rows.groupBy("path", "m.rule_id", "m.category", "m.sha256").agg(F.count("*").alias("occurrences"))
