"""Repeated multi-line chunks, cut at content-defined places.

A rolling hash over the hashes of two consecutive lines says where a chunk ends, so the same lines are cut alike wherever
they stand.  Chunks of two or more lines that occur again anywhere are removed, all but their first occurrence.

``dedup_passages`` looks up every window of two lines instead of the chunks that the hash cuts, so no repeated passage stays.
``dedup_chunks_and_passages`` removes both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.columns import unused
from ledgerloom.llm.store import written

DIVISOR = 3  # one line in this many ends a chunk
FACTOR = 31


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _chunks() -> Column:
    """Array of (first line, lines, text) of the column ``lines``, by the places in the column ``last``."""
    return F.transform(
        "last",
        lambda end, i: F.struct(
            F.coalesce(F.get("last", i - 1) + 1, F.lit(0)).alias("first_line"),
            (end - F.coalesce(F.get("last", i - 1), F.lit(-1))).alias("n_lines"),
        ),
    )


def _within_chunks(removed: str) -> Column:
    """How many rows of the array ``removed`` (first_line, n_lines, chunk) are no chunks and lie within one."""
    chunks = F.array_sort(F.filter(removed, lambda r: r["chunk"]))
    end = lambda c: F.coalesce(c["first_line"] + c["n_lines"], F.lit(0))
    # of each line up to the last chunk's end: the first line of its chunk, or -1
    chunk_of = F.flatten(F.transform(chunks, lambda c, i: F.concat(F.array_repeat(F.lit(-1), c["first_line"] - end(F.get(chunks, i - 1))), F.array_repeat(c["first_line"], c["n_lines"]))))
    inside = lambda r: ~r["chunk"] & (F.get(chunk_of, r["first_line"]) >= 0) & (F.get(chunk_of, r["first_line"]) == F.get(chunk_of, r["first_line"] + r["n_lines"] - 1))
    return F.size(F.filter(removed, inside))


def _without(docs: DataFrame, again: DataFrame) -> DataFrame:
    """``docs`` without the lines of ``again`` (doc_id, text_hash, first_line, n_lines), plus the three counts.  Where ``again`` says
    which of its rows are chunks (chunk), the others count unless they lie within one of these."""
    removed, own_id, own_hash, split = unused(docs.columns, "removed", "own_id", "own_hash", "lines")
    removals = again.groupBy(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).agg(F.collect_set(F.struct(*(c for c in ("first_line", "n_lines", "chunk") if c in again.columns))).alias(removed))
    joined = docs.join(removals, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash)), "left")
    gone = F.array_distinct(F.flatten(F.transform(removed, lambda r: F.sequence(r["first_line"], r["first_line"] + r["n_lines"] - 1))))
    counts = ("n_lines", "n_removed_lines", "n_removed_chunks")
    n_apart = F.size(removed) - (_within_chunks(removed) if "chunk" in again.columns else 0)
    rest = F.split("text", "\n")
    wanted = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(rest) - 1), gone))
    cleaned = F.when(F.col(removed).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(wanted, lambda i: F.get(split, i)), "\n")
    )
    return (
        joined.withColumn(split, F.when(F.col(removed).isNotNull(), rest))
        .select(
            *(cleaned.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in counts),
            F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
            F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed_lines"),
            F.coalesce(n_apart, F.lit(0)).cast("long").alias("n_removed_chunks"),
        )
    )


def _cut(docs: DataFrame, divisor: int) -> DataFrame:
    """doc_id, text_hash, lines, and the last line of each chunk."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines")).where("lines is not null")
    hashed = lines.withColumn("hashes", F.transform("lines", _line_hash))
    ends = F.transform(
        "hashes", lambda h, i: F.when(((F.coalesce(F.get("hashes", i - 1), F.lit(0)) * FACTOR + h) % divisor == 0) | (i == F.size("hashes") - 1), i)
    )
    return hashed.select("doc_id", "text_hash", "lines", F.array_compact(ends).alias("last"))


def _repeated_chunks(docs: DataFrame, divisor: int) -> DataFrame:
    """doc_id, text_hash, first_line, n_lines of the chunks that stand earlier."""
    chunks = (
        _cut(docs, divisor).select("doc_id", "text_hash", "lines", F.explode(_chunks()).alias("c"))
        .where("c.n_lines > 1")
        .select("doc_id", "text_hash", "c.first_line", "c.n_lines", F.array_join(F.slice("lines", F.col("c.first_line") + 1, F.col("c.n_lines")), "\n").alias("chunk"))
        .withColumn("key", F.xxhash64("chunk", F.octet_length("chunk")))
    )
    place = F.struct("doc_id", "text_hash", "first_line")
    firsts = chunks.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last_one")).where("first < last_one").select("key", "first")
    repeated, _ = written(chunks.join(firsts, "key"), "repeated-chunks")
    kept_bytes = repeated.where(place == F.col("first")).groupBy("key").agg(F.min("chunk").alias("kept_chunk"))
    again = repeated.where(place > F.col("first")).join(kept_bytes, "key").where(F.col("chunk") == F.col("kept_chunk"))
    return again.select("doc_id", "text_hash", "first_line", "n_lines")


def dedup_lines(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with a cleaned ``text``, plus ``n_lines``, ``n_removed_lines`` and ``n_removed_chunks``.

    Lines are the \\n-split parts of ``text``.  A chunk is removed if it has at least two lines and the same bytes stand
    as a chunk earlier: in a smaller doc_id, or before it in the same document.  What is left is joined by \\n; other columns
    stay as they are, but for those named as the three counts, which these replace.  A null text stays null and has no lines; an empty one has one empty line.  Rows that share a
    doc_id are told apart by ``text`` only, so repeated rows keep equal results.  doc_id may be null, which counts as
    the smallest.
    """
    return _without(docs, _repeated_chunks(docs, divisor))


def _repeated_windows(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, first_line, n_lines of the windows of two lines with text that stand earlier."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines")).where("lines is not null")
    filled = lines.withColumn("filled", F.array_compact(F.transform("lines", lambda line, i: F.when(F.rlike(line, F.lit("\\S")), i)))).where("size(filled) > 1")
    pairs = F.arrays_zip(F.expr("slice(filled, 1, size(filled) - 1)").alias("first_line"), F.expr("slice(filled, 2, size(filled) - 1)").alias("last_line"))
    window = lambda w: F.array_join(F.slice("lines", w["first_line"] + 1, w["last_line"] - w["first_line"] + 1), "\n")
    own = lambda w: F.struct(w["first_line"].alias("first_line"), (w["last_line"] - w["first_line"] + 1).alias("n_lines"), F.unhex(F.sha2(window(w), 256)).alias("key"))
    windows, _ = written(filled.select("doc_id", "text_hash", F.inline(F.transform(pairs, own))), "line-windows")
    place = F.struct("doc_id", "text_hash", "first_line")
    firsts = windows.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last_one")).where("first < last_one").select("key", "first")
    overlaps = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("first_line") < F.col("first.first_line") + F.col("n_lines"))
    return windows.join(firsts, "key").where((place > F.col("first")) & ~overlaps).select("doc_id", "text_hash", "first_line", "n_lines")


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without any line of a passage of two or more lines that stands earlier; columns as of ``dedup_lines``.

    A window is two lines with text and the blank ones between them, so blank lines alone are no passage.  It is removed if
    the same bytes (by SHA-256) stand earlier and do not overlap it: in a smaller doc_id, or before it in the same document.
    A longer passage goes line by line, as all its windows do.  A removed line's earlier copy is kept or has an earlier one
    itself, so every line stays once.  n_removed_chunks counts windows.  Null and repeated rows are taken as by ``dedup_lines``.
    """
    return _without(docs, _repeated_windows(docs))


def dedup_chunks_and_passages(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` without the chunks that ``dedup_lines`` removes; an exact check over windows of two lines, as in ``dedup_passages``,
    removes the repeated passages that the chunks' ends have cut.  Both are judged on the input, so what a removal brings
    together is no passage.  n_removed_chunks counts chunks, and windows that do not lie within one of these.

    Chunks and windows are written apart, so no plan holds both and the driver plans small ones."""
    chunks, _ = written(_repeated_chunks(docs, divisor), "chunks-again")
    windows, _ = written(_repeated_windows(docs), "windows-again")
    return _without(docs, chunks.withColumn("chunk", F.lit(True)).unionByName(windows.withColumn("chunk", F.lit(False))))
