"""Lines of files of any size, read split by split and numbered by sums over the splits before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.members import require_none
from ledgerloom.sources.checkpoints import written
from ledgerloom.sources.json_rows import is_strict_json


def _based(counts: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``counts`` with ``base``, the sum of ``n`` before each in its group: one small row a split or piece."""
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))


def numbered_file_lines(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    """source_path, line, raw of the lines with text of the files under ``path``; lines count from 1 in each file, blank ones included.

    With ``across`` they count on over the files in the order of their names, one small row a file.  Lines end with a line
    feed, a carriage return or both.  The lines are written once as they are dealt, since their places within a split are told by a
    running id of that deal; then every split adds what the splits before it hold."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw")
    )
    lines = written(raw, "lines")
    splits = _based(lines.groupBy("source_path", "split").agg(F.count("*").alias("n"), F.min("at").alias("first")), ["source_path"], ["split"])
    if across:
        files = splits.groupBy("source_path").agg(F.sum("n").alias("n"))
        files = files.withColumn("from", F.coalesce(F.sum("n").over(Window.orderBy("source_path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        splits = splits.join(files.select("source_path", "from"), "source_path").withColumn("base", F.col("base") + F.col("from"))
    placed = lines.join(splits.select("source_path", "split", "first", "base"), ["source_path", "split"])
    return placed.where(F.trim("raw") != "").select("source_path", (F.col("base") + F.col("at") - F.col("first") + 1).alias("line"), "raw")


def line_violations(lines: DataFrame, shape: str = "invalid_jsonl_shape") -> DataFrame:
    """code, subject (path:line) of ``lines`` (source_path, line, raw) that are no strict JSON, or no object."""
    d = F.try_parse_json("raw")
    code = F.when(~F.coalesce(is_strict_json(F.col("raw")), F.lit(False)), "invalid_jsonl").when(~F.startswith(F.schema_of_variant(d), F.lit("OBJECT")), shape)
    return lines.select(code.alias("code"), F.concat_ws(":", "source_path", F.col("line").cast("string")).alias("subject")).where("code is not null")


def candidate_rows(spark: SparkSession, path: str, max_bytes: int = 536_870_912) -> DataFrame:
    """source_path, line, d of the JSON-lines files under ``path``, each row an object, as VARIANT.  A file over ``max_bytes`` and a line that is none
    raise their code, before a row is given."""
    sizes = spark.read.format("binaryFile").load(path).select("path", "length")  # the listing: no content is read
    require_none(sizes.where(F.col("length") > max_bytes).select(F.lit("jsonl_size_limit").alias("code"), F.col("path").alias("subject")))
    lines = written(numbered_file_lines(spark, path), "candidate-lines")
    require_none(line_violations(lines))
    return lines.select("source_path", "line", F.parse_json("raw").alias("d"))


def numbered_piece_lines(pieces: DataFrame) -> DataFrame:
    """The same of ``pieces`` (source, path, piece, content), consecutive parts of members that end at line feeds.

    A piece within a line can't be read apart from the next and fails the job, so pieces bound the length of a line."""
    text = F.col("content").cast("string")
    last = F.max("piece").over(Window.partitionBy("source", "path"))
    torn = (F.col("piece") < F.col("last")) & ~F.endswith(text, F.lit("\n"))
    rows = pieces.withColumn("last", last).select(
        "source", "path", "piece", F.split(F.when(torn, F.raise_error(F.lit("jsonl_line_limit"))).otherwise(F.regexp_replace(text, "\r?\n\\z", "")), "\r\n|\n|\r").alias("lines")
    )
    rows = written(rows, "piece-lines")
    based = _based(rows.select("source", "path", "piece", F.size("lines").alias("n")), ["source", "path"], ["piece"]).select("source", "path", "piece", "base")
    each = rows.select("source", "path", "piece", F.posexplode("lines").alias("at", "raw")).join(based, ["source", "path", "piece"])
    return each.where(F.trim("raw") != "").select(F.col("path").alias("source_path"), (F.col("base") + F.col("at") + 1).alias("line"), "raw")

