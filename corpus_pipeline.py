"""Five stages from raw documents to packed training sequences.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last one returns the places of
the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.columns import unused
from ledgerloom.llm.decontaminate import contaminated
from ledgerloom.llm.line_dedup import dedup_chunks_and_passages
from ledgerloom.llm.minhash import near_duplicates
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.queries import tokenizer_path
from ledgerloom.llm.store import written
from ledgerloom.llm.toxicity import filter_toxic, fit


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the models, fitted on the labelled ones, do not call toxic."""
    return filter_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that stand earlier, and without the passages that an exact check after it still finds;
    n_chars follows the text."""
    cleaned = dedup_chunks_and_passages(docs).select(*(F.col(f"`{c}`") for c in docs.columns))
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    (kept_id,) = unused(docs.columns, "kept_id")
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias(kept_id))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    (found_id,) = unused(docs.columns, "found_id")
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias(found_id)).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(found_id)), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path(), keep_ids=False).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]
#: Scores, sketches and token ids are out of reach of SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
