"""What becomes of documents: their text is taken where a reader for it is fixed, else the original is kept or told by its hash."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.docx import extract_documents

# Fixed value: the one format whose reader is fixed.
READABLE = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"


@dataclass(frozen=True)
class DocumentPolicy:
    """``by_cause``: reasons tell why a text was not taken (four causes); without it they have one reason."""

    extract_text: bool = True
    max_extract: int = 26_214_400
    keep_under: int = 26_214_400
    by_cause: bool = False


def asked(policy: DocumentPolicy) -> Column:
    """Whether a document's (media_type, size_bytes) text is to be taken."""
    return F.lit(policy.extract_text) & F.col("media_type").eqNullSafe(READABLE) & (F.col("size_bytes") <= policy.max_extract)


def document_texts(decided: DataFrame, policy: DocumentPolicy = DocumentPolicy()) -> DataFrame:
    """path, text, problem of the documents among ``decided`` whose text is asked for."""
    return extract_documents(decided.where("decision = 'extract'").where(asked(policy)))


def settled_documents(decided: DataFrame, texts: DataFrame, policy: DocumentPolicy = DocumentPolicy()) -> DataFrame:
    """``decided`` (path, decision, reason, media_type, size_bytes) with what documents came to, and ``extraction_error``.

    A document whose text was taken stays ``extract``.  Another is kept whole up to ``keep_under`` bytes, with the cause as its reason, and
    tombstoned beyond."""
    known = texts.select("path", F.col("problem").alias("extraction_error"), F.lit(True).alias("_read"))
    both = decided.join(known, "path", "left")
    document = F.col("decision") == "extract"
    taken = document & F.col("_read").isNotNull() & F.col("extraction_error").isNull()
    cause = (
        F.when(F.col("extraction_error").isNotNull(), "document_retained_extractor_error").when(F.lit(not policy.extract_text), "document_retained_text_extraction_disabled")
        .when(~F.col("media_type").eqNullSafe(READABLE), "document_retained_no_frozen_extractor").otherwise("document_retained_over_extract_limit")
    )
    kept = F.col("size_bytes") <= policy.keep_under
    fallback = cause if policy.by_cause else F.lit("document_retained_no_frozen_extraction")
    decision = F.when(document & ~taken, F.when(kept, "keep").otherwise("tombstone")).otherwise(F.col("decision"))
    reason = F.when(taken, "document_text_extracted").when(document, F.when(kept, fallback).otherwise("document_over_retention_limit")).otherwise(F.col("reason"))
    return both.withColumns({"decision": decision, "reason": reason}).drop("_read")


def retained(decided: DataFrame, policy: DocumentPolicy = DocumentPolicy()) -> DataFrame:
    """The members of ``decided`` whose bytes are kept: those decided so, and originals of texts that are small enough."""
    return decided.where((F.col("decision") == "keep") | (F.col("decision") == "extract") & (F.col("size_bytes") <= policy.keep_under))
