"""Plain distributed prefix doubling: every byte position is ranked, and ranks are paired at growing offsets.

``suffix_dedup`` gives the same strings at a fraction of the shuffle; this is the method as it is usually told, kept for
comparison (figures in the README) and as a second opinion in tests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.rolling import fingerprints, prefix_sums
from ledgerloom.llm.store import dropped, written

PIECE = 1 << 18  # positions of one text that are ranked at a time


def _base_ranks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text").cast(pa.binary()), batch.column("doc_id").to_pylist()
            for doc_id, cell in zip(ids, texts):
                data = np.frombuffer(cell.as_py() or b"", dtype=np.uint8)
                for base in range(0, max(len(data) - size + 1, 0), PIECE):
                    sums = prefix_sums(data[base : base + PIECE + size - 1])
                    at = np.arange(len(sums) - size)
                    ranks = fingerprints(sums, at, at + size).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(at), pa.int64()), pa.array(at + base), pa.array(ranks)], names=["doc_id", "at", "rank"])

    return run


def _open(positions: DataFrame, *pair: str) -> DataFrame:
    """``positions`` whose ``pair`` occurs again, with a new rank: the first position of all that share it."""
    again = positions.groupBy(*pair).agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at")).alias("first")).where("n > 1")
    return positions.join(again, list(pair)).select("doc_id", "at", F.xxhash64("first.doc_id", "first.at").alias("rank"))


def repeated_starts(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, at) of every string of ``length`` bytes that also starts elsewhere; unique doc_ids, texts as UTF-8, null: empty.

    A position stays open while its rank is shared.  A longer string repeats only if the strings at both of its ends do, so
    each round pairs open positions with open ones.  Texts shorter than ``length`` and empty tables give nothing."""
    sizes = [length]
    while sizes[-1] > 32:
        sizes.append(-(-sizes[-1] // 2))
    sizes.reverse()
    ranked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_base_ranks(sizes[0]), "doc_id long, at long, rank long")
    kept, path = written(_open(ranked, "rank"), "doubling")
    for size, longer in zip(sizes, sizes[1:]):
        ahead = kept.select("doc_id", (F.col("at") - (longer - size)).alias("at"), F.col("rank").alias("next"))
        paired, old = kept.join(ahead, ["doc_id", "at"]), path
        kept, path = written(_open(paired, "rank", "next"), "doubling")
        dropped(docs.sparkSession, old)
    return kept.select("doc_id", "at")
