"""Benchmark decontamination by SimHash windows, a multi-index over Hamming blocks, and exact verification.

For each benchmark item, windows of as many shingles as the item has slide over every text.  A window's fingerprint is
the sign of the summed bit vectors of its shingles.  The 64 bits are cut into ``RADIUS + 1`` blocks: two fingerprints
within the radius agree on at least one block, so looking up each block's value finds all of them.  A candidate window
is confirmed by the exact weighted Jaccard similarity of its five-word shingles, each weighing as often as it occurs.

A window can only reach the threshold if it shares a shingle with the item, so windows that hold no shingle of any item
are skipped before they are fingerprinted; nothing is lost by that.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.columns import unused
from ledgerloom.llm.rolling import mix
from ledgerloom.llm.words import WIDTH, shingle_hashes, text_chunks, word_hashes

BITS = 64
RADIUS = 23  # four standard deviations beyond the distance expected at a similarity of 0.75
ITEM_BLOCK = 2_000  # items that one pass over the documents carries
ITEM_BYTES = 16 << 20  # and bytes of their texts
NEAR = 1 << 15  # places of a text whose windows are fingerprinted together


class ItemIndex:
    """Items' shingles, fingerprints and block tables; bounded by the size of one block of items."""

    def __init__(self, ids: list[int], texts: list[str]):
        shingles, bounds = [], [0]
        for _, _, data, offsets in text_chunks(pa.array(texts, pa.string())):
            s, b = shingle_hashes(*word_hashes(data, offsets))
            shingles.append(s)
            bounds += (b[1:] + bounds[-1]).tolist()
        flat = np.concatenate(shingles) if shingles else np.zeros(0, np.uint64)
        self.ids = np.array(ids, dtype=np.int64)
        self.counts = [Counter(flat[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
        self.sizes = np.diff(np.array(bounds, dtype=np.int64))
        self.vocabulary = np.unique(flat)
        sums = np.zeros((len(flat) + 1, BITS), dtype=np.int32)
        np.cumsum(signs(flat), axis=0, out=sums[1:])
        at = np.array(bounds, dtype=np.int64)
        self.prints = pack(sums[at[1:]] - sums[at[:-1]])
        edges = np.linspace(0, BITS, RADIUS + 2).round().astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edges, edges[1:])]
        self.widths = np.unique(self.sizes[self.sizes > 0])
        # by number of shingles: which items have each value in each block
        self.tables = {}
        for width in self.widths:
            own = np.flatnonzero(self.sizes == width)
            table = []
            for shift, mask in self.blocks:
                member = np.zeros((int(mask) + 1, len(own)), dtype=bool)
                member[((self.prints[own] >> shift) & mask).astype(int), np.arange(len(own))] = True
                table.append(member)
            self.tables[int(width)] = (own, table)

    def near(self, prints: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the print, item) of every pair within the radius, by block look-ups."""
        own, table = self.tables[width]
        candidate = np.zeros((len(prints), len(own)), dtype=bool)
        for (shift, mask), member in zip(self.blocks, table):
            candidate |= member[((prints >> shift) & mask).astype(np.int64)]
        at, item = np.nonzero(candidate)
        close = np.bitwise_count(prints[at] ^ self.prints[own][item]) <= RADIUS
        return at[close], own[item[close]]


def signs(shingles: np.ndarray) -> np.ndarray:
    """One row of 64 values of 1 and -1 for each shingle."""
    bits = np.unpackbits(mix(shingles).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints: a bit for each positive sum."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def weighted_similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Sums of the smaller and of the larger counts."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common, sum(a.values()) + sum(b.values()) - common


def _matches(index: ItemIndex, shingles: np.ndarray, gated: np.ndarray, percent: int) -> set[int]:
    """Items that some window of one text's shingles matches; ``gated``: places that hold a shingle of some item."""
    found: set[int] = set()
    wanted = set(range(len(index.ids)))
    marks = np.zeros(len(shingles) + 1, dtype=np.int64)
    marks[gated + 1] = 1
    np.cumsum(marks, out=marks)
    for width in index.widths.tolist():
        # the whole text where it is shorter than the window
        size = min(width, len(shingles))
        starts = np.unique(np.concatenate([gated - j for j in range(size)])) if size * len(gated) < 4 * len(shingles) else np.arange(len(shingles))
        starts = starts[(starts >= 0) & (starts <= len(shingles) - size)]
        starts = starts[marks[starts + size] > marks[starts]]
        at = 0
        while at < len(starts):
            # starts near each other: sums are held for the places between them, so far ones are no part of it
            part = starts[at : np.searchsorted(starts, starts[at] + NEAR)]
            at += len(part)
            low, high = part[0], part[-1] + size
            sums = np.zeros((high - low + 1, BITS), dtype=np.int32)
            np.cumsum(signs(shingles[low:high]), axis=0, out=sums[1:])
            prints = pack(sums[part - low + size] - sums[part - low])
            where, items = index.near(prints, width)
            shared = marks[part[where] + size] - marks[part[where]]
            good = 100 * shared >= percent * width  # common shingles are at most these, united ones at least the item's
            for start, item in zip(part[where[good]].tolist(), items[good].tolist()):
                if item in wanted and item not in found:
                    common, united = weighted_similarity(index.counts[item], Counter(shingles[start : start + size].tolist()))
                    if 100 * common >= percent * united:
                        found.add(item)
    return found


def _search(index: ItemIndex, percent: int):
    table = np.zeros(1 << 20, dtype=bool)
    table[(index.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows, items = [], []
            for first, last, data, offsets in text_chunks(batch.column("text")):
                shingles, bounds = shingle_hashes(*word_hashes(data, offsets))
                likely = np.flatnonzero(table[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)])
                hits = likely[np.isin(shingles[likely], index.vocabulary)] if len(index.vocabulary) else likely[:0]
                cuts = np.searchsorted(hits, bounds)
                for i in np.flatnonzero(np.diff(cuts)):
                    own = shingles[bounds[i] : bounds[i + 1]]
                    for item in sorted(_matches(index, own, hits[cuts[i] : cuts[i + 1]] - bounds[i], percent)):
                        rows.append(ids[first + i])
                        items.append(int(index.ids[item]))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(items, pa.int64())], names=["doc_id", "item_id"])

    return run


def item_blocks(benchmark: DataFrame, block: int = ITEM_BLOCK) -> Iterator[tuple[list[int], list[str]]]:
    """Items in order of their texts' digests, in blocks of bounded number and size; equal texts come once, under the
    smallest id."""
    items = (
        benchmark.where("text is not null").groupBy("text").agg(F.min(F.col("item_id").cast("long")).alias("item_id")).orderBy(F.sha2("text", 256), "item_id")
    )
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():
        if ids and (len(ids) >= block or size + len(row["text"].encode()) > ITEM_BYTES):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += len(row["text"].encode())
    if ids:
        yield ids, texts


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 75, block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_id, item_id) of every document of ``docs`` (doc_id, text) with a window that matches an item of
    ``benchmark`` (item_id, text) by 100 * common >= percent * united weighted shingles.

    Texts are lower-cased (A-Z) and cut into words; a text or item of fewer than five words has one shingle, its whole
    sequence.  A text shorter than an item is one window.  Null, empty and blank texts match nothing.  Items with equal
    texts report the smallest id.  A very long text takes memory for its hashes, some 30 bytes a word, and for the sums of
    ``NEAR`` places and an item.  The items travel with the tasks in blocks of at most 2,000, one pass over the
    documents each.
    """
    spark = docs.sparkSession
    found = None
    for ids, texts in item_blocks(benchmark, block):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_search(ItemIndex(ids, texts), percent), "doc_id long, item_id long")
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], "doc_id long, item_id long") if found is None else found.distinct()


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` with ``item_ids`` (sorted; empty if none), ``contaminated`` and ``kept``; rows of one doc_id (or of none)
    share their marks.  Columns of ``docs`` with the names of the three marks are replaced, all others stay."""
    own_id, found_items = unused(docs.columns, "own_id", "items")
    found = contaminated(docs, benchmark, percent).groupBy(F.col("doc_id").alias(own_id)).agg(F.sort_array(F.collect_set("item_id")).alias(found_items))
    items = F.coalesce(found_items, F.array().cast("array<bigint>"))
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col(own_id)), "left")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("item_ids", "contaminated", "kept")]
    return joined.select(*others, items.alias("item_ids"), (F.size(items) > 0).alias("contaminated"), (F.size(items) == 0).alias("kept"))
