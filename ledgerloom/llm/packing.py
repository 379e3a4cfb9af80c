"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Lengths are whole numbers from 1 to the capacity, so equal lengths are interchangeable and the packing is planned on
the histogram of lengths: at most ``capacity`` counts, whatever the input's size.  The plan takes lengths in falling
order; a segment tree over remaining capacities finds the tightest open bins in logarithmic time, and a run of equal
pieces fills a run of equal bins at once.  That is best-fit decreasing over all documents, not over shares of them.
Every piece then finds its place from its rank among the pieces of its length, which comes from prefix sums.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import dropped, written

CAPACITY = 2048
# Fixed value: the pre-tokeniser that byte-level vocabularies name by ``use_regex``.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones stand for themselves, the others
    follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of texts under a vocabulary file, without special tokens around them.

    A byte-level vocabulary whose ids follow the order of its merges is read as ranks by the faster of two libraries,
    with the same ids; any other file, and texts that hold an added token's content, go to the file's own library, which is
    loaded when first asked.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.added = [t["content"] for t in described.get("added_tokens") or []]
        self.ranks = self._ranks(described)

    @functools.cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @staticmethod
    def _ranks(described: dict):
        model, before = described["model"], described.get("pre_tokenizer") or {}
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        unusual = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model.get("type") != "BPE" or described.get("normalizer") or any(before.get(k) != v for k, v in usual.items()) or any(model.get(k) for k in unusual):
            return None
        merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        letters = byte_of_letter()
        if None in merged or any(a >= b for a, b in zip(merged, merged[1:])) or len(model["vocab"]) != len(letters) + len(merged):
            return None
        import tiktoken

        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        return tiktoken.Encoding("packing", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.ranks is None or any(t in text for t in self.added):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.ranks.encode_ordinary(text)


@functools.cache
def encoder(tokenizer_path: str) -> Encoder:
    """The worker's encoder of this vocabulary."""
    return Encoder(tokenizer_path)


def _tokenize(tokenizer_path: str, capacity: int, separator: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).ids
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = []
                some = batch.slice(at, 256)
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text")):
                    found = array("I", encode(text.as_py() or ""))
                    found.append(separator)
                    n, tokens = len(found), np.asarray(found, dtype="<u4").tobytes()
                    head = n % capacity or capacity
                    cuts = [0, *range(head, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        own = tokens[4 * a : 4 * b]
                        rows.append((doc_id, piece, a, b - a, zlib.crc32(own), part, int(seen[b - a]), own if keep_ids else None))
                        seen[b - a] += 1
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


class _OpenBins:
    """Runs of bins by remaining capacity, with a segment tree over the capacities that have any."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def put(self, left: int, first: int, n: int) -> None:
        if n and left:
            self.runs[left].append((first, n))
            node = left + self.size
            while node and not self.any[node]:
                self.any[node] = 1
                node //= 2

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` that an open bin has."""
        node = length + self.size
        if self.any[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None

    def take(self, left: int) -> tuple[int, int]:
        run = self.runs[left].pop()
        if not self.runs[left]:
            node = left + self.size
            self.any[node] = 0
            node //= 2
            while node:
                self.any[node] = self.any[2 * node] or self.any[2 * node + 1]
                node //= 2
        return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Placement of every rank of every length, and the number of bins.

    Rows (length, first rank, first bin, pieces per bin, offset of the first of them): rank ``r`` goes to bin
    ``first bin + (r - first rank) // per``.  Rows are sorted by length, then first rank.
    """
    bins, used, rows = _OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while rank < n:
            left = bins.tightest(length)
            per = (capacity if left is None else left) // length
            if left is None:
                left, first, free = capacity, used, -(-(n - rank) // per)
                used += free
            else:
                first, free = bins.take(left)
            rows.append((length, rank, first, per, capacity - left))
            full = min(free, (n - rank) // per)
            rest = min(n - rank - full * per, per) if full < free else 0
            bins.put(left - per * length, first, full)
            if rest:
                bins.put(left - rest * length, first + full, 1)
            bins.put(left, first + full + bool(rest), free - full - bool(rest))
            rank += full * per + rest
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5), used


def _place(table: np.ndarray):
    keys = table[:, 0] << 48 | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1] if len(batch) else np.zeros((0, 5), np.int64)
            nth = rank - row[:, 1]
            per = np.maximum(row[:, 3], 1)
            columns = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            columns |= {"sequence_id": pa.array(row[:, 2] + nth // per), "offset": pa.array(row[:, 4] + nth % per * length)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, separator: int = 0, keep_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset: one row per piece of ``docs`` (doc_id, text).

    A document's ids end with ``separator``.  Documents of more than ``capacity`` ids are cut from their end, so only the
    first piece may be shorter; no other document is cut.  A null text is empty and makes a piece of the separator alone.
    ``ids`` holds little-endian 32-bit ids, or null without ``keep_ids``.  Repeated rows are packed as often as they
    occur; an empty table gives an empty result.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long, ids binary"
    pieces, _ = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenize(tokenizer_path, capacity, separator, keep_ids), schema), "pieces"
    )
    by_part, part_path = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases, _ = written(by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "ranks")
    dropped(docs.sparkSession, part_path)
    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", (F.col("base") + F.col("nth")).alias("rank")
    )
    table, _ = plan(counts, capacity)
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"
    return ranked.mapInArrow(_place(table), out)
