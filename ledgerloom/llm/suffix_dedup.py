"""Removal of repeated 200-byte strings by ranks of growing length at content-chosen positions.

Full prefix doubling (``prefix_doubling.py``) ranks every byte position.  Two equal strings of ``LENGTH`` bytes have the same inner bytes, so it is
enough to rank positions that are chosen by content alone: of every string's ``LENGTH - SEED + 1`` inner seeds (64 bytes)
the one with the smallest fingerprint is its anchor, about one position in 69.  Each string belongs to one anchor, and
equal strings have their anchors at the same place.  Ranks are fingerprints, so a longer rank comes from the text itself
and only the question whether a rank is unique needs a shuffle:

1. rank 64 bytes at each anchor; positions whose rank is unique are done.
2. rank the whole span of an anchor's strings (up to 336 bytes); where it repeats, all of them repeat.
3. for the other anchors and one example of each repeated span beside them: by blocks of 35 offsets, rank the bytes that
   all strings of a block share; a unique rank ends the block.  Where the block's whole span repeats, all of it repeats.
4. the strings of the blocks still open are ranked one by one, at their full 200 bytes.

Every removed string has been found equal in two 64-bit fingerprints of one polynomial, over different bytes: its anchor's
seed and the string, block or span itself.  Bytes are not compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.rolling import fingerprints, mix, prefix_sums, sliding_min
from ledgerloom.llm.store import dropped, written

LENGTH = 200
SEED = 64
BLOCK = 35  # offsets of an anchor in its strings, ranked together in step 3
SEGMENT = 1 << 20  # bytes of one text that are fingerprinted at a time; 24 bits of a key hold a position in it
_PLACE = np.uint64((1 << 24) - 1)


def _segments(text: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping parts of one text, so that each string of ``length`` bytes starts in exactly one."""
    data = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, max(len(data) - length + 1, 0), SEGMENT):
        yield at, data[at : at + SEGMENT + length - 1]


def anchors(data: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(seed fingerprint, span fingerprint, anchor, first string start, last string start) of each anchor of a text."""
    sums = prefix_sums(data)
    places = np.arange(len(data) - seed + 1)
    seeds = fingerprints(sums, places, places + seed)
    keys = (seeds & ~_PLACE) | places.astype(np.uint64)
    chosen = (sliding_min(keys, length - seed + 1) & _PLACE).astype(np.int64)
    low = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    high = np.concatenate((low[1:], [len(chosen)])) - 1
    at = chosen[low]
    span = mix(fingerprints(sums, low, high + length) + (at - low).astype(np.uint64))
    return seeds[at], span, at, low, high


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    column = batch.column("text").cast(pa.binary())
    for i in range(len(column)):
        yield i, column[i].as_py() or b""


def _rank_seeds(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, size = batch.column("doc_id").to_numpy(zero_copy_only=False), [], 0
            for i, text in _texts(batch):
                for base, data in _segments(text, length):
                    seeds, span, at, low, high = anchors(data, length, seed)
                    found.append((seeds.view(np.int64), span.view(np.int64), np.full(len(at), ids[i], np.int64), at + base, at - low, high - low))
                    size += len(at)
                if size > 100_000:
                    yield _rows(found)
                    found, size = [], 0
            if found:
                yield _rows(found)

    return run


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*found)]
    kinds = [pa.int64()] * 4 + [pa.int16()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["seed", "span", "doc_id", "at", "back", "more"])


_SEEDS = "seed long, span long, doc_id long, at long, back short, more short"
_BLOCKS = "seed long, block int, core long, whole long, doc_id long, low long, high long, own boolean, strings binary"


def _rank_blocks(length: int, width: int):
    """Rows (doc_id, text, anchors) to a row for each block of offsets: ranks of what its strings share and of all they
    cover, and the ranks of the strings themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists, found, size = batch.column("doc_id").to_pylist(), batch.column("anchors"), [], 0
            bounds, flat = lists.offsets.to_numpy(), lists.values
            fields = {n: flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("seed", "at", "back", "more", "own")}
            for i, text in _texts(batch):
                own = {n: c[bounds[i] : bounds[i + 1]] for n, c in fields.items()}
                first = own["at"] - own["back"]
                data, segment = np.frombuffer(text, dtype=np.uint8), first // SEGMENT
                for part in np.unique(segment):
                    use = np.flatnonzero(segment == part)
                    base = int(part) * SEGMENT
                    sums = prefix_sums(data[base : base + SEGMENT + 2 * length])
                    found.append(_blocks_of(sums, base, ids[i], {n: c[use] for n, c in own.items()}, length, width))
                    size += len(found[-1][-1])
                if size > 500_000:
                    yield _block_rows(found)
                    found, size = [], 0
            if found:
                yield _block_rows(found)

    return run


def _blocks_of(sums: np.ndarray, base: int, doc_id: int, own: dict[str, np.ndarray], length: int, width: int) -> tuple[np.ndarray, ...]:
    """Columns of _BLOCKS for anchors of one text, the lengths of the last one's values before it."""
    n = own["more"] + 1
    anchor = np.repeat(np.arange(len(n)), n)
    at = own["at"] - base
    starts = np.arange(len(anchor)) - np.repeat(np.cumsum(n) - n, n) + (at - own["back"])[anchor]
    each = fingerprints(sums, starts, starts + length)
    block = (at[anchor] - starts) // width
    cut = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1]))))
    sizes = np.diff(np.concatenate((cut, [len(anchor)])))
    anchor, block, low = anchor[cut], block[cut], starts[cut]
    near, far = block * width, block * width + width - 1
    core = fingerprints(sums, at[anchor] - near, at[anchor] - far + length)
    left, right = at[anchor] - far, at[anchor] - near + length
    fits = (left >= 0) & (right < len(sums))
    whole = fingerprints(sums, np.where(fits, left, 0), np.where(fits, right, 0))
    return (
        own["seed"][anchor], block, core.view(np.int64), whole.view(np.int64), fits, np.full(len(cut), doc_id, np.int64),
        low + base, low + base + sizes - 1, own["own"][anchor].astype(bool), sizes * 8, each,
    )


def _block_rows(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    seed, block, core, whole, fits, doc_id, low, high, own, sizes, strings = (np.concatenate(c) for c in zip(*found))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    binary = pa.Array.from_buffers(pa.binary(), len(seed), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(strings.tobytes())])
    columns = [pa.array(seed), pa.array(block.astype(np.int32)), pa.array(core), pa.array(whole, mask=~fits), *map(pa.array, (doc_id, low, high, own)), binary]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _BLOCKS.split(", ")])


def _single_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        ranks = [np.frombuffer(s, dtype=np.int64) for s in batch.column("strings").to_pylist()]
        n = np.array([len(r) for r in ranks])
        low, at = batch.column("low").to_numpy(), np.concatenate([np.arange(k) for k in n])
        # a string's place in its anchor's offsets: equal strings have it in common
        columns = [np.repeat(batch.column("seed").to_numpy(), n), np.concatenate(ranks), np.repeat(batch.column("doc_id").to_numpy(), n), np.repeat(low, n) + at]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["seed", "rank", "doc_id", "low"])


def _merged(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Byte runs covered by strings that start in the given closed ranges."""
    runs: list[list[int]] = []
    for low, high in sorted(starts):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high + length)
        else:
            runs.append([low, high + length])
    return [(a, b) for a, b in runs]


def _spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("doc_id"), batch.column("ranges").to_pylist()
            spans = [[{"start": a, "end": b} for a, b in _merged([(r["low"], r["high"]) for r in rows], length)] for rows in lists]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "spans"]
            )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``own``, which rows of one doc_id share if their texts are equal.

    That is doc_id; where it is null, or where it stands at different texts, it is a hash of both.  Those ids are found by one
    small row a document, and written, so that the texts are not dealt anew for them while they are few."""
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h")).where("doc_id is not null")
    mixed, _ = written(told.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select(F.col("doc_id").alias("mixed")), "mixed-ids")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(mixed, F.col("doc_id") == F.col("mixed"), "left")
    hashed = F.col("doc_id").isNull() | F.col("mixed").isNotNull()
    return own.select("doc_id", "text", F.when(hashed, F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id")).alias("own"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, spans) of documents with bytes covered by a string of ``length`` bytes that also starts elsewhere.

    ``docs`` has doc_id, not null, and text; rows of one doc_id have equal texts, and each repeats the strings of the other.  Texts
    are taken as UTF-8, whole, and nulls as empty.  Spans are maximal, in order, [start, end) in bytes.  Strings never cross
    documents.  A string may overlap its own repetition.  Texts shorter than ``length`` have none; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    seed = max(1, length * SEED // LENGTH)
    width = max(1, length * BLOCK // LENGTH)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranked, ranked_path = written(docs.mapInArrow(_rank_seeds(length, seed), _SEEDS), "seeds")
    # written, so that the join deals both sides by itself and a seed that very many anchors share is split over tasks
    again, again_path = written(ranked.groupBy("seed").count().where("count > 1").select("seed"), "repeated-seeds")
    open_, open_path = written(ranked.join(again, "seed"), "open-anchors")
    dropped(spark, ranked_path, again_path)

    spans = open_.groupBy("seed", "span").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at", "back", "more")).alias("example"))
    spans, spans_path = written(spans, "anchor-spans")
    solved = open_.join(spans.where("n > 1").select("seed", "span"), ["seed", "span"]).select(
        "doc_id", (F.col("at") - F.col("back")).alias("low"), (F.col("at") - F.col("back") + F.col("more")).alias("high")
    )
    single = spans.where("n = 1").select("seed", "example.*", F.lit(True).alias("own"))
    beside = spans.where("n > 1").join(single.select("seed").distinct(), "seed").select("seed", "example.*", F.lit(False).alias("own"))
    # a seed whose anchors all repeat whole spans needs no closer look, nor does one that is left alone
    pairs = single.unionByName(beside)
    lists = pairs.groupBy("doc_id").agg(F.collect_list(F.struct("seed", "at", "back", "more", "own")).alias("anchors"))
    blocks, blocks_path = written(docs.join(lists, "doc_id").mapInArrow(_rank_blocks(length, width), _BLOCKS), "blocks")
    key = ["seed", "block", "core"]
    cores = blocks.groupBy(*key).agg(F.count("*").alias("n"), F.max("own").alias("any_own")).where("n > 1 and any_own").select(*key)
    cored = blocks.join(cores, key)
    wholes = cored.where("whole is not null").groupBy("seed", "block", "whole").agg(F.count("*").alias("n_whole"), F.min(F.struct("doc_id", "low")).alias("first"))
    cored, cored_path = written(cored.join(wholes, ["seed", "block", "whole"], "left").withColumn("n_whole", F.coalesce("n_whole", F.lit(1))), "cores")
    solved_blocks = cored.where("own and n_whole > 1").select("doc_id", "low", "high")
    # of equal blocks one is compared with the rest
    rest = cored.where((F.col("n_whole") == 1) | (F.struct("doc_id", "low") == F.col("first")))
    strings, strings_path = written(rest.select("seed", "strings", "doc_id", "low").mapInArrow(_single_strings, "seed long, rank long, doc_id long, low long"), "strings")
    repeated = strings.groupBy("seed", "rank").count().where("count > 1").select("seed", "rank")
    solved_strings = strings.join(repeated, ["seed", "rank"]).select("doc_id", "low", F.col("low").alias("high"))
    ranges = solved.unionByName(solved_blocks).unionByName(solved_strings).groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    out, _ = written(ranges.mapInArrow(_spans(length), "doc_id long, spans array<struct<start: long, end: long>>"), "spans")
    dropped(spark, open_path, spans_path, blocks_path, cored_path, strings_path)
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, lists, rows = batch.column("doc_id"), batch.column("spans"), []
        for i, text in _texts(batch):
            at, kept = 0, []
            for span in lists[i].as_py() or []:
                kept.append(text[at : span["start"]])
                at = span["end"]
            rest = b"".join([*kept, text[at:]])
            rows.append((len(text), len(text) - len(rest), len(lists[i].as_py() or []), hashlib.sha256(rest).hexdigest(), rest))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the remaining bytes, of every row of ``docs``.

    See ``repeated_spans``.  What is left of a text may start or end inside a character, so it stays binary.  Rows are
    judged one by one: rows of one doc_id may have different texts, and a null doc_id is one like others.
    """
    own = _keyed(docs)
    spans = repeated_spans(own.select(F.col("own").alias("doc_id"), "text"), length).withColumnRenamed("doc_id", "of")
    joined = own.join(spans, F.col("own") == F.col("of"), "left").drop("own", "of")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
