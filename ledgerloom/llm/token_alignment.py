"""Alignment of two tokenizers over whole texts: token intervals joined in DuckDB inside Arrow partitions, counts merged in Spark.

Texts go in blocks of some MiB.  A block's texts are cut before every space that follows something else than white space; neither
vocabulary has an entry across such a place, which is checked when it is loaded, so tokens and groups of a text are those of its
segments in a row and each distinct segment is encoded and aligned once a block.  Token bytes of the segments are intervals
in two DuckDB tables; joins on ends give the links, ASOF joins the group of each token, range joins the overlaps, and window sums
number the groups.

What pairs of ids count corpus-wide is summed in Spark from each block's own sums, and handed back to the blocks.
"""

from __future__ import annotations

import functools
import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.packing import byte_of_letter, encoder
from ledgerloom.llm.store import written
from ledgerloom.llm.words import text_chunks

BLOCK = 8 << 20
SPACE = "▁"
# White space in ASCII, and beyond it as (bytes before the last, last bytes).
ASCII_WHITE = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32)
WIDE_WHITE = ((b"\xc2", (0x85, 0xA0)), (b"\xe1\x9a", (0x80,)), (b"\xe2\x80", (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), (b"\xe2\x81", (0x9F,)), (b"\xe3\x80", (0x80,)))

ALIGN = {
    # links: tokens that end together; their running number is that of the group that they end
    "ends": "SELECT a.e, a.id AS a_id, b.id AS b_id, CAST(sum(1) OVER (ORDER BY a.e ROWS UNBOUNDED PRECEDING) - 1 AS INT) AS g FROM a JOIN b ON a.e = b.e",
    # a token's group is that of the first common end not before its own
    "grouped_a": "SELECT a.s, a.e, a.id, ends.g FROM a ASOF JOIN ends ON a.e <= ends.e",
    "grouped_b": "SELECT b.s, b.e, b.id, ends.g FROM b ASOF JOIN ends ON b.e <= ends.e",
    "sizes": """SELECT g, a_id, b_id, x.n AS n_a, y.n AS n_b FROM ends JOIN (SELECT g, count(*) AS n FROM grouped_a GROUP BY g) x USING (g)
        JOIN (SELECT g, count(*) AS n FROM grouped_b GROUP BY g) y USING (g)""",
    # most groups are one token of each, which the link names
    "long_a": "SELECT g, string_agg(id, ',' ORDER BY e) AS ids FROM grouped_a JOIN sizes USING (g) WHERE n_a > 1 GROUP BY g",
    "long_b": "SELECT g, string_agg(id, ',' ORDER BY e) AS ids FROM grouped_b JOIN sizes USING (g) WHERE n_b > 1 GROUP BY g",
    "shared": """SELECT g, count(*) AS n FROM (SELECT * FROM grouped_a SEMI JOIN (SELECT g FROM sizes WHERE n_a + n_b > 2) USING (g)) x
        JOIN grouped_b y USING (g) WHERE x.s < y.e AND y.s < x.e GROUP BY g""",
}
GROUPS = """SELECT ends.e, ends.a_id, ends.b_id, n_a, n_b, coalesce(shared.n, 1) AS n_overlaps,
    coalesce(long_a.ids, CAST(ends.a_id AS VARCHAR)) || '|' || coalesce(long_b.ids, CAST(ends.b_id AS VARCHAR)) AS said
    FROM ends JOIN sizes USING (g) LEFT JOIN shared USING (g) LEFT JOIN long_a USING (g) LEFT JOIN long_b USING (g) ORDER BY g"""


_WHITE = np.zeros(256, dtype=bool)
_WHITE[list(ASCII_WHITE)] = True


class Vocabularies:
    """Two vocabulary files: ids of segments, and the bytes of ids."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece

        own = encoder(byte_level)
        if own.ranks is None:
            own.tokenizer.encode_special_tokens = True
        self.encode_a = own.ranks.encode_ordinary if own.ranks else lambda text: own.tokenizer.encode(text, add_special_tokens=False).ids
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = byte_of_letter()
        with open(byte_level, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            bytes_a[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        p = self.pieces
        named = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        bytes_b = [bytes([int(n[3:-1], 16)]) if p.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(named)]
        self.bytes = [pa.array(b, pa.large_binary()) for b in (bytes_a, bytes_b)]
        self.lengths = [np.array([len(x) for x in b], dtype=np.int64) for b in (bytes_a, bytes_b)]
        # an entry across "x " would tie segments together; then texts stay whole
        self.cuts = own.ranks is not None and not any(b" " in b.lstrip(b" ") for b in bytes_b)

    def encode(self, segments: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vocabulary the ids of all segments (which begin with a space) in a row, and how many each has."""
        found = []
        for lists in (map(self.encode_a, segments), self._by_pieces(segments)):
            ids, counts = array("i"), np.zeros(len(segments), dtype=np.int64)
            for i, own in enumerate(lists):
                ids.extend(own)
                counts[i] = len(own)
            found.append((np.frombuffer(ids, dtype=np.int32), counts))
        return found

    def _by_pieces(self, segments: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(segments), 10_000):
            yield from self.pieces.encode([s[1:] for s in segments[at : at + 10_000]], num_threads=1)


@functools.cache
def vocabularies(byte_level: str, pieces: str) -> Vocabularies:
    """The worker's pair of vocabularies."""
    return Vocabularies(byte_level, pieces)


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each that is not empty, and their offsets."""
    full = np.diff(offsets) > 0
    out = np.insert(data, offsets[:-1][full], np.uint8(32))
    return out, offsets + np.concatenate(([0], np.cumsum(full)))


def cut_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where segments begin: at each text that is not empty, and at each space after something else than white space, unless
    the text ends with it."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    last = data[at - 1]
    white = _WHITE[last]
    wide = np.flatnonzero(last >= 0x80)  # few: only they can end a wider white space
    for lead, ends in WIDE_WHITE:
        same = np.isin(last[wide], ends)
        for k, byte in enumerate(reversed(lead)):
            before = at[wide] - 2 - k
            same &= (before >= 0) & (data[before] == byte)
        white[wide] |= same
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[offsets[1:]] = True
    inner = at[~white & ~ends[at + 1]]
    begins = np.zeros(len(data), dtype=bool)
    begins[starts] = begins[inner] = True
    return np.flatnonzero(begins)


def _same_bytes(table: pa.Array, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether the bytes of each segment's tokens, joined, are the segment."""
    of = np.repeat(np.arange(len(counts)), counts)
    total = np.bincount(of, weights=lengths[ids], minlength=len(counts)).astype(np.int64)
    good = total == np.diff(bounds)
    own = table.take(pa.array(ids[good[of]]))
    joined = np.frombuffer(own.buffers()[2] or b"", dtype=np.uint8)[: int(total[good].sum())]
    of_byte = np.repeat(np.arange(len(counts)), np.diff(bounds))
    wrong = of_byte[good[of_byte]][joined != data[good[of_byte]]]
    good[wrong] = False
    return good


def _intervals(ids: np.ndarray, lengths: np.ndarray) -> pa.Table:
    ends = np.cumsum(lengths[ids])
    return pa.table({"s": ends - lengths[ids], "e": ends, "id": ids})


def aligned(a: pa.Table, b: pa.Table) -> pa.Table:
    """Groups in order: end, the link (a_id, b_id), n_a, n_b, n_overlaps, and their ids as ``a1,a2|b1``, of two tables of
    token intervals (s, e, id) that cover the same bytes."""
    import duckdb

    with duckdb.connect(config={"threads": 1}) as base:
        base.register("a", a)
        base.register("b", b)
        for name, query in ALIGN.items():
            base.execute(f"CREATE TABLE {name} AS {query}")
        return base.sql(GROUPS).to_arrow_table()


BLOCK_SCHEMA = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_overlaps array<long>, sha256 array<string>, "
    "own_pairs binary, own_counts binary, own_sizes array<int>, pairs array<struct<a:int,b:int,n:long>>"
)
_PAIRS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))
_KINDS = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.binary(), pa.binary(), pa.list_(pa.int32()), _PAIRS]
_NAMES = [c.split(" ")[0] for c in BLOCK_SCHEMA.split(", ")]


def _packed(values: np.ndarray) -> bytes:
    """Small whole numbers, byte by byte of all of them, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _joined(parts: pa.Array, edges: np.ndarray) -> pa.Array:
    """``parts`` between each two edges, joined by ``;``."""
    parts = pa.concat_arrays(parts.chunks) if isinstance(parts, pa.ChunkedArray) else parts
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), parts.cast(pa.string())), ";")


def _block(vocabulary: Vocabularies, doc_ids: list, data: np.ndarray, offsets: np.ndarray) -> list:
    """The columns of a block after its number."""
    data, offsets = spaced(data, offsets)
    starts = cut_places(data, offsets) if vocabulary.cuts else offsets[:-1][np.diff(offsets) > 0]
    bounds = np.append(starts, len(data)).astype(np.int64)
    places = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
    segment = places.indices.to_numpy(zero_copy_only=False)
    distinct = places.dictionary.cast(pa.large_string())
    own = np.frombuffer(distinct.buffers()[2] or b"", dtype=np.uint8)
    own_bounds = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[: len(distinct) + 1] if len(distinct) else np.zeros(1, dtype=np.int64)
    encoded = vocabulary.encode(distinct.to_pylist())
    good = np.ones(len(distinct), dtype=bool)
    for (ids, counts), table, lengths in zip(encoded, vocabulary.bytes, vocabulary.lengths):
        good &= _same_bytes(table, lengths, ids, counts, own, own_bounds)
    kept = [ids[np.repeat(good, counts)] for ids, counts in encoded]
    ends = np.cumsum(np.diff(own_bounds)[good])
    links = aligned(*(_intervals(ids, lengths) for ids, lengths in zip(kept, vocabulary.lengths)))
    # segments end where groups end
    edges = np.append(0, np.searchsorted(links.column("e").to_numpy(), np.cumsum(np.diff(own_bounds)[good]), side="right"))

    # per distinct segment, then per document; a document with a segment whose bytes differ has no tokens
    of_doc = np.searchsorted(offsets, starts, side="right") - 1
    n_docs = len(offsets) - 1
    fine = np.diff(offsets) > 0
    fine[of_doc[~good[segment]]] = False
    place = np.cumsum(good) - 1
    use = fine[of_doc]
    row, of_doc = place[segment[use]], of_doc[use]
    sums = {}
    for c in ("n_a", "n_b", "n_overlaps"):
        through = np.append(0, np.cumsum(links.column(c).to_numpy()))
        sums[c] = np.bincount(of_doc, weights=np.diff(through[edges])[row], minlength=n_docs).astype(np.int64)
    n_groups = np.diff(edges)
    sums["n_groups"] = np.bincount(of_doc, weights=n_groups[row], minlength=n_docs).astype(np.int64)
    said = _joined(links.column("said"), edges)
    said = _joined(said.take(pa.array(row)), np.searchsorted(of_doc, np.arange(n_docs + 1)))
    digests = [hashlib.sha256(x.as_buffer()).hexdigest() if f else "" for f, x in zip(fine, said)]

    # the links of each document as counts of the block's pairs
    keys = links.column("a_id").to_numpy().astype(np.int64) << 32 | links.column("b_id").to_numpy()
    pairs, pair = np.unique(keys, return_inverse=True)
    n, first = n_groups[row], edges[:-1][row]
    link = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    own_keys, own_counts = np.unique(np.repeat(of_doc, n) * max(len(pairs), 1) + pair[link], return_counts=True)
    doc, own_pair = np.divmod(own_keys, max(len(pairs), 1))
    totals = np.bincount(own_pair, weights=own_counts, minlength=len(pairs)).astype(np.int64)
    used = totals > 0
    renamed = (np.cumsum(used) - 1)[own_pair]
    steps = np.diff(renamed, prepend=0)
    heads = np.searchsorted(doc, np.arange(n_docs))
    heads = heads[heads < len(renamed)]
    steps[heads] = renamed[heads]  # each document counts from zero
    listed = pa.StructArray.from_arrays([pa.array((pairs[used] >> 32).astype(np.int32)), pa.array((pairs[used] & 0xFFFFFFFF).astype(np.int32)), pa.array(totals[used])], names=["a", "b", "n"])
    return [doc_ids, *(sums[c] for c in ("n_a", "n_b", "n_groups", "n_overlaps")), digests, _packed(steps), _packed(own_counts), np.bincount(doc, minlength=n_docs).astype(np.int32), listed]


def _blocks(byte_level: str, pieces: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, number = vocabularies(byte_level, pieces), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, data, offsets in text_chunks(batch.column("text"), size):
                columns = [number, *_block(vocabulary, ids.slice(first, last - first).to_pylist(), data, offsets)]
                yield pa.RecordBatch.from_arrays([pa.array([c.to_pylist() if isinstance(c, pa.Array) else c], k) for c, k in zip(columns, _KINDS)], names=_NAMES)
                number += 1

    return run


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, n_overlaps long, groups_sha256 string"


def _counted(blocks: pa.Table, looked: pa.Table) -> pa.Table:
    """Documents of one block, with what its pairs count corpus-wide."""
    if not len(blocks):
        return pa.table({c.split(" ")[0]: pa.array([], pa.string() if c.endswith("string") else pa.int64()) for c in OUT.split(", ")})
    n = {c: np.array(blocks.column(c)[0].as_py(), dtype=np.int64) for c in ("n_a", "n_b", "n_groups", "n_overlaps")}
    sizes = np.array(blocks.column("own_sizes")[0].as_py(), dtype=np.int64)
    steps, times = (_unpacked(blocks.column(c)[0].as_py()) for c in ("own_pairs", "own_counts"))
    run, starts = np.cumsum(steps), np.cumsum(sizes) - sizes
    pair = run - np.repeat(np.where(starts > 0, run[np.maximum(starts - 1, 0)], 0) if len(run) else starts, sizes)
    count, best = np.zeros(len(looked), dtype=np.int64), np.zeros(len(looked), dtype=np.int64)
    at = looked.column("pair").to_numpy()
    count[at], best[at] = looked.column("count").to_numpy(), looked.column("best").to_numpy()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    count_sum, n_best = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    np.add.at(count_sum, doc, times * count[pair])
    np.add.at(n_best, doc, times * best[pair])
    return pa.table(
        {
            "doc_id": pa.array(blocks.column("doc_ids")[0].as_py(), pa.int64()), "n_a": n["n_a"], "n_b": n["n_b"], "n_groups": n["n_groups"], "n_links": n["n_groups"],
            "n_best": n_best, "count_sum": count_sum, "n_overlaps": n["n_overlaps"], "groups_sha256": pa.array(blocks.column("sha256")[0].as_py(), pa.string()),
        }
    )


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Documents and pair counts of ``docs`` (doc_id, text) under a byte-level vocabulary A and a vocabulary of pieces B.

    Documents: doc_id, n_a, n_b (tokens), n_groups (runs of bytes between places where tokens of both end), n_links (pairs of
    tokens that end together), n_best (links whose pair is, corpus-wide, the most frequent of its B id; ties count), count_sum
    (corpus-wide counts of the pair, over the links), n_overlaps (pairs of tokens that share a byte), groups_sha256 (of
    ``a1,a2|b1;a3|b2``).  Pair counts: a, b, count, best.

    A reads a space and the text, B the text.  Texts that are null or empty, or that a vocabulary does not give back byte for byte,
    have no tokens: zeros and an empty digest.  Special tokens' strings are plain text.  Repeated rows count as often as
    they occur; a null doc_id stays; an empty table gives empty results.  A text longer than ``block`` bytes is a block of
    its own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks, _ = written(rows.mapInArrow(_blocks(byte_level, pieces, block), BLOCK_SCHEMA), "aligned-blocks")
    own = blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("pair", "p")).select("of_block", "pair", "p.a", "p.b", "p.n")
    counts = own.groupBy("a", "b").agg(F.sum("n").alias("count"))
    # one B id has at most as many pairs as A has ids
    counts, _ = written(counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b"))), "pair-counts")
    looked = own.join(counts, ["a", "b"]).select("of_block", "pair", "count", F.col("best").cast("int").alias("best"))
    found = blocks.drop("pairs").groupBy("block").cogroup(looked.groupBy("of_block")).applyInArrow(_counted, OUT)
    return found, counts
