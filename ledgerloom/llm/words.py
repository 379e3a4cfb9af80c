"""Words and word shingles of whole texts as 64-bit hashes, computed column-wise from Arrow buffers.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``; A-Z count as a-z.  Texts are taken in chunks of
about ``CHUNK`` bytes, so memory does not follow the batch; one text longer than that is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerloom.llm.rolling import fingerprints, mix, prefix_sums

CHUNK = 1 << 18  # a task's arrays take some hundred bytes for each of these, and a worker keeps part of them
WIDTH = 5

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[32, *range(9, 14)]] = False
_STEPS = mix(np.arange(101, 101 + WIDTH, dtype=np.uint64)) | np.uint64(1)


def text_chunks(texts: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows in them) of consecutive rows; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    values = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + chunk, side="right")) - 1)
        yield first, last, values[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a word never crosses the edge of a text."""
    inside = IN_WORD[data]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        before[edges] = False
        after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and for each text where its words begin in that array (one more at the end)."""
    starts, ends = word_bounds(data, offsets)
    return fingerprints(prefix_sums(LOWER[data]), starts, ends), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words in order, and where each text's begin; a text of fewer words has its whole
    sequence as its only one, a text without words has none."""
    counts = np.diff(bounds)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    out_bounds = np.concatenate(([0], np.cumsum(n)))
    total = np.zeros(len(words), dtype=np.uint64)
    for j in range(width):
        total[: len(words) - j] += words[j:] * _STEPS[j]
    out = np.empty(out_bounds[-1], dtype=np.uint64)
    long = np.repeat(counts >= width, counts)
    left = np.repeat(bounds[1:], counts) - np.arange(len(words))
    out_long = np.repeat(counts >= width, n)
    out[out_long] = mix(total[long & (left >= width)])
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        own = words[bounds[i] : bounds[i + 1]]
        out[out_bounds[i]] = mix(np.array([len(own)], dtype=np.uint64) + (own * _STEPS[: len(own)]).sum(dtype=np.uint64))[0]
    return out, out_bounds
