"""Vectorised polynomial fingerprints over bytes, shared by the operators of this subpackage.

All arithmetic is modulo 2**64.  A byte ``b`` at index ``i`` of a buffer contributes ``TABLE[b] * BASE**i`` to a
prefix sum, so the fingerprint of any substring is a difference of two prefix sums times ``BASE**-start``; that makes
it independent of where the substring stands.  ``mix`` then spreads the result over all 64 bits.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor, shift, multiply); a bijection, so it adds no collisions."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, grown by doubling and kept for the life of the worker."""
    have = len(_powers["up"]) if _powers else 0
    if have < n:
        size = max(n, 2 * have, 1 << 16)
        up = np.full(size, BASE, dtype=np.uint64)
        down = np.full(size, pow(BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``out[i]`` sums the contributions of the first ``i`` bytes of a uint8 array."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    if len(data):
        np.cumsum(BYTE_CODES[data] * powers(len(data))[0], out=out[1:], dtype=np.uint64)
    return out


def fingerprints(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed fingerprints of the substrings [start, end), their lengths folded in."""
    down = powers(len(sums))[1]
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths * np.uint64(0x8CB92BA72F3D8DD7))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: block-wise running minima from both sides."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])
