"""Position-independent 64-bit hashes of all substrings of a byte string, with numpy.

A prefix sum of ``table[byte] * base**i`` (mod 2**64) gives the hash of any
substring as ``(H[end] - H[start]) * base**-start``, mixed to even bits.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
_STATE: dict[str, np.ndarray] = {}
BYTE = np.random.default_rng(20240131).integers(0, 1 << 64, 256, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i (mod 2**64) for i < n, kept per process and grown by doubling."""
    have = _STATE.get("up")
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        up, down = np.full(size, U(BASE)), np.full(size, U(pow(BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        _STATE["up"], _STATE["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _STATE["up"][:n], _STATE["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base**i, one longer than the input."""
    h = np.empty(len(values) + 1, dtype=np.uint64)
    h[0] = 0
    np.cumsum(values * powers(len(values))[0], out=h[1:])
    return h


def prefix_of(raw: np.ndarray) -> np.ndarray:
    return prefix(BYTE[raw])


def span(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the substrings [start, end)."""
    return mix((h[end] - h[start]) * powers(len(h))[1][start])
