"""Numpy helpers over code points: windowed polynomial hashes and word hashes.

All hashes are position independent: ``sum(c[i+j] * B**j) mod 2**64``, computed
with one cumulative sum of ``c[i] * B**i`` and the inverse powers of the odd
base. Long texts are worked in segments, so memory follows the segment size and
not the text."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
SEGMENT = 1 << 19
_MASK = (1 << 64) - 1
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` for i < n, kept per process."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 12)
        for name, base in (("up", BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that order and low bits of a hash are uniform."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sums(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _power(len(cp) + 1)
    out = np.zeros(len(cp) + 1, dtype=np.uint64)
    np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out, down


def segments(n: int, overlap: int, size: int = SEGMENT):
    """(start, end) pieces that share ``overlap`` positions, so every window of
    ``overlap + 1`` positions lies in exactly one piece."""
    at = 0
    while True:
        end = min(n, at + size + overlap)
        yield at, end
        if end >= n:
            return
        at += size


def window_hashes(cp: np.ndarray, width: int) -> np.ndarray:
    """Mixed hash of every window of ``width`` code points (empty if none)."""
    n = len(cp) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    sums, down = _sums(cp)
    return mix((sums[width:] - sums[:-width]) * down[:n])


def span_hashes(cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of each span [start, end)."""
    sums, down = _sums(cp)
    return mix((sums[end] - sums[start]) * down[start])
