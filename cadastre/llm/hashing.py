"""Vectorised 64-bit hashes of words and byte strings of an Arrow text batch."""

from __future__ import annotations

import functools

import numpy as np

#: An odd multiplier for each independent hash, and the constants of a 64-bit finaliser.
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_values(which: int) -> np.ndarray:
    return np.random.default_rng(7 + which).integers(0, 2**64, 256, np.uint64, endpoint=False)


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """base ** i (or its inverse mod 2**64) for i below ``n``."""
    have = _POWERS.get((which, inverse))
    if have is None or len(have) < n:
        base = BASES[which] if not inverse else pow(BASES[which], -1, 2**64)
        size = max(1 << 18, 1 << max(0, n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[(which, inverse)] = have
    return have[:n]


def forget_powers() -> None:
    """Drop powers for long inputs; they are quickly made again."""
    for key in [k for k, have in _POWERS.items() if len(have) > 1 << 18]:
        del _POWERS[key]


def prefix_sums(data: np.ndarray, which: int, bytes_: bool = True) -> np.ndarray:
    """Running polynomial sums, one more than ``data``; see :func:`spans`."""
    values = _byte_values(which)[data] if bytes_ else data
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * powers(which, len(data)), out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of each [start, end) from running sums; equal strings, equal hashes."""
    inv = powers(which, len(sums), True)
    return mix((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64))


def word_spans(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (run without blanks) and the number of words
    of each row; words never cross rows."""
    solid = ~BLANK[raw]
    if not len(raw):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(rows) - 1, np.int64)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = rows[:-1][rows[:-1] < len(raw)]
    first[heads] = solid[heads]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    tails = rows[1:][rows[1:] > 0] - 1
    last[tails] = solid[tails]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.diff(np.searchsorted(start, rows))


def window_hashes(values: np.ndarray, size: int, which: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values (64-bit), over the whole array."""
    if len(values) < size:
        return np.empty(0, np.uint64)
    sums = prefix_sums(values, which, bytes_=False)
    at = np.arange(len(values) - size + 1)
    return spans(sums, at, at + size, which)


def sliding_argmin(values: np.ndarray, size: int) -> np.ndarray:
    """Index of the least value in each window of ``size`` (first on ties)."""
    n = len(values) - size + 1
    at = np.arange(len(values))
    span = 1
    while span < size:
        step = min(span, size - span)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at[:n]
