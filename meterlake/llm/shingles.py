"""Word shingles of a text as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_DRAW = np.random.default_rng(20_250_701)
_BYTE = _DRAW.integers(0, 2**64, size=256, dtype=np.uint64)
_BASE = np.uint64(0x9E37_79B9_7F4A_7C17)  # odd, and 3 modulo 4
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD6E8_FEB8_6659_FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(base: int, length: int) -> np.ndarray:
    """Powers of the base, or of its inverse, modulo 2 ** 64."""
    if len(_powers[base]) < length:
        steps = np.full(max(length, 1 << 16), (_BASE, _BACK)[base], dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:length]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D0_49BB_1331_11EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each run of bytes other than white space, in order."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.uint64)
    edge = np.ones(len(raw) + 2, dtype=bool)
    edge[1:-1] = _SPACE[raw]
    turn = np.flatnonzero(edge[1:] != edge[:-1])
    start, stop = turn[::2], turn[1::2]
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _power(0, len(raw)), out=total[1:])
    return mixed((total[stop] - total[start]) * _power(1, len(raw))[start])


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of `WIDTH` words, A-Z in lower case.

    With fewer words the whole sequence is one shingle; without any the set is empty.
    """
    words = word_hashes((text or "").encode("utf-8", "replace").lower())
    width = min(len(words), WIDTH)
    if not width:
        return words
    n = len(words) - width + 1
    total = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        total = total * _STEP + words[i : i + n]
    return np.unique(mixed(total))
