"""Hashed word shingles of texts, in numpy.

Words are runs of characters other than the six ASCII white-space ones, with A-Z
in lower case; a shingle is ``n`` words in a row, or all words of a text with
fewer. A shingle's hash has 64 bits and depends on its words alone.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240607)
#: A random value for each byte, and an odd multiplier with its inverse modulo 2 ** 64.
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_P = 0x9E3779B97F4A7C15
_Q = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int) -> np.ndarray:
    """_P ** 0 .. _P ** (n - 1), and grown by doubling."""
    have = _POWERS.get(0)
    if have is None or len(have) < n:
        out = np.ones(1, np.uint64)
        step = np.uint64(_P)
        while len(out) < n:
            out = np.concatenate([out, out * step])
            step = step * step
        have = _POWERS[0] = out
    return have[:n]


def word_hashes(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a byte array."""
    with np.errstate(over="ignore"):
        inside = ~_SPACE[flat]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        bounds = np.concatenate(([0] if len(inside) and inside[0] else [], edge, [len(flat)] if len(inside) and inside[-1] else [])).astype(np.int64)
        first, end = bounds[0::2], bounds[1::2]
        if not len(first):
            return np.empty(0, np.uint64), first
        # sum of byte value * P ** (place in the word), as a difference of sums with the longest word's powers
        place = np.arange(len(flat), dtype=np.int64)
        place -= np.repeat(np.concatenate(([0], first)), np.diff(np.concatenate(([0], first, [len(flat)]))))
        value = _BYTE[flat] * _powers(int((end - first).max()) + 1)[np.minimum(place, int((end - first).max()))]
        value[~inside] = 0
        return mix(np.add.reduceat(value, first) + (end - first).astype(np.uint64)), first


def shingle_sets(texts: list[str | None], n: int = 5) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    raw = [t.encode("utf-8", "surrogatepass") + b" " if t else b" " for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8)
    words, first = word_hashes(flat)
    ends = np.searchsorted(first, np.cumsum(sizes))
    with np.errstate(over="ignore"):
        if len(words) >= n:
            rolled = words[:len(words) - n + 1].copy()
            for j in range(1, n):
                rolled = rolled * _Q + words[j:len(words) - n + 1 + j]
            rolled = mix(rolled)
        out, lo = [], 0
        for hi in ends.tolist():
            if hi - lo >= n:
                s = np.sort(rolled[lo:hi - n + 1])
                out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
            elif hi > lo:
                h = words[lo:lo + 1].copy()
                for j in range(lo + 1, hi):
                    h = h * _Q + words[j]
                out.append(mix(h + np.uint64(hi - lo)))
            else:
                out.append(np.empty(0, np.uint64))
            lo = hi
    return out
