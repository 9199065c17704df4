"""Vectorised 64-bit hashes of words and word shingles for many texts at once.

A word's hash is a polynomial over its bytes, taken from running sums over the whole batch, and then mixed.
"""

from __future__ import annotations

import numpy as np

from .shared import pieces

_BASE = 0x9E3779B97F4A7C15 | 1
_TURNED = pow(_BASE, -1, 1 << 64)
_FACTORS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(64)], np.uint64)
PIECE = 1 << 17  # characters of the texts whose arrays are made at once
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all blank-separated words in order, and where each text's words begin (one more than texts)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    powers, turned = _powers(_BASE, data.size), _powers(_TURNED, data.size)
    blank = _BLANK[data]
    before = np.concatenate([[True], blank[:-1]])
    begins, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), sums])
    hashes = mix((sums[ends] - sums[begins]) * turned[begins])
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(begins, offsets)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``width`` words, A-Z in lower case.

    A text with fewer words is one shingle of all its words; one without words, or null, has none.
    """
    out: list[np.ndarray] = []
    for begin, end in pieces(texts, PIECE):
        part = [(t or "").encode().lower() for t in texts[begin:end]]
        hashes, firsts = word_hashes(part)
        n = max(len(hashes) - width + 1, 0)
        joined = np.zeros(n, np.uint64)
        for i in range(width):
            joined += hashes[i:i + n] * _FACTORS[i]
        joined = mix(joined)
        for a, b in zip(firsts[:-1], firsts[1:], strict=True):
            if b - a >= width:
                out.append(np.unique(joined[a:b - width + 1]))
            elif b > a:
                whole = (hashes[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(mix(np.array([whole], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def ranges(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after the other, and the range of each."""
    sizes = ends - begins
    which = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[which], which
