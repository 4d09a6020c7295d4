"""Passes over the code points of many texts at once: kinds of characters, runs, and hashes of stretches."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

LETTER, MARK, DIGIT, UPPER, BLANK, DENSE, STOP, TRAIL = (1 << i for i in range(8))
_MULTIPLIER = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: the bits of its kind, its hash in lower case, and whether it is visible."""
    kinds, lower, seen = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint64), np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        cat = unicodedata.category(c)
        kinds[i] = (LETTER if cat[0] == "L" else MARK if cat[0] == "M" else DIGIT if cat[0] == "N" else 0) | (UPPER if cat == "Lu" else 0)
        seen[i] = cat[0] not in "ZC"
        if cat == "Lu" and len(c.lower()) == 1:
            lower[i] = ord(c.lower())
    for chars, bit in ((" \t\n\x0b\f\r", BLANK), (".!?。！？…", STOP), (" \t\n\x0b\f\r\"'”’»«“」』)]", TRAIL)):
        kinds[[ord(c) for c in chars]] |= bit
    kinds[0x3040:0x3100] |= DENSE
    kinds[0x3400:0xA000] |= DENSE
    h = (lower + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return kinds, h ^ (h >> np.uint64(29)), seen


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2^64."""
    up, down = np.full(n, _MULTIPLIER, np.uint64), np.full(n, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each followed by a line end, and where each text begins (and the last ends)."""
    code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    return code, np.concatenate([[0], np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))])


def runs(inside: np.ndarray, parted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; where parted is true, every element is a run of its own."""
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] if parted is None else ~inside[:-1] | parted[1:] | parted[:-1]
    end[:-1] &= ~inside[1:] if parted is None else ~inside[1:] | parted[1:] | parted[:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def stretch_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch [start, end) of 64-bit values, by differences of one running sum."""
    size = 1 << max(10, int(len(values)).bit_length())
    up, down = (x[: len(values) + 1] for x in _powers(size))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)])
    return (total[end] - total[start]) * down[start]


def word_hashes(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the lower-cased characters of each stretch of code."""
    return stretch_hashes(characters()[1][code], start, end)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
