"""Hashed words of a text, computed on whole arrays of bytes."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SIGN = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: What separates words: white space, or every ASCII sign that is neither letter nor digit.
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
NO_WORD = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
#: Bytes with A-Z lower-cased.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_FOLDED_SIGN = _SIGN[FOLD]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of an odd base and of its inverse."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        if len(_POWERS) > 3:
            _POWERS.clear()
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def hashed(raw: np.ndarray, gaps: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit key, start and end of each word in an array of bytes; A-Z count as a-z."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = np.concatenate([[True], gaps[raw], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[::2], edge[1::2]
    up, down = powers(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_FOLDED_SIGN[raw] * up[: len(raw)], dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts, ends


def numbered(text: str) -> tuple[list[bytes], np.ndarray]:
    """The words of a text as they stand (``[^\\x20\\x09-\\x0D]+``) and a number for each, equal for equal words only."""
    words = text.encode("utf-8", "surrogatepass").split()
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return words, np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
