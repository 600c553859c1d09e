"""Words of many texts as 64-bit hashes, computed on byte arrays at once."""

from __future__ import annotations

import numpy as np

MULTIPLIER = 0x9E3779B97F4A7C15
_STEP = 4096
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int) -> np.ndarray:
    out, x = np.empty(_STEP, np.uint64), 1
    for i in range(_STEP):
        out[i], x = x, x * base % 2**64
    return out


_NEAR = _powers(MULTIPLIER | 1)
_FAR = _powers(pow(MULTIPLIER | 1, _STEP, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, a space after each, and where each text ends (its space)."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))) - 1
    return np.frombuffer(b" ".join(parts) + b" ", np.uint8), ends


def word_hashes(data: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, the texts' first word numbers (one more at the end), and the words' first bytes.

    A word is a longest run of bytes for which ``inside`` holds; A-Z count as a-z. The byte after each text
    must be outside.
    """
    word = inside[data]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    if not len(starts):
        return np.empty(0, np.uint64), bounds, starts
    size = stops - starts
    at = np.flatnonzero(word)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(at)) - np.repeat(first, size)
    value = (LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * _NEAR[place % _STEP]
    if size.max() >= _STEP:
        value *= _FAR[(place // _STEP) % _STEP]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64)), bounds, starts


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``n``-word shingles (space-separated words, a-z = A-Z).

    A text of fewer words has its whole sequence as the only one; without words the set is empty.
    """
    data, ends = joined(texts)
    words, bounds, _ = word_hashes(data, ends, ~SPACES)
    odd = [np.uint64(int(_NEAR[7 * i + 5]) | 1) for i in range(n)]
    rows = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        rows += words[i:i + len(rows)] * odd[i]
    rows, out = mix(rows), []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            own = np.sort(rows[a:b - n + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            total = (b - a) * 0x5851F42D4C957F2D
            for i, w in enumerate(words[a:b].tolist()):
                total += w * int(odd[i])
            out.append(mix(np.array([total % 2**64], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
