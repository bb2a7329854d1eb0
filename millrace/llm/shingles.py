"""Word shingles of whole texts as 64-bit hashes, over arrays of bytes.

Words are runs of anything but ASCII white space, A-Z lower-cased; both act on single bytes of UTF-8, so texts need
no decoding. A word's hash is a polynomial in its bytes, read off prefix sums; texts are worked through in pieces
that end between words, so memory follows the number of words.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64) + 1
_LOWER[65:91] = np.arange(97, 123, dtype=np.uint64) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.multiply.accumulate(steps)
    return _TABLES["up"], _TABLES["down"]


def _piece_hashes(b: np.ndarray) -> np.ndarray:
    apart = _SEPARATOR[b]
    edge = np.flatnonzero(np.diff(apart, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(max(PIECE + 1, len(b) + 1))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_LOWER[b] * up[: len(b)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """The hash of each word of ``data`` (UTF-8), in order."""
    b = np.frombuffer(data, np.uint8)
    if len(b) <= PIECE:
        return _piece_hashes(b)
    out, at = [], 0
    while at < len(b):
        end = min(len(b), at + PIECE)
        while end < len(b):
            gaps = np.flatnonzero(_SEPARATOR[b[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(len(b), end + PIECE)  # a word longer than a piece
        out.append(_piece_hashes(b[at:end]))
        at = end
    return np.concatenate(out)


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` words; of the whole sequence if it is shorter; nothing without words."""
    if not len(words):
        return words
    size = min(n, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total = mix(total + words[k : len(words) - size + 1 + k] * np.uint64((2 * k + 1) * 0x632BE59BD9B4E019 % (1 << 64) | 1))
    return total


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(sequence_hashes(word_hashes(text.encode()), n)) if text else np.zeros(0, np.uint64)
