"""Vectorised word and shingle hashing shared by the text operators.

A word is a maximal run of bytes other than space and TAB..CR, with A-Z lower-cased;
hashing works on the UTF-8 bytes with numpy, so a text costs a fixed number of array
passes whatever its number of words. Long texts are hashed piece by piece (pieces end at
white space), which bounds the working memory without cutting any word.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_PIECE = 1 << 18

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_pow = np.ones(1, dtype=U64)
_inv = np.ones(1, dtype=U64)


def _grow(n: int) -> None:
    """Make sure that powers of the base and of its inverse exist up to exponent n."""
    global _pow, _inv
    if len(_pow) > n:
        return
    size = 1 << (n + 1).bit_length()
    with np.errstate(over="ignore"):
        steps = np.full(size, _BASE, dtype=U64)
        steps[0] = 1
        _pow = np.multiply.accumulate(steps)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        _inv = np.multiply.accumulate(steps)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _pieces(data: bytes):
    at = 0
    while len(data) - at > _PIECE:
        end = at + _PIECE
        found = [p for p in (data.rfind(c, at, end) for c in (b" ", b"\n", b"\t")) if p > at]
        if not found:  # one word longer than a piece: take the text to the next white space
            while end < len(data) and not IS_SPACE[data[end]]:
                end += 1
            found = [end]
        cut = max(found)
        yield data[at:cut]
        at = cut
    yield data[at:]


def tokens(text: str | None, gap_table: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, end byte) of each run of bytes outside gap_table, in order, over the whole text.

    gap_table holds white space at least, so that no token crosses two pieces.
    """
    hashes, starts, ends, at = [], [], [], 0
    for piece in _pieces((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)):
        b = np.frombuffer(piece, dtype=np.uint8)
        n = len(b)
        _grow(n)
        gap = np.ones(n + 2, dtype=bool)
        gap[1:-1] = gap_table[b]
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        start, end = edge[0::2], edge[1::2]
        with np.errstate(over="ignore"):
            prefix = np.zeros(n + 1, dtype=U64)
            np.cumsum((b.astype(U64) + U64(1)) * _pow[:n], out=prefix[1:])
            hashes.append(mix64((prefix[end] - prefix[start]) * _inv[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93)))
        starts.append(start + at)
        ends.append(end + at)
        at += n
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of each word of the whole text, in order; empty for null or blank text."""
    return tokens(text)[0]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; by sorting, which numpy does faster than its hash-based unique."""
    x = np.sort(x)
    if len(x) > 1:
        x = x[np.append(True, x[1:] != x[:-1])]
    return x


def shingle_stream(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of width words, in order, repeats included; of all words if there are fewer."""
    n = len(words)
    if n == 0:
        return words
    w = min(width, n)
    with np.errstate(over="ignore"):
        out = words[: n - w + 1].copy()
        for k in range(1, w):
            out = out * U64(0xC2B2AE3D27D4EB4F) + words[k : n - w + 1 + k]
        return mix64(out + U64(w) * U64(0x9FB21C651E98DF25))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of the whole text."""
    return distinct(shingle_stream(word_hashes(text), width))
