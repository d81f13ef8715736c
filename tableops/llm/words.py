"""Words and their hashes for whole Arrow batches of texts: numpy over the UTF-8 bytes, no loop over words.

A word is a run of bytes other than space and 0x09-0x0D; these bytes never occur inside a multi-byte character. A-Z are
lower-cased. A word's hash is a polynomial in its bytes modulo 2**64, taken from running sums, then mixed; the hash of k
neighbouring words is a polynomial in their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Texts are handled in slices of about this size, as arrays take many times the bytes of a slice; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18
_BYTE_BASE, _WORD_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
SYMBOLS = np.ones(256, bool)  # all bytes but 0-9, A-Z, a-z and those of characters beyond ASCII
SYMBOLS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER_CODES = LOWER.astype(np.uint64) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            for name, base in (("up", self.base), ("down", self.inverse)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


@dataclass
class Words:
    """Words of some texts: byte bounds within the slice, hashes, and ``first[i]:first[i + 1]`` as the words of text i."""

    row: int  # of the first text within the batch
    begin: np.ndarray  # of each text, within the slice
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLICE_BYTES of text each."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        yield row, min(stop, rows)
        row = stop


def split_words(data: np.ndarray, begin: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each text; begin: where texts begin, and the end of the last.

    ``space`` tells for each of 256 byte values whether it parts words.
    """
    inside = ~space[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads = begin[:-1][begin[:-1] < begin[1:]]  # a text starts a word of its own also without white space before it
    start[heads] = inside[heads]
    end[heads[1:] - 1] = inside[heads[1:] - 1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(start, begin)


def batch_words(column: pa.Array, space: np.ndarray = _SPACE) -> Iterator[Words]:
    """Words of a text column, slice by slice; ``space`` as in split_words."""
    data, offsets = buffers(column)
    for low, high in slices(offsets):
        begin = offsets[low : high + 1] - offsets[low]
        part = data[offsets[low] : offsets[high]]
        start, end, first = split_words(part, begin, space)
        up, down = _BYTES.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LOWER_CODES[part] * up[: len(part)], out=sums[1:])
        yield Words(low, begin, start, end, mix((sums[end] - sums[start]) * down[start]), first)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k neighbouring values of one text or slice; fewer than k values give none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.upto(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * down[:n] + np.uint64(k))


def text_grams(words: Words, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of all k-word shingles in order); a text with fewer words is one shingle, without words it has none."""
    grams = gram_hashes(words.hash, k)
    for i in range(len(words)):
        low, high = words.first[i], words.first[i + 1]
        if high - low >= k:
            yield words.row + i, grams[low : high - k + 1]
        else:
            yield words.row + i, gram_hashes(words.hash[low:high], int(high - low)) if high > low else grams[:0]


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
