"""Words of whole Arrow text columns as NumPy arrays: positions and 64-bit hashes, without Python objects per word.

A column is walked in pieces of about `PIECE` bytes, cut between texts only, so memory is bounded by the longest
text. Hashes are sums of byte codes times powers of an odd number, modulo 2**64, mixed at the end; they are
the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
ODD = np.uint64(0x9E3779B97F4A7C13)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
CODES = np.random.default_rng(20240601).integers(1, 1 << 64, size=256, dtype=np.uint64)

#: Bytes of the two kinds of words in use, and A-Z in lower case.
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD**i and its inverse for i < n at least."""
    if len(_powers[0]) < n:
        for k, base in enumerate((ODD, INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Piece:
    """Texts `first` to `first + n - 1` of a batch: their bytes, and where each starts (n + 1 offsets)."""

    first: int
    n: int
    data: np.ndarray
    starts: np.ndarray


@dataclass
class Words:
    """Byte ranges of the words of a piece, the text each is in, and the words' range for each text."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray  # n + 1 entries: words first[i] to first[i + 1] - 1 are in text i


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[Piece]:
    """The texts of a column, null as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield Piece(i, j - i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def find_words(piece: Piece, data: np.ndarray, kind: np.ndarray) -> Words:
    """Runs of bytes of a kind in `data`, the piece's bytes (maybe in lower case); no run crosses texts."""
    inside = kind[data]
    size = len(data)
    begins, ends = inside.copy(), inside.copy()
    if size:
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        heads = piece.starts[:-1]
        heads = heads[heads < size]
        begins[heads] = inside[heads]
        tails = piece.starts[1:]
        tails = tails[tails > 0] - 1
        ends[tails] = inside[tails]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, piece.starts)
    text = np.repeat(np.arange(piece.n), np.diff(first))
    return Words(start, end, text, first)


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(CODES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` consecutive words, at the place of the first; callers leave out those across texts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, _ = powers(width + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * up[k + 1]
    return mix(total + np.uint64(width))


def windows_inside(words: Words, width: int) -> np.ndarray:
    """Places where `width` words in a row are all in one text."""
    left = words.first[1:][words.text] - np.arange(len(words.text))
    return np.flatnonzero(left >= width)


def count_code_points(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Code points between consecutive bounds: bytes that do not continue one."""
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.diff(heads[bounds])


def span_sums(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of marks between consecutive bounds."""
    sums = np.concatenate([[0], np.cumsum(marks)])
    return np.diff(sums[bounds])


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the ranges one after another, and where each begins (one offset more than ranges)."""
    edges = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    return data[np.repeat(start - edges[:-1], length) + np.arange(edges[-1])], edges


def distinct(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """For each range of `raw` the number of its value among the distinct ones, and these; compared byte by byte."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(edges, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
    column = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, buffers).dictionary_encode()
    return column.indices.to_numpy(zero_copy_only=False).astype(np.int64), column.dictionary.to_pylist()
