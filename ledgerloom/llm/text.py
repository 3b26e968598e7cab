"""Word arithmetic on whole Arrow columns of text.

A column's UTF-8 bytes are treated as one flat array.  Words are runs of bytes
from a class (every byte of a non-ASCII character is a word byte in all classes
used here), found with boolean masks, and identified by 64-bit multilinear hashes.
No loop over documents, words or characters is needed for any of this.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U64 = np.uint64


def byte_class(keep: Callable[[int], bool]) -> np.ndarray:
    return np.array([keep(b) for b in range(256)], dtype=bool)


#: [^\x20\x09-\x0D]
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z and everything outside ASCII
ALNUM_LOWER = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def randoms(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 32)) * U64(0x9E3779B97F4A7C15))


BYTE_VALUES = randoms(256, 1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows (missing text is empty) and the n + 1 row offsets into them."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text, so memory doesn't follow the batch size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes.astype(np.int64) + 64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


@dataclass
class Words:
    """Words of a chunk: byte spans, the row of each, and word counts per row."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    per_row: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of each row's first word."""
        return np.concatenate([[0], np.cumsum(self.per_row)[:-1]]) if len(self.per_row) else np.zeros(0, np.int64)


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    inside = kind[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        before[edges] = False
        after[edges - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    at = np.searchsorted(start, offsets)
    per_row = np.diff(at)
    return Words(data, offsets, start, end, np.repeat(np.arange(len(per_row)), per_row), per_row)


def word_hashes(w: Words, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
    """Hash of each whole word, then of its first k bytes for each k (shorter words: 0).

    sum(value(byte) * random(position)) modulo 2^64, scrambled with the length.
    """
    if not len(w.start):
        return [np.zeros(0, U64) for _ in range(1 + len(prefixes))]
    length = w.end - w.start
    total = int(length.sum())
    first = np.cumsum(length) - length
    at = np.arange(total) - np.repeat(first, length)
    source = at + np.repeat(w.start, length)
    with np.errstate(over="ignore"):
        terms = BYTE_VALUES[w.data[source]] * randoms(int(length.max()), 2)[at]
        out = [mix(np.add.reduceat(terms, first) + length.astype(U64))]
        for k in prefixes:
            cut = np.add.reduceat(np.where(at < k, terms, U64(0)), first)
            out.append(np.where(length >= k, mix(cut + U64(k << 40)), U64(0)))
    return out


def shingle_hashes(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k consecutive words of one row, and the index of the first word of each."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, U64)
        for i, r in enumerate(randoms(k, 3 + k)):
            out += h[i: n + i] * (r | U64(1))
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return mix(out[at]), at


def per_row_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of the given sizes, empty groups included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def runs(hit: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of maximal runs of hits inside one row."""
    if not len(hit):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.concatenate([[False], (row[1:] == row[:-1]) & hit[1:] & hit[:-1]])
    first = np.flatnonzero(hit & ~same)
    last = np.flatnonzero(hit & ~np.concatenate([same[1:], [False]]))
    return first, last
