"""Near-duplicate groups from SimHash fingerprints, linked through a pigeonring filter.

Fingerprint: of all word shingles (repeats included) of a text; bit b is set if
over half of the shingle hashes have it set.  Two texts are linked if their
fingerprints differ in at most ``tau`` bits.

Filter: the 64 bits are cut into ``tau + 1`` consecutive segments on a ring.  If
two fingerprints differ in at most tau bits, some segment starts a chain whose
first l segments differ, for every l, in at most l * tau / (tau + 1) bits.  The
chain's first segment is thus equal and the second differs in one bit at most, so
(start, first segment, second segment with one bit left out) is a join key that
loses no link.  Rows that meet under a key are checked against the budgets of the
longer chains, and only then by their full Hamming distance.

Groups of fingerprints under one key are linked by spanning trees, never by all
pairs, and a large group is cut into blocks that are compared block against block
in separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.graph import components
from ledgerloom.llm.text import LOWER, NOT_SPACE, chunks, utf8, words
from ledgerloom.session import durable

BLOCK = 2048
HASH_SEED = 42


def _fingerprint_chunk(data: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    w = words(data, offsets, NOT_SPACE)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(w.start):
        return out
    # one space between the words of a row: a word's bytes and, where something follows, one more byte
    keep = NOT_SPACE[data]
    follows = w.end[w.end < len(data)]
    keep[follows] = True
    clean = LOWER[data]
    clean[~NOT_SPACE[data]] = 0x20
    moved = np.cumsum(keep) - 1
    flat = clean[keep].tobytes()
    start, end = moved[w.start], moved[w.end - 1] + 1
    size = np.minimum(w.per_row, k)
    count = np.where(w.per_row > 0, w.per_row - size + 1, 0)
    rows = np.flatnonzero(count)
    total = int(count.sum())
    n = count[rows]
    head = np.cumsum(n) - n
    first = np.arange(total) - np.repeat(head, n) + np.repeat(w.first[rows], n)
    last = first + np.repeat(size[rows], n) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(flat[a:b], HASH_SEED) for a, b in zip(start[first].tolist(), end[last].tolist(), strict=True)),
                    np.uint64, total)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, head, axis=0, dtype=np.int32)
    set_ = (2 * ones > n[:, None]).astype(np.uint8)
    out[rows] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", k: int = 4,
                      keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` and the signed 64-bit fingerprint of each row's whole text.

    Missing and empty texts have fingerprint zero.
    """
    keep = list(keep if keep is not None else docs.columns)
    names = [f"c{i}" for i in range(len(keep))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "t"):
            fp = _fingerprint_chunk(*utf8(b.column("t")), k).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(fp)], [*names, "fp"])

    kinds = dict(given.dtypes)
    made = given.mapInArrow(run, ", ".join([*(f"{n} {kinds[n]}" for n in names), "fp bigint"]))
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.col("fp").alias(out))


def _segments(tau: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of the ring's segments."""
    m = tau + 1
    width = [64 // m + (i < 64 % m) for i in range(m)]
    return [(sum(width[:i]), width[i]) for i in range(m)]


def _rotated(fp, by: int):
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def chain_keys(fp, tau: int) -> list:
    """One key for each start and each bit of the second segment that is left out."""
    segs, keys = _segments(tau), []
    for i, (at, width) in enumerate(segs):
        second = segs[(i + 1) % len(segs)][1]
        two = F.shiftrightunsigned(_rotated(fp, at), 64 - width - second)
        for j in range(second):
            tag = (i * 64 + j) << 48
            keys.append(two.bitwiseAND(F.lit(((1 << (width + second)) - 1) & ~(1 << j)).cast("long")).bitwiseOR(F.lit(tag).cast("long")))
    return keys


def _chain_masks(tau: int) -> np.ndarray:
    """masks[start][l]: the bits of the first l segments from ``start`` on."""
    segs = _segments(tau)
    one = [((1 << w) - 1) << (64 - a - w) for a, w in segs]
    m = len(segs)
    return np.array([[sum(one[(i + x) % m] for x in range(length)) for length in range(m + 1)] for i in range(m)], np.uint64)


def _linked(a: np.ndarray, b: np.ndarray, start: np.ndarray, masks: np.ndarray, tau: int) -> np.ndarray:
    """Indexes of the pairs within every chain budget, the last of which is the full distance."""
    x, m, at = a ^ b, len(masks), np.arange(len(a))
    for length in range(2, m + 1):
        fine = np.bitwise_count(x[at] & masks[start[at], length]) <= length * tau // m
        at = at[fine]
    return at


class _Forest:
    """Union-find over the rows of a batch; tells which links join two trees."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def _find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        apart = np.flatnonzero(self.root[a] != self.root[b])
        used = []
        for k in apart.tolist():
            i, j = self._find(a[k]), self._find(b[k])
            if i != j:
                self.root[max(i, j)] = min(i, j)
                used.append(k)
        if used:
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up
        return used


def _trees(group: np.ndarray, fp: np.ndarray, start: np.ndarray, masks: np.ndarray, tau: int,
           side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest within each run of equal ``group``; with ``side``, only across or within it."""
    n, found = len(fp), ([], [])
    forest = _Forest(n)
    left = np.append(np.flatnonzero(np.diff(group)) + 1, n)
    left = left[np.searchsorted(left, np.arange(n), side="right")] - np.arange(n)  # rows from here to the group's end
    shift, rows = 1, np.flatnonzero(left > 1)
    while len(rows):
        a, b = rows, rows + shift
        if side is not None:
            cross = side[a] != side[b]
            a, b = a[cross], b[cross]
        at = _linked(fp[a], fp[b], start[a], masks, tau)
        if len(at):
            used = forest.add(a[at], b[at])
            found[0].append(fp[a[at][used]])
            found[1].append(fp[b[at][used]])
        shift += 1
        rows = rows[left[rows] > shift]
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(found[0]), np.concatenate(found[1])) if found[0] else (empty, empty)


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Sorted rows in pieces that end where a group ends, if that comes within BLOCK rows; the flag says so."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            cols = [np.concatenate([r, c]) for r, c in zip(rest, cols, strict=True)]
        rest = cols
        if len(cols[0]) < 2:
            continue
        changes = np.zeros(len(cols[0]) - 1, bool)
        for k in range(len(by)):
            changes |= cols[k][1:] != cols[k][:-1]
        last = np.flatnonzero(changes)
        if len(last):
            cut = int(last[-1]) + 1
            yield [c[:cut] for c in cols], True
            rest = [c[cut:] for c in cols]
        elif len(cols[0]) > 4 * BLOCK:
            yield cols, False
            rest = None
    if rest is not None and len(rest[0]):
        yield rest, True


def _link_small(tau: int):
    masks = _chain_masks(tau)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, key, block):
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(key), pa.array(block)], ["a", "b", "key", "block"])

        going, dealt = None, 0  # the key of a large group that goes on, and its rows so far
        for (key, fp), _ in _whole_groups(batches, ["key"]):
            fp = fp.view(np.uint64)
            edge = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            size = np.diff(np.append(edge, len(key)))
            large = size > BLOCK
            if going is not None and key[0] == going:
                large[0] = True
            elif going is not None:
                going, dealt = None, 0
            for g in np.flatnonzero(large).tolist():
                if key[edge[g]] != going:
                    going, dealt = key[edge[g]], 0
                at = slice(edge[g], edge[g] + size[g])
                block = (dealt + np.arange(size[g])) // BLOCK
                dealt += int(size[g])
                yield out(fp[at], fp[at], key[at], block)
            rows = np.flatnonzero(np.repeat((size > 1) & ~large, size))
            if len(rows):
                a, b = _trees(key[rows], fp[rows], (key[rows] >> 54).astype(np.int64), masks, tau)
                if len(a):
                    yield out(a, b, np.zeros(len(a), np.int64), np.full(len(a), -1, np.int64))

    return run


def _link_blocks(tau: int):
    masks = _chain_masks(tau)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, low, high, block, fp), _ in _whole_groups(batches, ["key", "low", "high"]):
            fp = fp.view(np.uint64)
            edge = np.concatenate([[0], np.flatnonzero((np.diff(key) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1])
            for s, e in zip(edge, np.append(edge[1:], len(key)), strict=True):
                at = slice(s, e)
                side = block[at] if low[s] != high[s] else None
                a, b = _trees(np.zeros(e - s), fp[at], (key[at] >> 54).astype(np.int64), masks, tau, side)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, tau: int = 4, col: str = "fp") -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that are within ``tau`` bits.

    ``fps`` holds each fingerprint once.
    """
    keyed = fps.select(F.explode(F.array(*chain_keys(F.col(col), tau))).alias("key"), F.col(col).alias("fp"))
    sorted_ = keyed.repartition("key").sortWithinPartitions("key", "fp")
    found = durable(sorted_.mapInArrow(_link_small(tau), "a bigint, b bigint, key bigint, block bigint"))
    small = found.where("block < 0").select("a", "b")
    large = found.where("block >= 0").select("key", "block", F.col("a").alias("fp"))
    blocks = large.groupBy("key").agg((F.max("block") + 1).alias("n"))
    paired = large.join(blocks, "key").select(
        "key", "block", "fp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"))
    dealt = paired.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "fp")
    across = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "fp").mapInArrow(
        _link_blocks(tau), "a bigint, b bigint")
    return small.unionAll(across).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 4, tau: int = 4,
                    keep: list[str] | None = None) -> DataFrame:
    """(doc id, ``fp``, ``component_id``, ``root``) and the ``keep`` columns for each row of ``docs``.

    ``root`` is the component's smallest fingerprint.  The component is named by its smallest document id.  Rows with equal texts have
    equal fingerprints and meet without being paired.  Missing ids take part in the
    links but never name a component, unless a component has no other id: then its
    name is missing.  Missing, empty and blank texts share fingerprint zero.
    """
    keep = list(keep or [])
    marked = durable(with_fingerprints(docs, text, "fp", k, [id_col, *keep]).withColumnRenamed(id_col, "id"))
    distinct = durable(marked.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(fingerprint_links(distinct.select("fp"), tau), "a", "b")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = durable(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id", "root"))
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id", "root", *keep)
