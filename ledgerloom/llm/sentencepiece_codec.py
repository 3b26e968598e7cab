"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The pieces and scores come from a given model; the merging is done here.  The
distinct words of a chunk of texts lie in flat symbol arrays.  Each round finds
the best-ranked pair of every word with a segmented minimum, merges its
occurrences from the left at once, and compacts the arrays; a word leaves when it
has no pair left.  Texts are then put together from their words' ids.

Merging one pair's occurrences at once equals merging them one by one unless the
new symbol takes part in a pair that ranks no worse (equal scores, or a piece that
has a better score than its part).  Such a word is finished one merge at a time.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import chunks

SPACE = "▁"
NONE = np.iinfo(np.int32).max
#: distinct words whose ids a task keeps
REMEMBERED = 200_000
#: symbols from which on a word is merged by a heap where the order matters
LONG = 64


@dataclass
class Model:
    """A BPE model as arrays; ``of`` reads it with the sentencepiece library."""

    symbol_of: np.ndarray  # code point -> symbol; -1: in no piece
    pair: np.ndarray  # sorted left * n_symbols + right
    rank: np.ndarray
    merged: np.ndarray
    risky: np.ndarray  # symbol -> part of a pair that ranks no worse than the symbol itself
    n_symbols: int
    n_pieces: int
    bytes_from: int  # id of the piece for byte 0; -1: none
    unknown: int
    end: int
    by_word: bool  # no piece reaches over the start of a word
    text: np.ndarray  # bytes of all pieces as they are decoded
    text_at: np.ndarray

    @classmethod
    def of(cls, path: str) -> Model:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize("ﬁ① a  b ") != f"{SPACE}ﬁ①{SPACE}a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("only models without normalisation and with a leading space are supported")
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        score = {names[i]: sp.get_score(i) for i in range(n) if not special[i]}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        ids = {names[i]: i for i in range(n) if not special[i]}
        chars = sorted({c for p in ids for c in p} - set(ids))
        symbols = ids | {c: n + k for k, c in enumerate(chars)}
        total = n + len(chars)
        symbol_of = np.full(0x110000, -1, np.int32)
        for s, k in symbols.items():
            if len(s) == 1:
                symbol_of[ord(s)] = k
        pairs, risky = [], np.zeros(total, bool)
        for p, i in ids.items():
            r = order[score[p]]
            for cut in range(1, len(p)):
                a, b = symbols.get(p[:cut]), symbols.get(p[cut:])
                if a is not None and b is not None:
                    pairs.append((a * total + b, r, i))
                    for part in (p[:cut], p[cut:]):
                        if len(part) > 1 and order[score[part]] >= r:
                            risky[symbols[part]] = True
        pairs.sort()
        pair, rank, merged = (np.array(x) for x in zip(*pairs, strict=True))
        byte = next((i for i in range(n) if sp.is_byte(i)), -1)
        said = [b"" if sp.is_control(i) else bytes([i - byte]) if sp.is_byte(i)
                else " ⁇ ".encode() if sp.is_unknown(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        return cls(symbol_of, pair.astype(np.int64), rank.astype(np.int32), merged.astype(np.int32), risky, total, n, byte,
                   sp.unk_id(), sp.eos_id(), not any(SPACE in p.lstrip(SPACE) for p in ids),
                   np.frombuffer(b"".join(said), np.uint8), np.cumsum([0, *map(len, said)]))

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of pairs; NONE if they don't merge."""
        key = left.astype(np.int64) * self.n_symbols + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        known = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.rank[at], NONE), np.where(known, self.merged[at], -1)

    def one_by_one(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """(symbols, positions of their first characters) after merging best pair first, leftmost first."""
        sym, n = symbols.tolist(), len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, merged = self.find(symbols[:-1], symbols[1:])
        heap = [(r, i, sym[i], sym[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), merged.tolist(), strict=True)) if r != NONE]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i] if not gone[i] else -1
            if j < 0 or sym[i] != a or sym[j] != b:
                continue
            sym[i], gone[j], after[i] = m, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    key = sym[x] * self.n_symbols + sym[y]
                    k = bisect.bisect_left(self.pair, key)
                    if sym[x] >= 0 <= sym[y] and k < len(self.pair) and self.pair[k] == key:
                        heapq.heappush(heap, (int(self.rank[k]), x, sym[x], sym[y], int(self.merged[k])))
        at = [i for i in range(n) if not gone[i]]
        return [sym[i] for i in at], at

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        # a symbol's ``at`` is its first character; finished symbols are put aside
        sym, word, at = self.symbol_of[chars], np.repeat(np.arange(len(words)), sizes), np.arange(len(chars))
        same = word[1:] == word[:-1]
        rank = np.full(len(sym), NONE, np.int32)
        result = np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            r, m = self.find(sym[:-1], sym[1:])
            rank[:-1], result[:-1] = np.where(same, r, NONE), m
        done_sym, done_at = [], []
        while len(sym):
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(head, len(sym)))
            best = np.minimum.reduceat(rank, head)
            pick = (rank == np.repeat(best, size)) & (rank != NONE)
            over = np.repeat(best == NONE, size)
            # words where the order among the best pairs may matter
            several = np.add.reduceat(pick, head, dtype=np.int64) > 1
            if several.any():
                danger = np.zeros(len(sym), bool)
                danger[pick] = self.risky[result[pick]]
                careful = several & np.logical_or.reduceat(danger, head)
                # in these only the first pair is merged in this round; long ones would take too many rounds
                spot = np.flatnonzero(pick & np.repeat(careful, size))
                group = np.searchsorted(head, spot, side="right")
                pick[spot[1:][group[1:] == group[:-1]]] = False
                careful = np.flatnonzero(careful & (size > LONG))
                for g in careful.tolist():
                    part = slice(head[g], head[g] + size[g])
                    s, p = self.one_by_one(sym[part])
                    done_sym.append(np.array(s, np.int32))
                    done_at.append(at[part][p])
                    over[part] = False
                if len(careful):
                    drop = np.zeros(len(head), bool)
                    drop[careful] = True
                    drop = np.repeat(drop, size)
                    keep = ~drop & ~over
                    done_sym.append(sym[over])
                    done_at.append(at[over])
                    sym, word, at, rank, result, pick = (x[keep] for x in (sym, word, at, rank, result, pick))
                    over = np.zeros(len(sym), bool)
            if over.any():
                done_sym.append(sym[over])
                done_at.append(at[over])
                sym, word, at, rank, result, pick = (x[~over] for x in (sym, word, at, rank, result, pick))
            if not len(sym):
                break
            # of pairs that overlap in a run, every other one from the left
            spot = np.flatnonzero(pick)
            lead = np.concatenate([[True], np.diff(spot) > 1])
            place = np.arange(len(spot))
            spot = spot[(place - np.maximum.accumulate(np.where(lead, place, 0))) % 2 == 0]
            sym[spot] = result[spot]
            keep = np.ones(len(sym), bool)
            keep[spot + 1] = False
            new = np.cumsum(keep) - 1
            sym, word, at, rank, result = (x[keep] for x in (sym, word, at, rank, result))
            here = new[spot]
            near = np.zeros(len(sym), bool)
            near[here] = True
            near[here[here > 0] - 1] = True
            touched = np.flatnonzero(near)
            inner = touched[touched + 1 < len(sym)]
            rank[touched] = NONE
            r, m = self.find(sym[inner], sym[inner + 1])
            rank[inner], result[inner] = np.where(word[inner] == word[inner + 1], r, NONE), m
        sym, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_at))
        order = np.argsort(at, kind="stable")
        return self._ids(sym[order].astype(np.int64), at[order], chars, np.cumsum(sizes))

    def _ids(self, sym: np.ndarray, at: np.ndarray, chars: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no pieces become their bytes (or the unknown id)."""
        word = np.searchsorted(ends, at, side="right")
        odd = np.flatnonzero((sym < 0) | (sym >= self.n_pieces))
        if not len(odd):
            return sym, np.bincount(word, minlength=len(ends))
        width = np.ones(len(sym), np.int64)
        code = chars[at[odd]].astype(np.int64)
        if self.bytes_from >= 0:
            width[odd] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        first = np.cumsum(width) - width
        out = np.repeat(sym, width)
        if self.bytes_from < 0:
            out[first[odd]] = self.unknown
        else:
            raw = np.frombuffer(code.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
            n = width[odd]
            slot = np.repeat(first[odd] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out[slot] = raw.astype(np.int64) + self.bytes_from
        return out, np.bincount(np.repeat(word, width), minlength=len(ends))

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids."""
        n = self.text_at[ids + 1] - self.text_at[ids]
        first = np.cumsum(n) - n
        flat = self.text[np.repeat(self.text_at[ids] - first, n) + np.arange(int(n.sum()))].tobytes()
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(np.concatenate([[0], sizes]))].tolist()
        out = []
        for a, b in zip(ends, ends[1:], strict=False):
            text = flat[a:b]
            out.append((text[1:] if text[:1] == b" " else text).decode("utf-8", "replace"))
        return out


class Encoder:
    """Encodes texts and remembers the words it has met, up to REMEMBERED of them."""

    _WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.start, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, texts: list[str | None], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        if len(self.index) > REMEMBERED:
            self._forget()
        found, sizes, split = [], [], self._WORD.findall
        for t in texts:
            t = SPACE + t.replace(" ", SPACE) if t else ""
            w = split(t) if self.model.by_word else [t] * bool(t)
            found += w
            sizes.append(len(w))
        fresh = [w for w in dict.fromkeys(found) if w not in self.index]
        if fresh:
            ids, count = self.model.encode_words(fresh)
            self.index.update(zip(fresh, range(len(self.start), len(self.start) + len(fresh)), strict=True))
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
            self.ids, self.count = np.concatenate([self.ids, ids.astype(np.int32)]), np.concatenate([self.count, count])
        at = np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))
        n = self.count[at]
        out = self.ids[np.repeat(self.start[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        word_end = np.cumsum(np.concatenate([[0], n]))[np.cumsum(np.concatenate([[0], sizes])).astype(np.int64)]
        total = np.diff(word_end)
        if end:
            out = np.insert(out, word_end[1:], self.model.end)
            total = total + 1
        return out, total


def encode(docs: DataFrame, model: Model, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """Every row of ``docs`` with the ids of its whole text and an end id; missing text is empty.

    ``decoded`` names a column for the text that decoding these ids gives, made by the
    same task.  Columns that have an output's name are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # its size is the vocabulary's
    keep = [c for c in docs.columns if c not in (out, decoded)]
    names = [f"c{i}" for i in range(len(keep))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("t"))
    kinds = dict(given.dtypes)
    made_of = ["ids"] + ["said"] * bool(decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        for b in chunks(batches, "t"):
            ids, n = encoder(b.column("t").to_pylist())
            made = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids.astype(np.int32)))]
            if decoded:
                made.append(pa.array(held.value.decode(ids.astype(np.int64), n), pa.string()))
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), *made], [*names, *made_of])

    types = {"ids": "array<int>", "said": "string"}
    found = given.mapInArrow(run, ", ".join([*(f"{n} {kinds[n]}" for n in names), *(f"{n} {types[n]}" for n in made_of)]))
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
                        *[F.col(n).alias(c) for c, n in zip((out, decoded), made_of, strict=False)])


def decode(docs: DataFrame, model: Model, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every row of ``docs`` with the text of its ids; missing ids give a missing text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != out]
    names = [f"c{i}" for i in range(len(keep))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{ids}`").alias("t"))
    kinds = dict(given.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                col = b.column("t")
                sizes = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = held.value.decode(col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes)
                said = pa.array(texts, pa.string(), mask=col.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), said], [*names, "said"])

    made = given.mapInArrow(run, ", ".join([*(f"{n} {kinds[n]}" for n in names), "said string"]))
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.col("said").alias(out))
