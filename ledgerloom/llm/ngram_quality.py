"""Quality from the perplexity under an open-vocabulary word bigram model.

Word bigrams of all trusted texts are counted and grow with them.  Interpolated modified
Kneser-Ney discounts pass what unseen bigrams keep on to words (by the number of distinct
words before them), and what unseen words keep on to a spelling: a byte n-gram model of
fixed size (``SYMBOLS`` byte classes, ``ORDER``), the only part that tasks look up in a table.

Bits of a text are those of its words as spelled, which need no counts, plus a
correction for each word and each bigram that the model knows.  Corrections are rows
(key, bits); each document's distinct words and bigrams, with their numbers, are joined
with them in shards of the key.  Frequent words' keys are salted.  All this is done in
``WAVES`` passes, each for its share of the words and of the bigrams that begin with
them: every word and bigram of every text is in one of them, and only a pass's shuffles
take disk at a time.

Each row belongs to one of ``FOLDS`` folds by its text and is scored by the model of
the other folds' trusted texts.  So trusted rows, from which the limits come, are as
new to their model as all others are to theirs.

A document's bits per byte are shrunk towards its language's mean by ``PRIOR``
bytes, as short texts scatter; it is rejected outside the language's quantiles
over all trusted documents, widened by a margin.  With few trusted rows quantiles are
just the least and the greatest; they are blended, by the number of rows, with limits
that take the scatter around the language's mean from all languages and are no
narrower than the limits of all trusted rows.  The rate by bytes alone must be within
its own limits, found in the same way: copies among trusted texts widen those of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import NOT_SPACE, U64, Words, chunks, mix, utf8, word_hashes, words
from ledgerloom.session import Stages, durable

SYMBOLS = 64
ORDER = 4
PRIOR = 200
FOLDS = 2
#: keys that stand for a text's start and end, frequent words whose keys are salted, and salts of each
START, END = U64(0x51A7_0000_0000_0001), U64(0x51A7_0000_0000_0002)
HOT, SALTS = 1_000, 16
#: passes, each over all texts for its share of the words and of the bigrams that begin with them; a pass's shuffles go when it ends
WAVES = 8
#: share of trusted documents on each side of the limits, and the widening as a share of the limit
TAIL, MARGIN = 0.001, 0.03
#: trusted rows at which a language's own quantiles weigh as much as the wider limits, and those in standard deviations
ENOUGH, FAR = 1_000, 3.1
TOP_BITS = 24.0
LARGEST = np.iinfo(np.int32).max


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for b in chunks(batches, "t"):
        total += np.bincount(utf8(b.column("t"))[0], minlength=256)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["byte", "n"])


def alphabet(texts: DataFrame) -> np.ndarray:
    """Class of each byte: 1 .. SYMBOLS - 2 by frequency, SYMBOLS - 1 for all others; 0 is a text's start."""
    counts = texts.mapInArrow(_byte_counts, "byte int, n bigint").groupBy("byte").agg(F.sum("n").alias("n"))
    out = np.full(256, SYMBOLS - 1, np.int64)
    for k, row in enumerate(counts.orderBy(F.desc("n"), "byte").limit(SYMBOLS - 2).collect()):
        out[row.byte] = k + 1
    return out


def grams(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte, as a number; texts begin with ORDER - 1 start symbols."""
    symbol = classes[data]
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = np.zeros(len(data), np.int64)
    for back in range(ORDER - 1, -1, -1):
        prior = np.zeros(len(data), np.int64)
        prior[back:] = symbol[: len(data) - back]
        out = out * SYMBOLS + np.where(place >= back, prior, 0)
    return out


def count_grams(texts: DataFrame, classes: np.ndarray) -> DataFrame:
    """(gram, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, room = np.zeros(SYMBOLS ** ORDER, np.int32), LARGEST

        def parts() -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(total)
            for part in np.array_split(at, len(at) // 50_000 + 1):
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part].astype(np.int64))], ["gram", "n"])

        for b in chunks(batches, "t"):
            got, n = np.unique(grams(*utf8(b.column("t")), classes), return_counts=True)
            if n.sum() > room:  # before a count could overflow
                yield from parts()
                total[:], room = 0, LARGEST
            total[got] += n.astype(np.int32)
            room -= n.sum()
        yield from parts()

    return texts.mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and 3 or more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (max(float(c), 1.0) for c in counts)
    y = n1 / (n1 + 2 * n2)
    return np.clip([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.0, [0.0, 1.0, 2.0, 3.0])


def _interpolate(counts: np.ndarray, discount: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """P(x | context) for counts[context, x], backing off to ``lower`` (one row, or one for each context)."""
    cut = discount[np.minimum(counts, 3)]
    total = counts.sum(-1, keepdims=True)
    free = cut.sum(-1, keepdims=True)
    seen = total > 0
    return np.where(seen, (counts - cut + free * lower) / np.maximum(total, 1), lower)


def probabilities(top: DataFrame) -> np.ndarray:
    """bits[gram]: minus the base-2 logarithm of the last symbol's probability after the others, as float16."""
    a = SYMBOLS
    # order k: (last k symbols, distinct symbols before them); the highest order has plain counts
    orders = [top]
    for k in range(ORDER - 1, 0, -1):
        orders.append(orders[-1].select((F.col("gram") % a ** k).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    joined = durable(reduce(DataFrame.unionAll, [
        d.select(F.lit(ORDER - i).alias("k"), "gram", "n") for i, d in enumerate(orders)]))
    of = {(r.k, r.n): r["count"] for r in joined.where("n <= 4").groupBy("k", "n").count().collect()}
    discount = {k: _discounts(np.array([of.get((k, c), 0) for c in (1, 2, 3, 4)])) for k in range(1, ORDER + 1)}
    first = np.zeros(a)
    for r in joined.where("k = 1").collect():  # SYMBOLS rows
        first[r.gram] = r.n
    unigram = _interpolate(first[None, :].astype(np.int64), discount[1], np.full((1, a), 1 / a))[0]

    def shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        k, gram, n = (table.column(c).to_numpy() for c in ("k", "gram", "n"))
        own = int(key[0].as_py())
        lower = unigram[None, :]
        for order in range(2, ORDER + 1):
            # contexts before the shard's symbol x last symbols
            counts = np.zeros((a ** (order - 2), a), np.int64)
            at = k == order
            counts[gram[at] // (a * a), gram[at] % a] = n[at]
            # a longer context's lower order is the context without its first symbol
            lower = _interpolate(counts, discount[order], np.tile(lower, (counts.shape[0] // lower.shape[0], 1)))
        bits = np.minimum(-np.log2(np.maximum(lower, 2.0 ** -TOP_BITS)), TOP_BITS).astype(np.float16)
        return pa.table({"symbol": pa.array([own], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    sharded = joined.where("k > 1").withColumn("symbol", F.expr(f"cast(gram div {a} % {a} as int)"))
    parts = sharded.groupBy("symbol").applyInArrow(shard, "symbol int, bits binary")
    out = np.empty((a ** (ORDER - 2), a, a), np.float16)
    out[:] = -np.log2(np.maximum(unigram, 2.0 ** -TOP_BITS))
    for r in parts.toLocalIterator():  # SYMBOLS rows, a partition at a time
        out[:, r.symbol, :] = np.frombuffer(r.bits, np.float16).reshape(-1, a)
    return out.ravel()


def _waves(w: Words) -> np.ndarray:
    """The pass each word belongs to, from its length and three of its bytes: words of other passes needn't be hashed."""
    length = (w.end - w.start).astype(U64)
    near = w.data[w.start].astype(U64) | w.data[w.end - 1].astype(U64) << U64(8) | w.data[(w.start + w.end) // 2].astype(U64) << U64(16)
    return (mix(near | length << U64(24)) % U64(WAVES)).astype(np.int8)


def _bigram(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(left * U64(0x9E3779B97F4A7C15) + mix(right))


def _pairs(w: Words, wave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, left, right) of each bigram whose left word belongs to this pass, start and end of texts with
    words included, and how many of the first have a word on the left, not the start (which belongs to pass 0)."""
    mine = np.flatnonzero(_waves(w) == wave)
    ends = np.append(w.row[1:] != w.row[:-1], np.ones(min(len(w.row), 1), bool))[mine]
    rows = np.flatnonzero(w.per_row) if wave == 0 else np.zeros(0, np.int64)
    need = np.zeros(len(w.start), bool)
    need[mine] = need[mine[~ends] + 1] = need[w.first[rows]] = True
    hashed = np.zeros(len(w.start), U64)
    hashed[need] = word_hashes(Words(w.data, w.offsets, w.start[need], w.end[need], w.row[need], w.per_row))[0]
    right = np.full(len(mine), END)
    right[~ends] = hashed[mine[~ends] + 1]
    return (np.concatenate([w.row[mine], rows]), np.concatenate([hashed[mine], np.full(len(rows), START)]),
            np.concatenate([right, hashed[w.first[rows]]]), len(mine))


def _spelled(w: Words, at: np.ndarray, tables: list[np.ndarray], classes: np.ndarray) -> list[np.ndarray]:
    """Bits of the words at these indexes by each table, from a space before to the space after them."""
    if not len(at):
        return [np.zeros(0) for _ in tables]
    size = w.end[at] - w.start[at] + 2
    offsets = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
    inner = (place > 0) & (place < np.repeat(size, size) - 1)
    flat = np.full(offsets[-1], 0x20, np.uint8)
    flat[inner] = w.data[(np.repeat(w.start[at], size) + place - 1)[inner]]
    g = grams(flat, offsets, classes)
    return [np.add.reduceat(np.where(place > 0, t[g].astype(np.float64), 0.0), offsets[:-1]) for t in tables]


def spell_words(texts: DataFrame, held: list[Broadcast], classes: np.ndarray) -> DataFrame:
    """(key, wave, s0, s1 ..) for each distinct word: its pass, and its spelling bits by each fold's table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [table.value for table in held]
        for b in chunks(batches, "t"):
            w = words(*utf8(b.column("t")), NOT_SPACE)
            known, first = np.unique(word_hashes(w)[0], return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(known.view(np.int64)), pa.array(_waves(w)[first]), *map(pa.array, _spelled(w, first, tables, classes))],
                ["key", "wave", *(f"s{f}" for f in range(FOLDS))])

    made = texts.select("t").mapInArrow(run, ", ".join(["key bigint, wave tinyint", *(f"s{f} double" for f in range(FOLDS))]))
    return made.groupBy("key").agg(F.max("wave").alias("wave"), *[F.max(f"s{f}").alias(f"s{f}") for f in range(FOLDS)])


def count_pairs(texts: DataFrame, wave: int) -> DataFrame:
    """(v, w, n0, n1 ..) for the bigrams of a pass: what the model for each fold has seen, in all other folds."""
    folds = range(FOLDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "t"):
            row, left, right, _ = _pairs(words(*utf8(b.column("t")), NOT_SPACE), wave)
            fold = b.column("fold").to_numpy()[row]
            with np.errstate(over="ignore"):
                _, at, n = np.unique(mix(_bigram(left, right) + fold.astype(U64)), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left[at].view(np.int64)), pa.array(right[at].view(np.int64)), *(pa.array(np.where(fold[at] != f, n, 0)) for f in folds)],
                ["v", "w", *(f"n{f}" for f in folds)])

    made = texts.mapInArrow(run, ", ".join(["v bigint, w bigint", *(f"n{f} bigint" for f in folds)]))
    return made.groupBy("v", "w").agg(*[F.sum(f"n{f}").alias(f"n{f}") for f in folds])


def _off(discount: np.ndarray, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(x)) for x in discount]), (F.least(n, F.lit(3)) + 1).cast("int"))


@dataclass
class WordModel:
    """``one``: (key, wave, b, c, keep, d for each fold) of each word, start and end; ``cut``: each fold's bigram discounts;
    what each word and each text costs besides its spelling, and the most frequent words."""

    one: DataFrame
    cut: list[np.ndarray]
    per_word: list[float]
    per_text: list[float]
    hot: list[int]


def word_model(texts: DataFrame, held: list[Broadcast], classes: np.ndarray) -> WordModel:
    """What words tell under each fold's model: their bigrams are counted in passes, of which only sums for each word stay."""
    folds, spark = range(FOLDS), texts.sparkSession
    lefts, rights = [], []
    with Stages(spark) as counting:
        spelling = durable(spell_words(texts, held, classes))
        for wave in range(WAVES):
            with Stages(spark) as counted:
                pairs = durable(count_pairs(texts, wave))
                n = [F.col(f"n{f}") for f in folds]
                # numbers of bigrams seen 1, 2, 3, 4 and more times
                lefts.append(counted.keep(pairs.groupBy(F.col("v").alias("key")).agg(
                    *[F.sum(n[f]).alias(f"c{f}") for f in folds],
                    *[F.count(F.when(n[f] == k if k < 5 else n[f] >= k, 1)).alias(f"l{f}_{k}") for f in folds for k in range(1, 6)]).withColumn(
                    "left_wave", F.lit(wave).cast("tinyint"))))
                rights.append(counted.keep(pairs.groupBy(F.col("w").alias("key")).agg(*[F.count(F.when(n[f] > 0, 1)).alias(f"k{f}") for f in folds])))
        left = reduce(DataFrame.unionAll, lefts)
        after = durable(reduce(DataFrame.unionAll, rights).groupBy("key").agg(*[F.sum(f"k{f}").alias(f"k{f}") for f in folds]))
        of = left.agg(*[F.coalesce(F.sum(f"l{f}_{k}"), F.lit(0)).alias(f"l{f}_{k}") for f in folds for k in range(1, 6)]).first()
        cut2 = [_discounts(np.array([of[f"l{f}_{k}"] for k in (1, 2, 3, 4)])) for f in folds]
        types = [max(sum(of[f"l{f}_{k}"] for k in range(1, 6)), 1) for f in folds]
        kept = [sum((F.col(f"l{f}_{k}") * float(cut2[f][min(k, 3)]) for k in range(1, 6)), F.lit(0.0)) for f in folds]
        context = left.select("key", "left_wave", *[f"c{f}" for f in folds], *[
            F.when(F.col(f"c{f}") > 0, F.greatest(kept[f] / F.col(f"c{f}"), F.lit(1e-9))).otherwise(1.0).alias(f"keep{f}") for f in folds])
        of = after.agg(*[F.count(F.when(F.col(f"k{f}") == k, 1)).alias(f"k{f}_{k}") for f in folds for k in (1, 2, 3, 4)],
                       *[F.count(F.when(F.col(f"k{f}") > 2, 1)).alias(f"more{f}") for f in folds]).first()
        cut1 = [_discounts(np.array([of[f"k{f}_{k}"] for k in (1, 2, 3, 4)])) for f in folds]
        free = [float(cut1[f][1] * of[f"k{f}_1"] + cut1[f][2] * of[f"k{f}_2"] + cut1[f][3] * of[f"more{f}"]) / types[f] for f in folds]
        free = [max(x, 1e-9) if of[f"k{f}_1"] + of[f"k{f}_2"] + of[f"more{f}"] else 1.0 for f, x in enumerate(free)]
        both = after.join(spelling, "key", "left").join(context, "key", "full")
        # the end of a text is no word and has no spelling
        unknown = [-np.log2(free[f]) + F.coalesce(F.col(f"s{f}"), F.lit(0.0)) for f in folds]
        bits = [F.when(F.col(f"k{f}") > 0, -F.log2((F.col(f"k{f}") - _off(cut1[f], F.col(f"k{f}"))) / types[f] + F.pow(
            F.lit(2.0), -unknown[f]))).otherwise(unknown[f]) for f in folds]
        keep = [F.coalesce(f"keep{f}", F.lit(1.0)) for f in folds]
        one = counting.keep(both.select("key", F.coalesce("wave", "left_wave").alias("wave"), *sum([[
            bits[f].alias(f"b{f}"), F.coalesce(F.col(f"c{f}"), F.lit(0)).alias(f"c{f}"), keep[f].alias(f"keep{f}"),
            (bits[f] - unknown[f] - F.log2(keep[f])).alias(f"d{f}")] for f in folds], [])))
    edge = {r.key: r for r in one.where(F.col("key").isin([int(x.view(np.int64)) for x in (START, END)])).collect()}
    first, last = (edge.get(int(x.view(np.int64))) for x in (START, END))
    text = [(-np.log2(first[f"keep{f}"]) + last[f"b{f}"]) if first and last else 0.0 for f in folds]
    hot = [r.key for r in one.orderBy(F.desc(sum((F.col(f"c{f}") for f in folds), F.lit(0))), "key").limit(HOT).collect()]
    return WordModel(one, cut2, [float(-np.log2(x)) for x in free], [float(x) for x in text], hot)


def corrections(texts: DataFrame, model: WordModel, wave: int) -> DataFrame:
    """(v, w, d0, d1 ..): what a pass's words (without v) and bigrams add to the spelled bits under each fold's model."""
    folds, one = range(FOLDS), model.one
    own = one.where(F.col("wave") == wave)
    single = own.select(F.lit(None).cast("bigint").alias("v"), F.col("key").alias("w"), *[f"d{f}" for f in folds])
    pair = count_pairs(texts, wave).join(own.select(F.col("key").alias("v"), *[f"c{f}" for f in folds], *[f"keep{f}" for f in folds]), "v").join(
        one.select(F.col("key").alias("w"), *[f"b{f}" for f in folds]), "w")
    likely = lambda f: (F.col(f"n{f}") - _off(model.cut[f], F.col(f"n{f}"))) / F.col(f"c{f}") + F.col(f"keep{f}") * F.pow(F.lit(2.0), -F.col(f"b{f}"))
    return single.unionAll(pair.select("v", "w", *[F.when(F.col(f"n{f}") > 0, -F.log2(F.greatest(likely(f), F.lit(1e-300))) + F.log2(f"keep{f}") - F.col(
        f"b{f}")).otherwise(0.0).alias(f"d{f}") for f in folds]))


def _keyed(rows: DataFrame, hot: list[int]) -> DataFrame:
    """(key, d): the corrections by the keys that ``document_keys`` gives, those of each fold, a frequent word's once for each salt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array(sorted(hot), np.int64)
        for b in batches:
            v, w = b.column("v"), b.column("w").to_numpy()
            single = v.is_null().to_numpy(zero_copy_only=False)
            base = np.where(single, w.view(U64), _bigram(v.fill_null(0).to_numpy().view(U64), w.view(U64)))
            times = np.where(single & np.isin(w, known), SALTS, 1)
            for f in range(FOLDS):
                d = b.column(f"d{f}").to_numpy(zero_copy_only=False)
                some = np.flatnonzero(d)
                at = np.repeat(some, times[some])
                salt = np.arange(len(at)) - np.repeat(np.cumsum(times[some]) - times[some], times[some])
                with np.errstate(over="ignore"):
                    key = mix(base[at] + U64(f)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key ^ (salt << 40)), pa.array(d[at])], ["key", "d"])

    return rows.mapInArrow(run, "key bigint, d double")


def document_keys(docs: DataFrame, hot: list[int], wave: int) -> DataFrame:
    """(key, file, place, n) for each distinct word and bigram of a pass in each row of ``docs`` (``t``, ``file``, ``place``,
    ``fold``), row by row, as repeated row keys take little room in shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array(sorted(hot), np.int64)
        for b in chunks(batches, "t"):
            row, left, right, single = _pairs(words(*utf8(b.column("t")), NOT_SPACE), wave)
            rows, base = np.concatenate([row[:single], row]), np.concatenate([left[:single], _bigram(left, right)])
            with np.errstate(over="ignore"):
                key = mix(base + b.column("fold").to_numpy().astype(U64)[rows])
                _, at, n = np.unique(mix(key + rows.astype(U64) * U64(0xD1B54A32D192ED03)), return_index=True, return_counts=True)
            order = np.argsort(rows[at], kind="stable")
            at, n = at[order], n[order].astype(np.int32)
            place, key = b.column("place").to_numpy()[rows[at]], key[at].view(np.int64)
            salted = (at < single) & np.isin(base[at].view(np.int64), known)
            key = np.where(salted, key ^ (place % SALTS << 40), key)
            file = b.column("file").to_numpy()[rows[at]]
            for i in range(0, len(key), 50_000):
                part = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (key, file, place, n)], ["key", "file", "place", "n"])

    return docs.select("t", "file", "place", "fold").mapInArrow(run, "key bigint, file bigint, place bigint, n int")


def spelled(docs: DataFrame, held: list[Broadcast], classes: np.ndarray, per_word: list[float], per_text: list[float]) -> DataFrame:
    """(file, place, n_bytes, bits, chars) for each row of ``docs`` (``t``, ``file``, ``place``, ``fold``): bits before corrections, and those by bytes alone.

    Space is by the byte tables too, but for the one space that ends a word, which its spelling has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [table.value for table in held]
        for b in chunks(batches, "t"):
            data, offsets = utf8(b.column("t"))
            w = words(data, offsets, NOT_SPACE)
            _, first, which = np.unique(word_hashes(w)[0], return_index=True, return_inverse=True)
            gap = ~NOT_SPACE[data]
            gap[w.end[w.end < len(data)]] &= data[w.end[w.end < len(data)]] != 0x20
            starts = offsets[:-1][(offsets[:-1] < len(data)) & (np.diff(offsets) > 0)]
            gap[starts] = ~NOT_SPACE[data[starts]]
            at = np.flatnonzero(gap)
            in_row = np.searchsorted(offsets, at, side="right") - 1
            every, n, fold = grams(data, offsets, classes), b.num_rows, b.column("fold").to_numpy()
            g, bits, chars = every[at], np.zeros(n), np.zeros(n)
            for f, (table, word) in enumerate(zip(tables, _spelled(w, first, tables, classes), strict=True)):
                # counts of nothing are integers, whatever their weights
                total = np.zeros(n) + np.bincount(w.row, word[which], n) + np.bincount(in_row, table[g].astype(np.float64), n)
                total += w.per_row * per_word[f] + np.where(w.per_row > 0, per_text[f], 0.0)
                bits = np.where(fold == f, total, bits)
                sums = np.concatenate([[0.0], np.cumsum(table[every], dtype=np.float64)])
                chars = np.where(fold == f, sums[offsets[1:]] - sums[offsets[:-1]], chars)
            yield pa.RecordBatch.from_arrays(
                [b.column("file"), b.column("place"), pa.array(np.diff(offsets)), pa.array(bits), pa.array(chars)],
                ["file", "place", "n_bytes", "bits", "chars"])

    return docs.select("t", "file", "place", "fold").mapInArrow(run, "file bigint, place bigint, n_bytes bigint, bits double, chars double")


def _rated(rows: DataFrame, known: DataFrame, bits: str) -> DataFrame:
    """``rows`` with their shrunk rate and its limits by the trusted rows in ``known``: <bits>_rate, <bits>_low, <bits>_high."""
    total = known.agg((F.sum(bits) / F.sum("n_bytes")).alias("mean")).first().mean
    per_lang = known.groupBy("lang").agg((F.sum(bits) / F.sum("n_bytes")).alias("mean"))
    means = durable(per_lang.where("lang is not null"))
    shrunk = lambda d: d.join(means, "lang", "left").withColumn(
        "rate", (F.col(bits) + PRIOR * F.coalesce("mean", F.lit(total or 0.0))) / (F.col("n_bytes") + PRIOR))
    rates = durable(shrunk(known).select("lang", "rate", (F.col("rate") / F.coalesce("mean", F.lit(total or 0.0))).alias("share")))
    edges = lambda c: F.percentile_approx(c, [TAIL, 1 - TAIL], 100_000)
    spread = rates.agg(F.count("rate").alias("n"), F.avg("rate").alias("mean"), F.stddev("rate").alias("sd"), edges("rate").alias("e"),
                       edges("share").alias("s"), F.stddev("share").alias("sd_share")).first()
    cut, low_share, high_share = [None, None], 1.0, 1.0
    if spread.n:
        far, own = FAR * (1 + 1 / spread.n) ** 0.5, spread.n / (spread.n + ENOUGH)
        wide = [min(spread.e[0], spread.mean - far * (spread.sd or 0.0)), max(spread.e[1], spread.mean + far * (spread.sd or 0.0))]
        cut = [own * e + (1 - own) * w for e, w in zip(spread.e, wide, strict=True)]
        low_share = min(spread.s[0], 1 - FAR * (spread.sd_share or 0.0)) - 1
        high_share = max(spread.s[1], 1 + FAR * (spread.sd_share or 0.0)) - 1
    # how far a language's texts scatter around its mean is taken from all languages until it has enough of its own;
    # a model that has seen few texts of it, unevenly dealt to folds, scatters more
    of_lang = rates.where("lang is not null").groupBy("lang").agg(F.count("rate").alias("n"), edges("rate").alias("e")).join(means, "lang")
    own, unsure = F.col("n") / (F.col("n") + ENOUGH), 1 + 3 / F.sqrt(F.col("n"))
    limits = durable(of_lang.select(
        "lang",
        (own * F.col("e")[0] + (1 - own) * F.least(F.col("mean") * (1 + low_share * unsure), F.lit(cut[0]))).alias("low"),
        (own * F.col("e")[1] + (1 - own) * F.greatest(F.col("mean") * (1 + high_share * unsure), F.lit(cut[1]))).alias("high")))
    low, high = (F.coalesce(c, F.lit(v).cast("double")) * m for c, v, m in (
        ("low", cut[0], 1 - MARGIN), ("high", cut[1], 1 + MARGIN)))
    return shrunk(rows).join(limits, "lang", "left").withColumns({f"{bits}_low": low, f"{bits}_high": high}).drop(
        "mean", "low", "high").withColumnRenamed("rate", f"{bits}_rate")


def _bits(marked: DataFrame, good: DataFrame, n_keep: int) -> DataFrame:
    """(id, lang, n_bytes, bits, chars, k0 ..) for each row of ``marked``, by the model of the good ids' texts."""
    folds, spark = range(FOLDS), marked.sparkSession
    classes = alphabet(marked.select("t"))
    # the same join at every size: labels grow with the documents
    trusted = durable(marked.join(good.hint("merge"), F.col("id") == F.col("good"), "left_semi").select("t", "fold"), "zstd")
    # one by one, so that the driver holds a single table
    held = [spark.sparkContext.broadcast(probabilities(durable(count_grams(trusted.where(F.col("fold") != f).select("t"), classes)))) for f in folds]
    model = word_model(trusted, held, classes)
    base = durable(spelled(marked, held, classes, model.per_word, model.per_text))
    for table in held:
        table.destroy()  # what is written is all that is needed from here on
    parts = []
    for wave in range(WAVES):
        with Stages(spark) as own:
            some = durable(_keyed(corrections(trusted, model, wave), model.hot))
            hits = document_keys(marked, model.hot, wave).join(some.hint("merge"), "key")
            parts.append(own.keep(hits.groupBy("file", "place").agg(F.sum(F.col("n") * F.col("d")).alias("d"))))
    fixed = reduce(DataFrame.unionAll, parts).groupBy("file", "place").agg(F.sum("d").alias("d"))
    at = ["file", "place"]
    return marked.drop("t").join(base.hint("merge"), at).join(fixed.hint("merge"), at, "left").select(
        "id", "lang", "n_bytes", F.greatest(F.col("bits") + F.coalesce("d", F.lit(0.0)), F.lit(0.0)).alias("bits"), "chars", *[
            f"k{i}" for i in range(n_keep)])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          label: str = "quality", keep: list[str] | None = None, key: str | None = None) -> DataFrame:
    """(id, lang, n_bytes, bits, perplexity, low, high, kept) and the ``keep`` columns for each row of ``docs``.

    Trusted are rows with label 1.  Languages without trusted rows, and a missing
    language, get the limits of all trusted rows; without any trusted row everything
    is kept.  Empty and missing texts are at their language's mean and kept.  ``key`` names a
    column of ``row_keys``; without it the rows are numbered and written.
    """
    keep = list(keep or [])
    good = labels.where(F.col(label) == 1).select(F.col(id_col).alias("good")).distinct()
    with Stages(docs.sparkSession) as stages:
        row = F.col(f"`{key}`") if key else F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("place"))
        marked = docs.select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("t"),
            F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(FOLDS)).cast("int").alias("fold"), row["file"].alias("file"), row["place"].alias("place"),
            *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
        marked = marked if key else durable(marked)
        raw = stages.keep(_bits(marked, good, len(keep)))
    known = raw.join(good, F.col("id") == F.col("good"), "left_semi").where("n_bytes > 0")
    rated = _rated(_rated(raw, known, "bits"), known, "chars")
    inside = [(F.col(f"{b}_rate") >= F.col(f"{b}_low")) & (F.col(f"{b}_rate") <= F.col(f"{b}_high")) for b in ("bits", "chars")]
    return rated.select(
        F.col("id").alias(id_col), F.col("lang").alias(lang), "n_bytes", "bits", F.pow(F.lit(2.0), "bits_rate").alias("perplexity"),
        F.pow(F.lit(2.0), "bits_low").alias("low"), F.pow(F.lit(2.0), "bits_high").alias("high"),
        F.coalesce(inside[0] & inside[1] | (F.col("n_bytes") == 0), F.lit(True)).alias("kept"), *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)])
