"""Exact ranked lexical search with a tree over items and trees over documents.

Both sides are hierarchies whose nodes hold coordinate maxima: a document node holds, for
each term, the largest contribution of that term to a score among its documents; an
item node holds the terms of its items.  The sum of a document node's maxima over an
item node's terms bounds every score between the two.  A pair of nodes goes down to
its children only if its bound reaches the weakest of the items' k-th best scores so
far; all others are pruned as a whole, and nothing is lost by that.

Documents are scanned once and keep only terms that some item may have (told by a bitmap
of fixed size; false marks cost space only, as terms are compared as text afterwards).
Tasks build the trees of their documents; items travel to them in blocks of bounded
size, a pass over the scanned documents for each block.  A first pass over about a
sixteenth of the documents gives each item a k-th best score to start from; the second
covers all of them, so each task returns few rows besides the final ones.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import ALNUM_LOWER, LOWER, chunks, utf8, word_hashes, words
from ledgerloom.session import durable

BITS = 23
#: (item, term) pairs of a block of items at most, but for one longer item
BLOCK_TERMS = 1 << 16
#: children of a tree node, documents of a tree at most, and their terms
FAN, TREE_DOCS, TREE_TERMS = 4, 2048, 1 << 19
#: pairs of terms and item nodes that are expanded at a time; a search for a term costs as much as so many such pairs
STEP, SEARCH = 1 << 21, 4
#: one of so many documents starts the search
SEED = 16


# -- texts to terms ---------------------------------------------------------------------

def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte spans as strings, without a Python object for each."""
    size = (end - start).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(ends[-1]) - np.repeat(ends[:-1] - start, size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[at])))


def _count_terms(marks):
    """For each row: number of terms, and its distinct terms (of those that ``marks`` has) with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if marks is None else np.unpackbits(np.frombuffer(marks.value, np.uint8), bitorder="little").view(bool)
        for batch in chunks(batches, "t"):
            data, offsets = utf8(batch.column("t"))
            data = LOWER[data]
            w = words(data, offsets, ALNUM_LOWER)
            h, row, at = word_hashes(w)[0], w.row, np.arange(len(w.start))
            if bits is not None:
                at = np.flatnonzero(bits[h >> np.uint64(64 - BITS)])
                h, row = h[at], row[at]
            order = np.lexsort((h, row))
            h, row, at = h[order], row[order], at[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            tf = np.diff(np.append(first, len(h)))
            lists = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=batch.num_rows))]).astype(np.int32)
            terms = _spans(data, w.start[at[first]], w.end[at[first]]).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(w.per_row.astype(np.int64)), pa.ListArray.from_arrays(pa.array(lists), terms),
                 pa.ListArray.from_arrays(pa.array(lists), pa.array(tf.astype(np.int64))), pa.ListArray.from_arrays(pa.array(lists), pa.array(h[first].view(np.int64)))],
                ["id", "n", "terms", "tf", "hashes"])

    return run


def _terms_of(df: DataFrame, id_col: str, text: str, marks=None) -> DataFrame:
    given = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t"))
    kind = given.dtypes[0][1]
    return given.mapInArrow(_count_terms(marks), f"id {kind}, n bigint, terms array<string>, tf array<bigint>, hashes array<bigint>")


def _bitmap(items: DataFrame) -> bytes:
    """At most 2^(BITS - 6) rows come to the driver, whatever the number of items."""
    rows = items.select(F.explode("hashes").alias("h")).select(F.shiftrightunsigned("h", 64 - BITS).alias("at")).groupBy(
        F.shiftright("at", 6).alias("block")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).collect()
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    for block, bits in rows:
        bitmap[block] = bits
    return bitmap.tobytes()


# -- trees ------------------------------------------------------------------------------

@dataclass
class Level:
    """Sparse rows of one level's nodes: row r has the terms at[start[r]: start[r + 1]], in rising order."""

    start: np.ndarray
    term: np.ndarray
    value: np.ndarray

    @property
    def nodes(self) -> int:
        return len(self.start) - 1

    def parents(self) -> Level:
        """Nodes of FAN neighbours each, with the largest value of every term."""
        node = np.repeat(np.arange(self.nodes) // FAN, np.diff(self.start))
        order = np.lexsort((self.term, node))
        node, term, value = node[order], self.term[order], self.value[order]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (node[1:] != node[:-1])
        first = np.flatnonzero(new)
        most = np.maximum.reduceat(value, first) if len(first) else value
        sizes = np.bincount(node[first], minlength=-(-self.nodes // FAN))
        return Level(np.concatenate([[0], np.cumsum(sizes)]), term[first], most)

    def taken(self, rows: np.ndarray) -> Level:
        sizes = np.diff(self.start)[rows]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) - np.repeat(ends[:-1] - self.start[rows], sizes)
        return Level(ends, self.term[at], self.value[at])


def tree(leaves: Level) -> list[Level]:
    """Levels from the root's children's parents down: the last one is ``leaves``."""
    levels = [leaves]
    while levels[0].nodes > 1:
        levels.insert(0, levels[0].parents())
    return levels


def _alike_first(level: Level, weight: np.ndarray) -> np.ndarray:
    """An order in which rows with the same strongest terms are neighbours."""
    row = np.repeat(np.arange(level.nodes), np.diff(level.start))
    order = np.lexsort((level.term, -weight, row))
    rank = np.arange(len(row)) - np.repeat(level.start[:-1], np.diff(level.start))
    keys = np.full((3, level.nodes), -1, np.int64)
    for k in range(3):
        here = rank == k
        keys[k, row[here]] = level.term[order][here]
    return np.lexsort(keys[::-1])


class Items:
    """A block of items: their tree and, for each level, the nodes that have a term."""

    def __init__(self, start: np.ndarray, term: np.ndarray, vocabulary: int) -> None:
        leaves = Level(start, term, np.ones(len(term), np.int64))
        self.order = _alike_first(leaves, np.bincount(term, minlength=vocabulary)[term])
        self.levels = tree(leaves.taken(self.order))
        self.holders = []
        for level in self.levels:
            node = np.repeat(np.arange(level.nodes), np.diff(level.start))
            by = np.argsort(level.term, kind="stable")
            self.holders.append((np.searchsorted(level.term[by], np.arange(vocabulary + 1)), node[by]))


def _pieces(sizes: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of rows with about STEP entries together, and each entry's place inside its row's."""
    piece = np.cumsum(sizes) // STEP
    for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]):
        ends = np.cumsum(sizes[a:b])
        if b > a and ends[-1]:
            yield slice(a, b), np.arange(ends[-1]) - np.repeat(ends - sizes[a:b], sizes[a:b])


def bounds(items: Items, level: int, docs: Level, alive: np.ndarray) -> np.ndarray:
    """Sums of ``docs``' values over the terms of each item node, for the pairs that are alive (item nodes x docs).

    While many are, each document node's terms meet the item nodes that hold them; of
    few pairs, the item node's terms are looked up in the document node's.  Sums stay
    below 2^53, where doubles are exact.
    """
    first, holder = items.holders[level]
    nodes = items.levels[level]
    out = np.zeros(alive.size)
    many = first[docs.term + 1] - first[docs.term]
    pair = np.flatnonzero(alive)
    own = np.diff(nodes.start)[pair // docs.nodes]
    row = np.repeat(np.arange(docs.nodes), np.diff(docs.start))
    if SEARCH * int(own.sum()) < int(many.sum()):
        keys = row * (len(first) - 1) + docs.term
        for cut, at in _pieces(own):
            node, doc = pair[cut] // docs.nodes, pair[cut] % docs.nodes
            term = nodes.term[at + np.repeat(nodes.start[node], own[cut])]
            key = np.repeat(doc, own[cut]) * (len(first) - 1) + term
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found = keys[place] == key
            out += np.bincount(np.repeat(pair[cut], own[cut])[found], docs.value[place[found]], minlength=alive.size)
    else:
        flat = alive.ravel()
        for cut, at in _pieces(many):
            to = holder[at + np.repeat(first[docs.term[cut]], many[cut])] * docs.nodes + np.repeat(row[cut], many[cut])
            live = flat[to]
            out += np.bincount(to[live], np.repeat(docs.value[cut], many[cut])[live], minlength=alive.size)
    return out.reshape(alive.shape).astype(np.int64)


class Best:
    """The k best documents of each item so far, as (score, id) with ties by id, missing ids last.

    ``least`` has the score that a further document must reach: the weakest of the k best,
    or the one the search started with.
    """

    def __init__(self, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least.copy()
        self.found: list[list[tuple]] = [[] for _ in least]

    def add(self, item: int, score: np.ndarray, ids: pa.Array) -> None:
        if len(score) > self.k:
            good = np.flatnonzero(score >= np.partition(score, -self.k)[-self.k])
            score, ids = score[good], ids.take(pa.array(good))
        more = [(-s, i is None, 0 if i is None else i) for s, i in zip(score.tolist(), ids.to_pylist(), strict=True)]
        self.found[item] = sorted(self.found[item] + more)[: self.k]
        if len(self.found[item]) == self.k:
            self.least[item] = max(self.least[item], -self.found[item][-1][0])


def search_tree(items: Items, docs: Level, ids: pa.Array, best: Best) -> int:
    """Adds the documents' scores to ``best``; returns the number of pairs whose score was needed.

    Both trees are gone down level by level; the shallower one waits at its leaves.
    """
    levels, least = tree(docs), best.least[items.order]
    depth = max(len(levels), len(items.levels))
    at_items = [min(s, len(items.levels) - 1) for s in range(depth)]
    at_docs = [min(s, len(levels) - 1) for s in range(depth)]
    kept = np.ones((1, 1), bool)
    for step, (i, d) in enumerate(zip(at_items, at_docs, strict=True)):
        if step and i != at_items[step - 1]:
            kept = np.repeat(kept, FAN, axis=0)[: items.levels[i].nodes]
        if step and d != at_docs[step - 1]:
            kept = np.repeat(kept, FAN, axis=1)[:, : levels[d].nodes]
        weakest = np.minimum.reduceat(least, np.arange(0, len(least), FAN ** (len(items.levels) - 1 - i)))
        some = np.flatnonzero(kept.any(0))
        if not len(some):
            return 0
        alive = kept[:, some]
        bound = bounds(items, i, levels[d].taken(some), alive)
        alive &= bound >= np.maximum(weakest, 1)[:, None]
        kept[:, some] = alive
    # between leaves a bound is the score itself
    for node in np.flatnonzero(alive.any(1)):
        at = np.flatnonzero(alive[node])
        best.add(int(items.order[node]), bound[node, at], ids.take(pa.array(some[at])))
    return int(alive.sum())


# -- search -----------------------------------------------------------------------------

@dataclass
class Block:
    """What tasks get of a block of items, in plain arrays.

    Item i has the terms at[start[i]: start[i + 1]]; ``least`` has for each a score that
    at least k documents reach, or 0.
    """

    vocabulary: list[str]
    weight: np.ndarray
    start: np.ndarray
    term: np.ndarray
    least: np.ndarray


def _trees(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(sizes) // TREE_TERMS + np.arange(batch.num_rows) // TREE_DOCS
    for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def _search(block, k: int, documents: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weight, start, items_term, least = block.value
        vocabulary, items = pa.array(vocabulary, pa.string()), Items(start, items_term, len(vocabulary))
        best, kind = Best(k, least), None
        for part in (t for batch in batches for t in _trees(batch)):
            kind, lists = part.column("id").type, part.column("terms")
            known = pc.index_in(lists.flatten(), value_set=vocabulary)
            has = known.is_valid().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[has]
            term = known.drop_null().to_numpy().astype(np.int64)
            tf = part.column("tf").flatten().to_numpy()[has]
            m = 10 + 90 * part.column("n").to_numpy() * documents // max(length, 1)
            value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
            by = np.lexsort((term, row))
            docs = Level(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))]), term[by], value[by])
            order = _alike_first(docs, -weight[docs.term])
            search_tree(items, docs.taken(order), part.column("id").take(pa.array(order)), best)
        rows = [(item, None if none else i, -s) for item, found in enumerate(best.found) for s, none, i in found]
        if rows:
            item, ids, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, kind), pa.array(score, pa.int64())], ["item", "id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[list]:
    """Items with their terms, a bounded number of terms at a time."""
    block, size = [], 0
    for item in items.toLocalIterator():
        if block and size + len(item.terms) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append(item)
        size += len(item.terms)
    if block:
        yield block


def _block(found: list) -> Block:
    vocabulary = {t: w for item in found for t, w in item.terms}
    number = {t: i for i, t in enumerate(vocabulary)}
    start = np.concatenate([[0], np.cumsum([len(item.terms) for item in found])]).astype(np.int64)
    term = np.array([t for item in found for t in sorted(number[t] for t, _ in item.terms)], np.int64)
    return Block(list(vocabulary), np.array(list(vocabulary.values()), np.int64), start, term, np.zeros(len(found), np.int64))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0.

    Terms are runs of letters and digits (A-Z in lower case, all of non-ASCII).  An
    item's score of a document sums, over its distinct terms, weight times saturated
    count, in whole numbers: weight floor(1000 ln((2N + 2) / (2 df + 1))), count
    10^9 tf div (1000 tf + 8 m), m = 10 + 90 n N div L, with N the documents that have
    terms, L their terms and n the document's.  Equal scores are ranked by ascending id,
    missing ids last.  Missing and empty texts have no terms and never occur.  Rows are
    documents and items of their own even where ids repeat.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = durable(_terms_of(items, item_id, item_text).withColumn("item_row", F.monotonically_increasing_id()))
    marks = spark.sparkContext.broadcast(_bitmap(asked))
    scanned = durable(_terms_of(docs, id_col, text, marks).drop("hashes"))
    total = scanned.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()

    of_items = asked.select("item_row", F.explode("terms").alias("term"))
    held = scanned.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = of_items.select("term").distinct().join(held, "term").withColumn(
        "weight", F.floor(1000 * F.log((F.lit(2.0 * total.documents) + 2) / (2 * F.col("df") + 1))).cast("bigint"))
    ready = durable(of_items.join(weights, "term").groupBy("item_row").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms")))

    def best(of: DataFrame, block: Block) -> DataFrame:
        sent = spark.sparkContext.broadcast((block.vocabulary, block.weight, block.start, block.term, block.least))
        kind = f"item int, id {dict(scanned.dtypes)['id']}, score bigint"
        return _best(of.mapInArrow(_search(sent, k, total.documents, total.length), kind), k)

    parts = []
    for found in _blocks(ready):
        block = _block(found)
        start = best(scanned.where(F.pmod(F.xxhash64("id", "n"), F.lit(SEED)) == 0), block)
        for row in start.where(F.col("rank") == k).select("item", "score").collect():
            block.least[row.item] = row.score
        rows = spark.createDataFrame([(i, item.item_row) for i, item in enumerate(found)], "item int, item_row bigint")
        parts.append(durable(best(scanned, block).join(rows, "item").select("item_row", "rank", "id", "score")))
    if not parts:
        kind = f"{item_id} {dict(asked.dtypes)['id']}, rank int, {id_col} {dict(scanned.dtypes)['id']}, score bigint"
        return spark.createDataFrame([], kind)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    names = asked.select("item_row", F.col("id").alias("asked_id"))
    return found.join(names, "item_row").select(F.col("asked_id").alias(item_id), "rank", F.col("id").alias(id_col), "score")
