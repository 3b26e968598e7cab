"""Benchmark decontamination as a prefix-filtered containment join.

A window is ``width`` consecutive words of a benchmark item (a shorter item is one
window).  Its tokens are shingles of up to three words.  As a window must be
contained whole, one necessary token suffices as its prefix: the one that is
rarest over all documents.  Steps:

1. Documents are scanned once.  A fixed-size bitmap of the benchmark's shingles
   (``BITS`` bits, whatever the benchmark's size) marks hits; only runs of hits
   long enough for the shortest window are kept, with their words.  False marks
   cost time but nothing else, as every window is verified.
2. Shingles of these passages are counted, which gives the rarity order.
3. Windows join passages on their prefix shingle, bounded by position (the window
   must fit around the shingle) and length, and are verified word by word.

Documents, benchmark items and windows meet in shuffle joins only; a window's
text is kept once, however many items have it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import ALNUM_LOWER, LOWER, chunks, runs, shingle_hashes, utf8, word_hashes, words
from ledgerloom.session import durable

BITS = 23
SHINGLE = 3


def _texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    flat = data.tobytes()
    return [flat[a:b].decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]


def _split(batch: pa.RecordBatch):
    data, offsets = utf8(batch.column("t"))
    data = LOWER[data]
    w = words(data, offsets, ALNUM_LOWER)
    return data, w, word_hashes(w)[0]


def _item_windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "t", 1 << 18):
            data, w, h = _split(batch)
            all_words = _texts(data, w.start, w.end)
            n = np.minimum(w.per_row, width)
            many = np.where(w.per_row > 0, w.per_row - n + 1, 0)
            row = np.repeat(np.arange(batch.num_rows), many)
            first = w.first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            shingles: list[list[int]] = []
            by_k = {}
            for k in range(1, SHINGLE + 1):
                value, at = shingle_hashes(h, w.row, k)
                full = np.zeros(len(h), np.uint64)
                full[at] = value
                by_k[k] = full.view(np.int64)
            for f, r in zip(first.tolist(), row.tolist(), strict=True):
                size = int(n[r])
                k = min(SHINGLE, size)
                shingles.append(by_k[k][f: f + size - k + 1].tolist())
            text = [" ".join(all_words[f: f + int(n[r])]) for f, r in zip(first.tolist(), row.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row)), pa.array(text, pa.string()), pa.array(n[row].astype(np.int32)),
                 pa.array(shingles, pa.list_(pa.int64()))], ["id", "words", "n", "shingles"])

    return run


def item_windows(items: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """(id, words, n, shingles) for every window of every item."""
    given = items.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text}`").alias("t"))
    return given.mapInArrow(_item_windows(width), "id string, words string, n int, shingles array<bigint>")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """At most 2^(BITS - 6) rows come to the driver, whatever the benchmark's size."""
    hashes = windows.select(F.explode("shingles").alias("h"))
    rows = hashes.select(F.shiftrightunsigned("h", 64 - BITS).alias("at")).groupBy(F.shiftright("at", 6).alias("block")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).collect()
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    for block, bits in rows:
        bitmap[block] = bits
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little").astype(bool)


def _passages(bitmap, shortest: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").view(bool)
        for batch in chunks(batches, "t"):
            data, w, h = _split(batch)
            first, last = [], []
            for k, least in shortest.items():
                value, at = shingle_hashes(h, w.row, k)
                hit = np.zeros(len(h), bool)
                hit[at] = marks[value >> np.uint64(64 - BITS)]
                a, b = runs(hit, w.row)
                long = b - a + 1 >= least
                first.append(a[long])
                last.append(b[long] + k - 1)
            a, b = (np.concatenate(first), np.concatenate(last)) if first else (np.zeros(0, int), np.zeros(0, int))
            found: list[list | None] = [None] * batch.num_rows
            for s, e in zip(a.tolist(), b.tolist(), strict=True):
                row = int(w.row[s])
                found[row] = found[row] or []
                found[row].append({"at": s - int(w.first[row]), "words": _texts(data, w.start[s: e + 1], w.end[s: e + 1])})
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(w.per_row.astype(np.int64)),
                 pa.array(found, pa.list_(pa.struct([("at", pa.int32()), ("words", pa.list_(pa.string()))])))],
                ["id", "n_words", "found"])

    return run


def _shingled(passages: DataFrame) -> DataFrame:
    """Every shingle position of every passage, as text; sizes 1 to SHINGLE as windows may need them."""
    return passages.select("row", "at", "words", "k", F.posexplode(F.expr(
        "case when size(words) < k then cast(array() as array<string>) "
        "else transform(sequence(0, size(words) - k), i -> array_join(slice(words, i + 1, k), ' ')) end")).alias("pos", "shingle"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = 10) -> DataFrame:
    """(id, n_words, n_hit, items) for each row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window; ``items`` lists the
    ids (as text, sorted) of items of which a window occurs.  Missing and empty texts
    have no words.  Repeated rows are judged one by one.  An item without an id still
    marks words but can't be listed; items with equal ids count as one.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t"))
    id_type = dict(given.dtypes)["id"]
    windows = durable(item_windows(items, item_id, item_text, width))
    sizes = [r.n for r in windows.select("n").distinct().collect()]  # 1 .. width
    shortest: dict[int, int] = {}
    for n in sizes:
        k = min(SHINGLE, n)
        shortest[k] = min(shortest.get(k, n), n - k + 1)
    marks = spark.sparkContext.broadcast(np.packbits(_bitmap(windows), bitorder="little").tobytes())
    scanned = durable(given.mapInArrow(
        _passages(marks, shortest),
        f"id {id_type}, n_words bigint, found array<struct<at:int,words:array<string>>>",
    ).withColumn("row", F.monotonically_increasing_id()))

    ks = F.array(*[F.lit(k) for k in sorted(shortest)]) if shortest else F.expr("cast(array() as array<int>)")
    passages = scanned.where("found is not null").select("row", F.explode("found").alias("f")).select(
        "row", "f.at", "f.words", F.explode(ks).alias("k")).distinct()
    tokens = _shingled(passages)
    distinct = windows.select("words", "n").distinct().withColumn("w", F.split("words", " ")).withColumn(
        "k", F.least(F.lit(SHINGLE), "n"))
    parts = distinct.select("words", "w", "n", F.col("k").alias("wk"), F.posexplode(F.expr(
        "transform(sequence(0, n - k), i -> array_join(slice(w, i + 1, k), ' '))")).alias("p", "shingle"))
    rarity = tokens.groupBy("k", "shingle").agg(F.count(F.lit(1)).alias("seen"))
    counted = parts.join(rarity.withColumnRenamed("k", "wk"), ["wk", "shingle"], "left").withColumn(
        "seen", F.coalesce("seen", F.lit(0)))
    # a window with a shingle that no passage has is nowhere
    prefix = counted.groupBy("words").agg(
        F.min(F.struct("seen", "shingle", "p", "w", "n", "wk")).alias("b")).where("b.seen > 0").select(
        F.col("words").alias("window"), "b.shingle", "b.p", "b.w", "b.n", F.col("b.wk").alias("k"))
    occurs = tokens.join(prefix, ["k", "shingle"]).where(
        "pos >= p and pos - p + n <= size(words) and slice(words, pos - p + 1, n) = w").select(
        "row", "window", "n", (F.col("at") + F.col("pos") - F.col("p")).alias("first"))
    occurs = durable(occurs.distinct())

    spans = occurs.groupBy("row", "first").agg((F.max("n") + F.col("first")).alias("end"))
    before = Window.partitionBy("row").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0))).groupBy("row").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("first", "done"))).alias("n_hit"))
    listed = occurs.select("row", "window").distinct().join(
        windows.where("id is not null").select(F.col("words").alias("window"), "id").distinct(), "window").groupBy("row").agg(
        F.array_sort(F.collect_set("id")).alias("items"))
    return scanned.drop("found").join(covered, "row", "left").join(listed, "row", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))
