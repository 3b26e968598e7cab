"""Shards by consistent hashing with virtual nodes and bounded loads.

Each shard has ``points`` virtual nodes on a ring of 2^60 positions; a key belongs to
the first node clockwise of its position.  A shard has room for its even part of the
rows.  Keys are offered to shards in rounds: first to their own shard, then, as far as
that is full, to the next shard clockwise, and so on.  Within a round a shard takes
keys in ring order.  So the balance is guaranteed, and only what overflows leaves the
place that plain consistent hashing gives it.

All keys between two nodes see the same shards in the same order.  The rounds therefore
need only the number of rows on each of the ``shards * points + 1`` arcs; the rows
themselves are ranked within their arcs by one sort by range, of which ties are cut by
a row number, so that a key with any share of the rows is spread over tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import durable

POINTS = 128
#: monotonically_increasing_id() counts the rows of a partition in its low 33 bits
LOW_BITS = 33


def ring(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, in ring order: the first 60 bits of md5('shard:point')."""
    return sorted((int(hashlib.md5(f"{s}:{p}".encode()).hexdigest()[:15], 16), s) for s in range(shards) for p in range(points))


def position(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("bigint")


def clockwise(nodes: Sequence[tuple[int, int]], arc: int) -> list[int]:
    """The shards in the order in which keys of an arc meet them."""
    return list(dict.fromkeys(nodes[(arc + i) % len(nodes)][1] for i in range(len(nodes))))


def room(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may take: even parts, at most one apart, widened by ``slack``."""
    if slack:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def settle(rows_of: dict[int, int], nodes: Sequence[tuple[int, int]], limits: Sequence[int]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each arc (shard, first, end, slot): its ranks from ``first`` to ``end`` go to the shard, from that slot on.

    Works on one number for each arc, whatever the number of rows.
    """
    held = [0] * len(limits)
    placed: dict[int, list[tuple[int, int, int, int]]] = {a: [] for a in sorted(rows_of)}
    done = dict.fromkeys(placed, 0)
    order = {a: clockwise(nodes, a) for a in placed}
    for turn in range(len(limits)):
        for arc, have in done.items():
            shard = order[arc][turn]
            take = min(rows_of[arc] - have, limits[shard] - held[shard])
            if take > 0:
                placed[arc].append((shard, have, have + take, held[shard]))
                held[shard] += take
                done[arc] += take
    return placed


def _arc(at: Column, nodes: Sequence[tuple[int, int]]) -> Column:
    """Number of nodes before a position, by halving steps; the arc past the last node leads to the first one."""
    marks = F.expr(f"array({', '.join(f'{p}L' for p, _ in nodes)})")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(nodes).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= len(nodes)) & (F.get(marks, n + step - 1) < at), n + step).otherwise(n))


def assign(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = 16, points: int = POINTS,
           slack: float = 0.0, keep: Sequence[str] = ()) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for each row of ``docs``, and the columns of ``keep``.

    With ``slack`` 0 shards' counts are at most one apart; with more, a shard takes up to
    (1 + slack) times its even part and fewer rows overflow.  Slots count each shard's
    rows from 0.  ``size`` is the text's bytes in UTF-8 plus 1; a missing text has none
    and the checksum 0.  A missing id is the empty key.  Rows with equal ids are ordered
    by size, then checksum; wholly equal ones are interchangeable.  Columns of ``keep``
    that have the name of a result are left out.  An empty table gives no rows.
    """
    if shards < 1 or points < 1:
        raise ValueError("shards and points must be positive")
    nodes = ring(shards, points)
    kept = [c for c in dict.fromkeys(keep) if c not in {id_col, "size", "text_crc32", "shard", "slot"}]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(body).cast("bigint") + 1).alias("size"), F.crc32(body.cast("binary")).alias("crc"),
        position(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("at"), F.monotonically_increasing_id().alias("row"),
        F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)]).alias("more"))
    order = ["at", "id", "size", "crc", "row"]
    rows = durable(rows.select("*", _arc(F.col("at"), nodes).alias("arc")))
    place = F.monotonically_increasing_id()
    ranked = durable(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "size", "crc", "arc", "more", place.alias("place")))
    piece = F.shiftright("place", LOW_BITS).alias("piece")

    # as many rows as partitions and arcs together
    runs = durable(ranked.groupBy(piece, "arc").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("lo")))
    rows_of = {r.arc: r.n for r in runs.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    placed = settle(rows_of, nodes, room(sum(rows_of.values()), shards, slack))
    segments = docs.sparkSession.createDataFrame(
        [(a, p) for a, p in placed.items()], "arc int, parts array<struct<shard:int,first:bigint,end:bigint,slot:bigint>>")
    before = Window.partitionBy("arc").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select("piece", "arc", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("lo")).alias("shift")).join(segments, "arc")
    found = ranked.select("*", piece).join(shifts, ["piece", "arc"]).withColumn("rank", F.col("place") + F.col("shift"))
    return found.withColumn("part", F.expr("filter(parts, p -> rank >= p.first and rank < p.end)[0]")).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("part.shard").alias("shard"),
        (F.col("part.slot") + F.col("rank") - F.col("part.first")).alias("slot"),
        *[F.col(f"more.k{i}").alias(c) for i, c in enumerate(kept)])
