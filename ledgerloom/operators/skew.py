"""Splitting of hot groups into ordered pieces.

An ordered window needs all rows of a group in one task.  A key that owns a
large share of the table would therefore serialise the job.  One counting pass
over the key columns (map-side combined) tells whether any group exceeds a row
budget.  If none does, a plain window is planned.  Otherwise the hot groups are
sorted by range over their whole order and tagged with a piece number, so windows
run per (key, piece) and the small piece totals are combined afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import durable

ROWS_PER_PIECE = 1_000_000
UNCUT = -1


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > limit).drop("__n")


def all_fit(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> bool:
    """Whether no group, nor the rows without a key, exceeds the row budget of a task."""
    return hot_groups(df, keys, ROWS_PER_PIECE if limit is None else limit).isEmpty()


def co_locate(df: DataFrame, key: str, source: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Bring the rows of each key together before a wide aggregate.

    The partial buffers of a spec with hundreds of outputs are far larger than
    the rows they summarise, so moving the rows once and aggregating in place is
    cheaper, and later joins on the key need no exchange.  The key counts are
    checked first (in ``source``, a cheap ancestor with the same keys): with a
    group above the row budget the rows stay put and are combined map-side.
    All readers of the moved rows share one exchange.
    """
    keyed = df.where(F.col(key).isNotNull())
    checked = (source if source is not None else df).where(F.col(key).isNotNull())
    if hot_groups(checked, [key], ROWS_PER_PIECE if limit is None else limit).isEmpty():
        return pinned(keyed.repartition(F.col(key)))
    return keyed


def pinned(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``df``, of which every reader is planned with all columns, or at least with ``cols``.

    Spark reuses an exchange only between equal plans, and each reader's own choice of
    columns would make them differ: the rows would be moved once for each reader.  The
    filter keeps all rows; as it asks for the task's number, no later filter is moved
    below it, and it isn't folded.
    """
    held = F.xxhash64(*[F.col(f"`{c}`") for c in (df.columns if cols is None else cols)]) == 0
    return df.where(F.when(F.spark_partition_id() < 0, held).otherwise(True))


def split_hot_groups(df: DataFrame, keys: Sequence[str], order: Column | Sequence[Column], rows_per_piece: int | None = None,
                     source: tuple[DataFrame, Sequence[str]] | None = None) -> tuple[DataFrame, bool]:
    """Tag rows with an order-preserving ``__piece`` number inside their group.

    The rows of hot groups are sorted by range over all of ``order``, of any types, into
    as many pieces as their number asks for; so a group is cut even where its first
    order column is constant.  Only rows that are equal in all of ``order`` always share
    a piece.  Rows of groups within budget carry ``UNCUT``.  The flag says whether
    anything was cut.  ``source`` is a cheap ancestor with keys of which each group has
    at least as many rows: if none of those is hot, ``df`` isn't computed to find that out.
    """
    keys = list(keys)
    order = [order] if isinstance(order, Column) else list(order)
    limit = ROWS_PER_PIECE if rows_per_piece is None else rows_per_piece
    if source is not None and hot_groups(source[0], source[1], limit).isEmpty():
        return df.withColumn("__piece", F.lit(UNCUT)), False
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    rows = counts.agg(F.sum("__n")).first()[0]
    if not rows:
        return df.withColumn("__piece", F.lit(UNCUT)), False
    if keys:
        named = counts.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
        same = reduce(lambda a, c: a & c, [F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
        hot, cold = df.join(named, same, "left_semi"), df.join(named, same, "left_anti").withColumn("__piece", F.lit(UNCUT).cast("bigint"))
    else:
        hot, cold = df, None
    sort = [*[F.col(f"`{k}`") for k in keys], *order]
    pieces = sorted_pieces(hot, sort, -(-rows // limit)).drop("__at")
    return pieces if cold is None else pieces.unionByName(cold), True


def piece_offsets(df: DataFrame, keys: Sequence[str], size: Column) -> DataFrame:
    """``__before`` and ``__group_n`` per piece: one row for each ROWS_PER_PIECE rows of a hot group."""
    totals = df.where(F.col("__piece") != UNCUT).groupBy(*keys, "__piece").agg(F.sum(size).alias("__piece_n"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = group.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    return (
        totals.withColumn("__before", F.coalesce(F.sum("__piece_n").over(before), F.lit(0)))
        .withColumn("__group_n", F.sum("__piece_n").over(group))
        .drop("__piece_n")
    )


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sort_number: Column,
              out: str = "position", rows_per_piece: int | None = None) -> DataFrame:
    """Exact 1-based position of each row in its group without one task per group.

    ``sort_number`` orders like the first key of ``order`` (ascending); hot groups are
    cut along it and all of ``order``.
    """
    keys = list(keys)
    tagged, cut = split_hot_groups(df, keys, [sort_number, *order], rows_per_piece)
    local = F.row_number().over(Window.partitionBy(*keys, "__piece").orderBy(*order)).cast("long")
    if not cut:
        return tagged.withColumn(out, local).drop("__piece")
    offsets = piece_offsets(tagged, keys, F.lit(1))
    return (
        tagged.withColumn("__local", local)
        .join(offsets, [*keys, "__piece"], "left")
        .withColumn(out, F.col("__local") + F.coalesce(F.col("__before"), F.lit(0)))
        .drop("__local", "__before", "__group_n", "__piece")
    )


def sorted_pieces(df: DataFrame, order: Sequence[str | Column], pieces: int | None = None) -> DataFrame:
    """``df`` written in ascending order of all ``order`` columns, with ``__piece`` and ``__at``, the place inside the piece.

    Pieces are ranges of the whole order, found by Spark's sample of it, so no value of
    any one column keeps its rows together; there are as many as shuffle partitions, or
    ``pieces`` if that is more.  Rows that are equal in all of ``order``
    share a piece; where they may be many, end the order with a column that differs.
    As the sorted table is written, later steps see the same places in every run.
    """
    place = F.monotonically_increasing_id()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(pieces, *order) if pieces is not None and pieces > least else df.repartitionByRange(*order)
    written = durable(ranged.sortWithinPartitions(*order).withColumn("__place", place))
    # the id counts a partition's rows in its low 33 bits
    return written.withColumns({"__piece": F.shiftright("__place", 33), "__at": F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__place")


def _before_pieces(pieces: DataFrame, size: Column) -> DataFrame:
    """``__before`` for each piece: one row for each partition, added up in order."""
    earlier = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("__piece").agg(F.sum(size).alias("__size"))
    return sizes.select("__piece", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))


def global_positions(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """0-based position of each row in the order of the whole table."""
    pieces = sorted_pieces(df, order)
    return pieces.join(_before_pieces(pieces, F.lit(1)), "__piece").withColumn(out, F.col("__at") + F.col("__before")).drop("__piece", "__at", "__before")


def running_total(df: DataFrame, order: Sequence[str], number: str, out: str = "total") -> DataFrame:
    """Sum of ``number`` over all rows up to and including each one, in the order of the whole table."""
    pieces = sorted_pieces(df, order)
    upto = Window.partitionBy("__piece").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = pieces.withColumn(out, F.sum(number).over(upto))
    return local.join(_before_pieces(pieces, F.col(number)), "__piece").withColumn(out, F.col(out) + F.col("__before")).drop("__piece", "__at", "__before")
