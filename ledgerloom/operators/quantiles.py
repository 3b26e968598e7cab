"""Exact quantiles that never hold one group's values in one task.

Equal values are counted first (map-side combine), the distinct values are
ranked piecewise, and the requested order statistics are picked with a plain
conditional aggregate.  The result equals linear-interpolation percentiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.skew import piece_offsets, split_hot_groups


def to_long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (keep..., feature, value), missing cells removed."""
    wide = df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keep), [f"`{c}`" if "." in c else c for c in cols], "feature", "value").where(
        F.col("value").isNotNull())


def value_ladder(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                 extras: dict[str, Column] | None = None, keep: Sequence[str] = (),
                 rows_per_piece: int | None = None) -> DataFrame:
    """Distinct values of each column with their counts and sorted positions.

    Columns out: by..., feature, value, cnt, first_pos (0-based), n, extras...
    """
    by = list(by)
    long = to_long(df, cols, [*by, *keep])
    for key in by:
        long = long.where(F.col(key).isNotNull())
    extra_aggs = [expr.alias(name) for name, expr in (extras or {}).items()]
    counts = long.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("cnt"), *extra_aggs)
    group = [*by, "feature"]
    # a group has no more distinct values of a feature than the table has rows of it
    tagged, cut = split_hot_groups(counts, group, F.col("value"), rows_per_piece, source=(df, by))
    local = Window.partitionBy(*group, "__piece")
    upto = local.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = tagged.withColumn("first_pos", F.sum("cnt").over(upto) - F.col("cnt")).withColumn(
        "n", F.sum("cnt").over(local))
    if cut:
        offsets = piece_offsets(tagged, group, F.col("cnt"))
        out = (out.join(offsets, [*group, "__piece"], "left")
               .withColumn("first_pos", F.col("first_pos") + F.coalesce(F.col("__before"), F.lit(0)))
               .withColumn("n", F.coalesce(F.col("__group_n"), F.col("n"))).drop("__before", "__group_n"))
    return out.drop("__piece")


def quantile_name(p: float) -> str:
    return "q" + format(p, ".6f").rstrip("0").rstrip(".").replace(".", "_")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    rows_per_piece: int | None = None) -> DataFrame:
    """One row per (by..., feature) with ``n`` and one column per probability."""
    ladder = value_ladder(df, cols, by, rows_per_piece=rows_per_piece)
    aggs, finals = [F.max("n").alias("n")], []
    for p in probs:
        name = quantile_name(p)
        point = (F.col("n") - 1) * F.lit(float(p))
        last_pos = F.col("first_pos") + F.col("cnt") - 1
        for side, target in (("lo", F.floor(point)), ("hi", F.ceil(point))):
            hit = (F.col("first_pos") <= target) & (target <= last_pos)
            aggs.append(F.max(F.when(hit, F.col("value"))).alias(f"{name}_{side}"))
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        final_point = (F.col("n") - 1) * F.lit(float(p))
        finals.append((low + (high - low) * (final_point - F.floor(final_point))).alias(name))
    return ladder.groupBy(*by, "feature").agg(*aggs).select(*by, "feature", "n", *finals)


def quantiles_wide(df: DataFrame, wanted: Sequence[tuple[str, str, float]], by: Sequence[str],
                   rows_per_piece: int | None = None) -> DataFrame:
    """One row per group with columns ``out`` for (out, column, probability)."""
    cols = list(dict.fromkeys(c for _, c, _ in wanted))
    probs = sorted({p for _, _, p in wanted})
    table = exact_quantiles(df, cols, probs, by, rows_per_piece)
    picks = [
        F.max(F.when(F.col("feature") == c, F.col(quantile_name(p)))).alias(out) for out, c, p in wanted
    ]
    return table.groupBy(*by).agg(*picks)
