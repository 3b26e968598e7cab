"""Quantile sketches of columns that can be stored and merged.

Beside the exact ladder, which sorts: a sketch of each column is one small binary value,
made in one pass, merged over days, partitions or tables, and asked for any quantile.
The returned value's rank is off by at most ``rank_error(k)`` of the rows, with 99 %
confidence for each answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.quantiles import quantile_name, to_long

K = 400


def rank_error(k: int = K) -> float:
    """Share of the rows by which a quantile's rank may be off: the KLL sketch's published bound."""
    return 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """(by..., feature, n, sketch) of each column; missing cells and NaN are left out."""
    long = to_long(df, cols, list(by)).where(~F.isnan("value"))
    return long.groupBy(*by, "feature").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One sketch for each (by..., feature) of tables of sketches put together."""
    return sketches.groupBy(*by, "feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, n) and a column for each probability, named as the exact quantiles are."""
    return sketches.select(*by, "feature", "n", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(quantile_name(p)) for p in probs])


def rank_check(df: DataFrame, quantiles: DataFrame, cols: Sequence[str], probs: Sequence[float], bound: float) -> DataFrame:
    """(feature, probability, n, within): whether each quantile's true rank is within ``bound`` of its probability."""
    asked = quantiles.select("feature", "n", F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), F.col(quantile_name(p)).alias("answer")) for p in probs])))
    values = to_long(df, cols).where(~F.isnan("value")).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    places = values.join(asked, "feature").groupBy("feature", "probability", "n").agg(
        F.sum(F.when(F.col("value") < F.col("answer"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") <= F.col("answer"), F.col("c")).otherwise(0)).alias("upto"))
    near = (F.col("below") / F.col("n") <= F.col("probability") + bound) & (F.col("upto") / F.col("n") >= F.col("probability") - bound)
    return places.select("feature", "probability", "n", near.alias("within"))
