"""Profiling tables.

Statistics of all columns are computed in one aggregate and unpivoted, so a
table with many columns is scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, pi

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.rowwise import cut
from ledgerloom.operators.clean import select_by_dtype
from ledgerloom.operators.encode import code_table
from ledgerloom.operators.gram import correlations
from ledgerloom.operators.quantiles import exact_quantiles, quantile_name, to_long


def _unpivot_row(row: DataFrame, cols: Sequence[str], name: str, value: str) -> DataFrame:
    return row.unpivot([], [F.col(f"`{c}`") for c in cols], name, value)


def null_profile(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Percentage of missing values per column, highest first."""
    shares = df.agg(*[(F.lit(100.0) * F.avg(F.col(f"`{c}`").isNull().cast("double"))).alias(c) for c in df.columns])
    out = _unpivot_row(shares, df.columns, "column", "percent")
    return (out.where(F.col("percent") != 0) if only_missing else out).orderBy(F.desc("percent"), "column")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max of every numeric column."""
    cols = list(cols) if cols else select_by_dtype(df, "numeric")
    moments = to_long(df, cols).groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).drop("n")
    return moments.join(quartiles, "feature", "left").select(
        "feature", "count", "mean", "std", "min", F.col("q0_25").alias("q25"), F.col("q0_5").alias("q50"),
        F.col("q0_75").alias("q75"), "max")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency and share of each present value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(column).cast("double")).scalar()
    return counts.withColumn("share", F.col("count") / total).orderBy(F.desc("count"), column)


def event_rate(df: DataFrame, column: str, target: str = "TARGET", drop_zero: bool = False) -> DataFrame:
    """Percentage of positives per category, highest first."""
    rows = df.where(F.col(column).isNotNull())
    hits = F.sum(F.when(F.col(target) == 1, 1.0).otherwise(0.0))
    out = rows.groupBy(column).agg((F.lit(100.0) * hits / F.count(F.lit(1))).alias("event_rate"))
    return (out.where(F.col("event_rate") != 0) if drop_zero else out).orderBy(F.desc("event_rate"), column)


def category_stats(df: DataFrame, column: str, target: str = "TARGET") -> DataFrame:
    """Number of rows and mean target per category."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("contracts"), F.avg(F.col(target).cast("double")).alias("mean_target")
    ).orderBy(F.desc_nulls_last("mean_target"), column)


def class_crosstab(df: DataFrame, column: str, target: str = "TARGET", classes: Sequence[int] = (0, 1)) -> DataFrame:
    counts = [F.count(F.when(F.col(target) == c, F.lit(1))).alias(f"class_{c}") for c in classes]
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(*counts)


def binned_rate(df: DataFrame, value: Column, edges: Sequence[float], target: str = "TARGET") -> DataFrame:
    """Mean target per right-closed bin."""
    return df.withColumn("bin", cut(value, edges)).where(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(target).cast("double")).alias("mean_target"))


def percentile_table(df: DataFrame, column: str, percentiles: Sequence[float]) -> DataFrame:
    """Exact percentiles (0-100, linear interpolation) of one column, long form."""
    probs = [round(p / 100, 9) for p in percentiles]
    wide = exact_quantiles(df, [column], probs)
    pairs = [F.struct(F.lit(float(p)).alias("percentile"), F.col(quantile_name(x)).alias("value"))
             for p, x in zip(percentiles, probs)]
    return wide.select(F.inline(F.array(*pairs)))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows per equal-width bin over [low, high]; the last bin is closed."""
    value = F.col(column).cast("double")
    code = F.when(value == F.lit(float(high)), F.lit(bins - 1)).otherwise(
        F.floor((value - F.lit(float(low))) * F.lit(bins / (high - low))).cast("int"))
    inside = df.where((value >= F.lit(float(low))) & (value <= F.lit(float(high))))
    return inside.withColumn("bin", code).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("rows"))


def edge_histogram(df: DataFrame, column: str, edges: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows per left-closed explicit bin; the last bin is closed on both sides."""
    value = F.col(column)
    code = F.when(value == F.lit(float(edges[-1])), F.lit(len(edges) - 2)).otherwise(cut(value, edges, right=False))
    return df.withColumn("bin", code).where(F.col("bin").isNotNull()).groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("rows"))


def kernel_density(df: DataFrame, column: str, by: str, grid: Sequence[float]) -> DataFrame:
    """Gaussian density per class at the grid points, Scott's bandwidth.

    Equal values are counted first; the kernel sums of all grid points are one
    aggregate per class, combined map-side.
    """
    value = F.col(column).cast("double")
    counted = df.select(by, value.alias("__x")).where(F.col(by).isNotNull() & F.col("__x").isNotNull()).groupBy(
        by, "__x").agg(F.count(F.lit(1)).cast("double").alias("__c"))
    shape = df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(value).cast("double").alias("__n"), F.stddev_samp(value).alias("__s"))
    shape = shape.withColumn("__h", F.col("__s") * F.pow(F.col("__n"), F.lit(-0.2))).where(F.col("__h") > 0)
    joined = counted.join(shape, by)
    scale = F.col("__n") * F.col("__h") * F.lit((2 * pi) ** 0.5)
    sums = []
    for i, g in enumerate(grid):
        z = (F.lit(float(g)) - F.col("__x")) / F.col("__h")
        sums.append(F.sum(F.col("__c") * F.exp(F.lit(-0.5) * z * z) / scale).alias(f"g{i}"))
    wide = joined.groupBy(by).agg(*sums)
    pairs = [F.struct(F.lit(float(g)).alias("grid"), F.col(f"g{i}").alias("density")) for i, g in enumerate(grid)]
    return wide.select(by, F.inline(F.array(*pairs)))


#: standard deviations beyond which the binned density's kernel is cut off
REACH = 6.0


def density_error(width: float, step: float) -> float:
    """How far ``binned_density`` may be from the exact sum, for a kernel's width and the distance of bins."""
    return step ** 2 / (8 * width ** 3 * (2 * pi) ** 0.5) + exp(-0.5 * REACH ** 2) / (width * (2 * pi) ** 0.5)


def binned_density(df: DataFrame, column: str, by: str, grid: Sequence[float], bins: int = 1024) -> DataFrame:
    """As ``kernel_density``, from ``bins`` points for each class in place of all distinct values.

    A value's weight is shared by the two points around it; each point then reaches the
    grid within ``REACH`` kernel widths.  After one pass that counts, the work follows
    the number of bins.  ``density_error`` bounds the difference from the exact sum.
    """
    value = F.col(column).cast("double")
    rows = df.select(F.col(by), value.alias("__x")).where(F.col(by).isNotNull() & F.col("__x").isNotNull())
    shape = rows.groupBy(by).agg(F.count("__x").cast("double").alias("__n"), F.stddev_samp("__x").alias("__s"), F.min("__x").alias("__lo"),
                                 F.max("__x").alias("__hi"))
    shape = shape.withColumns({"__h": F.col("__s") * F.pow(F.col("__n"), F.lit(-0.2)), "__d": (F.col("__hi") - F.col("__lo")) / F.lit(bins - 1)}).where(
        F.col("__h") > 0)
    at = rows.join(shape.select(by, "__lo", "__d"), by).withColumn("__p", (F.col("__x") - F.col("__lo")) / F.col("__d")).withColumn(
        "__i", F.least(F.floor("__p"), F.lit(bins - 2)))
    right = F.col("__p") - F.col("__i")
    shared = at.groupBy(by, "__i").agg(F.sum(1 - right).alias("__left"), F.sum(right).alias("__right"))
    points = shared.select(by, F.inline(F.array(F.struct(F.col("__i").alias("__b"), F.col("__left").alias("__c")),
                                                F.struct((F.col("__i") + 1).alias("__b"), F.col("__right").alias("__c"))))).groupBy(by, "__b").agg(
        F.sum("__c").alias("__c"))
    placed = points.join(shape, by).withColumn("__x", F.col("__lo") + F.col("__b") * F.col("__d"))
    near = F.filter(F.array(*[F.lit(float(g)) for g in grid]), lambda g: F.abs(g - F.col("__x")) <= F.lit(REACH) * F.col("__h"))
    z = (F.col("grid") - F.col("__x")) / F.col("__h")
    sums = placed.withColumn("grid", F.explode(near)).groupBy(by, "grid").agg(
        F.sum(F.col("__c") * F.exp(F.lit(-0.5) * z * z) / (F.col("__n") * F.col("__h") * F.lit((2 * pi) ** 0.5))).alias("density"))
    every = shape.select(by, F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("grid"))
    return every.join(sums, [by, "grid"], "left").select(by, "grid", F.coalesce("density", F.lit(0.0)).alias("density"))


def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and outlier count per class."""
    quartiles = exact_quantiles(df, [column], [0.25, 0.5, 0.75], [by]).select(
        by, F.col("q0_25").alias("q1"), F.col("q0_5").alias("median"), F.col("q0_75").alias("q3"))
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    value = F.col(column).cast("double")
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    return df.where(value.isNotNull()).join(quartiles, by).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, value)).alias("low_whisker"), F.max(F.when(inside, value)).alias("high_whisker"),
        F.count(F.when(~inside, F.lit(1))).alias("outliers"))


def correlation(df: DataFrame, cols: Sequence[str], block: int | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlations, lower triangle, long form (one row for each pair of named columns).

    One pass serves any number of pairs; ``block`` is accepted from older callers and has no effect.
    """
    r = correlations(df, cols)
    rows = [(cols[j], cols[i], None if np.isnan(r[i, j]) else float(r[i, j])) for j in range(len(cols)) for i in range(j)]
    return df.sparkSession.createDataFrame(rows, "row string, column string, corr double")


def target_correlation(df: DataFrame, cols: Sequence[str], target: str = "TARGET") -> DataFrame:
    r = correlations(df, [*cols, target])[:-1, -1]
    rows = [(c, None if np.isnan(v) else float(v)) for c, v in zip(cols, r, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, corr double").orderBy(F.desc_nulls_last("corr"), "feature")


def contingency(df: DataFrame, cols: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Counts per (feature, bin, class): equal-width bins of numbers, and values of text columns in sorted order."""
    texts = [c for c, t in df.dtypes if c in cols and t == "string"]
    numbers = [c for c in cols if c not in texts]
    if not texts:
        return _binned_cells(df, numbers, target, bins)
    named = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in texts])
    said = df.where(F.col(target).isNotNull()).select(F.col(target).alias("class"), F.inline(named)).where("value is not null")
    counted = said.groupBy("feature", "value", "class").agg(F.count(F.lit(1)).cast("double").alias("n"))
    codes = code_table(df, texts).withColumnRenamed("column", "feature")
    cells = counted.join(codes, ["feature", "value"]).select("feature", F.col("code").alias("bin"), "class", "n")
    return cells.unionByName(_binned_cells(df, numbers, target, bins)) if numbers else cells


def _binned_cells(df: DataFrame, cols: Sequence[str], target: str, bins: int) -> DataFrame:
    ranges = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    limits = ranges.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in cols])))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    code = F.when(width <= 0, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) / width).cast("int")))
    # the limits hold one row per column, so their size is fixed by the call
    return (to_long(df.where(F.col(target).isNotNull()), cols, [target]).join(F.broadcast(limits), "feature")
            .withColumn("bin", code).groupBy("feature", "bin", F.col(target).alias("class"))
            .agg(F.count(F.lit(1)).cast("double").alias("n")))


def cramers_v(df: DataFrame, cols: Sequence[str], target: str = "TARGET", bins: int = 10) -> DataFrame:
    """Association of binned features with a class: V = sqrt(chi2 / (N * (min(r, c) - 1)))."""
    cells = contingency(df, cols, target, bins)
    chi2 = _chi_square(cells)
    rank = F.least("r", "k") - 1
    return chi2.select("feature", F.when(rank > 0, F.sqrt(F.col("chi2") / (F.col("total") * rank))).alias("cramers_v"))


def _chi_square(cells: DataFrame) -> DataFrame:
    """Chi-square per feature from its small contingency table."""
    rows = cells.groupBy("feature", "bin").agg(F.sum("n").alias("row_n"))
    classes = cells.groupBy("feature", "class").agg(F.sum("n").alias("class_n"))
    totals = rows.groupBy("feature").agg(F.sum("row_n").alias("total"), F.count(F.lit(1)).alias("r"))
    kinds = classes.groupBy("feature").agg(F.count(F.lit(1)).alias("k"))
    joined = cells.join(rows, ["feature", "bin"]).join(classes, ["feature", "class"])
    parts = joined.groupBy("feature").agg(F.sum(F.col("n") * F.col("n") / (F.col("row_n") * F.col("class_n"))).alias("s"))
    return parts.join(totals, "feature").join(kinds, "feature").withColumn(
        "chi2", F.greatest(F.lit(0.0), F.col("total") * (F.col("s") - F.lit(1.0))))


def phik(df: DataFrame, cols: Sequence[str], target: str = "TARGET", bins: int = 10, top: int | None = None) -> DataFrame:
    """Correlation coefficient phi_k of each feature with the target.

    The contingency tables are counted by Spark; inverting the bivariate normal
    is a numeric step on at most ``bins`` x classes cells per feature.
    """
    from ledgerloom.functions.normal import PHIK_SCHEMA, phik_of_cells

    cells = contingency(df, cols, target, bins)
    out = cells.groupBy("feature").applyInPandas(phik_of_cells, PHIK_SCHEMA).orderBy(F.desc("phik"), "feature")
    return out.limit(top) if top else out


def metric_by_category(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.avg(F.col(value).cast("double")).alias(f"mean_{value}"))


def flag_coverage(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Share of ones per flag column."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in flags])
    return _unpivot_row(row, flags, "flag", "share")


def distinct_per_entity(df: DataFrame, entity: Sequence[str], column: str) -> DataFrame:
    """How many entities have 1, 2, ... distinct values (zero left out)."""
    pairs = df.where(F.col(column).isNotNull()).select(*entity, column).distinct()
    counts = pairs.groupBy(*entity).agg(F.count(F.lit(1)).alias("distinct_values"))
    return counts.groupBy("distinct_values").agg(F.count(F.lit(1)).alias("entities")).orderBy("distinct_values")
