"""Row-wise feature expressions with missing-value rules.

Missing is always NULL and never NaN.  A division by zero is missing, plain
arithmetic propagates missing values, and comparisons against a missing value
are false, so flags turn them into 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "as_col", "safe_div", "sql_text", "ratios", "differences", "sums", "products", "powers",
    "weighted_sum", "sum_skip_missing", "row_stat", "row_kurtosis", "flag",
    "flag_unless_zero", "clamp_at_zero", "value_if_flag", "step_label", "cut",
    "pair_label", "days_to_years", "absolute",
]


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def sql_text(value: str) -> str:
    """A string as a Spark SQL literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def ratios(df: DataFrame, triples: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Add ``name = numerator / denominator`` for every triple."""
    return df.withColumns({name: F.expr(f"try_divide(cast(`{a}` as double), cast(`{b}` as double))")
                           for name, a, b in triples})


def differences(df: DataFrame, triples: Sequence[tuple[str, str, str]]) -> DataFrame:
    return df.withColumns({name: F.expr(f"`{a}` - `{b}`") for name, a, b in triples})


def sums(df: DataFrame, specs: Mapping[str, Sequence[str]], skip_missing: bool = False) -> DataFrame:
    """Add ``name = a + b + ...``; missing propagates unless ``skip_missing``."""
    cell = "coalesce(`{}`, 0)" if skip_missing else "`{}`"
    return df.withColumns({name: F.expr(" + ".join(cell.format(c) for c in cols)) for name, cols in specs.items()})


def products(df: DataFrame, specs: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({name: F.expr(" * ".join(f"`{c}`" for c in cols)) for name, cols in specs.items()})


def powers(df: DataFrame, specs: Mapping[str, tuple[str, float]]) -> DataFrame:
    return df.withColumns({name: F.pow(F.col(c), F.lit(float(p))) for name, (c, p) in specs.items()})


def weighted_sum(weights: Mapping[str, float]) -> Column:
    return reduce(add, (F.col(c) * F.lit(float(w)) for c, w in weights.items()))


def sum_skip_missing(cols: Sequence[Column | str]) -> Column:
    """Row sum that counts missing cells as 0."""
    return reduce(add, (F.coalesce(as_col(c), F.lit(0)) for c in cols))


def row_stat(cols: Sequence[Column | str], fn: str) -> Column:
    """Min, max, mean, var (population) skip missing cells; median does not."""
    cells = [as_col(c).cast("double") for c in cols]
    if fn == "min":
        return F.least(*cells)
    if fn == "max":
        return F.greatest(*cells)
    present = reduce(add, (c.isNotNull().cast("int") for c in cells))
    mean = F.try_divide(sum_skip_missing(cells).cast("double"), present.cast("double"))
    if fn == "mean":
        return mean
    if fn == "var":
        squares = reduce(add, (F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in cells))
        return F.try_divide(squares, present.cast("double"))
    if fn == "median":
        ordered = F.array_sort(F.array(*cells))
        n = len(cells)
        middle = (ordered[(n - 1) // 2] + ordered[n // 2]) / F.lit(2.0)
        return F.when(present == n, middle)
    raise ValueError(f"unknown row statistic {fn!r}")


def row_kurtosis(cols: Sequence[Column | str]) -> Column:
    """Bias-corrected excess kurtosis over the cells of one row (constant row: 0)."""
    n = len(cols)
    if n < 4:
        raise ValueError("row kurtosis needs at least four columns")
    # power sums of the distances to the first cell: one short expression per sum
    cells = [as_col(c).cast("double") for c in cols]
    d = [c - cells[0] for c in cells]
    s1, s2 = reduce(add, d), reduce(add, (x * x for x in d))
    s3, s4 = reduce(add, (x * x * x for x in d)), reduce(add, (x * x * x * x for x in d))
    mean = s1 / F.lit(float(n))
    m2 = s2 - s1 * mean
    m4 = s4 - F.lit(4.0) * mean * s3 + F.lit(6.0) * mean * mean * s2 - F.lit(3.0) * s1 * mean * mean * mean
    scale = F.lit(n * (n + 1) * (n - 1) / ((n - 2) * (n - 3)))
    shift = F.lit(3.0 * (n - 1) ** 2 / ((n - 2) * (n - 3)))
    return F.when(m2.isNull(), None).when(m2 == 0, F.lit(0.0)).otherwise(scale * m4 / (m2 * m2) - shift)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere and where it is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def flag_unless_zero(c: Column | str) -> Column:
    """0 where the value is zero, 1 elsewhere and where it is missing."""
    return F.when(as_col(c) == 0, F.lit(0)).otherwise(F.lit(1))


def clamp_at_zero(c: Column | str) -> Column:
    col = as_col(c)
    return F.when(col <= 0, F.lit(0)).otherwise(col)


def value_if_flag(flag_col: Column | str, value: Column | str) -> Column:
    return F.when(as_col(flag_col) == 1, as_col(value)).otherwise(F.lit(0.0))


def step_label(c: Column | str, uppers: Sequence[float], default: int, missing: int | None = None) -> Column:
    """1-based index of the first upper bound that is >= the value."""
    col = as_col(c)
    chain = F.when(col.isNull(), F.lit(missing if missing is not None else default))
    for label, upper in enumerate(uppers, start=1):
        chain = chain.when(col <= F.lit(float(upper)), F.lit(label))
    return chain.otherwise(F.lit(default))


def cut(c: Column | str, edges: Sequence[float], right: bool = True, labels: Sequence | None = None,
        include_lowest: bool = False) -> Column:
    """Bin code or label by explicit edges; values outside every bin are missing."""
    col = as_col(c)
    names = list(labels) if labels is not None else list(range(len(edges) - 1))
    chain = None
    for i, (low, high, name) in enumerate(zip(edges[:-1], edges[1:], names)):
        low_l, high_l = F.lit(float(low)), F.lit(float(high))
        if right:
            inside = ((col >= low_l) if include_lowest and i == 0 else (col > low_l)) & (col <= high_l)
        else:
            inside = (col >= low_l) & (col < high_l)
        chain = F.when(inside, F.lit(name)) if chain is None else chain.when(inside, F.lit(name))
    return chain


def pair_label(first: Column | str, second: Column | str, labels: Mapping[tuple[str, str], int]) -> Column:
    """Label of a combination of two categories; unknown combinations are missing."""
    a, b = as_col(first), as_col(second)
    chain = None
    for (x, y), label in labels.items():
        hit = (a == x) & (b == y)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain


def days_to_years(c: Column | str) -> Column:
    """Non-positive day offset to positive years."""
    return -as_col(c) / F.lit(365.0)


def absolute(c: Column | str) -> Column:
    return F.abs(as_col(c))
