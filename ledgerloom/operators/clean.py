"""Cleaning, renaming and column selection."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGRAL = ("tinyint", "smallint", "int", "bigint")
FRACTIONAL = ("float", "double")


def null_sentinels(df: DataFrame, sentinels: Mapping[str, float]) -> DataFrame:
    """Replace a magic value by missing, column by column."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in sentinels.items()})


def null_outside(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]],
                 closed: bool = True) -> DataFrame:
    """Values outside [low, high] (or the open interval) become missing; rows stay."""
    out = {}
    for c, (low, high) in bounds.items():
        col, keep = F.col(c), F.lit(True)
        if low is not None:
            keep = keep & ((col >= F.lit(low)) if closed else (col > F.lit(low)))
        if high is not None:
            keep = keep & ((col <= F.lit(high)) if closed else (col < F.lit(high)))
        out[c] = F.when(keep, col)
    return df.withColumns(out)


def fill_categorical(df: DataFrame, value: str = "XNA", cols: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=list(cols) if cols else select_by_dtype(df, "string"))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def sanitize_names(df: DataFrame) -> DataFrame:
    """Strip everything but letters, digits and underscores from column names."""
    names = [re.sub(r"[^A-Za-z0-9_]+", "", c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return df.toDF(*names)


def drop_index_columns(df: DataFrame) -> DataFrame:
    """Drop row-number columns left behind by an earlier export."""
    return df.drop(*[c for c in df.columns if c.startswith("Unnamed") or c == "_c0"])


def present_share(df: DataFrame) -> DataFrame:
    """One row: share of non-missing values of every column."""
    return df.agg(*[F.avg(F.col(f"`{c}`").isNotNull().cast("double")).alias(c) for c in df.columns])


def drop_sparse_columns(df: DataFrame, min_present: float = 0.6) -> DataFrame:
    """Keep columns whose share of present values is at least ``min_present``."""
    shares = present_share(df).first().asDict()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if (shares[c] or 0.0) >= min_present])


def select_like(df: DataFrame, token: str) -> list[str]:
    return [c for c in df.columns if token in c]


def select_by_dtype(df: DataFrame, kind: str) -> list[str]:
    wanted = {"string": ("string",), "numeric": INTEGRAL + FRACTIONAL}[kind]
    return [c for c, t in df.dtypes if t in wanted or (kind == "numeric" and t.startswith("decimal"))]


def select_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Contiguous columns from ``first`` to ``last``, both included."""
    cols = df.columns
    return cols[cols.index(first): cols.index(last) + 1]


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def remap_values(df: DataFrame, column: str, labels: Mapping, default: Column | None = None) -> DataFrame:
    """Value to label; values without a label keep their own text."""
    chain = None
    for value, label in labels.items():
        hit = F.col(column) == F.lit(value)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return df.withColumn(column, chain.otherwise(default if default is not None else F.col(column).cast("string")))


def inf_to_null(df: DataFrame) -> DataFrame:
    """Infinite and NaN values of every fractional column become missing."""
    out = {}
    for c, t in df.dtypes:
        if t in FRACTIONAL:
            col = F.col(f"`{c}`")
            out[c] = F.when(~F.isnan(col) & (F.abs(col) != F.lit(float("inf"))), col)
    return df.withColumns(out) if out else df


# Integer ranges of the storage types, narrowest first.
INTEGER_RANGES = (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63))
FLOAT_MAX = 3.4028234663852886e38


def narrow(df: DataFrame, floats: bool = True) -> DataFrame:
    """Smallest type whose range strictly contains each column's observed values."""
    numeric = [(c, t) for c, t in df.dtypes if t in INTEGRAL + FRACTIONAL]
    if not numeric:
        return df
    aggs = []
    for i, (c, _) in enumerate(numeric):
        aggs += [F.min(f"`{c}`").alias(f"lo{i}"), F.max(f"`{c}`").alias(f"hi{i}")]
    seen, casts = df.agg(*aggs).first(), {}
    for i, (c, t) in enumerate(numeric):
        low, high = seen[f"lo{i}"], seen[f"hi{i}"]
        if low is None:
            continue
        if t in INTEGRAL:
            for name, bits in INTEGER_RANGES:
                if low > -(2 ** bits) and high < 2 ** bits - 1:
                    casts[c] = name
                    break
        elif floats and low > -FLOAT_MAX and high < FLOAT_MAX:
            casts[c] = "float"
    return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in casts.items()})
