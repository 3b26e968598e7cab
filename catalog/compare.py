"""One number format for both engines.

Sums of inexact doubles depend on the order of addition.  Both sides therefore
round to 8 decimals and to single precision before they are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def _rounded(column: str) -> str:
    return f"cast(cast(rint(cast(`{column}` as double) * 1e8D) / 1e8D as float) as double) + 0D as `{column}`"


def fixed(df: DataFrame, *cols: str) -> DataFrame:
    """Round the named columns (default: every fractional column)."""
    names = set(cols or [c for c, t in df.dtypes if t in ("float", "double")])
    return df.selectExpr(*[_rounded(c) if c in names else f"`{c}`" for c in df.columns])


def fixed_features(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys unchanged, every other column as a rounded double."""
    return df.selectExpr(*[f"`{c}`" if c in keys else _rounded(c) for c in df.columns])


def _steps(expr: str) -> str:
    return f"round_even(cast({expr} as double) * 100000000::double, 0) / 100000000::double"


def r(expr: str, name: str | None = None) -> str:
    """The same rounding in SQL."""
    out = f"cast(cast({_steps(expr)} as float) as double) + cast(0 as double)"
    return f'{out} as "{name}"' if name else out


def features_sql(inner: str, keys: Sequence[str]) -> str:
    listed = ", ".join(keys)
    return (f"select {listed}, cast(cast({_steps(f'columns(* exclude ({listed}))')} as float) as double) "
            f"+ cast(0 as double) from ({inner})")
