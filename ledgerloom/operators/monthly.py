"""Aggregates over any months from one mergeable state for each key and month.

A state holds rows, counts, sums, centred squares and extremes of the columns, and, where
asked for, sketches of distinct values and quantiles.  States of a window are merged into
its aggregates, so 6-, 12- and 24-month blocks share one pass over the rows, and a new
month is added by reading its rows alone.  States are stored by month; a window reads
only the months that it covers.  A key's month may have several states (late rows, a
refresh in parts): merging does not care.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.aggspec import Spec, out_name

#: what each function of a spec needs of a column's state
NEEDS = {"count": "n", "sum": "s", "mean": "ns", "var": "nsm", "std": "nsm", "min": "l", "max": "h", "size": "",
         "nunique_approx": "d", "median_approx": "q"}


def _parts(spec: Spec) -> dict[str, str]:
    unknown = {fn for fns in spec.values() for fn in fns} - set(NEEDS)
    if unknown:
        raise ValueError(f"{sorted(unknown)} can't be merged; known are {sorted(NEEDS)}")
    return {c: "".join(dict.fromkeys("".join(NEEDS[fn] for fn in fns))) for c, fns in spec.items()}


def monthly_states(df: DataFrame, by: str, month: str, spec: Spec) -> DataFrame:
    """(by, month, __rows, states of the columns): one row for each key and month; rows without either are left out."""
    make = {
        "n": lambda v: F.count(v), "s": lambda v: F.sum(v.cast("double")), "m": lambda v: F.var_pop(v.cast("double")) * F.count(v),
        "l": F.min, "h": F.max, "d": lambda v: F.hll_sketch_agg(v.cast("string")), "q": lambda v: F.kll_sketch_agg_double(v.cast("double")),
    }
    aggs = [make[p](F.col(f"`{c}`")).alias(f"{c}__{p}") for c, parts in _parts(spec).items() for p in parts]
    known = df.where(F.col(by).isNotNull() & F.col(month).isNotNull())
    return known.groupBy(by, month).agg(F.count(F.lit(1)).alias("__rows"), *aggs)


def window_blocks(states: DataFrame, by: str, month: str, spec: Spec, windows: Mapping[str, tuple[int | None, int | None]]) -> DataFrame:
    """One row for each key with PREFIX + COLUMN + FUNCTION for each window ``prefix: (first month, last month)``, both included.

    Equal to aggregating the window's rows: a key without rows in a window has missing
    values there; sums without present values are 0.
    """
    spread = [c for c, parts in _parts(spec).items() if "m" in parts]
    # means of months are taken relative to one of the key's, which keeps small variances around large means
    states = states.withColumns({f"{c}__r": F.max(_mean(c)).over(Window.partitionBy(by)) for c in spread})
    aggs = []
    for prefix, (first, last) in windows.items():
        inside = F.lit(True)
        if first is not None:
            inside &= F.col(month) >= F.lit(first)
        if last is not None:
            inside &= F.col(month) <= F.lit(last)

        def part(c: str, p: str, inside: Column = inside) -> Column:
            return F.when(inside, F.col(f"`{c}__{p}`"))

        rows = F.sum(F.when(inside, F.col("__rows")))
        for c, fns in spec.items():
            for fn in fns:
                aggs.append(_merged(fn, c, part, rows).alias(out_name(prefix, c, fn)))
    return states.groupBy(by).agg(*aggs)


def _mean(c: str) -> Column:
    return F.when(F.col(f"`{c}__n`") > 0, F.col(f"`{c}__s`") / F.col(f"`{c}__n`"))


def _merged(fn: str, c: str, part, rows: Column) -> Column:
    if fn == "size":
        return rows
    if fn == "min":
        return F.min(part(c, "l"))
    if fn == "max":
        return F.max(part(c, "h"))
    if fn == "count":
        return F.when(rows > 0, F.coalesce(F.sum(part(c, "n")), F.lit(0)))
    if fn == "sum":
        return F.when(rows > 0, F.coalesce(F.sum(part(c, "s")), F.lit(0.0)))
    if fn == "nunique_approx":
        return F.when(rows > 0, F.hll_sketch_estimate(F.hll_union_agg(part(c, "d"))))
    if fn == "median_approx":
        merged = F.kll_merge_agg_double(part(c, "q"))
        return F.when(F.kll_sketch_get_n_double(merged) > 0, F.kll_sketch_get_quantile_double(merged, F.lit(0.5)))
    n, s = F.sum(part(c, "n")), F.sum(part(c, "s"))
    if fn == "mean":
        return F.when(n > 0, s / n)
    # squares around the months' means, and of those around the whole mean
    away = part(c, "n") * (_mean(c) - F.col(f"`{c}__r`"))
    between = F.sum(away * (_mean(c) - F.col(f"`{c}__r`"))) - F.sum(away) * F.sum(away) / n
    var = F.when(n > 1, F.greatest(F.sum(part(c, "m")) + between, F.lit(0.0)) / (n - 1))
    return var if fn == "var" else F.sqrt(var)


def append_states(states: DataFrame, path: str, month: str) -> None:
    """Add states to a store; each row must enter a store once."""
    states.write.mode("append").partitionBy(month).parquet(path)


def refresh(new_rows: DataFrame, path: str, by: str, month: str, spec: Spec) -> None:
    """Bring rows that arrived since the last time into a store, without reading what it holds."""
    append_states(monthly_states(new_rows, by, month, spec), path, month)


def stored_states(spark: SparkSession, path: str, month: str, months: Sequence[int] | None = None) -> DataFrame:
    """The states of a store, of ``months`` (first, last) only if given."""
    states = spark.read.parquet(path)
    return states if months is None else states.where(F.col(month).between(*months))
