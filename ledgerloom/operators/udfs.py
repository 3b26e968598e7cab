"""Hooks for user functions; built-in operators never go through Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.skew import sorted_pieces

#: rows of a group that a carried-state function gets at a time
RUN = 100_000


def grouped_map(df: DataFrame, by: str, fn: Callable[[pd.DataFrame], dict], schema: str,
                max_rows: int = 5_000_000) -> DataFrame:
    """One result row per key from a user function over the key's pandas frame.

    Such a function needs its whole group in memory, so groups are size-checked
    where they run: a group above ``max_rows`` fails the job with a clear error
    instead of exhausting the worker, and its rows are never dropped; functions that
    can be put together from parts have no limit in ``grouped_reduce``.
    """

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > max_rows:
            raise ValueError(f"group {key[0]!r} has {len(pdf)} rows, limit is {max_rows}; use a built-in operator")
        return pd.DataFrame([{by: key[0], **fn(pdf)}])

    return df.where(F.col(by).isNotNull()).groupBy(by).applyInPandas(run, schema)


def grouped_reduce(df: DataFrame, by: str, partial: Callable[[pd.DataFrame], dict], merge: Callable[[pd.DataFrame], dict],
                   finish: Callable[[dict], dict], state: str, schema: str, fan_in: int = 64) -> DataFrame:
    """One result row per key from a user reducer, for groups of any size.

    ``partial`` turns some rows of a key into a state (the columns of ``state``),
    ``merge`` several states into one, and ``finish`` the last one into the result.
    No worker sees more of a group than one Arrow batch, or than the states of one of
    ``fan_in`` parts; ``schema`` and ``state`` name the columns besides the key.
    """
    kind = dict(df.dtypes)[by]

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{by: key, **partial(part)} for key, part in pdf.groupby(by, sort=False)]
            if rows:
                yield pd.DataFrame(rows)

    def merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{by: key[0], **merge(pdf)}])

    def ended(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{by: key[0], **finish(merge(pdf))}])

    states = df.where(F.col(by).isNotNull()).mapInPandas(begin, f"`{by}` {kind}, {state}").withColumn(
        "__part", F.spark_partition_id() % fan_in)
    few = states.groupBy(by, "__part").applyInPandas(merged, f"`{by}` {kind}, {state}")
    return few.groupBy(by).applyInPandas(ended, f"`{by}` {kind}, {schema}")


def grouped_transform(df: DataFrame, by: Sequence[str], order: Sequence[str], column: str, out: str,
                      fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Same-length user function over one ordered column of each group, which must fit into a worker's memory.

    ``grouped_scan`` has no such limit.
    """
    schema = df.drop(out).withColumn(out, F.lit(0.0)).schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        return pdf.assign(**{out: fn(pdf[column]).astype(float)})

    return df.groupBy(*by).applyInPandas(run, schema)


def grouped_scan(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str,
                 summarise: Callable[[pd.DataFrame], dict], merge: Callable[[dict, dict], dict],
                 step: Callable[[dict | None, pd.DataFrame], pd.Series], state: str, run: int = RUN) -> DataFrame:
    """Same-length user function over each ordered group, with a state carried from run to run.

    Rows are sorted by range over ``by`` and ``order`` together, and each group is cut into
    runs of at most ``run`` rows, so a group may be larger than any worker's memory:

    - ``summarise(rows)`` makes the state of one run by itself, a dict of ``state``'s fields;
    - ``merge(before, after)`` makes the state of two neighbouring stretches; it must be associative;
    - ``step(before, rows)`` yields the values (doubles) of a run's rows from the state of all rows of
      the group before it, None for the first run.

    States of a group (one for each run) are merged in one task.  ``order`` should be
    total: rows equal in all of it stand in any order.  Rows without a key are a group.
    """
    by = list(by)
    pieces = sorted_pieces(df.drop(out), [*by, *(c for c in order if c not in by)])
    rows = pieces.withColumn("__run", F.floor(F.col("__at") / run))
    place, columns = ["__piece", "__run"], [c for c in df.columns if c != out]
    keys = ", ".join(f"`{c}` {t}" for c, t in df.select(*by).dtypes)
    fields = [f.name for f in StructType.fromDDL(state).fields]
    carried = f"{keys}, __piece bigint, __run bigint, __first boolean, {state}"
    made = f"{keys}, __piece bigint, __run bigint, {state}"
    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__at")
        return pd.DataFrame([{**pdf.iloc[0][[*by, *place]].to_dict(), **summarise(pdf[columns])}])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(place)
        so_far, found = None, []
        for row in pdf.to_dict("records"):
            found.append({**{c: row[c] for c in [*by, *place]}, "__first": so_far is None, **(so_far or {f: row[f] for f in fields})})
            own = {f: row[f] for f in fields}
            so_far = own if so_far is None else merge(so_far, own)
        return pd.DataFrame(found)

    def apply(pdf: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({c: [] for c in [*columns, out]})
        pdf = pdf.sort_values("__at")
        first = states.iloc[0]
        before = None if first["__first"] else {f: first[f] for f in fields}
        return pdf[columns].assign(**{out: step(before, pdf[columns]).astype(float)})

    states = rows.groupBy(*by, *place).applyInPandas(summary, made).groupBy(*by).applyInPandas(chain, carried)
    schema = df.drop(out).withColumn(out, F.lit(0.0)).schema
    return rows.groupBy(*by, *place).cogroup(states.groupBy(*by, *place)).applyInPandas(apply, schema)


def scalar_function(fn: Callable[..., pd.Series], returns: str) -> Callable[..., Column]:
    """Wrap a vectorised pandas function as a column function."""
    return F.pandas_udf(fn, returns)


def group_aggregate(fn: Callable[..., float], returns: str = "double") -> Callable[..., Column]:
    """Wrap a pandas reducer (Series -> number) as a grouped aggregate."""

    def reducer(values: pd.Series) -> float:
        return fn(values)

    return F.pandas_udf(reducer, returns)
