"""Specification-driven group aggregation.

A spec maps a column to a list of function names; output columns are called
``PREFIX + COLUMN + '_' + FUNCTION``.  Several specs over row segments are fused
into one aggregate, so N segments cost one shuffle instead of N.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.rowwise import safe_div, sql_text
from ledgerloom.operators.quantiles import quantiles_wide

Spec = Mapping[str, Sequence[str]]
ORDERED = ("first", "last")
EXACT = {"median": (0.5,), "iqr": (0.25, 0.75)}


@dataclass(frozen=True)
class Segment:
    """Rows satisfying ``where`` aggregated by ``spec`` under ``prefix``."""

    prefix: str
    spec: Spec
    where: Column | None = None
    order: tuple[Column, ...] = field(default=())


def out_name(prefix: str, column: str, fn: str) -> str:
    return f"{prefix}{column}_{fn.upper()}"


def value_at(value: Column, order: Sequence[Column], newest: bool = True, where: Column | None = None) -> Column:
    """Last (or first) present value along ``order`` inside a group."""
    present = value.isNotNull() if where is None else (value.isNotNull() & where)
    rank = F.when(present, F.struct(*order))
    return F.max_by(value, rank) if newest else F.min_by(value, rank)


# Spark SQL text per function name; {v} is the (segment-masked) value.  One parsed
# text per output keeps the building of specs with hundreds of outputs cheap.
FUNCTIONS = {
    "min": "min({v})", "max": "max({v})", "mean": "avg(cast({v} as double))",
    "var": "var_samp(cast({v} as double))", "std": "stddev_samp(cast({v} as double))",
    "skew": "skewness(cast({v} as double))", "kurt": "kurtosis(cast({v} as double))",
    # the bias-corrected form: missing below three values, zero for a constant
    "skew_unbiased": "case when count({v}) > 2 then coalesce(nanvl(skewness(cast({v} as double)), 0), 0) "
                     "* sqrt(count({v}) * (count({v}) - 1D)) / (count({v}) - 2) end",
}
# fields of the aggregate's buffer; Spark compiles a whole stage only where it has at most 100
FIELDS = {"mean": 2, "var": 3, "std": 3, "skew": 4, "kurt": 5, "skew_unbiased": 5, "sum": 2}
COMPILED = 80
COUNTED = {"sum": "coalesce(sum({v}), 0)", "count": "count({v})", "size": "count({rows})"}


def expression(column: str, fn: str, name: str, inside: str | None = None) -> Column:
    """One aggregate; ``inside`` names a boolean column that marks the segment's rows."""
    value = f"`{column}`" if inside is None else f"case when `{inside}` then `{column}` end"
    rows = "1" if inside is None else f"case when `{inside}` then 1 end"
    if fn in FUNCTIONS:
        text = FUNCTIONS[fn].format(v=value)
    elif fn in COUNTED:
        text = COUNTED[fn].format(v=value, rows=rows)
        text = text if inside is None else f"case when count({rows}) > 0 then {text} end"
    else:
        raise ValueError(f"unknown aggregate {fn!r}")
    return F.expr(f"{text} as `{name}`")


def tiles(wanted: Sequence[tuple[str, int, Column]], limit: int = COMPILED) -> list[list[Column]]:
    """Aggregates (column read, buffer fields, aggregate) in runs of at most ``limit`` fields; those of a column follow each other."""
    place = {c: i for i, c in enumerate(dict.fromkeys(c for c, _, _ in wanted))}
    out: list[list[Column]] = []
    room = 0
    for _, fields, agg in sorted(wanted, key=lambda w: place[w[0]]):
        if not out or fields > room:
            out.append([])
            room = limit
        out[-1].append(agg)
        room -= fields
    return out


def segmented_agg(df: DataFrame, by: str | Sequence[str], segments: Sequence[Segment],
                  extra: Sequence[Column] = (), tiled: bool = False) -> DataFrame:
    """All segments of one table aggregated per key with one shuffle.

    Groups with no row in a segment get NULL in all of that segment's columns.
    Distinct counts run as their own narrow two-step aggregate (no row
    expansion), first/last values as a sort-based one and exact medians through
    the value ladder; all are joined on the key, on which the blocks are already
    partitioned.  Wide specs gain from ``co_locate`` beforehand: with ``tiled`` rows
    that lie together are then aggregated in tiles that Spark compiles, where a single
    aggregate of hundreds of outputs is interpreted field by field.
    """
    keys = [by] if isinstance(by, str) else list(by)
    rows = df.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    inside = [None if seg.where is None else f"__seg{i}" for i, seg in enumerate(segments)]
    rows = rows.withColumns({m: seg.where for m, seg in zip(inside, segments) if m is not None})
    plain, ordered, distinct, exact = list(extra), [], [], []
    sizes = [("", 2)] * len(plain)
    for i, seg in enumerate(segments):
        for column, fns in seg.spec.items():
            for fn in fns:
                name = out_name(seg.prefix, column, fn)
                if fn == "nunique":
                    distinct.append((name, column, i))
                elif fn in EXACT:
                    exact.append((name, column, fn, i))
                elif fn in ORDERED:
                    if not seg.order:
                        raise ValueError("first/last need an explicit order")
                    where = None if inside[i] is None else F.col(inside[i])
                    ordered.append(value_at(F.col(f"`{column}`"), seg.order, fn == "last", where).alias(name))
                else:
                    plain.append(expression(column, fn, name, inside[i]))
                    # a segment's sum and count also count its rows
                    sizes.append((column, FIELDS.get(fn, 1) + (fn in COUNTED and inside[i] is not None)))
    order = [out_name(s.prefix, c, f) for s in segments for c, fs in s.spec.items() for f in fs]
    blocks = []
    if ordered:
        # ordering by a struct needs a sort-based aggregate; the rest stays hash-based
        blocks.append(rows.groupBy(*keys).agg(*ordered))
    if plain and tiled:
        blocks += [rows.groupBy(*keys).agg(*part) for part in tiles([(*size, agg) for size, agg in zip(sizes, plain, strict=True)])]
    elif plain or not (ordered or distinct or exact):
        blocks.append(rows.groupBy(*keys).agg(*(plain or [F.count(F.lit(1)).alias("__rows")])))
    for column in dict.fromkeys(c for _, c, _ in distinct):
        wanted = [(n, i) for n, c, i in distinct if c == column]
        flags, outs = [], []
        for name, i in wanted:
            mark = inside[i]
            flags.append(F.expr(f"max({'true' if mark is None else f'coalesce(`{mark}`, false)'}) as `__in_{name}`"))
            counted = f"count(case when `__in_{name}` then __value end)"
            outs.append(F.expr(f"{counted if mark is None else f'case when max(`__in_{name}`) then {counted} end'} as `{name}`"))
        pairs = rows.withColumn("__value", F.col(f"`{column}`")).groupBy(*keys, "__value")
        blocks.append(pairs.agg(*flags).groupBy(*keys).agg(*outs))
    for i in dict.fromkeys(i for *_, i in exact):
        seg = segments[i]
        subset = rows if inside[i] is None else rows.where(F.col(inside[i]))
        wanted, finals = [], []
        for name, column, fn, j in exact:
            if j != i:
                continue
            parts = [f"__{name}_{k}" for k in range(len(EXACT[fn]))]
            wanted += [(part, column, p) for part, p in zip(parts, EXACT[fn])]
            finals.append((F.col(parts[-1]) - F.col(parts[0]) if fn == "iqr" else F.col(parts[0])).alias(name))
        blocks.append(quantiles_wide(subset, wanted, keys).select(*keys, *finals))
    joined = reduce(lambda a, b: a.join(b, keys, "left"), blocks)
    known = {*order, *keys, "__rows"}
    extras = [c for c in joined.columns if c not in known]
    return joined.select(*keys, *[f"`{c}`" for c in order], *[f"`{c}`" for c in extras])


def group_agg(df: DataFrame, spec: Spec, by: str | Sequence[str], prefix: str = "",
              order: Sequence[Column] = (), extra: Sequence[Column] = (), tiled: bool = False) -> DataFrame:
    return segmented_agg(df, by, [Segment(prefix, spec, None, tuple(order))], extra, tiled)


def group_agg_merge(detail: DataFrame, base: DataFrame, spec: Spec, by: str, prefix: str = "",
                    order: Sequence[Column] = ()) -> DataFrame:
    """Aggregate ``detail`` and left-join the block to ``base``."""
    return base.join(group_agg(detail, spec, by, prefix, order), by, "left")


def category_share(df: DataFrame, by: str | Sequence[str], domains: Mapping[str, Sequence[str]],
                   prefix: str = "", suffix: str = "") -> DataFrame:
    """Share of each category per key without materialising dummy columns."""
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(*share_columns(domains, prefix, suffix))


def share_columns(domains: Mapping[str, Sequence[str]], prefix: str = "", suffix: str = "_MEAN",
                  where: Column | None = None) -> list[Column]:
    if where is not None:
        return [F.avg(F.when(where, F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)))).alias(
            f"{prefix}{c}_{v}{suffix}") for c, values in domains.items() for v in values]
    return [F.expr(f"avg(case when `{c}` = {sql_text(v)} then 1D else 0D end) as `{prefix}{c}_{v}{suffix}`")
            for c, values in domains.items() for v in values]


def two_level_agg(df: DataFrame, outer: str, inner: str, inner_aggs: Sequence[Column],
                  outer_aggs: Sequence[Column]) -> DataFrame:
    """Aggregate per (outer, inner), then per outer."""
    return df.groupBy(outer, inner).agg(*inner_aggs).groupBy(outer).agg(*outer_aggs)


def share_of_rows(condition: Column, scale: float = 100.0) -> Column:
    """``scale`` times the share of rows for which the condition is true."""
    hits = F.sum(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))
    return F.lit(scale) * hits / F.count(F.lit(1))


def ratio_of_sums(num: str, den: str, scale: float = 1.0) -> Column:
    return safe_div(F.coalesce(F.sum(num), F.lit(0)), F.coalesce(F.sum(den), F.lit(0))) * F.lit(scale)


def latest_row(df: DataFrame, by: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest order tuple per group (map-side combinable)."""
    keys = [by] if isinstance(by, str) else list(by)
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row")).select(
        *keys, *[F.col("__row").getField(c).alias(c) for c in rest])


def sum_by_entity(detail: DataFrame, ids: DataFrame | None, entity: str, cols: Sequence[str]) -> DataFrame:
    """Sums per entity, optionally only for the entities named in ``ids``."""
    rows = detail if ids is None else detail.join(ids.select(entity).distinct(), entity, "left_semi")
    return rows.groupBy(entity).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])


def cohort_mean(df: DataFrame, cohort: str, cols: Sequence[str], prefix: str) -> DataFrame:
    """Mean of ``cols`` per cohort attached to every row of the cohort."""
    means = df.where(F.col(cohort).isNotNull()).groupBy(cohort).agg(
        *[F.avg(F.col(c).cast("double")).alias(prefix + c) for c in cols])
    return df.join(means, cohort, "left")


def group_table(df: DataFrame, by: str | Sequence[str], cols: Sequence[str], fn: str = "mean") -> DataFrame:
    """Plain table of group means or counts."""
    keys = [by] if isinstance(by, str) else list(by)
    rows = df.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    return rows.groupBy(*keys).agg(*[expression(c, fn, out_name("", c, fn)) for c in cols])


def top_rows_per_group(df: DataFrame, by: str, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of each group; the rank limit is applied before the shuffle."""
    window = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") <= k).drop("__rn")
