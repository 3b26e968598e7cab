"""Group statistics joined back to rows and ordered-sequence features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.aggspec import Spec, expression, group_agg, out_name, top_rows_per_group
from ledgerloom.operators.quantiles import value_ladder
from ledgerloom.operators.skew import UNCUT, pinned, split_hot_groups
from ledgerloom.session import durable


def stat_table(df: DataFrame, keys: Sequence[str], stats: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per group with the statistics ``out: (column, function)``."""
    spec: dict[str, list[str]] = {}
    for column, fn in stats.values():
        spec.setdefault(column, [])
        if fn not in spec[column]:
            spec[column].append(fn)
    table = group_agg(df, spec, list(keys), "__g_")
    return table.selectExpr(*[f"`{k}`" for k in keys], *[f"`__g_{c}_{fn.upper()}` as `{out}`" for out, (c, fn) in stats.items()])


def group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Attach group statistics to every row.

    The statistics are pre-aggregated and left-joined rather than computed in a
    window, so a hot group is combined map-side and never sorted in one task;
    the small side is broadcast only if its measured size allows it.
    """
    return df.join(stat_table(df, keys, stats), list(keys), "left")


def attach_stats(df: DataFrame, wanted: Sequence[tuple[Sequence[str], Mapping[str, tuple[str, str]]]]) -> DataFrame:
    """Several statistics tables, all computed from ``df`` itself, joined to it."""
    tables = [(list(keys), stat_table(df, keys, stats)) for keys, stats in wanted]
    return reduce(lambda out, item: out.join(item[1], item[0], "left"), tables, df)


def interaction_spec(key_lists: Sequence[Sequence[str]], spec: Spec):
    """Statistics named COL_FN_AGG_key1_key2... for every key list."""
    return [(keys, {f"{c}_{fn.upper()}_AGG_{'_'.join(keys)}": (c, fn) for c, fns in spec.items() for fn in fns})
            for keys in key_lists]


def grouping_table(df: DataFrame, key_lists: Sequence[Sequence[str]], spec: Spec) -> tuple[DataFrame, list[int]]:
    """Statistics of all key lists from one aggregate, and the ``__gid`` by which each list's rows are told apart.

    Rows are expanded once for each list and combined before one exchange.  Groups with a
    missing key are left out.  ``spec`` takes aggregates that need one pass (no medians,
    first, last or distinct counts).
    """
    keys = list(dict.fromkeys(k for ks in key_lists for k in ks))
    measures = [expression(c, fn, out_name("__g_", c, fn)) for c, fns in spec.items() for fn in fns]
    named = df.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{c}`") for c in spec if c not in keys])
    sets = [[F.col(f"`{k}`") for k in ks] for ks in key_lists]
    table = named.groupingSets(sets, *[F.col(f"`{k}`") for k in keys]).agg(F.grouping_id().cast("bigint").alias("__gid"), *measures)
    gids = [sum(1 << i for i, k in enumerate(reversed(keys)) if k not in ks) for ks in key_lists]
    whole = reduce(lambda a, b: a | b, [(F.col("__gid") == gid) & reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in ks])
                                        for gid, ks in zip(gids, key_lists)])
    return table.where(whole), gids


def interaction_stats(df: DataFrame, key_lists: Sequence[Sequence[str]], spec: Spec, source: DataFrame | None = None) -> DataFrame:
    """``df`` with every list's statistics, named COL_FN_AGG_key1_key2...

    One pass over ``df``, or over ``source``, an ancestor with the same rows that is
    cheaper to read, makes all of them; the written groups are then joined list by
    list, by broadcast as far as their written sizes allow.
    """
    table, gids = grouping_table(df if source is None else source, key_lists, spec)
    table = durable(table)
    out = df
    for gid, (keys, outs) in zip(gids, interaction_spec(key_lists, spec)):
        own = table.where(F.col("__gid") == gid).select(
            *[F.col(f"`{k}`") for k in keys], *[F.col(f"`{out_name('__g_', c, fn)}`").alias(o) for o, (c, fn) in outs.items()])
        out = out.join(own, list(keys), "left")
    return out


def lookup_map(df: DataFrame, key: str, column: str, fn: str, out: str) -> DataFrame:
    return group_stats(df, [key], {out: (column, fn)})


def entities_active_since(df: DataFrame, entity: str, day: str, in_place: bool = False) -> DataFrame:
    """Attach each entity's newest day as ``LAST_DAY``; one lookup serves any window.

    ``in_place`` finds it among the sorted rows of the entity, which move once at most;
    it asks for entities that a task can hold (see ``all_fit``).
    """
    if in_place:
        latest = F.max(day).over(Window.partitionBy(entity))
        return df.withColumn("LAST_DAY", F.when(F.col(entity).isNotNull(), latest))
    newest = df.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.max(day).alias("LAST_DAY"))
    return df.join(newest, entity, "left")


def recent_entities(df: DataFrame, entity: str, day: str, min_day: float) -> DataFrame:
    """All rows of the entities that have at least one row since ``min_day``."""
    ids = df.where(F.col(day) >= F.lit(min_day)).select(entity).distinct()
    return df.join(ids, entity, "left_semi")


def _chunk_rows(alpha: float) -> int:
    """Rows over which a weight falls to 1e-120, which is far inside double range for any alpha."""
    if not 0 < alpha < 1:
        raise ValueError("alpha must lie strictly between 0 and 1")
    return max(2, int(120 / -math.log10(1 - alpha)))


def ewma(df: DataFrame, cols: Sequence[str], alpha: float, by: Sequence[str], order: Sequence[str],
         prefix: str = "EXP_", rows_per_piece: int | None = None) -> DataFrame:
    """Exponentially weighted mean per group in ascending ``order``.

    Weights are normalised; missing cells get no weight but still age the
    earlier ones, and carry the last value forward.  Rows are numbered inside
    chunks over which a weight falls to 1e-120, so that the decay powers cannot
    overflow and a chunk needs only the closing sums of the chunk before it:
    anything older weighs less than that, whatever ``alpha``.  Groups above
    ``rows_per_piece`` rows (default: the row budget of ``skew``) are cut along their
    whole order; the summaries of a group's pieces are chained.
    """
    by, q, size = list(by), 1.0 - alpha, _chunk_rows(alpha)
    tagged, cut = split_hot_groups(df, by, [F.col(c).asc_nulls_first() for c in order], rows_per_piece)
    group = [*by, "__piece"]
    ordered = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = tagged.withColumn("__rn", F.row_number().over(ordered) - 1).withColumns({
        "__chunk": F.floor(F.col("__rn") / F.lit(size)), "__pos": (F.col("__rn") % F.lit(size)).cast("double")})
    chunk = Window.partitionBy(*group, "__chunk").orderBy("__rn").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = Window.partitionBy(*group).orderBy("__rn")
    earlier = running.rowsBetween(Window.unboundedPreceding, -1)
    upto = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grow = F.pow(F.lit(1.0 / q), F.col("__pos"))
    shrink = F.pow(F.lit(q), F.col("__pos"))
    closing = F.col("__pos") == F.lit(float(size - 1))
    sums, states, values = {}, {}, {}
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        sums[f"__num{i}"] = F.coalesce(F.sum(x * grow).over(chunk), F.lit(0.0)) * shrink
        sums[f"__den{i}"] = F.coalesce(F.sum(F.when(x.isNotNull(), grow)).over(chunk), F.lit(0.0)) * shrink
        previous = F.last(F.when(closing, F.struct(F.col(f"__num{i}").alias("num"), F.col(f"__den{i}").alias("den"))),
                          ignorenulls=True).over(earlier)
        states[f"__prev{i}"] = previous
        fade = shrink * F.lit(q)
        num = F.col(f"__num{i}") + F.coalesce(F.col(f"__prev{i}.num"), F.lit(0.0)) * fade
        den = F.col(f"__den{i}") + F.coalesce(F.col(f"__prev{i}.den"), F.lit(0.0)) * fade
        values[f"__here{i}"] = F.when(x.isNotNull(), F.struct(num.alias("num"), den.alias("den"), F.col("__rn").alias("rn")))
    local = numbered.withColumns(sums).withColumns(states).withColumns(values).withColumns(
        {f"__seen{i}": F.last(F.col(f"__here{i}"), ignorenulls=True).over(upto) for i in range(len(cols))})
    joined = local.join(_carry_over(local, by, q, len(cols)), group, "left") if cut else local
    out = {}
    for i, c in enumerate(cols):
        seen = F.col(f"__seen{i}")
        out[prefix + c] = seen["num"] / seen["den"]
        if cut:
            carry = F.col(f"__carry{i}")
            age = F.pow(F.lit(q), (seen["rn"] + F.lit(1) + carry["gap"]).cast("double"))
            mixed = (seen["num"] + carry["num"] * age) / (seen["den"] + carry["den"] * age)
            entered = F.when(seen.isNotNull(), mixed).otherwise(carry["num"] / carry["den"])
            out[prefix + c] = F.when(carry.isNotNull(), entered).otherwise(seen["num"] / seen["den"])
    return joined.withColumns(out).select(*[f"`{c}`" for c in df.columns], *[f"`{prefix}{c}`" for c in cols])


def _carry_over(local: DataFrame, by: Sequence[str], q: float, n: int) -> DataFrame:
    """State entering each piece of a cut group: weighted sums as of the last present row."""
    group = [*by, "__piece"]
    newest = [F.max_by(F.struct(*[F.col(f"__seen{i}").alias(f"s{i}") for i in range(n)]), "__rn").alias("__end"),
              F.count(F.lit(1)).alias("__rows")]
    ends = local.where(F.col("__piece") != UNCUT).groupBy(*group).agg(*newest)
    before = Window.partitionBy(*by).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    chain = ends.withColumn("__chain", F.collect_list(F.struct("__rows", "__end")).over(before))
    empty = F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den"), F.lit(0).cast("long").alias("gap"))
    carries = {}
    for i in range(n):
        folded = F.aggregate(F.col("__chain"), empty, _chain_step(f"s{i}", q))
        carries[f"__carry{i}"] = F.when(folded["den"] > 0, folded)
    return chain.withColumns(carries).select(*group, *carries)


def _chain_step(name: str, q: float):
    """Fold one piece summary into the state that enters the next piece."""

    def step(acc: Column, item: Column) -> Column:
        end = item["__end"][name]
        age = F.pow(F.lit(q), (end["rn"] + F.lit(1) + acc["gap"]).cast("double"))
        moved = F.struct((end["num"] + acc["num"] * age).alias("num"), (end["den"] + acc["den"] * age).alias("den"),
                         (item["__rows"] - F.lit(1) - end["rn"]).cast("long").alias("gap"))
        idle = F.struct(acc["num"].alias("num"), acc["den"].alias("den"), (acc["gap"] + item["__rows"]).alias("gap"))
        return F.when(end.isNotNull(), moved).otherwise(idle)

    return step


def ewma_last(df: DataFrame, cols: Sequence[str], alpha: float, by: Sequence[str], order: Sequence[str],
              outer: str, prefix: str = "EXP_") -> DataFrame:
    """Newest exponentially weighted value of each ``outer`` key."""
    smoothed = ewma(df, cols, alpha, by, order, prefix)
    spec = {prefix + c: ["last"] for c in cols}
    rank = [F.col(c) for c in order] + [F.col(c) for c in by if c != outer]
    return group_agg(smoothed, spec, outer, "", rank)


def last_k_trend(df: DataFrame, by: str, order: Sequence[Column], cols: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """Slope of each column over its k newest rows, positions counted newest first.

    A single row gives 0, a missing cell inside the window gives missing.  Only
    max(k) rows per group survive the map side of the ranking.
    """
    window = Window.partitionBy(by).orderBy(*order)
    top = (df.where(F.col(by).isNotNull()).withColumn("__rn", F.row_number().over(window))
           .where(F.col("__rn") <= F.lit(max(ks))))
    x = (F.col("__rn") - 1).cast("double")
    aggs = []
    for k in ks:
        inside = F.col("__rn") <= F.lit(k)
        rows = F.count(F.when(inside, F.lit(1)))
        for c in cols:
            y = F.col(c).cast("double")
            slope = F.regr_slope(F.when(inside, y), F.when(inside, x))
            aggs.append(F.when(F.count(F.when(inside, y)) < rows, None).when(rows == 1, F.lit(0.0))
                        .otherwise(slope).alias(f"{k}_TREND_{c}"))
    return top.groupBy(by).agg(*aggs)


def latest_entity_stats(df: DataFrame, by: str, entity: str, order: Sequence[Column], spec: Spec,
                        prefix: str = "LAST_") -> DataFrame:
    """Aggregates over the rows of the entity that owns the newest row of each key."""
    newest = (df.where(F.col(by).isNotNull()).groupBy(by)
              .agg(F.max_by(entity, F.struct(*order)).alias("__newest")))
    # joined by the key alone, by which the rows may lie together already
    own = pinned(df.join(newest, by), [entity, "__newest"]).where(F.col(entity) == F.col("__newest")).drop("__newest")
    return group_agg(own, spec, by, prefix)


def last_n_entities(df: DataFrame, by: str, entity: str, newest: Column, n: int, entity_agg: Mapping[str, Column],
                    outer_agg: Sequence[Column]) -> DataFrame:
    """Aggregate per entity, keep the n newest entities per key, aggregate those."""
    per = df.groupBy(by, entity).agg(newest.alias("__newest"), *[e.alias(a) for a, e in entity_agg.items()])
    kept = top_rows_per_group(per, by, [F.col("__newest").desc_nulls_last(), F.col(entity).desc()], n)
    return kept.groupBy(by).agg(*outer_agg)


def empirical_cdf(df: DataFrame, column: str, by: Sequence[str] = (), rows_per_piece: int | None = None) -> DataFrame:
    """Run-length form of the empirical distribution: one row per distinct value.

    Positions are i/(n-1); a run of equal values covers [cdf_first, cdf_last].
    """
    ladder = value_ladder(df, [column], by, rows_per_piece=rows_per_piece)
    span = F.when(F.col("n") > 1, (F.col("n") - 1).cast("double"))
    return ladder.select(*by, F.col("value").alias(column), "cnt", (F.col("first_pos") / span).alias("cdf_first"),
                         ((F.col("first_pos") + F.col("cnt") - 1) / span).alias("cdf_last"))


def partition_total(df: DataFrame, keys: Sequence[str], column: str, out: str, in_place: bool = False) -> DataFrame:
    """Attach the total of each group; ``in_place`` as in ``entities_active_since``."""
    if in_place:
        named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        total = F.coalesce(F.sum(column).over(Window.partitionBy(*keys)), F.lit(0))
        return df.withColumn(out, F.when(named, total))
    return group_stats(df, keys, {out: (column, "sum")})
