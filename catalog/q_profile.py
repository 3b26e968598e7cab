"""Profiling tables."""

from __future__ import annotations

from itertools import combinations
from math import pi

from pyspark.sql import functions as F

from catalog.registry import S, query
from ledgerloom import functions as X
from ledgerloom.operators import profile as P
from ledgerloom.operators import sketches as K
from ledgerloom.sources.schemas import COLUMNS
from ledgerloom.sources.schemas import COLUMNS, DOCUMENT_FLAGS

APP = S("application")
APP_COLUMNS = [c for kind in ("id", "int", "num", "str") for c in COLUMNS["application"][kind]]
NUMBERS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "EXT_SOURCE_1", "EXT_SOURCE_2", "DAYS_BIRTH"]


def per_column(columns, expr: str, name: str, value: str) -> str:
    return " union all ".join(f"select '{c}' as {name}, {expr.format(c=c)} as {value} from a" for c in columns)


@query(f"with a as {APP} {per_column(APP_COLUMNS, '100 * avg(case when {c} is null then 1.0::double else 0 end)', '\"column\"', 'percent')}", rnd="percent")
def null_profile(t):
    return P.null_profile(t("application"))


@query(f"with a as {APP} select * from ({per_column(APP_COLUMNS, '100 * avg(case when {c} is null then 1.0::double else 0 end)', '\"column\"', 'percent')}) where percent <> 0", rnd="percent")
def null_profile_missing_only(t):
    return P.null_profile(t("application"), only_missing=True)


@query(f"with a as {APP} " + " union all ".join(
    f"select '{c}' as feature, count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std, cast(min({c}) as double) as min, "
    f"quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50, quantile_cont({c}, 0.75) as q75, cast(max({c}) as double) as max from a"
    for c in NUMBERS), keys="feature")
def describe_table(t):
    return P.describe(t("application"), NUMBERS)


@query(f"with a as {APP} select OCCUPATION_TYPE, count(*) as count, count(*) / (select count(OCCUPATION_TYPE)::double from a) as share from a where OCCUPATION_TYPE is not null group by 1", rnd="share")
def value_counts(t):
    return P.value_counts(t("application"), "OCCUPATION_TYPE")


@query(f"select NAME_INCOME_TYPE, 100 * sum(case when TARGET = 1 then 1 else 0 end) / count(*)::double as event_rate from {APP} group by 1", rnd="event_rate")
def event_rate_by_category(t):
    return P.event_rate(t("application"), "NAME_INCOME_TYPE")


@query(f"select OCCUPATION_TYPE, 100 * sum(case when TARGET = 1 then 1 else 0 end) / count(*)::double as event_rate from {APP} where OCCUPATION_TYPE is not null group by 1 having sum(case when TARGET = 1 then 1 else 0 end) > 0", rnd="event_rate")
def event_rate_nonzero(t):
    return P.event_rate(t("application"), "OCCUPATION_TYPE", drop_zero=True)


@query(f"select OCCUPATION_TYPE, count(*) as contracts, avg(TARGET) as mean_target from {APP} where OCCUPATION_TYPE is not null group by 1", rnd="mean_target")
def category_stats(t):
    return P.category_stats(t("application"), "OCCUPATION_TYPE")


@query(f"select CODE_GENDER, count(*) filter (where TARGET = 0) as class_0, count(*) filter (where TARGET = 1) as class_1 from {APP} group by 1")
def class_crosstab(t):
    return P.class_crosstab(t("application"), "CODE_GENDER")


YEARS = [20 + 5 * i for i in range(11)]


@query(f"""select case {' '.join(f'when y > {a} and y <= {b} then {i}' for i, (a, b) in enumerate(zip(YEARS[:-1], YEARS[1:])))} end as bin,
count(*) as rows, avg(TARGET) as mean_target from (select TARGET, -DAYS_BIRTH / 365::double as y from {APP} where TARGET is not null) where y > 20 and y <= 70 group by 1""", rnd="mean_target")
def binned_event_rate(t):
    labelled = t("application").where(F.col("TARGET").isNotNull())
    return P.binned_rate(labelled, X.days_to_years("DAYS_BIRTH"), YEARS)


FINE = [0, 10, 25, 50, 75, 90, 92, 99, 99.1, 99.2, 99.3, 99.4, 99.5, 99.6, 99.7, 99.8, 99.9, 100]


@query(f"with a as {S('bureau')} " + " union all ".join(
    f"select {p}::double as percentile, quantile_cont(CREDIT_DAY_OVERDUE, {round(p / 100, 9)}) as value from a" for p in FINE), rnd="value")
def percentile_table(t):
    return P.percentile_table(t("bureau"), "CREDIT_DAY_OVERDUE", FINE)


@query(f"""select TARGET::double as TARGET, case when DAYS_REGISTRATION = 0 then 14 else floor((DAYS_REGISTRATION + 15000) * (15 / 15000::double))::int end as bin, count(*) as rows
from {APP} where TARGET is not null and DAYS_REGISTRATION between -15000 and 0 group by 1, 2""", rnd="TARGET")
def histogram(t):
    return P.histogram(t("application").where(F.col("TARGET").isNotNull()), "DAYS_REGISTRATION", -15000, 0, 15, ["TARGET"])


EDGES = [0, 1, 30, 60, 90, 200, 400]


@query(f"""select case when CREDIT_DAY_OVERDUE = 400 then {len(EDGES) - 2} {' '.join(f'when CREDIT_DAY_OVERDUE >= {a} and CREDIT_DAY_OVERDUE < {b} then {i}' for i, (a, b) in enumerate(zip(EDGES[:-1], EDGES[1:])))} end as bin,
count(*) as rows from {S('bureau')} where CREDIT_DAY_OVERDUE between 0 and 400 group by 1""")
def histogram_explicit_edges(t):
    return P.edge_histogram(t("bureau"), "CREDIT_DAY_OVERDUE", EDGES)


GRID = [20.0 + 2 * i for i in range(26)]


@query(f"""with a as (select TARGET, -DAYS_BIRTH / 365::double as x from {APP} where TARGET is not null),
s as (select TARGET, count(*) as n, stddev_samp(x) * power(count(*), -0.2::double) as h from a group by 1),
g as (select unnest({GRID}) as grid)
select a.TARGET::double as TARGET, g.grid::double as grid, sum(exp(-0.5::double * power((g.grid - a.x) / s.h, 2)) / (s.n * s.h * {(2 * pi) ** 0.5!r}::double)) as density
from a join s on a.TARGET = s.TARGET cross join g group by 1, 2""", rnd="TARGET density")
def kde_by_class(t):
    df = t("application").select("TARGET", X.days_to_years("DAYS_BIRTH").alias("YEARS_BIRTH"))
    return P.kernel_density(df, "YEARS_BIRTH", "TARGET", GRID)


BINS = 1024


@query(f"""with a as (select TARGET, -DAYS_BIRTH / 365::double as x from {APP} where TARGET is not null),
s as (select TARGET, count(*) as n, stddev_samp(x) * power(count(*), -0.2::double) as h, min(x) as lo, (max(x) - min(x)) / {BINS - 1} as d from a where x is not null group by 1),
p as (select a.TARGET, least(floor((x - lo) / d), {BINS - 2}) as i, (x - lo) / d as p from a join s on a.TARGET = s.TARGET),
b as (select TARGET, i, sum(1 - (p - i)) as c from p group by 1, 2 union all select TARGET, i + 1, sum(p - i) from p group by 1, 2),
g as (select unnest({GRID}) as grid)
select s.TARGET::double as TARGET, g.grid::double as grid, coalesce(sum(c * exp(-0.5::double * power((g.grid - (lo + i * d)) / h, 2)) / (n * h * {(2 * pi) ** 0.5!r}::double))
  filter (where abs(g.grid - (lo + i * d)) <= {P.REACH} * h), 0) as density from s join b on b.TARGET = s.TARGET cross join g group by 1, 2""", rnd="TARGET density")
def binned_kde_by_class(t):
    df = t("application").select("TARGET", X.days_to_years("DAYS_BIRTH").alias("YEARS_BIRTH"))
    return P.binned_density(df, "YEARS_BIRTH", "TARGET", GRID, BINS)


SKETCHED = [c for c in COLUMNS["application"]["int"] if c != "TARGET"] + COLUMNS["application"]["num"]
SKETCH_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query(f"""with l as (unpivot (select {', '.join(f'cast({c} as double) as {c}' for c in SKETCHED)} from {APP}) on {', '.join(SKETCHED)} into name feature value value)
select feature, p as probability, count(*) as n, true as within from l, (select unnest({SKETCH_PROBS}::double[]) as p) group by 1, 2""")
def quantile_sketch_ranks(t):
    """Sketches of two parts of every numeric applicant column, stored and merged: ranks within twice the bound for one answer."""
    app, path = t("application"), t.scratch()
    for part in (0, 1):
        K.quantile_sketches(app.where(F.pmod("SK_ID_CURR", F.lit(2)) == part), SKETCHED).write.mode("append").parquet(path)
    merged = K.sketch_quantiles(K.merge_sketches(t.spark.read.parquet(path)), SKETCH_PROBS)
    return K.rank_check(app, merged, SKETCHED, SKETCH_PROBS, 2 * K.rank_error())


@query(f"""with a as (select CREDIT_ACTIVE, AMT_CREDIT_SUM as x from {S('bureau')}),
s as (select CREDIT_ACTIVE, quantile_cont(x, 0.25) as q1, median(x) as median, quantile_cont(x, 0.75) as q3 from a group by 1)
select a.CREDIT_ACTIVE, q1, median, q3, min(x) filter (where x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as low_whisker,
max(x) filter (where x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as high_whisker,
count(*) filter (where not (x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as outliers
from a join s on a.CREDIT_ACTIVE = s.CREDIT_ACTIVE group by 1, 2, 3, 4""", rnd="q1 median q3 low_whisker high_whisker")
def box_stats_by_class(t):
    return P.box_stats(t("bureau"), "AMT_CREDIT_SUM", "CREDIT_ACTIVE")


@query(f"with a as {APP} " + " union all ".join(
    f"select '{b}' as row, '{a}' as \"column\", corr({b}, {a}) as corr from a" for a, b in combinations(NUMBERS, 2)), rnd="corr")
def correlation_matrix(t):
    return P.correlation(t("application"), NUMBERS)


WIDE = [*COLUMNS["application"]["num"], "DAYS_BIRTH", "CNT_CHILDREN"]


@query(f"with a as {APP}, l as (select [" + ", ".join(
    f"struct_pack(\"row\" := '{b}', \"column\" := '{a}', corr := corr({b}, {a}))" for a, b in combinations(WIDE, 2))
    + "] as c from a) select unnest(c, recursive := true) from l", rnd="corr")
def correlation_matrix_wide(t):
    """All numeric applicant columns."""
    return P.correlation(t("application"), WIDE)


@query(f"with a as {APP} {per_column(NUMBERS, 'corr({c}, TARGET)', 'feature', 'corr')}", rnd="corr")
def correlation_with_target(t):
    return P.target_correlation(t("application"), NUMBERS)


@query(f"with a as (select * from {APP} where TARGET is not null), " + ", ".join(
    f"c{i} as (select case when hi <= lo then 0 else least(9, floor(({c} - lo) / ((hi - lo) / 10::double))) end as bin, TARGET as class, count(*)::double as n "
    f"from a, (select min({c}) as lo, max({c}) as hi from {APP}) where {c} is not null group by 1, 2)" for i, c in enumerate(NUMBERS)) + " "
    + " union all ".join(
    f"select '{c}' as feature, sqrt(greatest(0, (select sum(n) from c{i}) * ((select sum(n * n / (rn * cn)) from (select n, sum(n) over (partition by bin) as rn, "
    f"sum(n) over (partition by class) as cn from c{i})) - 1)) / ((select sum(n) from c{i}) * (least((select count(distinct bin) from c{i}), (select count(distinct class) from c{i})) - 1))) as cramers_v"
    for i, c in enumerate(NUMBERS)), rnd="cramers_v")
def cramers_v_with_target(t):
    return P.cramers_v(t("application"), NUMBERS)


@query()
def phik_with_target(t):
    return P.phik(t("application"), NUMBERS, top=10)


@query(f"select NAME_EDUCATION_TYPE, avg(AMT_INCOME_TOTAL) as mean_AMT_INCOME_TOTAL from {APP} group by 1", rnd="mean_AMT_INCOME_TOTAL")
def metric_by_category(t):
    return P.metric_by_category(t("application"), "NAME_EDUCATION_TYPE", "AMT_INCOME_TOTAL")


@query(f"with a as {APP} {per_column(DOCUMENT_FLAGS, 'avg({c})', 'flag', 'share')}", rnd="share")
def flag_coverage(t):
    return P.flag_coverage(t("application"), DOCUMENT_FLAGS)


@query(f"""select distinct_values, count(*) as entities from (select b.SK_ID_CURR, CREDIT_ACTIVE, count(distinct STATUS) as distinct_values from {S('bureau')} b
join {S('bureau_balance')} m on b.SK_ID_BUREAU = m.SK_ID_BUREAU group by 1, 2) where distinct_values <> 0 group by 1""")
def distinct_per_entity(t):
    df = t("bureau").join(t("bureau_balance"), "SK_ID_BUREAU")
    return P.distinct_per_entity(df, ["SK_ID_CURR", "CREDIT_ACTIVE"], "STATUS")


@query(f"""with a as (select NAME_INCOME_TYPE as v, TARGET as c from {APP} where TARGET is not null and NAME_INCOME_TYPE is not null),
n as (select v, c, count(*)::double as n from a group by 1, 2),
m as (select n, sum(n) over (partition by v) as rn, sum(n) over (partition by c) as cn, sum(n) over () as t from n)
select 'NAME_INCOME_TYPE' as feature, sqrt(greatest(0, any_value(t) * (sum(n * n / (rn * cn)) - 1)) / (any_value(t)
  * (least((select count(distinct v) from n), (select count(distinct c) from n)) - 1))) as cramers_v from m""", rnd="cramers_v")
def cramers_v_of_text(t):
    return P.cramers_v(t("application"), ["NAME_INCOME_TYPE"])
