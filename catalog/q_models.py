"""Selection, training, scoring and user-function hooks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from catalog.newton_sql import auc_sql, newton_ctes
from catalog.preset_sql import measure
from catalog.q_presets import MASTER_TABLES, TIE
from catalog.registry import S, Tables, query
from ledgerloom.operators import modelling as M
from ledgerloom.operators import neighbours as N
from ledgerloom.operators import newton as W
from ledgerloom.operators import udfs as U
from ledgerloom.operators.clean import inf_to_null, sanitize_names, select_by_dtype
from ledgerloom.plans import applicants
from ledgerloom.plans.scoring import train_and_score as run_training
from ledgerloom.sources import io
from ledgerloom.sources.schemas import COLUMNS

APP = S("application")
KEY = "SK_ID_CURR"
FEATURES = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


def model_table(t: Tables):
    return t("application").select(KEY, "TARGET", *FEATURES)


def prepared(t: Tables):
    """Imputed, scaled training rows and unlabelled rows, features packed, with folds."""
    train, test = M.split_by_label(model_table(t))
    train, test = M.impute_scale(train, test, FEATURES)
    return M.durable(W.packed(M.stratified_folds(train, KEY), FEATURES, "TARGET", [KEY, "fold"])), W.packed(test, FEATURES, "TARGET", [KEY])


def importance_table(t: Tables, fit: W.Fit, top: int):
    rows = [(c, float(abs(b))) for c, b in zip(FEATURES, fit.coefficients)]
    return t.spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top)


MEANS = ", ".join(f"(select avg({c}) from a where TARGET is not null) as {c}_m" for c in FEATURES)
FILLED = f"(select {KEY}, TARGET, {', '.join(f'coalesce({c}, {c}_m) as {c}' for c in FEATURES)} from a, (select {MEANS}))"


@query(f"with a as {APP} select {KEY}, {', '.join(FEATURES)} from {FILLED}", keys=KEY)
def mean_impute(t):
    df = model_table(t)
    return M.mean_impute(df, M.train_means(M.split_by_label(df)[0], FEATURES)).drop("TARGET")


@query(f"with a as {APP}, f as {FILLED} select {KEY}, "
       + ", ".join(f"({c} - (select avg({c}) from f where TARGET is not null)) / (select stddev_pop({c}) from f where TARGET is not null) as {c}" for c in FEATURES)
       + " from f", keys=KEY)
def standard_scale(t):
    train, test = M.split_by_label(model_table(t))
    train, test = M.impute_scale(train, test, FEATURES)
    return train.unionByName(test).drop("TARGET")


def _dealt_sql(key: str, seed: int) -> str:
    return f"cast('0x' || substr(md5(cast({key} as varchar) || ':{seed}'), 1, 13) as bigint)"


D = len(FEATURES)
#: imputed and scaled rows x0 ..., with the folds of the labelled ones
SCALED = f"""a as materialized {APP}, f as materialized {FILLED},
z as materialized (select {KEY}, TARGET as y, {', '.join(f"({c} - (select avg({c}) from f where TARGET is not null)) / (select stddev_pop({c}) from f where TARGET is not null) as x{i}" for i, c in enumerate(FEATURES))},
  case when TARGET is not null then (row_number() over (partition by TARGET order by {_dealt_sql(KEY, 42)}, {KEY}) - 1) % 5 end as fold from f)"""
XS = ", ".join(f"x{i}" for i in range(D))


def _weighted(cond: str = "y = 1", w0: str = "w0", w1: str = "w1") -> str:
    return f"case when {cond} then {w1} else {w0} end"


def _linear(bias: str = f"b{D}") -> str:
    return " + ".join([f"b{i} * x{i}" for i in range(D)] + [bias])


def _single_sql(w0: float, w1: float) -> str:
    rows = f"select 0 as g, y, {_weighted(w0=f'{w0}::double', w1=f'{w1}::double')} as w, 1.0::double as c, {XS}, 1.0::double as x{D} from z where y is not null"
    return f"with {SCALED}, {newton_ctes(rows, D, 'fit')}"


LISTED = " union all ".join(f"select '{c}' as feature, abs(b{i}) as importance from fit" for i, c in enumerate(FEATURES))


@query(f"{_single_sql(0.525, 5.25)} {LISTED}", rnd="importance")
def weighted_logistic_regression(t):
    train, _ = prepared(t)
    fit, = W.fit_together(train, [W.Candidate(1.0, (0.525, 5.25))])
    return importance_table(t, fit, D)


GRID_SQL = ", ".join(f"({i}, {c}::double, {w0}::double, {w1}::double)" for i, (c, (w0, w1)) in enumerate((c, w) for c in M.GRID_C for w in M.GRID_WEIGHTS))


def _grid_sql() -> str:
    rows = f"""select i * 5 + held as g, y, {_weighted()} as w, c, {XS}, 1.0::double as x{D} from z, (values {GRID_SQL}) k(i, c, w0, w1), range(5) h(held)
  where y is not null and fold <> held"""
    scores = f"select g, y, {_linear()} as score from z join fit on fold = g % 5 where y is not null"
    return f"""with {SCALED}, {newton_ctes(rows, D, 'fit')},
per_fold as ({auc_sql(scores, 'g')})
select c, w0 as weight_0, w1 as weight_1, avg(auc) as auc from per_fold join (values {GRID_SQL}) k(i, c, w0, w1) on i = g // 5 group by all"""


@query(_grid_sql(), rnd="auc")
def grid_search_cv(t):
    train, _ = prepared(t)
    rows = [(x.params["c"], *x.params["weights"], x.auc) for x in M.grid_search(train)]
    return t.spark.createDataFrame(rows, "c double, weight_0 double, weight_1 double, auc double")


DRAWN = ", ".join(f"({i}, {c.c!r}::double, {c.tol!r}::double, {c.max_iter}, {c.weights[0]!r}::double, {c.weights[1]!r}::double, {float(c.intercept)}::double)"
                  for i, c in enumerate(M.random_candidates()))
DRAWN = f"(values {DRAWN}) k(i, c, tol, max_iter, w0, w1, one)"


def _drawn_ctes(where: str, name: str, chosen: str = "", source: str = "z") -> str:
    rows = f"select i as g, y, {_weighted()} as w, c, {XS}, one as x{D} from {source}, {DRAWN} where y is not null and {where}{chosen}"
    return newton_ctes(rows, D, name)


@query(f"""with {SCALED}, {_drawn_ctes('fold <> 0', 'fit')}, judged as ({auc_sql(f'select g, y, {_linear()} as score from z, fit where y is not null and fold = 0', 'g')})
select c, tol, cast(max_iter as integer) as max_iter, auc from judged join {DRAWN} on i = g""", rnd="auc")
def random_search(t):
    train, _ = prepared(t)
    rows = [(x.params["c"], x.params["tol"], x.params["max_iter"], x.auc) for x in M.random_search(train)]
    return t.spark.createDataFrame(rows, "c double, tol double, max_iter int, auc double")


AUC_SCORE = "0.5 * coalesce(EXT_SOURCE_2, 0) + 0.25 * coalesce(EXT_SOURCE_3, 0)"


@query(f"""with s as (select TARGET, {AUC_SCORE} as score from {APP} where TARGET is not null),
k as (select TARGET, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2::double as rk from s)
select (sum(case when TARGET = 1 then rk end) - sum(TARGET) * (sum(TARGET) + 1) / 2::double) / (sum(TARGET)::double * sum(1 - TARGET)) as auc from k""", rnd="auc")
def roc_auc(t):
    train, _ = M.split_by_label(t("application"))
    scored = train.withColumn("score", F.lit(0.5) * F.coalesce("EXT_SOURCE_2", F.lit(0.0)) + F.lit(0.25) * F.coalesce("EXT_SOURCE_3", F.lit(0.0)))
    return M.auc(scored)


@query(f"{_single_sql(0.525, 5.25)} select {KEY}, 1 / (1 + exp(-({_linear()}))) as score from z, fit", keys=KEY)
def score_probability(t):
    train, test = prepared(t)
    fit, = W.fit_together(train, [W.Candidate(1.0, (0.525, 5.25))])
    return W.with_scores(train.drop("fold").unionByName(test), [fit], ["score"]).select(KEY, "score")


@query(f"select {KEY}, case when {_dealt_sql(KEY, 0)} % 100 < 75 then 1 else 0 end as is_train from {APP}")
def train_valid_split(t):
    return M.train_valid_split(model_table(t), KEY, seed=0).select(KEY, "is_train")


@query(f"""select {KEY}, TARGET, cast((row_number() over (partition by TARGET order by {_dealt_sql(KEY, 42)}, {KEY}) - 1) % 5 as integer) as fold
from {APP} where TARGET is not null""")
def stratified_kfold(t):
    train, _ = M.split_by_label(model_table(t))
    return M.stratified_folds(train, KEY).select(KEY, "TARGET", "fold")


@query()
def drop_zero_importance(t):
    train, _ = M.split_by_label(model_table(t))
    importance = M.zero_importance(M.mean_impute(train, M.train_means(train, FEATURES)), FEATURES, KEY)
    return t.spark.createDataFrame(list(importance.items()), "feature string, importance double")


@query()
def iterative_importance_selection(t):
    train, _ = M.split_by_label(model_table(t))
    chosen = M.iterative_select(M.mean_impute(train, M.train_means(train, FEATURES)), FEATURES, KEY)
    return t.spark.createDataFrame([(c,) for c in chosen], "feature string")


NUMERIC = [c for c in COLUMNS["application"]["int"] if c != "TARGET"] + COLUMNS["application"]["num"]


def _vif_sql(cols: list[str]) -> str:
    """Sweeps of the gram matrix, written out: one for each column, of cells (i, j, v)."""
    filled = ", ".join(f"coalesce({c}::double, (select avg({c}) from a)) as x{i}" for i, c in enumerate(cols))
    sums = ", ".join(f"sum(x{i} * x{j}) as s{i}_{j}" for i in range(len(cols)) for j in range(i, len(cols)))
    cells = ", ".join(f"{{'i': {i}, 'j': {j}, 'v': s{min(i, j)}_{max(i, j)}}}" for i in range(len(cols)) for j in range(len(cols)))
    sweep = """
m{q} as materialized (
  select i, j, case when not p.v >= 1e-9 then m.v when i = {k} and j = {k} then -1 / p.v when i = {k} or j = {k} then m.v / p.v else m.v - l.v * r.v / p.v end as v
  from m{k} m, (select v from m{k} where i = {k} and j = {k}) p, (select i as li, v from m{k} where j = {k}) l, (select j as rj, v from m{k} where i = {k}) r
  where li = i and rj = j)"""
    return f"""with a as materialized (select * from {APP} where TARGET is not null), x as materialized (select {filled} from a),
g as materialized (select unnest([{cells}]) as c from (select {sums} from x)),
c0 as materialized (select c.i as i, c.j as j, c.v as v from g), size as (select i, case when v > 0 then sqrt(v) else 1 end as s from c0 where i = j),
m0 as materialized (select c0.i, c0.j, v / (a.s * b.s) as v from c0 join size a on a.i = c0.i join size b on b.i = c0.j),
{','.join(sweep.format(k=k, q=k + 1) for k in range(len(cols)))},
names as (select unnest({cols}) as feature, unnest(range({len(cols)})) as i)
select feature, case when v < -0.5 then -v end as vif from names join (select i, v from m{len(cols)} where i = j) using (i)"""


def filled_numbers(t: Tables):
    train, _ = M.split_by_label(t("application").select("TARGET", *NUMERIC))
    return M.mean_impute(train, M.train_means(train, NUMERIC))


@query(f"select feature from ({_vif_sql(NUMERIC)}) where vif < 10")
def vif_filter(t):
    """The numeric applicant columns whose factor stays below 10."""
    return t.spark.createDataFrame([(c,) for c in M.vif_filter(filled_numbers(t), NUMERIC)], "feature string")


def vif_table(t: Tables, cols: list[str]):
    """Factors, missing where infinite."""
    factors = M.vif(filled_numbers(t), cols)
    return t.spark.createDataFrame([(c, None if v == float("inf") else v) for c, v in factors.items()], "feature string, vif double")


@query(_vif_sql(NUMERIC), rnd="vif")
def vif_report(t):
    """The factors of all numeric applicant columns, written as a report and read again."""
    path = io.write_report(vif_table(t, NUMERIC), t.scratch())
    return t.spark.read.schema("feature string, vif double").csv(path, header=True)


@query(_vif_sql(NUMERIC), rnd="vif")
def vif_filter_wide(t):
    return vif_table(t, NUMERIC)


@query()
def vif_eliminate(t):
    """What is left when the numeric applicant column with the largest factor goes, until all are below 10."""
    return t.spark.createDataFrame([(c,) for c in M.vif_eliminate(filled_numbers(t), NUMERIC)], "feature string")


MI_FEATURES = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_GOODS_PRICE", "EXT_SOURCE_2"]


@query(f"with a as (select * from {APP} where TARGET is not null), " + ", ".join(
    f"m{i} as (select bin, TARGET, count(*)::double as n from (select TARGET, floor((rank() over (order by {c}) - 1) * 10 / (count(*) over ())) as bin "
    f"from a where {c} is not null) group by 1, 2)" for i, c in enumerate(MI_FEATURES)) + " select * from ("
    + " union all ".join(
    f"select '{c}' as feature, sum(n / t * ln(n * t / (bn * cn))) as mutual_information from (select n, sum(n) over () as t, "
    f"sum(n) over (partition by bin) as bn, sum(n) over (partition by TARGET) as cn from m{i})" for i, c in enumerate(MI_FEATURES))
    + ") order by mutual_information desc, feature limit 3", rnd="mutual_information")
def mutual_info_k_best(t):
    train, _ = M.split_by_label(t("application").select("TARGET", *MI_FEATURES))
    return M.mutual_info_top(train, MI_FEATURES)


def _neighbours_sql(k: int) -> str:
    """Distances from sorted rows, ranges by inequality join, psi(m) as a sum of 1/i."""
    near = ", ".join(f"abs(value - {f}(value, {j}) over w)" for j in range(1, k + 1) for f in ("lag", "lead"))
    return f"""
with a as (select TARGET, {', '.join(f'cast({c} as double) as {c}' for c in NUMERIC)} from {APP} where TARGET is not null),
l as (unpivot a on {', '.join(NUMERIC)} into name feature value value),
s as (select feature, TARGET as c, value, count(*) over (partition by feature, TARGET) as size, [{near}] as away from l
  window w as (partition by feature, TARGET order by value)),
d as materialized (select feature, c, value, size, least({k}, size - 1) as k, list_sort(list_filter(away, lambda x: x is not null))[least({k}, size - 1)] as r,
  count(*) as cnt from s where size > 1 group by all),
p as materialized (select feature, value, sum(cnt) as n from d group by 1, 2),
m as (
  select d.feature, d.c, d.value, sum(p.n) as m from d join p on p.feature = d.feature and p.value > d.value - r and p.value < d.value + r where r > 0 group by 1, 2, 3
  union all select d.feature, d.c, d.value, p.n from d join p on p.feature = d.feature and p.value = d.value where r = 0),
psi as materialized (select range as i, coalesce(sum(1 / range::double) over (order by range rows between unbounded preceding and 1 preceding), 0) - 0.57721566490153286 as v
  from range(1, (select count(*) + 2 from a))),
f as (select feature, sum(cnt) as n, sum(cnt * (pk.v - ps.v - pm.v)) as s from d join m using (feature, c, value)
  join psi pk on pk.i = d.k join psi ps on ps.i = d.size join psi pm on pm.i = m.m group by 1)
select f.feature, greatest(0, v + s / n) as mutual_information from f join psi on psi.i = n"""


@query(_neighbours_sql(3), rnd="mutual_information")
def mutual_information_neighbours(t):
    return N.mutual_information_neighbours(t("application"), NUMERIC)


@query(f"select * from ({_neighbours_sql(3)}) order by mutual_information desc, feature limit {int(0.75 * len(NUMERIC))}", rnd="mutual_information")
def neighbours_k_best(t):
    return N.neighbours_k_best(t("application"), NUMERIC)


@query(f"{_single_sql(1.0, 1.0)} select * from ({LISTED}) order by importance desc, feature limit 5", rnd="importance")
def coefficient_importance(t):
    train, _ = prepared(t)
    fit, = W.fit_together(train, [W.Candidate()])
    return importance_table(t, fit, 5)


@query(f"select TARGET::double as TARGET, count(*) as rows, count(*) / (select count(TARGET)::double from {APP}) as share from {APP} where TARGET is not null group by 1", rnd="TARGET share")
def class_balance(t):
    return M.class_balance(t("application"))


def _scored_sql() -> str:
    """Binned information picks the features (others are 0 in every fit), fold 0 the candidate, all rows the coefficients."""
    cells = ", ".join(f"""mi{i} as (select '{c}' as feature, sum(n / t * ln(n * t / (bn * cn))) as mi from (
  select n, sum(n) over () as t, sum(n) over (partition by bin) as bn, sum(n) over (partition by y) as cn from (
    select bin, y, count(*)::double as n from (select y, floor((rank() over (order by x{i}) - 1) * 10 / (count(*) over ())) as bin from z where y is not null) group by 1, 2)))"""
                      for i, c in enumerate(FEATURES))
    top = " union all ".join(f"select * from mi{i}" for i in range(D))
    picked = ", ".join(f"x{i} * (select count(*) from top where feature = '{c}') as x{i}" for i, c in enumerate(FEATURES))
    return f"""with {SCALED}, {cells}, top as materialized (select * from ({top}) order by mi desc, feature limit {int(0.75 * D)}),
v as materialized (select {KEY}, y, fold, {picked} from z),
{_drawn_ctes('fold <> 0', 'fit', source='v')}, judged as ({auc_sql(f'select g, y, {_linear()} as score from v, fit where y is not null and fold = 0', 'g')}),
best as materialized (select g from judged order by auc desc, g limit 1),
{_drawn_ctes('true', 'last', ' and i = (select g from best)', 'v')}
select {KEY}, 1 / (1 + exp(-({_linear()}))) as TARGET from v, last where y is null"""


@query(_scored_sql(), rnd="TARGET")
def train_and_score(t):
    return run_training(model_table(t), select="mutual_information", search="random").scores


def master_table(t: Tables):
    """The merged table of all blocks, written once, with the names of its numeric feature columns."""
    df = M.durable(inf_to_null(sanitize_names(applicants.master_feature_table({n: t(n) for n in MASTER_TABLES}, tiebreak=TIE))))
    return df, [c for c in select_by_dtype(df, "numeric") if c not in (KEY, "TARGET")]


@query()
def train_and_score_master(t):
    """Selection by variance inflation over every numeric column of the merged table, then search, fit and scores."""
    df, cols = master_table(t)
    return run_training(df.select(KEY, "TARGET", *cols), select="vif_eliminate", search="grid").scores


# ------------------------------------------------------------------ user functions
@query("select o_custkey, max(o_totalprice) - min(o_totalprice) as spread, count(*)::double as orders from orders group by 1", rnd="spread")
def grouped_map_apply(t):
    def describe(pdf: pd.DataFrame) -> dict:
        return {"spread": pdf["o_totalprice"].max() - pdf["o_totalprice"].min(), "orders": float(len(pdf))}

    return U.grouped_map(t("orders").select("o_custkey", "o_totalprice"), "o_custkey", describe,
                         "o_custkey long, spread double, orders double")


@query("""with d as (select o_orderpriority, cast(substr(cast(cast(floor(o_totalprice) as bigint) as varchar), 1, 1) as bigint) as digit from orders),
n as (select o_orderpriority, digit, count(*) as n from d group by 1, 2)
select o_orderpriority, arg_min(digit, {'n': -n, 'd': digit}) as digit, max(n) as orders from n group by 1""")
def grouped_reduce_digits(t):
    """The most frequent leading digit of each priority's prices, from mergeable counts of digits."""
    digits = [f"d{i}" for i in range(10)]

    def partial(pdf: pd.DataFrame) -> dict:
        first = pdf["o_totalprice"].floordiv(1).astype("int64").astype(str).str[0].astype(int)
        counts = first.value_counts()
        return {d: int(counts.get(i, 0)) for i, d in enumerate(digits)}

    def merge(states: pd.DataFrame) -> dict:
        return states[digits].sum().to_dict()

    def finish(state: dict) -> dict:
        best = max(range(10), key=lambda i: (state[digits[i]], -i))
        return {"digit": best, "orders": state[digits[best]]}

    return U.grouped_reduce(t("orders").select("o_orderpriority", "o_totalprice"), "o_orderpriority", partial, merge, finish,
                            ", ".join(f"{d} bigint" for d in digits), "digit bigint, orders bigint")


@query("""select user_id, event_id, sum(value) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as total
from events""", rnd="total")
def grouped_transform(t):
    return U.grouped_transform(t("events").select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "value", "total",
                               lambda s: s.cumsum()).select("user_id", "event_id", "total")


@query("""select user_id, event_id, sum(value) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as total
from events""", rnd="total")
def grouped_scan_total(t):
    """The running total again, from runs of rows and their sums."""
    def step(before: dict | None, rows: pd.DataFrame) -> pd.Series:
        return rows["value"].cumsum() + (before["s"] if before else 0.0)

    return U.grouped_scan(t("events").select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "total",
                          lambda rows: {"s": rows["value"].sum()}, lambda a, b: {"s": a["s"] + b["s"]}, step, "s double").select("user_id", "event_id", "total")


@query("select o_orderkey, case when o_totalprice > 200000 then 1 else 0 end::bigint as big from orders")
def scalar_row_function(t):
    big = U.scalar_function(_is_big, "long")
    return t("orders").select("o_orderkey", big("o_totalprice").alias("big"))


def _is_big(values: pd.Series) -> pd.Series:
    return (values > 200000).astype("int64")


@query(f"select o_custkey, {measure('o_totalprice', 'max')} - {measure('o_totalprice', 'min')} as spread from orders group by 1", rnd="spread")
def custom_group_aggregate(t):
    spread = U.group_aggregate(_spread)
    return t("orders").groupBy("o_custkey").agg(spread("o_totalprice").alias("spread"))


def _spread(values: pd.Series) -> float:
    return float(values.max() - values.min())



@query(f"""select TARGET::double as TARGET, f::double as fold, (n - f + 4) // 5 as n_rows from
(select TARGET, count(*) as n from {APP} where TARGET is not null group by 1), (select unnest([0, 1, 2, 3, 4]) as f)""", rnd="TARGET fold")
def stratified_kfold_balance(t):
    train, _ = M.split_by_label(model_table(t))
    return M.stratified_folds(train, KEY).groupBy("TARGET", "fold").agg(F.count(F.lit(1)).alias("n_rows"))
