"""Joins, aggregations, ordered sequences, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.preset_sql import (BALANCE, NEWEST_FIRST, block, div, ewma_columns, flag, installment_rows, measure,
                                trend)
from catalog.registry import S, query
from ledgerloom.operators import aggspec as A
from ledgerloom.operators import monthly as Y
from ledgerloom.operators import relations as R
from ledgerloom.operators import sequences as Q
from ledgerloom.plans import history as H
from ledgerloom.plans import specs
from ledgerloom.plans.applicants import duration_group_features

ORDERS = {"o_totalprice": ["min", "max", "mean", "sum", "var", "count"], "o_orderkey": ["nunique", "size"]}
ORDERS_SQL = f"select o_custkey, {block('', ORDERS)} from orders group by o_custkey"
WEEKDAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]

# ------------------------------------------------------------------------- joins


@query(f"""with a as (select SK_ID_CURR, AMT_CREDIT from {S('application')}),
b as (select SK_ID_CURR, {block('B_', {'AMT_CREDIT_SUM': ['sum', 'max']})} from {S('bureau')} group by 1),
p as (select SK_ID_CURR, {block('P_', {'AMT_CREDIT': ['mean']})} from {S('previous_application')} group by 1),
i as (select SK_ID_CURR, {block('I_', {'AMT_PAYMENT': ['sum']})} from {S('installments_payments')} group by 1),
c as (select SK_ID_CURR, {block('C_', {'AMT_BALANCE': ['max']})} from {S('credit_card_balance')} group by 1)
select a.*, b.* exclude (SK_ID_CURR), p.* exclude (SK_ID_CURR), i.* exclude (SK_ID_CURR), c.* exclude (SK_ID_CURR) from a
left join b on a.SK_ID_CURR = b.SK_ID_CURR left join p on a.SK_ID_CURR = p.SK_ID_CURR
left join i on a.SK_ID_CURR = i.SK_ID_CURR left join c on a.SK_ID_CURR = c.SK_ID_CURR""", keys="SK_ID_CURR")
def left_join_feature_blocks(t):
    key = "SK_ID_CURR"
    return R.star_left_join(t("application").select(key, "AMT_CREDIT"), [
        A.group_agg(t("bureau"), {"AMT_CREDIT_SUM": ["sum", "max"]}, key, "B_"),
        A.group_agg(t("previous_application"), {"AMT_CREDIT": ["mean"]}, key, "P_"),
        A.group_agg(t("installments_payments"), {"AMT_PAYMENT": ["sum"]}, key, "I_"),
        A.group_agg(t("credit_card_balance"), {"AMT_BALANCE": ["max"]}, key, "C_"),
    ], key)


@query(f"""with b as ({BALANCE}) select l.SK_ID_BUREAU, l.SK_ID_CURR, b.* exclude (SK_ID_BUREAU) from {S('bureau')} l
left join b on l.SK_ID_BUREAU = b.SK_ID_BUREAU""", keys="SK_ID_BUREAU SK_ID_CURR")
def left_join_child_summary(t):
    return t("bureau").select("SK_ID_BUREAU", "SK_ID_CURR").join(
        H.balance_history_summary(t("bureau_balance")), "SK_ID_BUREAU", "left")


STATS = {"G_MEAN": ("AMT_CREDIT_SUM", "mean"), "G_MEDIAN": ("AMT_CREDIT_SUM", "median"),
         "G_STD": ("AMT_CREDIT_SUM", "std"), "G_SUM": ("AMT_CREDIT_SUM", "sum")}


@query(f"""with b as {S('bureau')}, g as (select CREDIT_TYPE, CREDIT_ACTIVE, {', '.join(f'{measure(c, fn)} as {o}' for o, (c, fn) in STATS.items())}
  from b group by 1, 2)
select b.SK_ID_BUREAU, g.* exclude (CREDIT_TYPE, CREDIT_ACTIVE) from b left join g on b.CREDIT_TYPE = g.CREDIT_TYPE
  and b.CREDIT_ACTIVE = g.CREDIT_ACTIVE""", keys="SK_ID_BUREAU")
def group_stat_join_back(t):
    return Q.group_stats(t("bureau"), ["CREDIT_TYPE", "CREDIT_ACTIVE"], STATS).select("SK_ID_BUREAU", *STATS)


# two of the columns are sums that only the applicant preset makes; raw columns stand for them here
INTER_KEYS = specs.INTERACTION_KEYS
INTER_SPEC = {c.replace("APARTMENTS_SUM", "APARTMENTS"): fns for c, fns in specs.INTERACTION_SPEC.items()}


def _interaction_sql() -> str:
    names, joins, ctes = [], [], []
    for i, keys in enumerate(INTER_KEYS):
        outs = {f"{c}_{fn.upper()}_AGG_{'_'.join(keys)}": (c, fn) for c, fns in INTER_SPEC.items() for fn in fns}
        ctes.append(f"g{i} as (select {', '.join(keys)}, {', '.join(f'{measure(c, fn)} as {o}' for o, (c, fn) in outs.items())} "
                    f"from a group by {', '.join(keys)})")
        joins.append(f"left join g{i} on " + " and ".join(f"a.{k} = g{i}.{k}" for k in keys))
        names += list(outs)
    return f"with a as {S('application')}, {', '.join(ctes)} select a.SK_ID_CURR, {', '.join(names)} from a {' '.join(joins)}"


@query(_interaction_sql(), keys="SK_ID_CURR")
def categorical_interaction_stats(t):
    out = Q.interaction_stats(t("application"), INTER_KEYS, INTER_SPEC)
    return out.select("SK_ID_CURR", *[o for _, stats in Q.interaction_spec(INTER_KEYS, INTER_SPEC) for o in stats])


# texts that both engines read; the three columns of other tables are aggregated from them
CTAR = {c: c for c in ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_REGISTRATION", "DAYS_EMPLOYED", "DAYS_BIRTH",
                       "BUREAU_ACTIVE_DAYS_CREDIT_MEAN", "APPROVED_CNT_PAYMENT_MEAN", "INS_DAYS_ENTRY_PAYMENT_MAX")} | {
    "EXT_SOURCES_PROD": "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3", "EXT_SOURCES_MEAN": "(EXT_SOURCE_1 + EXT_SOURCE_2 + EXT_SOURCE_3) / 3",
    "CREDIT_TO_GOODS_RATIO": div("AMT_CREDIT", "AMT_GOODS_PRICE"), "EMPLOYED_TO_BIRTH_RATIO": div("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "CREDIT_TO_ANNUITY_RATIO": div("AMT_CREDIT", "AMT_ANNUITY")}
CTAR_STATS = {f"CTAR_{c}_{fn.upper()}": (c, fn) for c in specs.DURATION_GROUP_FEATURES for fn in ("mean", "median", "std")}
CTAR_PARTS = {"bureau": "avg(case when CREDIT_ACTIVE = 'Active' then cast(DAYS_CREDIT as double) end) as BUREAU_ACTIVE_DAYS_CREDIT_MEAN",
              "previous_application": "avg(case when NAME_CONTRACT_STATUS = 'Approved' then CNT_PAYMENT end) as APPROVED_CNT_PAYMENT_MEAN",
              "installments_payments": "max(DAYS_ENTRY_PAYMENT) as INS_DAYS_ENTRY_PAYMENT_MAX"}


@query(f"""with w as (select * from {S('application')} {' '.join(f'left join (select SK_ID_CURR, {out} from {S(name)} group by 1) using (SK_ID_CURR)' for name, out in CTAR_PARTS.items())}),
a as (select SK_ID_CURR, {', '.join(f'{text} as {c}' for c, text in CTAR.items())} from w),
g as (select CREDIT_TO_ANNUITY_RATIO, {', '.join(f'{measure(c, fn)} as {o}' for o, (c, fn) in CTAR_STATS.items())} from a group by 1)
select SK_ID_CURR, {', '.join(CTAR_STATS)} from a left join g on a.CREDIT_TO_ANNUITY_RATIO = g.CREDIT_TO_ANNUITY_RATIO""", keys="SK_ID_CURR")
def numeric_group_stats(t):
    df = t("application")
    for name, out in CTAR_PARTS.items():
        df = df.join(t(name).groupBy("SK_ID_CURR").agg(F.expr(out)), "SK_ID_CURR", "left")
    df = df.select("SK_ID_CURR", *[F.expr(text).alias(c) for c, text in CTAR.items()])
    return duration_group_features(df).select("SK_ID_CURR", *CTAR_STATS)


@query(f"""with a as {S('application')}, g as (select ORGANIZATION_TYPE, median(AMT_INCOME_TOTAL) as NEW_INC_BY_ORG from a group by 1)
select a.SK_ID_CURR, NEW_INC_BY_ORG from a left join g on a.ORGANIZATION_TYPE = g.ORGANIZATION_TYPE""", rnd="NEW_INC_BY_ORG")
def lookup_map(t):
    return Q.lookup_map(t("application"), "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL", "median", "NEW_INC_BY_ORG").select(
        "SK_ID_CURR", "NEW_INC_BY_ORG")


@query(f"""with i as {S('installments_payments')} select SK_ID_PREV, NUM_INSTALMENT_NUMBER, AMT_INSTALMENT from i
where SK_ID_PREV in (select SK_ID_PREV from i where DAYS_INSTALMENT >= -360)""")
def semi_join_recent_entities(t):
    return Q.recent_entities(t("installments_payments"), "SK_ID_PREV", "DAYS_INSTALMENT", -360).select(
        "SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "AMT_INSTALMENT")


@query(f"""select SK_ID_PREV, NUM_INSTALMENT_NUMBER, AMT_INSTALMENT from {S('installments_payments')}
where SK_ID_PREV in (select SK_ID_PREV from {S('previous_application')} where NAME_CONTRACT_STATUS = 'Refused')""")
def semi_join_ids(t):
    refused = t("previous_application").where(F.col("NAME_CONTRACT_STATUS") == "Refused")
    return R.semi_join_ids(t("installments_payments"), refused, "SK_ID_PREV").select(
        "SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "AMT_INSTALMENT")


@query(f"""with l as (select SK_ID_CURR, TARGET from {S('application_train')}),
b as (select SK_ID_BUREAU, SK_ID_CURR from {S('bureau')}), m as {S('bureau_balance')}
select l.SK_ID_CURR, cast(l.TARGET as double) as TARGET, b.SK_ID_BUREAU, m.STATUS from l left join b on l.SK_ID_CURR = b.SK_ID_CURR
left join m on b.SK_ID_BUREAU = m.SK_ID_BUREAU""", rnd="TARGET SK_ID_BUREAU")
def label_enrichment(t):
    first = R.enrich_with_label(t("application_train"), t("bureau").select("SK_ID_BUREAU", "SK_ID_CURR"), "SK_ID_CURR")
    return first.join(t("bureau_balance").select("SK_ID_BUREAU", "STATUS"), "SK_ID_BUREAU", "left").select(
        "SK_ID_CURR", "TARGET", "SK_ID_BUREAU", "STATUS")


# ------------------------------------------------------------------ aggregations
@query(ORDERS_SQL, keys="o_custkey")
def group_agg_spec(t):
    return A.group_agg(t("orders"), ORDERS, "o_custkey")


@query(f"with g as ({ORDERS_SQL}) select c.c_custkey, g.* exclude (o_custkey) from customer c left join g on c.c_custkey = g.o_custkey",
       keys="c_custkey")
def group_agg_and_merge(t):
    orders = t("orders").withColumnRenamed("o_custkey", "c_custkey")
    return A.group_agg_merge(orders, t("customer").select("c_custkey"), ORDERS, "c_custkey")


SEGMENT_SPEC = {"AMT_CREDIT_SUM": ["max", "mean", "sum", "var"], "AMT_CREDIT_SUM_DEBT": ["mean", "count"], "SK_ID_BUREAU": ["size", "nunique"]}
SEGMENTS = {"ALL_": None, "ACTIVE_": "CREDIT_ACTIVE = 'Active'", "CAR_": "CREDIT_TYPE = 'Car loan'", "LAST12M_": "DAYS_CREDIT >= -360"}


@query(f"select SK_ID_CURR, {', '.join(block(p, SEGMENT_SPEC, w) for p, w in SEGMENTS.items())} from {S('bureau')} group by 1", keys="SK_ID_CURR")
def segmented_agg(t):
    return A.segmented_agg(t("bureau"), "SK_ID_CURR", [
        A.Segment(p, SEGMENT_SPEC, None if w is None else F.expr(w)) for p, w in SEGMENTS.items()])


@query(f"select SK_ID_BUREAU, {', '.join(f"avg({flag(f"STATUS = '{v}'")}) as STATUS_{v}" for v in specs.BALANCE_STATUSES)} "
       f"from {S('bureau_balance')} group by 1", keys="SK_ID_BUREAU")
def category_share(t):
    return A.category_share(t("bureau_balance"), "SK_ID_BUREAU", {"STATUS": specs.BALANCE_STATUSES})


@query(f"""select SK_ID_CURR, coalesce(sum(m), 0) as TOTAL_INSTALMENTS, avg(n) as ROWS_PER_LOAN from (
select SK_ID_CURR, SK_ID_PREV, max(CNT_INSTALMENT_MATURE_CUM) as m, count(*) as n from {S('credit_card_balance')} group by 1, 2) group by 1""", keys="SK_ID_CURR")
def two_level_agg(t):
    return A.two_level_agg(t("credit_card_balance"), "SK_ID_CURR", "SK_ID_PREV",
                           [F.max("CNT_INSTALMENT_MATURE_CUM").alias("m"), F.count(F.lit(1)).alias("n")],
                           [F.coalesce(F.sum("m"), F.lit(0.0)).alias("TOTAL_INSTALMENTS"), F.avg("n").alias("ROWS_PER_LOAN")])


@query(f"select SK_ID_CURR, count(distinct STATUS_) as STATUSES, count(distinct SK_ID_BUREAU) as LOANS from (select *, nullif(CREDIT_ACTIVE, 'Sold') as STATUS_ from {S('bureau')}) group by 1")
def count_distinct(t):
    df = t("bureau").withColumn("STATUS_", F.nullif(F.col("CREDIT_ACTIVE"), F.lit("Sold")))
    out = A.group_agg(df, {"STATUS_": ["nunique"], "SK_ID_BUREAU": ["nunique"]}, "SK_ID_CURR")
    return out.toDF("SK_ID_CURR", "STATUSES", "LOANS")


def _card_ratio_sql() -> str:
    from catalog.preset_sql import card
    return (f"select SK_ID_CURR, INSTALLMENTS_PER_LOAN, DPD_COUNT, PERCENTAGE_MISSED_PAYMENTS, CASH_CARD_RATIO, DRAWINGS_RATIO "
            f"from ({card()})")


@query(_card_ratio_sql(), keys="SK_ID_CURR")
def conditional_ratio_agg(t):
    return H.card_customer_ratios(t("credit_card_balance"))


@query(f"""with b as ({BALANCE}), r as (select l.SK_ID_BUREAU, MONTHS_BALANCE_SIZE, AMT_CREDIT_SUM, AMT_CREDIT_MAX_OVERDUE from {S('bureau')} l
left join b on l.SK_ID_BUREAU = b.SK_ID_BUREAU),
g as (select MONTHS_BALANCE_SIZE, avg(AMT_CREDIT_SUM) as LL_AMT_CREDIT_SUM, avg(AMT_CREDIT_MAX_OVERDUE) as LL_AMT_CREDIT_MAX_OVERDUE from r group by 1)
select SK_ID_BUREAU, LL_AMT_CREDIT_SUM, LL_AMT_CREDIT_MAX_OVERDUE from r left join g on r.MONTHS_BALANCE_SIZE = g.MONTHS_BALANCE_SIZE""", keys="SK_ID_BUREAU")
def duration_cohort_mean(t):
    rows = t("bureau").join(H.balance_history_summary(t("bureau_balance")), "SK_ID_BUREAU", "left")
    out = A.cohort_mean(rows, "MONTHS_BALANCE_SIZE", ["AMT_CREDIT_SUM", "AMT_CREDIT_MAX_OVERDUE"], "LL_")
    return out.select("SK_ID_BUREAU", "LL_AMT_CREDIT_SUM", "LL_AMT_CREDIT_MAX_OVERDUE")


@query(f"""select SK_ID_CURR, first(AMT_CREDIT_MAX_OVERDUE order by DAYS_CREDIT, SK_ID_BUREAU) filter (where AMT_CREDIT_MAX_OVERDUE is not null) as OLDEST,
last(AMT_CREDIT_MAX_OVERDUE order by DAYS_CREDIT, SK_ID_BUREAU) filter (where AMT_CREDIT_MAX_OVERDUE is not null) as NEWEST from {S('bureau')} group by 1""")
def first_last_by_order(t):
    order = [F.col("DAYS_CREDIT"), F.col("SK_ID_BUREAU")]
    value = F.col("AMT_CREDIT_MAX_OVERDUE")
    return t("bureau").groupBy("SK_ID_CURR").agg(A.value_at(value, order, newest=False).alias("OLDEST"),
                                                 A.value_at(value, order).alias("NEWEST"))


@query(f"""select SK_ID_PREV, MONTHS_BALANCE, AMT_BALANCE from (select *, row_number() over (partition by SK_ID_PREV
order by MONTHS_BALANCE desc, ROW_ID desc) as k from {S('credit_card_balance')}) where k = 1""")
def latest_row_per_group(t):
    return A.latest_row(t("credit_card_balance").select("SK_ID_PREV", "MONTHS_BALANCE", "ROW_ID", "AMT_BALANCE"), "SK_ID_PREV",
                        ["MONTHS_BALANCE", "ROW_ID"]).select("SK_ID_PREV", "MONTHS_BALANCE", "AMT_BALANCE")


COMPLETION = ["POS_LOAN_COMPLETED_MEAN", "POS_COMPLETED_BEFORE_MEAN", "POS_REMAINING_INSTALMENTS", "POS_REMAINING_INSTALMENTS_RATIO"]


def _pos_part(cols) -> str:
    from catalog.preset_sql import pos
    return f"select SK_ID_CURR, {', '.join(cols)} from ({pos()})"


@query(_pos_part(COMPLETION), keys="SK_ID_CURR")
def loan_completion_metrics(t):
    return H.loan_completion_metrics(t("POS_CASH_balance").withColumn("MONTH", F.col("MONTHS_BALANCE")), ["ROW_ID"])


MOMENTS = {"l_extendedprice": ["std", "skew", "kurt", "iqr", "median"], "l_quantity": ["skew", "kurt", "median"]}


def _moment_sql(c: str) -> str:
    centred = f"(sum(power({c} - {c}_mu, 3)) / count(*)) / nullif(power(sum(power({c} - {c}_mu, 2)) / count(*), 1.5), 0)"
    kurt = f"(sum(power({c} - {c}_mu, 4)) / count(*)) / nullif(power(sum(power({c} - {c}_mu, 2)) / count(*), 2), 0) - 3"
    return f"{centred} as {c}_SKEW, {kurt} as {c}_KURT, median({c}) as {c}_MEDIAN"


@query(f"""select l_suppkey, stddev_samp(l_extendedprice) as l_extendedprice_STD, {_moment_sql('l_extendedprice')},
quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) as l_extendedprice_IQR, {_moment_sql('l_quantity')}
from (select *, avg(l_extendedprice) over (partition by l_suppkey) as l_extendedprice_mu,
avg(l_quantity) over (partition by l_suppkey) as l_quantity_mu from lineitem) group by l_suppkey""", keys="l_suppkey")
def higher_moment_agg(t):
    return A.group_agg(t("lineitem"), MOMENTS, "l_suppkey")


@query("select o_custkey, skewness(o_totalprice) as o_totalprice_SKEW_UNBIASED from orders group by o_custkey", rnd="o_totalprice_SKEW_UNBIASED")
def unbiased_skew_agg(t):
    return A.group_agg(t("orders"), {"o_totalprice": ["skew_unbiased"]}, "o_custkey")


@query(f"select ORGANIZATION_TYPE, median(AMT_INCOME_TOTAL) as AMT_INCOME_TOTAL_MEDIAN from {S('application')} where ORGANIZATION_TYPE is not null group by 1")
def exact_median_by_group(t):
    return A.group_agg(t("application"), {"AMT_INCOME_TOTAL": ["median"]}, "ORGANIZATION_TYPE")


@query(f"""with ids as (select SK_ID_PREV, AMT_CREDIT from {S('previous_application')} where NAME_CONTRACT_STATUS = 'Approved' and DAYS_LAST_DUE = 365243)
select i.SK_ID_PREV, coalesce(sum(AMT_INSTALMENT), 0) - coalesce(sum(AMT_PAYMENT), 0) as INSTALMENT_PAYMENT_DIFF,
coalesce(sum(AMT_PAYMENT), 0) / nullif(max(ids.AMT_CREDIT), 0) as REPAYMENT_RATIO
from {S('installments_payments')} i join ids on i.SK_ID_PREV = ids.SK_ID_PREV group by 1""", keys="SK_ID_PREV")
def sum_by_entity(t):
    from ledgerloom.functions import safe_div
    active = H.previous_rows(t("previous_application")).where(F.col("IS_ACTIVE") == 1)
    sums = A.sum_by_entity(t("installments_payments"), active, "SK_ID_PREV", ["AMT_INSTALMENT", "AMT_PAYMENT"])
    return sums.join(active.select("SK_ID_PREV", "AMT_CREDIT"), "SK_ID_PREV").select(
        "SK_ID_PREV", (F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT")).alias("INSTALMENT_PAYMENT_DIFF"),
        safe_div("AMT_PAYMENT", "AMT_CREDIT").alias("REPAYMENT_RATIO"))


@query(f"""select SK_ID_CURR, {div('coalesce(sum(AMT_CREDIT_SUM_DEBT), 0)', 'coalesce(sum(AMT_CREDIT_SUM), 0)')} as DEBT_OVER_CREDIT,
{div('coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0)', 'coalesce(sum(AMT_CREDIT_SUM_DEBT), 0)')} as OVERDUE_DEBT_RATIO from {S('bureau')} group by 1""", keys="SK_ID_CURR")
def debt_ratio_after_agg(t):
    return t("bureau").groupBy("SK_ID_CURR").agg(
        A.ratio_of_sums("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM").alias("DEBT_OVER_CREDIT"),
        A.ratio_of_sums("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_DEBT").alias("OVERDUE_DEBT_RATIO"))


@query(f"select CODE_GENDER, NAME_FAMILY_STATUS, avg(TARGET) as TARGET_MEAN, avg(AMT_CREDIT) as AMT_CREDIT_MEAN from {S('application')} group by 1, 2",
       rnd="TARGET_MEAN AMT_CREDIT_MEAN")
def group_mean_or_count_table(t):
    return A.group_table(t("application"), ["CODE_GENDER", "NAME_FAMILY_STATUS"], ["TARGET", "AMT_CREDIT"])


# ------------------------------------------------------------- ordered sequences
EVENTS = "select user_id, event_id, ts, case when event_type = 'error' then null else value end as x, value from events"


@query(f"""with n as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from ({EVENTS}))
select user_id, event_id, {ewma_columns(['x', 'value'], 0.7, 'user_id')} from n""", keys="user_id event_id")
def ewma_by_group(t):
    df = t("events").select("user_id", "event_id", "ts", "value", F.when(F.col("event_type") != "error", F.col("value")).alias("x"))
    return Q.ewma(df, ["x", "value"], 0.7, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "EXP_x", "EXP_value")


@query(f"""with n as (select *, row_number() over (partition by event_type order by ts, event_id) as rn
from (select event_type, event_id, ts, case when event_id % 7 = 3 then null else value end as x from events))
select event_type, event_id, {ewma_columns(['x'], 0.0005, 'event_type')} from n""", keys="event_type event_id")
def ewma_small_alpha(t):
    """Long memory: thousands of rows of each type still weigh in."""
    df = t("events").select("event_type", "event_id", "ts", F.when(F.col("event_id") % 7 != 3, F.col("value")).alias("x"))
    return Q.ewma(df, ["x"], 0.0005, ["event_type"], ["ts", "event_id"]).select("event_type", "event_id", "EXP_x")


INS_ORDER = "NUM_INSTALMENT_NUMBER nulls first, DAYS_ENTRY_PAYMENT nulls first, AMT_INSTALMENT nulls first, AMT_PAYMENT nulls first, NUM_INSTALMENT_VERSION nulls first"


@query(f"""with n as (select *, {div('DAYS_INSTALMENT', 'DAYS_ENTRY_PAYMENT')} as DAYS_PAYMENT_RATIO, DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT as DAYS_PAYMENT_DIFF,
{div('AMT_PAYMENT', 'AMT_INSTALMENT')} as AMT_PAYMENT_RATIO, AMT_INSTALMENT - AMT_PAYMENT as AMT_PAYMENT_DIFF,
row_number() over (partition by SK_ID_CURR, SK_ID_PREV order by {INS_ORDER}, DAYS_INSTALMENT) as rn from {S('installments_payments')})
select SK_ID_PREV, NUM_INSTALMENT_NUMBER, {ewma_columns(['DAYS_PAYMENT_RATIO', 'DAYS_PAYMENT_DIFF', 'AMT_PAYMENT_RATIO', 'AMT_PAYMENT_DIFF'], 0.5, 'SK_ID_CURR, SK_ID_PREV')}
from n""", keys="SK_ID_PREV NUM_INSTALMENT_NUMBER")
def ewma_per_loan(t):
    rows = H.installment_ewma(H.installment_rows(t("installments_payments")))
    return rows.select("SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "EXP_DAYS_PAYMENT_RATIO", "EXP_DAYS_PAYMENT_DIFF",
                       "EXP_AMT_PAYMENT_RATIO", "EXP_AMT_PAYMENT_DIFF")


@query(f"""with n as (select *, row_number() over (partition by SK_ID_CURR, SK_ID_PREV order by MONTHS_BALANCE, ROW_ID) as rn from {S('credit_card_balance')}),
e as (select *, {ewma_columns(['AMT_BALANCE', 'AMT_PAYMENT_CURRENT'], 0.7, 'SK_ID_CURR, SK_ID_PREV')} from n)
select SK_ID_CURR, {block('', {'EXP_AMT_BALANCE': ['last'], 'EXP_AMT_PAYMENT_CURRENT': ['last']}, None, 'MONTHS_BALANCE, ROW_ID, SK_ID_PREV')} from e group by 1""", keys="SK_ID_CURR")
def ewma_last(t):
    return Q.ewma_last(t("credit_card_balance"), ["AMT_BALANCE", "AMT_PAYMENT_CURRENT"], 0.7, ["SK_ID_CURR", "SK_ID_PREV"],
                       ["MONTHS_BALANCE", "ROW_ID"], "SK_ID_CURR")


@query(f"""with n as (select *, row_number() over (partition by SK_ID_CURR order by {NEWEST_FIRST}) - 1 as x from ({installment_rows()}))
select SK_ID_CURR, {', '.join(trend(c, k) for k in specs.TREND_PERIODS for c in ('DPD', 'PAID_OVER_AMOUNT'))} from n group by 1""", keys="SK_ID_CURR")
def last_k_trend(t):
    newest = [F.col("DAYS_INSTALMENT").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in H.INSTALLMENT_ORDER]]
    return Q.last_k_trend(H.installment_rows(t("installments_payments")), "SK_ID_CURR", newest, ["DPD", "PAID_OVER_AMOUNT"],
                          specs.TREND_PERIODS)


@query(f"""with n as (select *, first(SK_ID_PREV) over (partition by SK_ID_CURR order by DAYS_INSTALMENT desc nulls last, SK_ID_PREV
rows between unbounded preceding and unbounded following) as newest_loan from ({installment_rows()}))
select SK_ID_CURR, {block('LAST_LOAN_', specs.LAST_LOAN)} from n where SK_ID_PREV = newest_loan group by 1""", keys="SK_ID_CURR")
def latest_entity_stats(t):
    return Q.latest_entity_stats(H.installment_rows(t("installments_payments")), "SK_ID_CURR", "SK_ID_PREV",
                                 [F.col("DAYS_INSTALMENT"), -F.col("SK_ID_PREV")], specs.LAST_LOAN, "LAST_LOAN_")


@query(_pos_part(["LATE_PAYMENT_SUM"]), keys="SK_ID_CURR")
def last_n_entities_mean(t):
    rows = t("POS_CASH_balance").withColumns({"MONTH": F.col("MONTHS_BALANCE"), "LATE_PAYMENT": F.when(F.col("SK_DPD") > 0, 1).otherwise(0)})
    return H.recent_late_sum(rows)


@query(f"""select SK_ID_PREV, NUM_INSTALMENT_NUMBER, coalesce(sum(AMT_PAYMENT) over (partition by SK_ID_PREV, NUM_INSTALMENT_NUMBER), 0) as AMT_PAYMENT_GROUPED
from {S('installments_payments')}""")
def partition_total(t):
    return Q.partition_total(t("installments_payments"), ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER"], "AMT_PAYMENT", "AMT_PAYMENT_GROUPED").select(
        "SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "AMT_PAYMENT_GROUPED")


@query("""select l_returnflag, l_extendedprice, count(*) as cnt, min(p) / cast(max(n) - 1 as double) as cdf_first, max(p) / cast(max(n) - 1 as double) as cdf_last
from (select l_returnflag, l_extendedprice, row_number() over (partition by l_returnflag order by l_extendedprice) - 1 as p,
count(*) over (partition by l_returnflag) as n from lineitem) group by 1, 2""", rnd="cdf_first cdf_last")
def empirical_cdf(t):
    return Q.empirical_cdf(t("lineitem"), "l_extendedprice", ["l_returnflag"])


# ------------------------------------------------------------ sorts, limits, sets
@query(f"select SK_ID_PREV, MONTHS_BALANCE, ROW_ID from {S('credit_card_balance')} order by SK_ID_PREV, MONTHS_BALANCE desc, ROW_ID")
def multi_key_sort(t):
    return R.sort_by(t("credit_card_balance").select("SK_ID_PREV", "MONTHS_BALANCE", "ROW_ID"), F.asc("SK_ID_PREV"),
                     F.desc("MONTHS_BALANCE"), F.asc("ROW_ID"))


@query(f"select SK_ID_CURR, AMT_CREDIT from {S('application')} order by AMT_CREDIT desc, SK_ID_CURR limit 20")
def top_k_rows(t):
    return R.top_k(t("application").select("SK_ID_CURR", "AMT_CREDIT"), [F.desc("AMT_CREDIT"), F.asc("SK_ID_CURR")], 20)


@query(f"""select SK_ID_CURR, SK_ID_BUREAU, DAYS_CREDIT from (select *, row_number() over (partition by SK_ID_CURR order by DAYS_CREDIT desc, SK_ID_BUREAU desc) as k
from {S('bureau')}) where k <= 3""")
def top_k_per_group(t):
    return A.top_rows_per_group(t("bureau").select("SK_ID_CURR", "SK_ID_BUREAU", "DAYS_CREDIT"), "SK_ID_CURR",
                                [F.desc("DAYS_CREDIT"), F.desc("SK_ID_BUREAU")], 3)


@query(f"""select WEEKDAY_APPR_PROCESS_START, n from (select WEEKDAY_APPR_PROCESS_START, count(*) as n from {S('application')} group by 1)
order by list_position({WEEKDAYS!r}, WEEKDAY_APPR_PROCESS_START)""")
def custom_category_order(t):
    counts = t("application").groupBy("WEEKDAY_APPR_PROCESS_START").agg(F.count(F.lit(1)).alias("n"))
    return R.sort_by(counts, R.by_fixed_order("WEEKDAY_APPR_PROCESS_START", WEEKDAYS))


@query(f"select SK_ID_CURR, cast(TARGET as double) as TARGET, AMT_CREDIT from {S('application')}", rnd="TARGET")
def union_by_name(t):
    return R.stack_tables(t("application_train"), t("application_test")).select("SK_ID_CURR", "TARGET", "AMT_CREDIT")


@query(f"""select (select count(distinct SK_ID_CURR) from {S('application_train')}) as left_keys,
(select count(distinct SK_ID_CURR) from {S('bureau')}) as right_keys,
(select count(*) from (select SK_ID_CURR from {S('application_train')} intersect select SK_ID_CURR from {S('bureau')})) as shared_keys""")
def key_overlap_count(t):
    return R.key_overlap(t("application_train"), t("bureau"), "SK_ID_CURR")


@query(f"select distinct SK_ID_PREV from {S('installments_payments')} where DAYS_INSTALMENT >= -360")
def distinct_values(t):
    return t("installments_payments").where(F.col("DAYS_INSTALMENT") >= -360).select("SK_ID_PREV").distinct()


@query(f"select (select count(*) from {S('bureau_balance')}) - (select count(*) from (select distinct * from {S('bureau_balance')})) as duplicates")
def duplicate_row_count(t):
    return R.duplicate_row_count(t("bureau_balance"))


MONTHLY = {c: ["mean", "sum", "max", "min", "var", "std", "count"] for c in ("AMT_BALANCE", "AMT_PAYMENT_CURRENT", "SK_DPD")} | {"MONTHS_BALANCE": ["size"]}
MONTH_WINDOWS = {f"CC_{m}M_": (-m, None) for m in (6, 12, 24)} | {"CC_YEAR2_": (-24, -13), "CC_ALL_": (None, None)}


def _between(first: int | None, last: int | None) -> str:
    return " and ".join([*([f"MONTHS_BALANCE >= {first}"] if first is not None else []), *([f"MONTHS_BALANCE <= {last}"] if last is not None else [])]) or "true"


@query(f"""select SK_ID_CURR, {', '.join(block(p, MONTHLY, _between(*w)) for p, w in MONTH_WINDOWS.items())} from {S('credit_card_balance')}
where SK_ID_CURR is not null and MONTHS_BALANCE is not null group by 1""", keys="SK_ID_CURR")
def monthly_window_blocks(t):
    """Five windows from stored monthly states; the newest month arrives later and is added without reading the others."""
    rows, path = t("credit_card_balance"), t.scratch()
    newest = rows.agg(F.max("MONTHS_BALANCE")).scalar()
    Y.append_states(Y.monthly_states(rows.where(F.col("MONTHS_BALANCE") < newest), "SK_ID_CURR", "MONTHS_BALANCE", MONTHLY), path, "MONTHS_BALANCE")
    Y.refresh(rows.where(F.col("MONTHS_BALANCE") == newest), path, "SK_ID_CURR", "MONTHS_BALANCE", MONTHLY)
    return Y.window_blocks(Y.stored_states(t.spark, path, "MONTHS_BALANCE"), "SK_ID_CURR", "MONTHS_BALANCE", MONTHLY, MONTH_WINDOWS)
