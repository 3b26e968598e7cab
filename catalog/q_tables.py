"""Scans, sinks, cleaning, row expressions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.preset_sql import applicant_rows, div, flag, installment_rows, previous_rows, row_kurtosis, steps
from catalog.registry import S, query
from ledgerloom import functions as X
from ledgerloom.operators import binning, clean, encode
from ledgerloom.operators.aggspec import group_agg
from ledgerloom.plans import specs
from ledgerloom.plans.applicants import applicant_row_features, clean_applicants, post_join_ratios
from ledgerloom.plans.history import bureau_features, days_past_due_features, installment_features, loan_interest_features, \
    previous_features, previous_rows as previous_row_features
from ledgerloom.sources import io
from ledgerloom.sources.schemas import DOCUMENT_FLAGS, FILES, HOUSING, schema_of

# ------------------------------------------------------------------ scans, sinks


@query(f"select * from {S('bureau')}", rnd="CREDIT_DAY_OVERDUE")
def csv_scan(t):
    path = t.scratch()
    t("bureau").write.mode("overwrite").csv(path, header=True)
    return io.read_table(t.spark, path, "csv", schema_of("bureau")).select(*t("bureau").columns)


@query(f"select SK_ID_BUREAU, SK_ID_CURR, DAYS_CREDIT, AMT_CREDIT_SUM_DEBT, CREDIT_ACTIVE from {S('bureau')}")
def csv_scan_missing_tokens(t):
    """Whole numbers exported with decimals, and three words for a missing value."""
    cols = ["SK_ID_BUREAU", "SK_ID_CURR", "DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT", "CREDIT_ACTIVE"]
    said = {"DAYS_CREDIT": F.concat(F.col("DAYS_CREDIT").cast("string"), F.lit(".0")), "AMT_CREDIT_SUM_DEBT": F.col("AMT_CREDIT_SUM_DEBT").cast("string")}
    path = t.scratch()
    t("bureau").select(*cols).withColumns(said).fillna("NaN", "AMT_CREDIT_SUM_DEBT").fillna("", "DAYS_CREDIT").fillna(
        "NA", "CREDIT_ACTIVE").write.csv(path, header=True)
    wanted = [f for f in schema_of("bureau").fields if f.name in cols]
    return io.read_table(t.spark, path, "csv", T.StructType(wanted)).select(*cols)


@query(f"select * from {S('bureau_balance')}")
def csv_scan_drop_index(t):
    path = t.scratch()
    exported = t("bureau_balance").withColumns({"Unnamed: 0": F.monotonically_increasing_id(), "Unnamed: 0.1": F.lit(0)})
    exported.write.mode("overwrite").csv(path, header=True)
    return io.read_table(t.spark, path, "csv", drop_index=True).withColumn("SK_ID_BUREAU", F.col("SK_ID_BUREAU").cast("long"))


@query(" union all ".join(f"select '{n}' as table_name, count(*) as n_rows from {S(n)}"
                          for n in [k for k in FILES if not k.startswith("application_")] + ["application"]))
def table_catalog(t):
    base = t.scratch()
    for name, file in FILES.items():
        t(name).write.mode("overwrite").parquet(f"{base}/{file}.parquet")
    out = None
    for name, df in io.table_catalog(t.spark, base, "parquet").items():
        part = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"select o_custkey, count(*) as o_totalprice_count, max(o_totalprice) as o_totalprice_max from orders group by o_custkey")
def feature_table_sink(t):
    features = group_agg(t("orders"), {"o_totalprice": ["count", "max"]}, "o_custkey")
    path = io.write_features(features.toDF("o_custkey", "o_totalprice_count", "o_totalprice_max"), t.scratch())
    return t.spark.read.parquet(path)


@query("select o_orderstatus, count(*) as orders from orders group by o_orderstatus")
def stage_checkpoint(t):
    staged = io.stage(t("orders").select("o_orderkey", "o_orderstatus"), t.scratch())
    return staged.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(f"select SK_ID_CURR, EXT_SOURCE_2 as TARGET from {S('application')} where TARGET is null")
def prediction_and_report_sink(t):
    scored = t("application").where(F.col("TARGET").isNull()).withColumn("score", F.col("EXT_SOURCE_2"))
    path = io.write_scores(scored, t.scratch(), "SK_ID_CURR", "score")
    return t.spark.read.schema("SK_ID_CURR long, TARGET double").csv(path, header=True)


# ------------------------------------------------------- projection and cleaning
@query(f"select SK_ID_PREV, {', '.join(f'nullif({c}, 365243) as {c}' for c in specs.PREVIOUS_SENTINEL_DAYS)} "
       f"from {S('previous_application')}")
def sentinel_to_null(t):
    df = t("previous_application").select("SK_ID_PREV", *specs.PREVIOUS_SENTINEL_DAYS)
    return clean.null_sentinels(df, {c: 365243.0 for c in specs.PREVIOUS_SENTINEL_DAYS})


@query(f"""select SK_ID_BUREAU, case when DAYS_CREDIT_ENDDATE >= -18250 then DAYS_CREDIT_ENDDATE end as DAYS_CREDIT_ENDDATE,
  case when DAYS_CREDIT_UPDATE >= -18250 then DAYS_CREDIT_UPDATE end as DAYS_CREDIT_UPDATE,
  case when CREDIT_DAY_OVERDUE <= 30 then CREDIT_DAY_OVERDUE end as CREDIT_DAY_OVERDUE from {S('bureau')}""", rnd="CREDIT_DAY_OVERDUE")
def threshold_to_null(t):
    df = t("bureau").select("SK_ID_BUREAU", "DAYS_CREDIT_ENDDATE", "DAYS_CREDIT_UPDATE", "CREDIT_DAY_OVERDUE")
    return clean.null_outside(df, {"DAYS_CREDIT_ENDDATE": (-18250, None), "DAYS_CREDIT_UPDATE": (-18250, None),
                                   "CREDIT_DAY_OVERDUE": (None, 30)})


@query(f"select SK_ID_CURR, coalesce(OCCUPATION_TYPE, 'XNA') as OCCUPATION_TYPE, "
       f"coalesce(ORGANIZATION_TYPE, 'XNA') as ORGANIZATION_TYPE from {S('application')}")
def fill_categorical(t):
    return clean.fill_categorical(t("application").select("SK_ID_CURR", "OCCUPATION_TYPE", "ORGANIZATION_TYPE"))


@query(f"select SK_ID_CURR, -DAYS_BIRTH / cast(365 as double) as YEARS_BIRTH, abs(DAYS_EMPLOYED) as DAYS_WORKED "
       f"from {S('application')}", rnd="YEARS_BIRTH")
def unit_convert(t):
    return t("application").select("SK_ID_CURR", X.days_to_years("DAYS_BIRTH").alias("YEARS_BIRTH"),
                                   X.absolute("DAYS_EMPLOYED").alias("DAYS_WORKED"))


@query(f"select SK_ID_PREV, AMT_RECIVABLE as AMT_RECEIVABLE from {S('credit_card_balance')}")
def rename_columns(t):
    return clean.rename(t("credit_card_balance").select("SK_ID_PREV", "AMT_RECIVABLE"), {"AMT_RECIVABLE": "AMT_RECEIVABLE"})


@query(f"""select SK_ID_CURR, count(*) filter (where NAME_CONTRACT_TYPE = 'Cash loans') as NAME_CONTRACT_TYPE_Cashloans,
  count(*) filter (where NAME_CONTRACT_TYPE = 'Consumer loans') as NAME_CONTRACT_TYPE_Consumerloans
  from {S('previous_application')} group by 1""")
def sanitize_names(t):
    wide = t("previous_application").groupBy("SK_ID_CURR").pivot("NAME_CONTRACT_TYPE", ["Cash loans", "Consumer loans"]).agg(
        F.count(F.lit(1)))
    named = wide.select("SK_ID_CURR", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(f"NAME_CONTRACT_TYPE_{c}")
                                        for c in wide.columns[1:]])
    return clean.sanitize_names(named)


@query(f"select * exclude ({', '.join(c for c in specs.APPLICANT_DROPS)}) from {S('application')}", rnd="TARGET")
def drop_columns(t):
    return t("application").drop(*specs.APPLICANT_DROPS)


@query(f"select * exclude (AMT_DOWN_PAYMENT, RATE_DOWN_PAYMENT, NAME_TYPE_SUITE) from {S('previous_application')}")
def drop_sparse_columns(t):
    return clean.drop_sparse_columns(t("previous_application"), 0.6)


@query(f"select SK_ID_CURR, {', '.join(DOCUMENT_FLAGS)} from {S('application')}")
def select_by_pattern(t):
    df = t("application")
    return df.select("SK_ID_CURR", *clean.select_like(df, "FLAG_DOC"))


@query(f"select SK_ID_BUREAU, CREDIT_ACTIVE, CREDIT_CURRENCY, CREDIT_TYPE from {S('bureau')}")
def select_by_dtype(t):
    df = t("bureau")
    return df.select("SK_ID_BUREAU", *clean.select_by_dtype(df, "string"))


@query(f"select SK_ID_CURR, {', '.join(f'{m}_AVG' for m in HOUSING)} from {S('application')}")
def select_by_position(t):
    df = t("application")
    return df.select("SK_ID_CURR", *clean.select_range(df, "APARTMENTS_AVG", "NONLIVINGAREA_AVG"))


@query(f"select SK_ID_PREV, cast(NFLAG_LAST_APPL_IN_DAY as varchar) as NFLAG_LAST_APPL_IN_DAY, "
       f"cast(trunc(AMT_APPLICATION / 1000) as bigint) as THOUSANDS from {S('previous_application')}")
def cast_columns(t):
    df = t("previous_application").select("SK_ID_PREV", "NFLAG_LAST_APPL_IN_DAY", (F.col("AMT_APPLICATION") / 1000).alias("THOUSANDS"))
    return clean.cast_columns(df, {"NFLAG_LAST_APPL_IN_DAY": "string", "THOUSANDS": "long"})


@query(f"select SK_ID_PREV, case NFLAG_LAST_APPL_IN_DAY when 0 then 'Yes' when 1 then 'No' end as NFLAG_LAST_APPL_IN_DAY "
       f"from {S('previous_application')}")
def remap_values(t):
    return clean.remap_values(t("previous_application").select("SK_ID_PREV", "NFLAG_LAST_APPL_IN_DAY"),
                              "NFLAG_LAST_APPL_IN_DAY", {0: "Yes", 1: "No"})


@query(f"select SK_ID_PREV, {', '.join(f'{flag(f"NAME_TYPE_SUITE = '{v}'")} as NAME_TYPE_SUITE_{v}' for v in ('Children', 'Family', 'Unaccompanied'))}, "
       f"{flag('NAME_TYPE_SUITE is null')} as NAME_TYPE_SUITE_nan from {S('previous_application')}")
def one_hot_encode(t):
    df, _ = encode.one_hot(t("previous_application").select("SK_ID_PREV", "NAME_TYPE_SUITE"))
    return df


@query(f"""with a as {S('application')}
select SK_ID_CURR, {', '.join(f"cast(coalesce(list_position((select list_sort(list(distinct {c}) filter (where {c} is not null)) from a), {c}) - 1, -1) as integer) as {c}"
                              for c in ('OCCUPATION_TYPE', 'ORGANIZATION_TYPE', 'NAME_INCOME_TYPE'))} from a""")
def label_encode(t):
    df = t("application").select("SK_ID_CURR", "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "NAME_INCOME_TYPE")
    return encode.label_encode(df)


@query("select p_partkey, cast(dense_rank() over (order by p_name) - 1 as integer) as p_name from part")
def label_encode_large_domain(t):
    return encode.label_encode(t("part").select("p_partkey", "p_name"), limit=2)


@query("""with v as (select c_nationkey, unnest([{'column': 'c_mktsegment', 'value': c_mktsegment}, {'column': 'c_name', 'value': c_name}], recursive := true) from customer),
n as (select c_nationkey, count(*) as "all" from customer group by 1)
select v.c_nationkey, "column", "value", count(*) / any_value("all")::double as share from v join n on v.c_nationkey = n.c_nationkey
where "value" is not null group by 1, 2, 3""", rnd="share")
def one_hot_large_domain(t):
    """Shares of every segment and of every customer name by nation, without a column for each."""
    return encode.one_hot_long(t("customer"), "c_nationkey", ["c_mktsegment", "c_name"])


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount / nullif(l_tax, 0) as share from lineitem", rnd="share")
def inf_to_null(t):
    df = t("lineitem")
    share = F.when(F.col("l_tax") == 0, F.lit(float("inf"))).otherwise(F.try_divide("l_discount", "l_tax"))
    return clean.inf_to_null(df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", share.alias("share")))


@query(f"""select cast(SK_ID_BUREAU as smallint) as SK_ID_BUREAU, cast(SK_ID_CURR as smallint) as SK_ID_CURR,
  cast(DAYS_CREDIT as smallint) as DAYS_CREDIT, cast(CNT_CREDIT_PROLONG as tinyint) as CNT_CREDIT_PROLONG,
  cast(AMT_CREDIT_SUM as float) as AMT_CREDIT_SUM from {S('bureau')}""")
def narrow_schema(t):
    return clean.narrow(t("bureau").select("SK_ID_BUREAU", "SK_ID_CURR", "DAYS_CREDIT", "CNT_CREDIT_PROLONG", "AMT_CREDIT_SUM"))


# --------------------------------------------------------------- row expressions
RATIOS = specs.APPLICANT_RATIOS[10:20]


@query(f"select SK_ID_CURR, {', '.join(f'{div(a, b)} as {n}' for n, a, b in RATIOS if 'BIRTH' not in n)} from {S('application')}",
       keys="SK_ID_CURR")
def ratio_features(t):
    wanted = [x for x in RATIOS if "BIRTH" not in x[0]]
    return X.ratios(t("application"), wanted).select("SK_ID_CURR", *[n for n, *_ in wanted])


@query(f"select SK_ID_CURR, AMT_INCOME_TOTAL - AMT_ANNUITY as INCOME_ANNUITY_DIFF, "
       f"CNT_FAM_MEMBERS - CNT_CHILDREN as CNT_NON_CHILD from {S('application')}")
def difference_features(t):
    pairs = [("INCOME_ANNUITY_DIFF", "AMT_INCOME_TOTAL", "AMT_ANNUITY"), ("CNT_NON_CHILD", "CNT_FAM_MEMBERS", "CNT_CHILDREN")]
    return X.differences(t("application"), pairs).select("SK_ID_CURR", *[n for n, *_ in pairs])


@query(f"select SK_ID_CURR, {' + '.join(f'{m}_AVG' for m in HOUSING)} as APARTMENTS_SUM_AVG from {S('application')}")
def sum_features(t):
    return X.sums(t("application"), {"APARTMENTS_SUM_AVG": [f"{m}_AVG" for m in HOUSING]}).select("SK_ID_CURR", "APARTMENTS_SUM_AVG")


@query(f"select SK_ID_CURR, {' + '.join(f'coalesce({m}_AVG, 0)' for m in HOUSING)} as APARTMENTS_SUM_AVG from {S('application')}")
def row_sum_skipna(t):
    return X.sums(t("application"), {"APARTMENTS_SUM_AVG": [f"{m}_AVG" for m in HOUSING]}, skip_missing=True).select(
        "SK_ID_CURR", "APARTMENTS_SUM_AVG")


@query(f"select SK_ID_CURR, EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3 as EXT_SOURCES_PROD, "
       f"EXT_SOURCE_1 * EXT_SOURCE_2 as \"EXT_SOURCE_1 EXT_SOURCE_2\" from {S('application')}")
def product_features(t):
    return X.products(t("application"), {"EXT_SOURCES_PROD": ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"],
                                         "EXT_SOURCE_1 EXT_SOURCE_2": ["EXT_SOURCE_1", "EXT_SOURCE_2"]}).select(
        "SK_ID_CURR", "EXT_SOURCES_PROD", "EXT_SOURCE_1 EXT_SOURCE_2")


@query(f"select SK_ID_CURR, power(EXT_SOURCE_1, 2) as \"EXT_SOURCE_1^2\" from {S('application')}")
def power_features(t):
    return X.powers(t("application"), {"EXT_SOURCE_1^2": ("EXT_SOURCE_1", 2)}).select("SK_ID_CURR", "EXT_SOURCE_1^2")


@query(f"select SK_ID_CURR, 2 * EXT_SOURCE_1 + EXT_SOURCE_2 + 3 * EXT_SOURCE_3 as EXT_SOURCES_WEIGHTED from {S('application')}")
def weighted_sum(t):
    weights = {"EXT_SOURCE_1": 2, "EXT_SOURCE_2": 1, "EXT_SOURCE_3": 3}
    return t("application").select("SK_ID_CURR", X.weighted_sum(weights).alias("EXT_SOURCES_WEIGHTED"))


@query(f"select SK_ID_CURR, EXT_SOURCES_MIN, EXT_SOURCES_MAX, EXT_SOURCES_MEAN, EXT_SOURCES_MEDIAN, EXT_SOURCES_VAR from ({applicant_rows()})",
       keys="SK_ID_CURR")
def row_statistics(t):
    scores = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    return t("application").select("SK_ID_CURR", *[X.row_stat(scores, fn).alias(f"EXT_SOURCES_{fn.upper()}")
                                                   for fn in ("min", "max", "mean", "median", "var")])


@query(f"select SK_ID_CURR, {row_kurtosis(DOCUMENT_FLAGS)} as NEW_DOC_KURT from {S('application')}", rnd="NEW_DOC_KURT")
def row_kurtosis_feature(t):
    return t("application").select("SK_ID_CURR", X.row_kurtosis(DOCUMENT_FLAGS).alias("NEW_DOC_KURT"))


@query(f"select SK_ID_BUREAU, {flag('AMT_CREDIT_MAX_OVERDUE > 100')} as OVERDUE, "
       f"case when CREDIT_DAY_OVERDUE = 0 then 0 else 1 end as FLAG_OVERDUE_RECENT from {S('bureau')}")
def threshold_flag(t):
    return t("bureau").select("SK_ID_BUREAU", X.flag(F.col("AMT_CREDIT_MAX_OVERDUE") > 100).alias("OVERDUE"),
                              X.flag_unless_zero("CREDIT_DAY_OVERDUE").alias("FLAG_OVERDUE_RECENT"))


INSTALMENT_KEYS = "SK_ID_PREV, NUM_INSTALMENT_NUMBER, DAYS_INSTALMENT, AMT_INSTALMENT, AMT_PAYMENT"


@query(f"select {INSTALMENT_KEYS}, case when DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT <= 0 then 0 "
       f"else DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT end as DPD from {S('installments_payments')}")
def clamp_at_zero(t):
    df = t("installments_payments")
    return df.select(*INSTALMENT_KEYS.split(", "), X.clamp_at_zero(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")).alias("DPD"))


@query(f"select {INSTALMENT_KEYS}, case when DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT then {div('AMT_PAYMENT', 'AMT_INSTALMENT')} "
       f"else 0 end as LATE_PAYMENT_RATIO from {S('installments_payments')}", rnd="LATE_PAYMENT_RATIO")
def conditional_value(t):
    df = t("installments_payments")
    late = X.flag(F.col("DAYS_ENTRY_PAYMENT") > F.col("DAYS_INSTALMENT"))
    return df.select(*INSTALMENT_KEYS.split(", "), X.value_if_flag(late, X.safe_div("AMT_PAYMENT", "AMT_INSTALMENT")).alias("LATE_PAYMENT_RATIO"))


@query(f"select SK_ID_CURR, {steps('(-DAYS_BIRTH / cast(365 as double))', specs.AGE_UPPERS, 0, 0)} as AGE_RANGE, "
       f"{steps(div('AMT_CREDIT', 'AMT_ANNUITY'), specs.DURATION_UPPERS, 7, 0)} as CREDIT_TO_ANNUITY_GROUP from {S('application')}")
def step_label(t):
    return t("application").select(
        "SK_ID_CURR", X.step_label(X.days_to_years("DAYS_BIRTH"), specs.AGE_UPPERS, 0, 0).alias("AGE_RANGE"),
        X.step_label(X.safe_div("AMT_CREDIT", "AMT_ANNUITY"), specs.DURATION_UPPERS, 7, 0).alias("CREDIT_TO_ANNUITY_GROUP"))


@query(f"select SK_ID_PREV, case when CNT_PAYMENT > 0 and CNT_PAYMENT <= 12 then 'Short' when CNT_PAYMENT > 12 and CNT_PAYMENT <= 60 "
       f"then 'Middle' when CNT_PAYMENT > 60 and CNT_PAYMENT <= 120 then 'Long' end as NEW_CNT_PAYMENT, "
       f"case when CNT_PAYMENT >= 0 and CNT_PAYMENT < 12 then 0 when CNT_PAYMENT >= 12 and CNT_PAYMENT < 60 then 1 end as LEFT_CLOSED "
       f"from {S('previous_application')}", rnd="LEFT_CLOSED")
def cut_bins(t):
    return t("previous_application").select(
        "SK_ID_PREV", X.cut("CNT_PAYMENT", [0, 12, 60, 120], labels=["Short", "Middle", "Long"]).alias("NEW_CNT_PAYMENT"),
        X.cut("CNT_PAYMENT", [0, 12, 60], right=False).alias("LEFT_CLOSED"))


@query(f"""with a as {S('bureau')}
select SK_ID_BUREAU, {' + '.join(f"(case when AMT_CREDIT_MAX_OVERDUE > (select quantile_cont(AMT_CREDIT_MAX_OVERDUE, {p}) from a) then 1 else 0 end)"
                                 for p in (0.2, 0.4, 0.6, 0.8))} + 0 * AMT_CREDIT_MAX_OVERDUE as QCUT from a""", rnd="QCUT")
def quantile_bins(t):
    return binning.quantile_cut(t("bureau"), "AMT_CREDIT_MAX_OVERDUE", 5, "QCUT").select("SK_ID_BUREAU", "QCUT")


@query(f"select SK_ID_CURR, case when FLAG_OWN_CAR = 'N' and FLAG_OWN_REALTY = 'N' then 0 when FLAG_OWN_CAR = 'Y' and FLAG_OWN_REALTY = 'N' then 1 "
       f"when FLAG_OWN_CAR = 'N' and FLAG_OWN_REALTY = 'Y' then 2 when FLAG_OWN_CAR = 'Y' and FLAG_OWN_REALTY = 'Y' then 3 end as FLAG_ASSET "
       f"from {S('application')}", rnd="FLAG_ASSET")
def predicate_matrix_label(t):
    return t("application").select("SK_ID_CURR", X.pair_label("FLAG_OWN_CAR", "FLAG_OWN_REALTY", specs.ASSET_LABELS).alias("FLAG_ASSET"))


INTEREST = ["NEW_RETURN_DAY", "NEW_DAYS_TERMINATION_DIFF", "SIMPLE_INTERESTS", "AMT_INTEREST", "INTEREST_SHARE", "INTEREST_RATE"]


@query(f"select SK_ID_PREV, {', '.join(INTEREST)} from ({previous_rows()})", keys="SK_ID_PREV")
def loan_interest(t):
    df = clean.null_sentinels(t("previous_application"), {c: 365243.0 for c in specs.PREVIOUS_SENTINEL_DAYS})
    return loan_interest_features(df).select("SK_ID_PREV", *INTEREST)


PAST_DUE = ["PAID_OVER_AMOUNT", "PAID_OVER", "DPD", "DBD", "LATE_PAYMENT", "PAYMENT_PERC", "LATE_PAYMENT_RATIO",
            "SIGNIFICANT_LATE_PAYMENT", "DPD_7", "DPD_15", "INS_IS_DPD_UNDER_120", "INS_IS_DPD_OVER_120"]


@query(f"select {INSTALMENT_KEYS}, {', '.join(PAST_DUE)} from ({installment_rows()})", keys="SK_ID_PREV NUM_INSTALMENT_NUMBER")
def days_past_due(t):
    return days_past_due_features(t("installments_payments")).select(*INSTALMENT_KEYS.split(", "), *PAST_DUE)


@query(f"select SK_ID_PREV, case when AMT_APPLICATION / nullif(AMT_CREDIT, 0) <= 1 then 'No' else 'Yes' end as NEW_APP_CREDIT_RATE_RATIO "
       f"from {S('previous_application')}")
def previous_row_labels(t):
    return previous_row_features(t("previous_application")).select("SK_ID_PREV", "NEW_APP_CREDIT_RATE_RATIO")


def _cross_sql() -> str:
    from catalog.preset_sql import bureau, installments, previous, ratio_list
    return f"""with app as ({applicant_rows()}), bur as ({bureau()}), prv as ({previous()}), ins as ({installments()})
select app.SK_ID_CURR, {ratio_list(specs.CROSS_TABLE_RATIOS)} from app left join bur on app.SK_ID_CURR = bur.SK_ID_CURR
left join prv on app.SK_ID_CURR = prv.SK_ID_CURR left join ins on app.SK_ID_CURR = ins.SK_ID_CURR"""


@query(_cross_sql(), keys="SK_ID_CURR")
def cross_table_ratios(t):
    needed = {c for _, a, b in specs.CROSS_TABLE_RATIOS for c in (a, b)} | {"SK_ID_CURR"}
    blocks = [bureau_features(t("bureau"), t("bureau_balance")),
              previous_features(t("previous_application"), t("installments_payments")),
              installment_features(t("installments_payments"), year_block=False)]
    out = applicant_row_features(clean_applicants(t("application")))
    out = out.select(*[c for c in out.columns if c in needed])
    for block in blocks:
        out = out.join(block.select(*[c for c in block.columns if c in needed]), "SK_ID_CURR", "left")
    return post_join_ratios(out).select("SK_ID_CURR", *[n for n, *_ in specs.CROSS_TABLE_RATIOS])


# ----------------------------------------------------------------------- filters
@query(f"select SK_ID_BUREAU, SK_ID_CURR from {S('bureau')} where CREDIT_ACTIVE = 'Active'")
def category_segment(t):
    return t("bureau").where(F.col("CREDIT_ACTIVE") == "Active").select("SK_ID_BUREAU", "SK_ID_CURR")


@query(f"select SK_ID_BUREAU, DAYS_CREDIT from {S('bureau')} where DAYS_CREDIT >= -360")
def recency_window(t):
    return t("bureau").where(F.col("DAYS_CREDIT") >= -30 * 12).select("SK_ID_BUREAU", "DAYS_CREDIT")


@query(f"select SK_ID_PREV from {S('previous_application')} where NAME_CONTRACT_STATUS = 'Approved' and DAYS_LAST_DUE = 365243")
def sentinel_segment(t):
    return previous_row_features(t("previous_application")).where(F.col("IS_ACTIVE") == 1).select("SK_ID_PREV")


@query(f"""with a as {S('application')} select SK_ID_CURR, AMT_ANNUITY, AMT_INCOME_TOTAL from a
where AMT_ANNUITY < (select quantile_cont(AMT_ANNUITY, 0.99) from a)
  and AMT_INCOME_TOTAL < (select quantile_cont(AMT_INCOME_TOTAL, 0.99) from a)""")
def percentile_cap(t):
    df = t("application").select("SK_ID_CURR", "AMT_ANNUITY", "AMT_INCOME_TOTAL")
    return binning.below_percentile(df, {"AMT_ANNUITY": 0.99, "AMT_INCOME_TOTAL": 0.99})


@query(f"select SK_ID_CURR, case when AMT_CREDIT > 100000 and AMT_CREDIT < 500000 then AMT_CREDIT end as AMT_CREDIT from {S('application')}")
def scale_limits(t):
    return clean.null_outside(t("application").select("SK_ID_CURR", "AMT_CREDIT"), {"AMT_CREDIT": (100000, 500000)}, closed=False)


@query(f"select case when TARGET is null then 'test' else 'train' end as side, count(*) as n_rows from {S('application')} group by 1")
def label_presence_split(t):
    from ledgerloom.operators.modelling import split_by_label
    train, test = split_by_label(t("application"))
    return train.agg(F.lit("train").alias("side"), F.count(F.lit(1)).alias("n_rows")).unionByName(
        test.agg(F.lit("test").alias("side"), F.count(F.lit(1)).alias("n_rows")))


@query(f"select SK_ID_CURR, sum(CREDIT_DAY_OVERDUE)::bigint as overdue from {S('bureau')} group by 1 having sum(CREDIT_DAY_OVERDUE) <> 0")
def nonzero_filter(t):
    return t("bureau").groupBy("SK_ID_CURR").agg(F.sum("CREDIT_DAY_OVERDUE").alias("overdue")).where(F.col("overdue") != 0)
