"""Feature blocks of the history tables, one row per applicant each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import (absolute, clamp_at_zero, cut, differences, flag, flag_unless_zero, products, ratios,
                                  safe_div, sum_skip_missing, value_if_flag)
from ledgerloom.operators.aggspec import (Segment, cohort_mean, group_agg, latest_row, ratio_of_sums,
                                          segmented_agg, share_columns, share_of_rows, two_level_agg, value_at)
from ledgerloom.operators.clean import null_outside, null_sentinels, rename
from ledgerloom.operators.encode import domains_of, one_hot
from ledgerloom.operators.sequences import (entities_active_since, ewma, last_k_trend, last_n_entities,
                                            latest_entity_stats, partition_total)
from ledgerloom.operators.skew import all_fit, co_locate
from ledgerloom.plans import specs

KEY = "SK_ID_CURR"
STILL_OPEN = 365243
FIFTY_YEARS = -50 * 365
DAYS_PER_MONTH = 30


# ---------------------------------------------------------------- credit bureau
def balance_history_summary(balance: DataFrame) -> DataFrame:
    """Per bureau loan: share of months in each status, and month statistics."""
    shares = share_columns({"STATUS": specs.BALANCE_STATUSES}, suffix="")
    return group_agg(balance, specs.BALANCE_MONTHS, "SK_ID_BUREAU", extra=shares)


def bureau_rows(bureau: DataFrame, earliest: int = FIFTY_YEARS) -> DataFrame:
    """Row features of bureau loans; day offsets before ``earliest`` are missing."""
    df = null_outside(bureau, {c: (earliest, None) for c in
                               ("DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "DAYS_CREDIT_UPDATE")})
    df = differences(df, [("ENDDATE_DIF", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT"),
                          ("DEBT_CREDIT_DIFF", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT")])
    df = df.withColumns({
        "CREDIT_DURATION": absolute(F.col("DAYS_CREDIT") - F.col("DAYS_CREDIT_ENDDATE")),
        "CREDIT_ENDDATE_UPDATE_DIFF": absolute(F.col("DAYS_CREDIT_UPDATE") - F.col("DAYS_CREDIT_ENDDATE")),
        "FLAG_OVERDUE_RECENT": flag_unless_zero("CREDIT_DAY_OVERDUE"),
    })
    df = products(df, {"CNT_PROLONGED_MAX_OVERDUE_MUL": ["CNT_CREDIT_PROLONG", "AMT_CREDIT_MAX_OVERDUE"]})
    return ratios(df, [
        ("DEBT_PERCENTAGE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"),
        ("CREDIT_TO_ANNUITY_RATIO", "AMT_CREDIT_SUM", "AMT_ANNUITY"),
        ("MAX_AMT_OVERDUE_DURATION_RATIO", "AMT_CREDIT_MAX_OVERDUE", "CREDIT_DURATION"),
        ("CURRENT_AMT_OVERDUE_DURATION_RATIO", "AMT_CREDIT_SUM_OVERDUE", "CREDIT_DURATION"),
        ("AMT_OVERDUE_DURATION_LEFT_RATIO", "AMT_CREDIT_SUM_OVERDUE", "DAYS_CREDIT_ENDDATE"),
        ("CNT_PROLONGED_DURATION_RATIO", "CNT_CREDIT_PROLONG", "CREDIT_DURATION"),
    ])


def bureau_features(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """General, active, closed, loan-type and recency blocks in one fused aggregate."""
    rows = bureau_rows(bureau).join(balance_history_summary(balance), "SK_ID_BUREAU", "left")
    rows = rows.withColumn("STATUS_SUM", sum_skip_missing([f"STATUS_{i}" for i in range(1, 6)]))
    rows = cohort_mean(rows, "MONTHS_BALANCE_SIZE", specs.COHORT_FEATURES, "LL_")
    rows = co_locate(rows, KEY, source=bureau)
    active, kind = F.col("CREDIT_ACTIVE"), F.col("CREDIT_TYPE")
    rows = rows.withColumns({
        **{f"CREDIT_ACTIVE_{v}": F.when(active == v, 1).otherwise(0) for v in specs.BUREAU_STATUSES},
        **{f"CREDIT_TYPE_{v}": F.when(kind == v, 1).otherwise(0) for v in specs.BUREAU_TYPES}})
    segments = [
        Segment("BUREAU_", specs.BUREAU_GENERAL),
        Segment("BUREAU_ACTIVE_", specs.BUREAU_ACTIVE, active == "Active"),
        Segment("BUREAU_CLOSED_", specs.BUREAU_CLOSED, active == "Closed"),
        *[Segment(f"BUREAU_{v.split(' ')[0].upper()}_", specs.BUREAU_LOAN_TYPE, kind == v) for v in specs.BUREAU_TYPES],
        *[Segment(f"BUREAU_LAST{m}M_", specs.BUREAU_RECENT, F.col("DAYS_CREDIT") >= -DAYS_PER_MONTH * m)
          for m in (12, 24)],
    ]
    segments.append(Segment("BUREAU_NEWEST_", {"AMT_CREDIT_MAX_OVERDUE": ["last"]}, None,
                            (F.col("DAYS_CREDIT"), F.col("SK_ID_BUREAU"))))
    out = rename(segmented_agg(rows, KEY, segments, tiled=True),
                 {"BUREAU_NEWEST_AMT_CREDIT_MAX_OVERDUE_LAST": "BUREAU_LAST_LOAN_MAX_OVERDUE"})
    return ratios(out, [
        ("BUREAU_DEBT_OVER_CREDIT", "BUREAU_AMT_CREDIT_SUM_DEBT_SUM", "BUREAU_AMT_CREDIT_SUM_SUM"),
        ("BUREAU_ACTIVE_DEBT_OVER_CREDIT", "BUREAU_ACTIVE_AMT_CREDIT_SUM_DEBT_SUM", "BUREAU_ACTIVE_AMT_CREDIT_SUM_SUM"),
        ("OVERDUE_DEBT_RATIO", "BUREAU_AMT_CREDIT_SUM_OVERDUE_SUM", "BUREAU_AMT_CREDIT_SUM_DEBT_SUM"),
    ])


# ------------------------------------------------------- previous applications
def loan_interest_features(df: DataFrame) -> DataFrame:
    """Interest and return-day features from annuity, term and credit."""
    annuity, term, credit = F.col("AMT_ANNUITY"), F.col("CNT_PAYMENT"), F.col("AMT_CREDIT")
    df = df.withColumns({
        "NEW_RETURN_DAY": F.col("DAYS_DECISION") + term * DAYS_PER_MONTH,
        "SIMPLE_INTERESTS": safe_div(safe_div(annuity * term, credit) - F.lit(1.0), term),
        "AMT_INTEREST": term * annuity - credit,
    })
    return df.withColumns({
        "NEW_DAYS_TERMINATION_DIFF": F.col("DAYS_TERMINATION") - F.col("NEW_RETURN_DAY"),
        "INTEREST_SHARE": safe_div("AMT_INTEREST", credit),
        "INTEREST_RATE": safe_div(F.lit(24.0) * F.col("AMT_INTEREST"), credit * (term + F.lit(1.0))),
    })


def previous_rows(previous: DataFrame) -> DataFrame:
    """Row features of previous applications; ``IS_ACTIVE`` is taken before the
    "still open" marker is cleaned away."""
    df = previous.withColumn("IS_ACTIVE", flag(
        (F.col("NAME_CONTRACT_STATUS") == "Approved") & (F.col("DAYS_LAST_DUE") == STILL_OPEN)))
    df = null_sentinels(df, {c: float(STILL_OPEN) for c in specs.PREVIOUS_SENTINEL_DAYS})
    df = differences(df, [
        ("APPLICATION_CREDIT_DIFF", "AMT_APPLICATION", "AMT_CREDIT"),
        ("NEW_DAYS_DUE_DIFF", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_FIRST_DUE"),
        ("NEW_END_DIFF", "DAYS_TERMINATION", "DAYS_LAST_DUE"),
        ("DAYS_LAST_DUE_DIFF", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE"),
    ])
    df = ratios(df, [
        ("APPLICATION_CREDIT_RATIO", "AMT_APPLICATION", "AMT_CREDIT"),
        ("NEW_CREDIT_GOODS_RATE", "AMT_CREDIT", "AMT_GOODS_PRICE"),
        ("CREDIT_TO_ANNUITY_RATIO", "AMT_CREDIT", "AMT_ANNUITY"),
        ("DOWN_PAYMENT_TO_CREDIT", "AMT_DOWN_PAYMENT", "AMT_CREDIT"),
    ])
    df = df.withColumns({
        "NEW_APP_CREDIT_RATE_RATIO": F.when(F.col("APPLICATION_CREDIT_RATIO") <= 1, "No").otherwise("Yes"),
        "NEW_CNT_PAYMENT": cut("CNT_PAYMENT", [0, 12, 60, 120], labels=["Short", "Middle", "Long"]),
    })
    return loan_interest_features(df)


def loan_payments(installments: DataFrame) -> DataFrame:
    """Per loan, in one pass: due and paid totals and whether any payment was late."""
    late = F.col("DAYS_ENTRY_PAYMENT") > F.col("DAYS_INSTALMENT")
    return installments.groupBy("SK_ID_PREV").agg(
        F.coalesce(F.sum("AMT_INSTALMENT"), F.lit(0.0)).alias("AMT_INSTALMENT"),
        F.coalesce(F.sum("AMT_PAYMENT"), F.lit(0.0)).alias("AMT_PAYMENT"),
        F.max(flag(late)).alias("EVER_LATE"))


def previous_features(previous: DataFrame, installments: DataFrame,
                      domains: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    paid = co_locate(previous.join(loan_payments(installments), "SK_ID_PREV", "left"), KEY, source=previous)
    rows = previous_rows(paid).withColumns({
        "INSTALMENT_PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        "REMAINING_DEBT": F.col("AMT_CREDIT") - F.col("AMT_PAYMENT"),
        "REPAYMENT_RATIO": safe_div("AMT_PAYMENT", "AMT_CREDIT"),
    })
    domains = domains or domains_of(previous, specs.PREVIOUS_CATEGORIES)
    status, kind = F.col("__status"), F.col("__type")
    rows, dummies = one_hot(rows.withColumns({"__status": F.col("NAME_CONTRACT_STATUS"), "__type": F.col("NAME_CONTRACT_TYPE")}),
                            specs.PREVIOUS_CATEGORIES, domains, null_as_category=False)
    wanted = [f"NAME_CONTRACT_TYPE_{v}" for v in ("Consumer loans", "Cash loans", "Revolving loans")]
    rows = rows.withColumns({c: F.lit(0) for c in wanted if c not in dummies})
    general = {**specs.PREVIOUS_GENERAL, **{c: ["mean"] for c in dummies}}
    out = segmented_agg(rows, KEY, [
        Segment("PREV_", general),
        Segment("PREV_ACTIVE_", specs.PREVIOUS_ACTIVE, F.col("IS_ACTIVE") == 1),
        Segment("APPROVED_", specs.PREVIOUS_APPROVED, status == "Approved"),
        Segment("REFUSED_", specs.PREVIOUS_REFUSED, status == "Refused"),
        *[Segment(f"PREV_{v.split(' ')[0]}_", specs.PREVIOUS_LOAN_TYPE, kind == v) for v in specs.PREVIOUS_TYPES],
        Segment("PREV_LATE_", specs.PREVIOUS_LATE, F.col("EVER_LATE") == 1),
        *[Segment(f"PREV_LAST{m}M_", specs.PREVIOUS_RECENT, F.col("DAYS_DECISION") >= -DAYS_PER_MONTH * m)
          for m in (6, 12, 24)],
    ], tiled=True)
    return ratios(out, [("TOTAL_REPAYMENT_RATIO", "PREV_ACTIVE_AMT_PAYMENT_SUM", "PREV_ACTIVE_AMT_CREDIT_SUM")])


# ------------------------------------------------------------ point-of-sale loans
def pos_rows(pos: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Row features; ``MONTH`` keeps the signed month, ``MONTHS_BALANCE`` its distance."""
    df = pos.withColumns({"MONTH": F.col("MONTHS_BALANCE"), "MONTHS_BALANCE": absolute("MONTHS_BALANCE")})
    df = ewma(df, ["CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"], 0.6, ["SK_ID_PREV"], ["MONTH", *tiebreak])
    dpd = F.col("SK_DPD")
    return df.withColumns({
        "SK_DPD_RATIO": safe_div("SK_DPD", "SK_DPD_DEF"),
        "TOTAL_TERM": F.col("CNT_INSTALMENT") + F.col("CNT_INSTALMENT_FUTURE"),
        "POS_IS_DPD_UNDER_120": flag((dpd > 0) & (dpd < 120)),
        "POS_IS_DPD_OVER_120": flag(dpd >= 120),
        "LATE_PAYMENT": flag(dpd > 0),
    })


def loan_completion_metrics(pos: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Completion features per loan summed per applicant (months oldest to newest)."""
    order = [F.col(c) for c in ("MONTH", *tiebreak)]
    term, left = F.col("CNT_INSTALMENT"), F.col("CNT_INSTALMENT_FUTURE")
    inner = [
        F.avg(F.when(F.col("NAME_CONTRACT_STATUS") == "Completed", 1.0).otherwise(0.0)).alias("done"),
        value_at(term, order, newest=False).alias("first_term"),
        value_at(term, order).alias("last_term"),
        value_at(left, order).alias("remaining"),
    ]
    shortened = flag((F.col("first_term") - F.col("last_term") > 0) & (F.col("done") > 0))
    outer = [
        F.sum("done").alias("POS_LOAN_COMPLETED_MEAN"),
        F.sum(shortened).alias("POS_COMPLETED_BEFORE_MEAN"),
        F.coalesce(F.sum("remaining"), F.lit(0.0)).alias("POS_REMAINING_INSTALMENTS"),
        F.coalesce(F.sum(safe_div("remaining", "last_term")), F.lit(0.0)).alias("POS_REMAINING_INSTALMENTS_RATIO"),
    ]
    return two_level_agg(pos, KEY, "SK_ID_PREV", inner, outer)


def recent_late_sum(pos: DataFrame, loans: int = 3) -> DataFrame:
    """Mean late months of the newest loans."""
    return last_n_entities(pos, KEY, "SK_ID_PREV", F.max("MONTH"), loans, {"late": F.sum("LATE_PAYMENT")},
                           [F.avg("late").alias("LATE_PAYMENT_SUM")])


def pos_features(pos: DataFrame, domains: Mapping[str, Sequence[str]] | None = None,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    rows = co_locate(pos_rows(pos, tiebreak), KEY, source=pos)
    domains = domains or domains_of(pos, ["NAME_CONTRACT_STATUS"])
    kept = [v for v in domains["NAME_CONTRACT_STATUS"] if v not in specs.POS_DROPPED_STATUSES]
    order = [F.col("MONTH"), F.col("SK_ID_PREV"), *[F.col(c) for c in tiebreak]]
    general = group_agg(rows, specs.POS_GENERAL, KEY, "POS_", order,
                        extra=share_columns({"NAME_CONTRACT_STATUS": kept}, "POS_"))
    return (general.join(loan_completion_metrics(rows, tiebreak), KEY, "left")
            .join(recent_late_sum(rows), KEY, "left"))


# --------------------------------------------------------------------- instalments
def days_past_due_features(df: DataFrame, late_from: str = "DPD") -> DataFrame:
    """Delay, over-payment and late flags.

    ``late_from='DBD'`` marks early payers as late, for comparison with tables
    built that way.
    """
    df = differences(df, [
        ("PAID_OVER_AMOUNT", "AMT_PAYMENT", "AMT_INSTALMENT"),
        ("DPD_diff", "DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT"),
        ("DBD_diff", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT"),
        ("DAYS_PAYMENT_DIFF", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT"),
        ("PAYMENT_DIFF", "AMT_INSTALMENT", "AMT_PAYMENT"),
        ("AMT_PAYMENT_DIFF", "AMT_INSTALMENT", "AMT_PAYMENT"),
    ])
    df = ratios(df, [
        ("INSTALMENT_PAYMENT_RATIO", "AMT_PAYMENT", "AMT_INSTALMENT"),
        ("PAYMENT_PERC", "AMT_PAYMENT", "AMT_INSTALMENT"),
        ("DAYS_PAYMENT_RATIO", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT"),
    ])
    df = df.withColumns({"DPD": clamp_at_zero("DPD_diff"), "DBD": clamp_at_zero("DBD_diff"),
                         "PAID_OVER": flag(F.col("PAID_OVER_AMOUNT") > 0)})
    dpd = F.col("DPD")
    df = df.withColumns({
        "LATE_PAYMENT": flag(F.col(late_from) > 0), "DPD_7": flag(dpd >= 7), "DPD_15": flag(dpd >= 15),
        "INS_IS_DPD_UNDER_120": flag((dpd > 0) & (dpd < 120)), "INS_IS_DPD_OVER_120": flag(dpd >= 120)})
    df = df.withColumn("LATE_PAYMENT_RATIO", value_if_flag("LATE_PAYMENT", "INSTALMENT_PAYMENT_RATIO"))
    return df.withColumn("SIGNIFICANT_LATE_PAYMENT", flag(F.col("LATE_PAYMENT_RATIO") > 0.05))


def installment_rows(installments: DataFrame, late_from: str = "DPD") -> DataFrame:
    """Row features of instalments; payments of one instalment number are totalled first."""
    return _installment_features(_with_payment_total(installments), late_from)


def _with_payment_total(installments: DataFrame, in_place: bool = False) -> DataFrame:
    return partition_total(installments, ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER"], "AMT_PAYMENT", "AMT_PAYMENT_GROUPED", in_place)


def _installment_features(df: DataFrame, late_from: str) -> DataFrame:
    df = differences(df, [("PAYMENT_DIFFERENCE", "AMT_INSTALMENT", "AMT_PAYMENT_GROUPED")])
    df = ratios(df, [("PAYMENT_RATIO", "AMT_INSTALMENT", "AMT_PAYMENT_GROUPED")])
    return days_past_due_features(df, late_from)


INSTALLMENT_ORDER = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT",
                     "NUM_INSTALMENT_VERSION"]


def installment_ewma(rows: DataFrame) -> DataFrame:
    """Smoothed payment behaviour per loan (optional row features)."""
    smoothed = ["DAYS_PAYMENT_RATIO", "DAYS_PAYMENT_DIFF", "INSTALMENT_PAYMENT_RATIO", "AMT_PAYMENT_DIFF"]
    out = ewma(rows, smoothed, 0.5, [KEY, "SK_ID_PREV"], INSTALLMENT_ORDER[1:])
    return rename(out, {"EXP_INSTALMENT_PAYMENT_RATIO": "EXP_AMT_PAYMENT_RATIO"})


def installment_features(installments: DataFrame, late_from: str = "DPD", year_block: bool = True,
                         detailed: bool = False) -> DataFrame:
    # loans first: rows that lie together by loan aren't moved again for its instalment numbers
    in_place = all_fit(installments, ["SK_ID_PREV"])
    raw = _with_payment_total(entities_active_since(installments, "SK_ID_PREV", "DAYS_INSTALMENT", in_place), in_place)
    rows = _installment_features(co_locate(raw, KEY, source=installments), late_from)
    segments = [
        Segment("INS_", specs.INSTALLMENTS_GENERAL),
        *[Segment(f"INS_{m}M_", specs.INSTALLMENTS_RECENT, F.col("LAST_DAY") >= -DAYS_PER_MONTH * m)
          for m in specs.INSTALLMENT_WINDOWS],
        Segment("INSTAL_", {"NUM_INSTALMENT_VERSION": ["nunique"]}),
    ]
    if year_block:
        segments.append(Segment("INS_D365", specs.INSTALLMENTS_YEAR, F.col("DAYS_ENTRY_PAYMENT") >= -365))
    if detailed:
        segments.append(Segment("INS_GEN_", specs.INSTALLMENTS_DETAILED))
    out = segmented_agg(rows, KEY, segments,
                        [F.count(F.lit(1)).alias("INSTAL_COUNT")], tiled=True)
    newest = [F.col("DAYS_INSTALMENT").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in INSTALLMENT_ORDER]]
    trends = last_k_trend(rows, KEY, newest, ["DPD", "PAID_OVER_AMOUNT"], specs.TREND_PERIODS)
    last = latest_entity_stats(rows, KEY, "SK_ID_PREV", [F.col("DAYS_INSTALMENT"), -F.col("SK_ID_PREV")],
                               specs.LAST_LOAN, "LAST_LOAN_")
    last = rename(last, {f"LAST_LOAN_{c}_{fn.upper()}": f"LAST_LOAN_{c}_{fn}"
                         for c, fns in specs.LAST_LOAN.items() for fn in fns})
    return out.join(trends, KEY, "left").join(last, KEY, "left")


# ----------------------------------------------------------------------- cards
def card_rows(card: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    df = rename(card, {"AMT_RECIVABLE": "AMT_RECEIVABLE"})
    df = ratios(df, [
        ("LIMIT_USE", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
        ("PAYMENT_DIV_MIN", "AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY"),
        ("DRAWING_LIMIT_RATIO", "AMT_DRAWINGS_ATM_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL"),
        ("BALANCE_LIMIT_RATIO", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
        ("MIN_PAYMENT_RATIO", "AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY"),
        ("MIN_PAYMENT_TOTAL_RATIO", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY"),
        ("SK_DPD_RATIO", "SK_DPD", "SK_DPD_DEF"),
    ])
    df = differences(df, [
        ("PAYMENT_MIN_DIFF", "AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY"),
        ("PAYMENT_MIN_DIFF_TOTAL", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY"),
        ("AMT_INTEREST_RECEIVABLE", "AMT_TOTAL_RECEIVABLE", "AMT_RECEIVABLE_PRINCIPAL"),
    ])
    df = df.withColumns({
        "LATE_PAYMENT": flag(F.col("SK_DPD") > 0),
        "AMT_DRAWING_SUM": sum_skip_missing([f"AMT_DRAWINGS_{k}CURRENT" for k in ("ATM_", "", "OTHER_", "POS_")]),
        "CNT_DRAWING_SUM": sum_skip_missing([*[f"CNT_DRAWINGS_{k}CURRENT" for k in ("ATM_", "", "OTHER_", "POS_")],
                                             "CNT_INSTALMENT_MATURE_CUM"]),
    })
    return ewma(df, specs.CARD_SMOOTHED, 0.7, [KEY, "SK_ID_PREV"], ["MONTHS_BALANCE", *tiebreak])


def card_customer_ratios(card: DataFrame) -> DataFrame:
    """Behaviour ratios per applicant: loan-level pass, then applicant-level pass."""
    per_loan = [F.max("CNT_INSTALMENT_MATURE_CUM").alias("instalments"),
                F.sum(flag_unless_zero("SK_DPD")).alias("dpd_months")]
    loans = F.count("SK_ID_PREV").cast("double")
    out = two_level_agg(card, KEY, "SK_ID_PREV", per_loan, [
        safe_div(F.coalesce(F.sum("instalments"), F.lit(0.0)), loans).cast("long").alias("INSTALLMENTS_PER_LOAN"),
        F.avg("dpd_months").alias("DPD_COUNT")])
    direct = card.groupBy(KEY).agg(
        share_of_rows(F.col("AMT_PAYMENT_CURRENT") < F.col("AMT_INST_MIN_REGULARITY")).alias("PERCENTAGE_MISSED_PAYMENTS"),
        ratio_of_sums("AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT", 100.0).alias("CASH_CARD_RATIO"),
        ratio_of_sums("AMT_DRAWINGS_CURRENT", "CNT_DRAWINGS_CURRENT", 100.0).alias("DRAWINGS_RATIO"))
    return out.join(direct, KEY, "left")


def card_features(card: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    dated = entities_active_since(card, "SK_ID_PREV", "MONTHS_BALANCE")
    rows = card_rows(co_locate(dated, KEY, source=card), tiebreak)
    order = (F.col("MONTHS_BALANCE"), F.col("SK_ID_PREV"), *[F.col(c) for c in tiebreak])
    blocks = segmented_agg(rows, KEY, [
        Segment("CC_", specs.CARD_GENERAL, None, order),
        *[Segment(f"CC_{m}M_", specs.CARD_RECENT, F.col("LAST_DAY") >= -m, order) for m in specs.CARD_WINDOWS]], tiled=True)
    newest = latest_row(card.select(KEY, "SK_ID_PREV", "MONTHS_BALANCE", "AMT_BALANCE", *tiebreak), "SK_ID_PREV",
                        ["MONTHS_BALANCE", *tiebreak])
    last = group_agg(newest, {"AMT_BALANCE": ["mean", "max"]}, KEY, "CC_LAST_")
    return blocks.join(last, KEY, "left").join(card_customer_ratios(card), KEY, "left")

