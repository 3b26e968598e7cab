"""Oracle SQL of the presets, written from the specs in plain SQL."""

from __future__ import annotations

from catalog.roles import role_sql
from ledgerloom.plans import specs
from ledgerloom.sources.schemas import COLUMNS, DOCUMENT_FLAGS, ENQUIRIES, HOUSING


def q(name: str) -> str:
    return '"' + name + '"'


def measure(column: str, fn: str, where: str | None = None, order: str = "") -> str:
    """One aggregate of the spec language in SQL."""
    c, only = q(column), f" filter (where {where})" if where else ""
    if fn in ("min", "max", "median"):
        return f"{fn}({c}){only}"
    if fn == "mean":
        return f"avg({c}){only}"
    if fn == "var":
        return f"var_samp({c}){only}"
    if fn == "std":
        return f"stddev_samp({c}){only}"
    if fn == "last":
        both = f"{c} is not null" + (f" and {where}" if where else "")
        return f"last({c} order by {order}) filter (where {both})"
    body = {"sum": f"coalesce(sum({c}){only}, 0)", "count": f"count({c}){only}", "size": f"count(*){only}",
            "nunique": f"count(distinct {c}){only}"}[fn]
    return f"case when count(*){only} > 0 then {body} end" if where else body


def block(prefix: str, spec, where: str | None = None, order: str = "") -> str:
    return ", ".join(f"{measure(c, fn, where, order)} as {q(prefix + c + '_' + fn.upper())}"
                     for c, fns in spec.items() for fn in fns)


def div(a: str, b: str) -> str:
    return f"cast({a} as double) / nullif(cast({b} as double), 0)"


def ratio_list(triples) -> str:
    return ", ".join(f"{div(q(a), q(b))} as {q(n)}" for n, a, b in triples)


def flag(cond: str) -> str:
    return f"case when {cond} then 1 else 0 end"


def ewma_columns(columns, alpha: float, by: str) -> str:
    weight = f"power(cast({round(1 - alpha, 10)!r} as double), -rn)"
    frame = f"over (partition by {by} order by rn rows between unbounded preceding and current row)"
    return ", ".join(
        f"sum({q(c)} * {weight}) {frame} / nullif(sum(case when {q(c)} is not null then {weight} end) {frame}, 0) "
        f"as {q('EXP_' + c)}" for c in columns)


BALANCE = (f"select SK_ID_BUREAU, {block('', specs.BALANCE_MONTHS)}, "
           + ", ".join(f"avg({flag(f"STATUS = '{v}'")}) as {q('STATUS_' + v)}" for v in specs.BALANCE_STATUSES)
           + f" from {role_sql('bureau_balance')} group by SK_ID_BUREAU")


def bureau() -> str:
    early = -50 * 365
    nulled = ", ".join(f"case when {c} >= {early} then {c} end as {c}" for c in
                       ("DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "DAYS_CREDIT_UPDATE"))
    dummies = ", ".join([f"{flag(f"CREDIT_ACTIVE = '{v}'")} as {q('CREDIT_ACTIVE_' + v)}" for v in specs.BUREAU_STATUSES]
                        + [f"{flag(f"CREDIT_TYPE = '{v}'")} as {q('CREDIT_TYPE_' + v)}" for v in specs.BUREAU_TYPES])
    cohort = ", ".join(f"avg({c}) as LL_{c}" for c in specs.COHORT_FEATURES)
    blocks = [block("BUREAU_", specs.BUREAU_GENERAL),
              block("BUREAU_ACTIVE_", specs.BUREAU_ACTIVE, "CREDIT_ACTIVE = 'Active'"),
              block("BUREAU_CLOSED_", specs.BUREAU_CLOSED, "CREDIT_ACTIVE = 'Closed'")]
    blocks += [block(f"BUREAU_{v.split(' ')[0].upper()}_", specs.BUREAU_LOAN_TYPE, f"CREDIT_TYPE = '{v}'")
               for v in specs.BUREAU_TYPES]
    blocks += [block(f"BUREAU_LAST{m}M_", specs.BUREAU_RECENT, f"DAYS_CREDIT >= {-30 * m}") for m in (12, 24)]
    late = " + ".join(f"coalesce(STATUS_{i}, 0)" for i in range(1, 6))
    return f"""
with raw as (select * replace ({nulled}) from {role_sql('bureau')}),
loans as (select *, DAYS_CREDIT_ENDDATE - DAYS_ENDDATE_FACT as ENDDATE_DIF,
    AMT_CREDIT_SUM - AMT_CREDIT_SUM_DEBT as DEBT_CREDIT_DIFF, {div('AMT_CREDIT_SUM', 'AMT_CREDIT_SUM_DEBT')} as DEBT_PERCENTAGE,
    {div('AMT_CREDIT_SUM', 'AMT_ANNUITY')} as CREDIT_TO_ANNUITY_RATIO from raw),
balance as ({BALANCE}),
joined as (select loans.*, balance.* exclude (SK_ID_BUREAU), {late} as STATUS_SUM, {dummies}
    from loans left join balance on loans.SK_ID_BUREAU = balance.SK_ID_BUREAU),
cohort as (select MONTHS_BALANCE_SIZE, {cohort} from joined where MONTHS_BALANCE_SIZE is not null group by 1),
r as (select joined.*, cohort.* exclude (MONTHS_BALANCE_SIZE) from joined
    left join cohort on joined.MONTHS_BALANCE_SIZE = cohort.MONTHS_BALANCE_SIZE),
g as (select SK_ID_CURR, {', '.join(blocks)},
    {measure('AMT_CREDIT_MAX_OVERDUE', 'last', None, 'DAYS_CREDIT, SK_ID_BUREAU')} as BUREAU_LAST_LOAN_MAX_OVERDUE
    from r group by SK_ID_CURR)
select *, {ratio_list([
    ("BUREAU_DEBT_OVER_CREDIT", "BUREAU_AMT_CREDIT_SUM_DEBT_SUM", "BUREAU_AMT_CREDIT_SUM_SUM"),
    ("BUREAU_ACTIVE_DEBT_OVER_CREDIT", "BUREAU_ACTIVE_AMT_CREDIT_SUM_DEBT_SUM", "BUREAU_ACTIVE_AMT_CREDIT_SUM_SUM"),
    ("OVERDUE_DEBT_RATIO", "BUREAU_AMT_CREDIT_SUM_OVERDUE_SUM", "BUREAU_AMT_CREDIT_SUM_DEBT_SUM")])} from g"""


# The category values that the previous-application role contains.
PREVIOUS_DOMAINS = {
    "NAME_CONTRACT_STATUS": ["Approved", "Canceled", "Refused"],
    "NAME_CONTRACT_TYPE": ["Cash loans", "Consumer loans", "Revolving loans", "XNA"],
    "CHANNEL_TYPE": ["Car dealer", "Channel of corporate sales", "Contact center", "Country-wide", "Stone"],
    "NAME_TYPE_SUITE": ["Children", "Family", "Unaccompanied"],
    "NAME_YIELD_GROUP": ["XNA", "high", "low_action", "low_normal", "middle"],
    "PRODUCT_COMBINATION": ["Card Street", "Card X-Sell", "Cash", "Cash Street", "POS household", "POS mobile"],
    "NAME_PRODUCT_TYPE": ["XNA", "walk-in", "x-sell"],
    "NAME_CLIENT_TYPE": ["New", "Refreshed", "Repeater", "XNA"],
}


def previous_rows() -> str:
    nulled = ", ".join(f"nullif({q(c)}, 365243) as {q(c)}" for c in specs.PREVIOUS_SENTINEL_DAYS)
    return f"""
select *, DAYS_DECISION + CNT_PAYMENT * 30 as NEW_RETURN_DAY,
  DAYS_TERMINATION - (DAYS_DECISION + CNT_PAYMENT * 30) as NEW_DAYS_TERMINATION_DIFF,
  AMT_APPLICATION - AMT_CREDIT as APPLICATION_CREDIT_DIFF, {div('AMT_APPLICATION', 'AMT_CREDIT')} as APPLICATION_CREDIT_RATIO,
  {div('AMT_CREDIT', 'AMT_GOODS_PRICE')} as NEW_CREDIT_GOODS_RATE, {div('AMT_CREDIT', 'AMT_ANNUITY')} as CREDIT_TO_ANNUITY_RATIO,
  {div('AMT_DOWN_PAYMENT', 'AMT_CREDIT')} as DOWN_PAYMENT_TO_CREDIT,
  DAYS_LAST_DUE_1ST_VERSION - DAYS_FIRST_DUE as NEW_DAYS_DUE_DIFF, DAYS_TERMINATION - DAYS_LAST_DUE as NEW_END_DIFF,
  DAYS_LAST_DUE_1ST_VERSION - DAYS_LAST_DUE as DAYS_LAST_DUE_DIFF,
  ({div('AMT_ANNUITY * CNT_PAYMENT', 'AMT_CREDIT')} - 1) / nullif(CNT_PAYMENT, 0) as SIMPLE_INTERESTS,
  CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT as AMT_INTEREST,
  {div('(CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT)', 'AMT_CREDIT')} as INTEREST_SHARE,
  {div('24 * (CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT)', 'AMT_CREDIT * (CNT_PAYMENT + 1)')} as INTEREST_RATE
from (select * replace ({nulled}),
        {flag("NAME_CONTRACT_STATUS = 'Approved' and DAYS_LAST_DUE = 365243")} as IS_ACTIVE
      from {role_sql('previous_application')})"""


def previous() -> str:
    dummies = [(c, v) for c in specs.PREVIOUS_CATEGORIES for v in PREVIOUS_DOMAINS[c]]
    made = ", ".join(f"{flag(f"{c} = '{v}'")} as {q(f'{c}_{v}')}" for c, v in dummies)
    general = {**specs.PREVIOUS_GENERAL, **{f"{c}_{v}": ["mean"] for c, v in dummies}}
    blocks = [block("PREV_", general), block("PREV_ACTIVE_", specs.PREVIOUS_ACTIVE, "IS_ACTIVE = 1"),
              block("APPROVED_", specs.PREVIOUS_APPROVED, "NAME_CONTRACT_STATUS = 'Approved'"),
              block("REFUSED_", specs.PREVIOUS_REFUSED, "NAME_CONTRACT_STATUS = 'Refused'")]
    blocks += [block(f"PREV_{v.split(' ')[0]}_", specs.PREVIOUS_LOAN_TYPE, f"NAME_CONTRACT_TYPE = '{v}'")
               for v in specs.PREVIOUS_TYPES]
    blocks.append(block("PREV_LATE_", specs.PREVIOUS_LATE, "EVER_LATE = 1"))
    blocks += [block(f"PREV_LAST{m}M_", specs.PREVIOUS_RECENT, f"DAYS_DECISION >= {-30 * m}") for m in (6, 12, 24)]
    return f"""
with p as ({previous_rows()}),
pay as (select SK_ID_PREV, coalesce(sum(AMT_INSTALMENT), 0) as AMT_INSTALMENT, coalesce(sum(AMT_PAYMENT), 0) as AMT_PAYMENT,
    max({flag('DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT')}) as EVER_LATE from {role_sql('installments_payments')} group by 1),
r as (select p.*, AMT_PAYMENT, EVER_LATE, AMT_INSTALMENT - AMT_PAYMENT as INSTALMENT_PAYMENT_DIFF,
    AMT_CREDIT - AMT_PAYMENT as REMAINING_DEBT, {div('AMT_PAYMENT', 'AMT_CREDIT')} as REPAYMENT_RATIO, {made}
    from p left join pay on p.SK_ID_PREV = pay.SK_ID_PREV),
g as (select SK_ID_CURR, {', '.join(blocks)} from r group by SK_ID_CURR)
select *, {ratio_list([("TOTAL_REPAYMENT_RATIO", "PREV_ACTIVE_AMT_PAYMENT_SUM", "PREV_ACTIVE_AMT_CREDIT_SUM")])} from g"""


def pos() -> str:
    statuses = ["Active", "Completed", "Signed"]
    shares = ", ".join(f"avg({flag(f"NAME_CONTRACT_STATUS = '{v}'")}) as {q(f'POS_NAME_CONTRACT_STATUS_{v}_MEAN')}"
                       for v in statuses)
    return f"""
with n as (select * replace (abs(MONTHS_BALANCE) as MONTHS_BALANCE), MONTHS_BALANCE as MONTH,
    {flag('SK_DPD > 0')} as LATE_PAYMENT,
    row_number() over (partition by SK_ID_PREV order by MONTHS_BALANCE, ROW_ID) as rn from {role_sql('POS_CASH_balance')}),
r as (select *, {ewma_columns(['CNT_INSTALMENT', 'CNT_INSTALMENT_FUTURE'], 0.6, 'SK_ID_PREV')} from n),
g as (select SK_ID_CURR, {block('POS_', specs.POS_GENERAL, None, 'MONTH, SK_ID_PREV, ROW_ID')}, {shares} from r group by 1),
loan as (select SK_ID_CURR, SK_ID_PREV, avg({flag("NAME_CONTRACT_STATUS = 'Completed'")}) as done,
    first(CNT_INSTALMENT order by MONTH, ROW_ID) filter (where CNT_INSTALMENT is not null) as t0,
    last(CNT_INSTALMENT order by MONTH, ROW_ID) filter (where CNT_INSTALMENT is not null) as t1,
    last(CNT_INSTALMENT_FUTURE order by MONTH, ROW_ID) filter (where CNT_INSTALMENT_FUTURE is not null) as remaining,
    max(MONTH) as newest, sum(LATE_PAYMENT) as late from r group by 1, 2),
c as (select SK_ID_CURR, sum(done) as POS_LOAN_COMPLETED_MEAN, sum({flag('t0 - t1 > 0 and done > 0')}) as POS_COMPLETED_BEFORE_MEAN,
    coalesce(sum(remaining), 0) as POS_REMAINING_INSTALMENTS,
    coalesce(sum({div('remaining', 't1')}), 0) as POS_REMAINING_INSTALMENTS_RATIO from loan group by 1),
l as (select SK_ID_CURR, avg(late) as LATE_PAYMENT_SUM from
    (select *, row_number() over (partition by SK_ID_CURR order by newest desc, SK_ID_PREV desc) as k from loan) where k <= 3 group by 1)
select g.*, c.* exclude (SK_ID_CURR), l.* exclude (SK_ID_CURR) from g
left join c on g.SK_ID_CURR = c.SK_ID_CURR left join l on g.SK_ID_CURR = l.SK_ID_CURR"""


def installment_rows() -> str:
    return f"""
select *, AMT_INSTALMENT - GROUPED as PAYMENT_DIFFERENCE, {div('AMT_INSTALMENT', 'GROUPED')} as PAYMENT_RATIO,
  {flag('PAID_OVER_AMOUNT > 0')} as PAID_OVER, {flag('DPD > 0')} as LATE_PAYMENT, {flag('DPD >= 7')} as DPD_7,
  {flag('DPD >= 15')} as DPD_15, {flag('DPD > 0 and DPD < 120')} as INS_IS_DPD_UNDER_120,
  {flag('DPD >= 120')} as INS_IS_DPD_OVER_120, case when DPD > 0 then PAYMENT_PERC else 0 end as LATE_PAYMENT_RATIO,
  {flag('DPD > 0 and PAYMENT_PERC > cast(0.05 as double)')} as SIGNIFICANT_LATE_PAYMENT
from (select *, coalesce(sum(AMT_PAYMENT) over (partition by SK_ID_PREV, NUM_INSTALMENT_NUMBER), 0) as GROUPED,
    max(DAYS_INSTALMENT) over (partition by SK_ID_PREV) as LAST_DAY,
    AMT_PAYMENT - AMT_INSTALMENT as PAID_OVER_AMOUNT, AMT_INSTALMENT - AMT_PAYMENT as PAYMENT_DIFF,
    {div('AMT_PAYMENT', 'AMT_INSTALMENT')} as PAYMENT_PERC,
    DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT as DPD_diff, DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT as DBD_diff,
    case when DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT <= 0 then 0 else DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT end as DPD,
    case when DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT <= 0 then 0 else DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT end as DBD
  from {role_sql('installments_payments')})"""


NEWEST_FIRST = ("DAYS_INSTALMENT desc nulls last, SK_ID_PREV nulls first, NUM_INSTALMENT_NUMBER nulls first, "
                "DAYS_ENTRY_PAYMENT nulls first, AMT_INSTALMENT nulls first, AMT_PAYMENT nulls first, "
                "NUM_INSTALMENT_VERSION nulls first")


def trend(column: str, k: int) -> str:
    y = f"({column}) filter (where x < {k})"
    return (f"case when count{y} < count(*) filter (where x < {k}) then null "
            f"when count(*) filter (where x < {k}) = 1 then 0 "
            f"else regr_slope({column}, x) filter (where x < {k}) end as {q(f'{k}_TREND_{column}')}")


def installments(detailed: bool = True) -> str:
    blocks = [block("INS_", specs.INSTALLMENTS_GENERAL)]
    blocks += [block(f"INS_{m}M_", specs.INSTALLMENTS_RECENT, f"LAST_DAY >= {-30 * m}") for m in specs.INSTALLMENT_WINDOWS]
    blocks += [block("INSTAL_", {"NUM_INSTALMENT_VERSION": ["nunique"]}),
               block("INS_D365", specs.INSTALLMENTS_YEAR, "DAYS_ENTRY_PAYMENT >= -365"), "count(*) as INSTAL_COUNT"]
    if detailed:
        blocks.append(block("INS_GEN_", specs.INSTALLMENTS_DETAILED))
    trends = ", ".join(trend(c, k) for k in specs.TREND_PERIODS for c in ("DPD", "PAID_OVER_AMOUNT"))
    last = ", ".join(f"{measure(c, fn)} as {q(f'LAST_LOAN_{c}_{fn}')}" for c, fns in specs.LAST_LOAN.items() for fn in fns)
    return f"""
with r as ({installment_rows()}),
g as (select SK_ID_CURR, {', '.join(blocks)} from r group by 1),
n as (select *, row_number() over (partition by SK_ID_CURR order by {NEWEST_FIRST}) - 1 as x,
    first(SK_ID_PREV) over (partition by SK_ID_CURR order by DAYS_INSTALMENT desc nulls last, SK_ID_PREV
        rows between unbounded preceding and unbounded following) as newest_loan from r),
t as (select SK_ID_CURR, {trends} from n group by 1),
l as (select SK_ID_CURR, {last} from n where SK_ID_PREV = newest_loan group by 1)
select g.*, t.* exclude (SK_ID_CURR), l.* exclude (SK_ID_CURR) from g
left join t on g.SK_ID_CURR = t.SK_ID_CURR left join l on g.SK_ID_CURR = l.SK_ID_CURR"""


CARD_ROWS = f"""
select * rename (AMT_RECIVABLE as AMT_RECEIVABLE), {ratio_list([
    ("LIMIT_USE", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
    ("PAYMENT_DIV_MIN", "AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY"),
    ("BALANCE_LIMIT_RATIO", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
    ("MIN_PAYMENT_RATIO", "AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY"),
    ("MIN_PAYMENT_TOTAL_RATIO", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY"),
    ("SK_DPD_RATIO", "SK_DPD", "SK_DPD_DEF")])},
  AMT_PAYMENT_CURRENT - AMT_INST_MIN_REGULARITY as PAYMENT_MIN_DIFF,
  AMT_TOTAL_RECEIVABLE - AMT_RECEIVABLE_PRINCIPAL as AMT_INTEREST_RECEIVABLE, {flag('SK_DPD > 0')} as LATE_PAYMENT,
  coalesce(AMT_DRAWINGS_ATM_CURRENT, 0) + coalesce(AMT_DRAWINGS_CURRENT, 0) + coalesce(AMT_DRAWINGS_OTHER_CURRENT, 0)
    + coalesce(AMT_DRAWINGS_POS_CURRENT, 0) as AMT_DRAWING_SUM,
  coalesce(CNT_DRAWINGS_ATM_CURRENT, 0) + coalesce(CNT_DRAWINGS_CURRENT, 0) + coalesce(CNT_DRAWINGS_OTHER_CURRENT, 0)
    + coalesce(CNT_DRAWINGS_POS_CURRENT, 0) + coalesce(CNT_INSTALMENT_MATURE_CUM, 0) as CNT_DRAWING_SUM,
  row_number() over (partition by SK_ID_CURR, SK_ID_PREV order by MONTHS_BALANCE, ROW_ID) as rn,
  max(MONTHS_BALANCE) over (partition by SK_ID_PREV) as LAST_DAY
from {role_sql('credit_card_balance')}"""


def card() -> str:
    order = "MONTHS_BALANCE, SK_ID_PREV, ROW_ID"
    blocks = [block("CC_", specs.CARD_GENERAL, None, order)]
    blocks += [block(f"CC_{m}M_", specs.CARD_RECENT, f"LAST_DAY >= {-m}", order) for m in specs.CARD_WINDOWS]
    return f"""
with n as ({CARD_ROWS}),
r as (select *, {ewma_columns(specs.CARD_SMOOTHED, 0.7, 'SK_ID_CURR, SK_ID_PREV')} from n),
g as (select SK_ID_CURR, {', '.join(blocks)} from r group by 1),
newest as (select SK_ID_CURR, AMT_BALANCE,
    row_number() over (partition by SK_ID_PREV order by MONTHS_BALANCE desc, ROW_ID desc) as k from r),
b as (select SK_ID_CURR, {block('CC_LAST_', {'AMT_BALANCE': ['mean', 'max']})} from newest where k = 1 group by 1),
loan as (select SK_ID_CURR, SK_ID_PREV, max(CNT_INSTALMENT_MATURE_CUM) as instalments,
    sum(case when SK_DPD = 0 then 0 else 1 end) as dpd_months from r group by 1, 2),
o as (select SK_ID_CURR, floor(coalesce(sum(instalments), 0) / count(SK_ID_PREV)) as INSTALLMENTS_PER_LOAN,
    avg(dpd_months) as DPD_COUNT from loan group by 1),
d as (select SK_ID_CURR, 100 * sum({flag('AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY')}) / count(*) as PERCENTAGE_MISSED_PAYMENTS,
    100 * {div('coalesce(sum(AMT_DRAWINGS_ATM_CURRENT), 0)', 'coalesce(sum(AMT_DRAWINGS_CURRENT), 0)')} as CASH_CARD_RATIO,
    100 * {div('coalesce(sum(AMT_DRAWINGS_CURRENT), 0)', 'coalesce(sum(CNT_DRAWINGS_CURRENT), 0)')} as DRAWINGS_RATIO
    from r group by 1)
select g.*, b.* exclude (SK_ID_CURR), o.* exclude (SK_ID_CURR), d.* exclude (SK_ID_CURR) from g
left join b on g.SK_ID_CURR = b.SK_ID_CURR left join o on g.SK_ID_CURR = o.SK_ID_CURR
left join d on g.SK_ID_CURR = d.SK_ID_CURR"""


def steps(column: str, uppers, default: int, missing: int) -> str:
    cases = " ".join(f"when {column} <= {u} then {i}" for i, u in enumerate(uppers, start=1))
    return f"case when {column} is null then {missing} {cases} else {default} end"


def row_kurtosis(columns) -> str:
    n = len(columns)
    mean = "(" + " + ".join(columns) + f") / cast({n} as double)"
    m2 = " + ".join(f"power({c} - {mean}, 2)" for c in columns)
    m4 = " + ".join(f"power({c} - {mean}, 4)" for c in columns)
    scale, shift = n * (n + 1) * (n - 1) / ((n - 2) * (n - 3)), 3.0 * (n - 1) ** 2 / ((n - 2) * (n - 3))
    return f"case when {m2} = 0 then 0 else cast({scale!r} as double) * ({m4}) / power({m2}, 2) - cast({shift!r} as double) end"


def applicant_rows() -> str:
    strings = COLUMNS["application"]["str"]
    filled = ", ".join(f"coalesce({c}, 'XNA') as {c}" for c in strings)
    s1, s2, s3 = "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"
    present = " + ".join(f"(case when {s} is null then 0 else 1 end)" for s in (s1, s2, s3))
    mean = f"(coalesce({s1}, 0) + coalesce({s2}, 0) + coalesce({s3}, 0)) / nullif({present}, 0)"
    var = "(" + " + ".join(f"coalesce(power({s} - EXT_SOURCES_MEAN, 2), 0)" for s in (s1, s2, s3)) + f") / nullif({present}, 0)"
    housing = {s: " + ".join([f"{m}_{s}" for m in HOUSING] + (["TOTALAREA_MODE"] if s == "MODE" else []))
               for s in ("AVG", "MODE", "MEDI")}
    bands = " ".join(f"when AMT_INCOME_TOTAL >= {a} and AMT_INCOME_TOTAL < {'1e300' if b == float('inf') else b} then {i}"
                     for i, (a, b) in enumerate(zip(specs.INCOME_EDGES[:-1], specs.INCOME_EDGES[1:]), start=1))
    assets = " ".join(f"when FLAG_OWN_CAR = '{a}' and FLAG_OWN_REALTY = '{b}' then {v}"
                      for (a, b), v in specs.ASSET_LABELS.items())
    circle = [f"{k}_{d}_CNT_SOCIAL_CIRCLE" for d in (30, 60) for k in ("OBS", "DEF")]
    return f"""
select * exclude (BIRTH_OFFSET, CHILDREN_PLUS_ONE),
  {steps('CREDIT_TO_ANNUITY_RATIO', specs.DURATION_UPPERS, 7, 0)} as CREDIT_TO_ANNUITY_GROUP
from (select *, {ratio_list(specs.APPLICANT_RATIOS)}, {var} as EXT_SOURCES_VAR,
    APARTMENTS_SUM_AVG * AMT_INCOME_TOTAL as INCOME_APARTMENT_AVG_MUL,
    APARTMENTS_SUM_MODE * AMT_INCOME_TOTAL as INCOME_APARTMENT_MODE_MUL,
    APARTMENTS_SUM_MEDI * AMT_INCOME_TOTAL as INCOME_APARTMENT_MEDI_MUL
  from (select *, {' + '.join(DOCUMENT_FLAGS)} as DOCUMENT_COUNT, {row_kurtosis(DOCUMENT_FLAGS)} as NEW_DOC_KURT,
    {steps('DAYS_BIRTH', specs.AGE_UPPERS, 0, 0)} as AGE_RANGE, {s1} * 2 + {s2} + {s3} * 3 as EXT_SOURCES_WEIGHTED,
    least({s1}, {s2}, {s3}) as EXT_SOURCES_MIN, greatest({s1}, {s2}, {s3}) as EXT_SOURCES_MAX, {mean} as EXT_SOURCES_MEAN,
    case when {present} = 3 then {s1} + {s2} + {s3} - least({s1}, {s2}, {s3}) - greatest({s1}, {s2}, {s3}) end as EXT_SOURCES_MEDIAN,
    {flag('BIRTH_OFFSET < -14000')} as RETIREMENT_AGE, {flag('DAYS_EMPLOYED < -2000')} as LONG_EMPLOYMENT,
    case {bands} end as INCOME_BAND, case {assets} end as FLAG_ASSET, CNT_CHILDREN + 1 as CHILDREN_PLUS_ONE,
    power({s1}, 2) as "EXT_SOURCE_1^2", power({s2}, 2) as "EXT_SOURCE_2^2", power({s3}, 2) as "EXT_SOURCE_3^2",
    {housing['AVG']} as APARTMENTS_SUM_AVG, {housing['MODE']} as APARTMENTS_SUM_MODE, {housing['MEDI']} as APARTMENTS_SUM_MEDI,
    OBS_30_CNT_SOCIAL_CIRCLE + OBS_60_CNT_SOCIAL_CIRCLE as OBS_30_60_SUM,
    DEF_30_CNT_SOCIAL_CIRCLE + DEF_60_CNT_SOCIAL_CIRCLE as DEF_30_60_SUM, {' + '.join(circle)} as SUM_OBS_DEF_ALL,
    {' + '.join(specs.SUMMED_DOCUMENTS)} as SUM_FLAGS_DOCUMENTS,
    DAYS_LAST_PHONE_CHANGE + DAYS_REGISTRATION + DAYS_ID_PUBLISH as DAYS_DETAILS_CHANGE_SUM,
    DAYS_LAST_PHONE_CHANGE * DAYS_REGISTRATION * DAYS_ID_PUBLISH as DAYS_DETAILS_CHANGE_MUL,
    {' + '.join(ENQUIRIES)} as AMT_ENQ_SUM, {s1} * {s2} * {s3} as EXT_SOURCES_PROD,
    {s1} * {s2} as "EXT_SOURCE_1 EXT_SOURCE_2", {s1} * {s3} as "EXT_SOURCE_1 EXT_SOURCE_3", {s2} * {s3} as "EXT_SOURCE_2 EXT_SOURCE_3",
    OBS_30_CNT_SOCIAL_CIRCLE * DEF_30_CNT_SOCIAL_CIRCLE as OBS_DEF_30_MUL,
    OBS_60_CNT_SOCIAL_CIRCLE * DEF_60_CNT_SOCIAL_CIRCLE as OBS_DEF_60_MUL,
    AMT_INCOME_TOTAL - AMT_ANNUITY as INCOME_ANNUITY_DIFF, CNT_FAM_MEMBERS - CNT_CHILDREN as CNT_NON_CHILD
  from (select * replace ({filled}, nullif(DAYS_EMPLOYED, 365243) as DAYS_EMPLOYED,
      nullif(DAYS_LAST_PHONE_CHANGE, 0) as DAYS_LAST_PHONE_CHANGE, -DAYS_BIRTH / cast(365 as double) as DAYS_BIRTH),
      DAYS_BIRTH as BIRTH_OFFSET from {role_sql('application')})))"""


def stat_join(name: str, keys, stats) -> tuple[str, str]:
    body = ", ".join(f"{measure(c, fn)} as {q(out)}" for out, (c, fn) in stats.items())
    cols = ", ".join(q(k) for k in keys)
    on = " and ".join(f"a.{q(k)} = {name}.{q(k)}" for k in keys)
    present = " and ".join(f"{q(k)} is not null" for k in keys)
    return f"{name} as (select {cols}, {body} from a where {present} group by {cols})", f"left join {name} on {on}"


def application() -> str:
    wanted = [(["ORGANIZATION_TYPE"], {"NEW_INC_BY_ORG": ("AMT_INCOME_TOTAL", "median")}),
              (specs.PEER_KEYS, specs.PEER_STATS), (specs.DURATION_KEYS, specs.DURATION_STATS)]
    wanted += [(keys, {f"{c}_{fn.upper()}_AGG_{'_'.join(keys)}": (c, fn)
                       for c, fns in specs.INTERACTION_SPEC.items() for fn in fns}) for keys in specs.INTERACTION_KEYS]
    parts = [stat_join(f"s{i}", keys, stats) for i, (keys, stats) in enumerate(wanted)]
    outs = ", ".join(f"s{i}.{q(o)}" for i, (_, stats) in enumerate(wanted) for o in stats)
    codes = ", ".join(f"list_position((select list_sort(list(distinct {c})) from a), {c}) - 1 as {c}"
                      for c in COLUMNS["application"]["str"])
    edges = " + ".join(f"(case when a.DAYS_BIRTH > (select quantile_cont(DAYS_BIRTH, {p}) from a) then 1 else 0 end)"
                       for p in (0.2, 0.4, 0.6, 0.8))
    drops = ", ".join(specs.APPLICANT_DROPS)
    return f"""
with a as ({applicant_rows()}), {', '.join(cte for cte, _ in parts)},
j as (select a.*, {edges} as DAYS_BIRTH_QCUT, {outs} from a {' '.join(join for _, join in parts)})
select * exclude ({drops}) from (select * replace ({codes}) from j)"""


def master() -> str:
    named = {"app": application(), "bur": bureau(), "prv": previous(), "psc": pos(), "ins": installments(detailed=False), "crd": card()}
    joins = " ".join(f"left join {k} on app.SK_ID_CURR = {k}.SK_ID_CURR" for k in list(named)[1:])
    stars = ", ".join(f"{k}.* exclude (SK_ID_CURR)" for k in list(named)[1:])
    stats = ", ".join(f"{measure(c, fn)} as {q(f'CTAR_{c}_{fn.upper()}')}"
                      for c in specs.DURATION_GROUP_FEATURES for fn in ("mean", "median", "std"))
    return f"""
with {', '.join(f'{k} as ({v})' for k, v in named.items())},
m as (select *, {ratio_list(specs.CROSS_TABLE_RATIOS)} from (select app.*, {stars} from app {joins})),
c as (select CREDIT_TO_ANNUITY_RATIO, {stats} from m where CREDIT_TO_ANNUITY_RATIO is not null group by 1)
select m.*, c.* exclude (CREDIT_TO_ANNUITY_RATIO) from m left join c on m.CREDIT_TO_ANNUITY_RATIO = c.CREDIT_TO_ANNUITY_RATIO"""
