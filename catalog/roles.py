"""The seven credit tables derived from the benchmark tables.

Each role is one SQL text that both engines accept, so that the presets and
their oracles read identical rows.  Amounts are whole numbers, scores are
multiples of 1/64: sums of them are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.schemas import COLUMNS, DOCUMENT_FLAGS, ENQUIRIES, HOUSING_COLUMNS

EPOCH = "2001-08-02"


def day(column: str, dialect: str) -> str:
    """Whole days from the reference date (negative = before)."""
    if dialect == "spark":
        return f"datediff({column}, DATE '{EPOCH}')"
    return f"date_diff('day', TIMESTAMP '{EPOCH}', {column})"


def _pick(expr: str, values: list[str]) -> str:
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {expr} {cases} end"


def _application(dialect: str, labelled: bool | None) -> str:
    k = "c.c_custkey"
    num = {
        "AMT_INCOME_TOTAL": f"25000 + ({k} * 7919) % 320000",
        "AMT_CREDIT": f"case when {k} % 3 = 0 then 50000 + ({k} * 104729) % 900000 "
                      f"else (5000 + ({k} * 131) % 40000) * (4 + {k} % 41) end",
        "AMT_ANNUITY": f"case when {k} % 23 = 0 then null else 5000 + ({k} * 131) % 40000 end",
        "AMT_GOODS_PRICE": "case when c.c_acctbal < -900 then null else floor(c.c_acctbal) + 1000 end",
        "EXT_SOURCE_1": f"case when {k} % 2 = 0 then null else (({k} * 37) % 64) / 64 end",
        "EXT_SOURCE_2": f"case when {k} % 29 = 0 then null else (({k} * 11 + 5) % 64) / 64 end",
        "EXT_SOURCE_3": f"case when {k} % 5 = 1 then null else (({k} * 23 + 1) % 64) / 64 end",
        "OWN_CAR_AGE": f"case when {k} % 3 = 0 then null else {k} % 40 end",
        "CNT_FAM_MEMBERS": f"case when {k} % 211 = 0 then null else 1 + {k} % 3 + {k} % 2 end",
        "REGION_POPULATION_RELATIVE": "(1 + c.c_nationkey) / 64",
        "DAYS_EMPLOYED": f"case when {k} % 6 = 0 then 365243 else -(({k} * 17) % 9000) end",
        "DAYS_LAST_PHONE_CHANGE": f"-(({k} * 13) % 1200)",
        "DAYS_REGISTRATION": f"-(({k} * 19) % 15000)",
        "OBS_30_CNT_SOCIAL_CIRCLE": f"case when {k} % 101 = 0 then null else {k} % 35 end",
        "DEF_30_CNT_SOCIAL_CIRCLE": f"{k} % 3",
        "OBS_60_CNT_SOCIAL_CIRCLE": f"case when {k} % 101 = 0 then null else {k} % 33 end",
        "DEF_60_CNT_SOCIAL_CIRCLE": f"{k} % 2",
    }
    num |= {c: f"case when {k} % 13 = 0 then null else ({k} * {i + 3}) % {i + 2} end" for i, c in enumerate(ENQUIRIES)}
    num |= {c: f"case when ({k} + {i}) % 17 = 0 then null else (({k} * {2 * i + 3}) % 64) / 64 end"
            for i, c in enumerate(HOUSING_COLUMNS)}
    ints = {
        "DAYS_BIRTH": f"-(7500 + ({k} * 31) % 17500)", "DAYS_ID_PUBLISH": f"-(({k} * 29) % 6000)",
        "CNT_CHILDREN": f"{k} % 3", "REGION_RATING_CLIENT": f"1 + {k} % 3",
        "REGION_RATING_CLIENT_W_CITY": f"1 + ({k} + 1) % 3", "HOUR_APPR_PROCESS_START": f"{k} % 24",
    }
    ints |= {c: f"case when ({k} * {i + 5}) % {i + 3} = 0 then 1 else 0 end" for i, c in enumerate(DOCUMENT_FLAGS)}
    for i, c in enumerate(COLUMNS["application"]["int"]):
        if c not in ints and c != "TARGET":
            ints[c] = f"case when ({k} + {i}) % {i % 5 + 2} = 0 then 1 else 0 end"
    strs = {
        "NAME_CONTRACT_TYPE": f"case when {k} % 4 = 0 then 'Revolving loans' else 'Cash loans' end",
        "CODE_GENDER": f"case when {k} % 3 = 0 then 'M' else 'F' end",
        "FLAG_OWN_CAR": f"case when {k} % 2 = 0 then 'N' else 'Y' end",
        "FLAG_OWN_REALTY": f"case when {k} % 41 = 0 then null when {k} % 7 < 4 then 'Y' else 'N' end",
        "NAME_INCOME_TYPE": "c.c_mktsegment", "NAME_EDUCATION_TYPE": "r.r_name",
        "NAME_FAMILY_STATUS": _pick(f"{k} % 4", ["Married", "Single", "Separated", "Widow"]),
        "NAME_HOUSING_TYPE": _pick(f"{k} % 3", ["House", "Rented", "Municipal"]),
        "OCCUPATION_TYPE": f"case when {k} % 4 = 1 then null else n.n_name end",
        "ORGANIZATION_TYPE": f"case when {k} % 37 = 0 then null else concat('Type ', cast({k} % 9 as string)) end",
        "WEEKDAY_APPR_PROCESS_START": _pick(f"{k} % 7", ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY",
                                                         "SATURDAY", "SUNDAY"]),
        "HOUSETYPE_MODE": _pick(f"{k} % 5", ["block", "terraced", "specific"]),
        "FONDKAPREMONT_MODE": _pick(f"{k} % 6", ["org", "reg"]),
        "EMERGENCYSTATE_MODE": _pick(f"{k} % 8", ["No", "Yes", "No"]),
    }
    cols = [f"{k} as SK_ID_CURR"]
    label = "case when c.c_acctbal < 0 then 1 else 0 end"
    if labelled:
        cols.append(f"cast({label} as int) as TARGET")
    elif labelled is None:
        cols.append(f"cast(case when {k} % 5 = 0 then null else {label} end as int) as TARGET")
    cols += [f"cast({e} as int) as {c}" for c, e in ints.items()]
    cols += [f"cast({e} as double) as {c}" for c, e in num.items()] + [f"{e} as {c}" for c, e in strs.items()]
    side = {True: f"{k} % 5 <> 0", False: f"{k} % 5 = 0", None: "true"}[labelled]
    return (f"select {', '.join(cols)} from customer c join nation n on c.c_nationkey = n.n_nationkey "
            f"join region r on n.n_regionkey = r.r_regionkey where {side}")


def _bureau(dialect: str) -> str:
    k, opened = "o_orderkey", day("o_orderdate", dialect)
    amount = "floor(o_totalprice)"
    return f"""
select {k} as SK_ID_BUREAU, o_custkey as SK_ID_CURR,
  cast({opened} as int) as DAYS_CREDIT,
  cast(case when {k} % 89 = 0 then null when {k} % 5 = 0 then ({k} * 31) % 400 else 0 end as int) as CREDIT_DAY_OVERDUE,
  cast({k} % 4 as int) as CNT_CREDIT_PROLONG,
  cast(case when {k} % 11 = 0 then null when {k} % 97 = 0 then -20000
       else {opened} + ({k} * 17) % 2000 end as double) as DAYS_CREDIT_ENDDATE,
  cast(case when o_orderstatus <> 'F' then null else {opened} + ({k} * 13) % 1500 end as double) as DAYS_ENDDATE_FACT,
  cast(case when {k} % 103 = 0 then -42000 else -(({k} * 7) % 900) end as double) as DAYS_CREDIT_UPDATE,
  cast(case when {k} % 3 = 0 then null else ({k} * 37) % 5000 end as double) as AMT_CREDIT_MAX_OVERDUE,
  cast({amount} as double) as AMT_CREDIT_SUM,
  cast(case when {k} % 6 = 0 then 0 when {k} % 7 = 0 then null else ({k} * 211) % 50000 end as double) as AMT_CREDIT_SUM_DEBT,
  cast(case when {k} % 9 = 0 then ({k} * 3) % 700 else 0 end as double) as AMT_CREDIT_SUM_OVERDUE,
  cast(case when {k} % 2 = 0 then null else ({k} * 5) % 3000 end as double) as AMT_ANNUITY,
  case o_orderstatus when 'F' then 'Closed' when 'O' then 'Active' else
       case when {k} % 2 = 0 then 'Sold' else 'Bad debt' end end as CREDIT_ACTIVE,
  concat('currency ', cast({k} % 3 as string)) as CREDIT_CURRENCY,
  case substring(o_orderpriority, 1, 1) when '1' then 'Consumer credit' when '2' then 'Credit card'
       when '3' then 'Mortgage' when '4' then 'Car loan' else 'Microloan' end as CREDIT_TYPE
from orders"""


def _bureau_balance(dialect: str) -> str:
    status = _pick("(l_suppkey + l_linenumber) % 8", ["C", "X", "0", "1", "2", "3", "4", "5"])
    return f"""
select l_orderkey as SK_ID_BUREAU, cast(-(l_partkey % 96) as int) as MONTHS_BALANCE, {status} as STATUS
from lineitem"""


def _previous(dialect: str) -> str:
    k, decided = "o_orderkey", day("o_orderdate", dialect)
    amount = "floor(o_totalprice)"
    return f"""
select {k} as SK_ID_PREV, o_custkey as SK_ID_CURR,
  cast({decided} as int) as DAYS_DECISION, cast({k} % 24 as int) as HOUR_APPR_PROCESS_START,
  cast(case when {k} % 50 = 0 then 0 else 1 end as int) as NFLAG_LAST_APPL_IN_DAY,
  cast({amount} as double) as AMT_APPLICATION,
  cast(case when {k} % 31 = 0 then 0 else {amount} + (({k} * 41) % 9000) - 3000 end as double) as AMT_CREDIT,
  cast(case when {k} % 19 = 0 then null when {k} % 43 = 0 then 0 else 500 + ({k} * 61) % 20000 end as double) as AMT_ANNUITY,
  cast(case when {k} % 2 = 0 then null else ({k} * 3) % 8000 end as double) as AMT_DOWN_PAYMENT,
  cast(case when {k} % 8 = 0 then null else {amount} + 500 end as double) as AMT_GOODS_PRICE,
  cast(case when {k} % 2 = 0 then null else ({k} % 64) / 64 end as double) as RATE_DOWN_PAYMENT,
  cast(case when {k} % 17 = 0 then null when {k} % 59 = 0 then 0 else 6 * (1 + {k} % 21) end as double) as CNT_PAYMENT,
  cast(case when {k} % 3 = 0 then 365243 when {k} % 3 = 1 then null else {decided} + {k} % 60 end as double) as DAYS_FIRST_DRAWING,
  cast(case when {k} % 47 = 0 then null else {decided} + 30 end as double) as DAYS_FIRST_DUE,
  cast(case when {k} % 53 = 0 then 365243 else {decided} + ({k} * 7) % 1500 end as double) as DAYS_LAST_DUE_1ST_VERSION,
  cast(case when {k} % 4 = 0 then 365243 when {k} % 67 = 0 then null else {decided} + ({k} * 5) % 1200 end as double) as DAYS_LAST_DUE,
  cast(case when {k} % 4 = 0 then 365243 when {k} % 67 = 0 then null else {decided} + ({k} * 5) % 1200 + {k} % 90 end as double) as DAYS_TERMINATION,
  case o_orderstatus when 'F' then 'Approved' when 'O' then
       case when {k} % 2 = 0 then 'Approved' else 'Refused' end else 'Canceled' end as NAME_CONTRACT_STATUS,
  case {k} % 10 when 9 then 'XNA' else {_pick(f"{k} % 3", ["Consumer loans", "Cash loans", "Revolving loans"])} end as NAME_CONTRACT_TYPE,
  {_pick(f"{k} % 5", ["Stone", "Country-wide", "Contact center", "Car dealer", "Channel of corporate sales"])} as CHANNEL_TYPE,
  {_pick(f"{k} % 6", ["Family", "Unaccompanied", "Children"])} as NAME_TYPE_SUITE,
  {_pick(f"{k} % 5", ["XNA", "low_action", "low_normal", "middle", "high"])} as NAME_YIELD_GROUP,
  {_pick(f"{k} % 7", ["Cash", "POS household", "POS mobile", "Card Street", "Card X-Sell", "Cash Street"])} as PRODUCT_COMBINATION,
  {_pick(f"{k} % 3", ["XNA", "x-sell", "walk-in"])} as NAME_PRODUCT_TYPE,
  {_pick(f"{k} % 4", ["New", "Repeater", "Refreshed", "XNA"])} as NAME_CLIENT_TYPE,
  case when {k} % 100 = 0 then 'N' else 'Y' end as FLAG_LAST_APPL_PER_CONTRACT
from orders"""


def _installments(dialect: str) -> str:
    due = f"{day('o_orderdate', dialect)} + 30 * l_linenumber"
    return f"""
select l_orderkey as SK_ID_PREV, o_custkey as SK_ID_CURR, l_linenumber as NUM_INSTALMENT_NUMBER,
  cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as double) as NUM_INSTALMENT_VERSION,
  cast({due} as double) as DAYS_INSTALMENT,
  cast(case when l_suppkey % 37 = 0 then null when l_partkey % 29 = 0 then {due} + 150
       else {due} + l_partkey % 41 - 20 end as double) as DAYS_ENTRY_PAYMENT,
  cast(case when l_tax = 0 and l_partkey % 2 = 0 then 0 else floor(l_extendedprice) end as double) as AMT_INSTALMENT,
  cast(case when l_suppkey % 37 = 0 then null when l_partkey % 31 = 0 then 0
       else floor(l_extendedprice) + (l_partkey * 7) % 900 - 450 end as double) as AMT_PAYMENT
from lineitem join orders on l_orderkey = o_orderkey"""


def _pos(dialect: str) -> str:
    k = "event_id"
    return f"""
select user_id * 10 + {k} % 3 as SK_ID_PREV, user_id as SK_ID_CURR, {k} as ROW_ID,
  cast(-(({k} * 7) % 97) as int) as MONTHS_BALANCE,
  cast(case when event_type = 'error' then ({k} * 11) % 200 when {k} % 4 = 0 then ({k} * 3) % 40 else 0 end as int) as SK_DPD,
  cast(case when {k} % 9 = 0 then ({k} * 3) % 20 else 0 end as int) as SK_DPD_DEF,
  cast(case when {k} % 41 = 0 then null else 6 * (1 + {k} % 10) end as double) as CNT_INSTALMENT,
  cast(case when {k} % 41 = 0 then null else {k} % 30 end as double) as CNT_INSTALMENT_FUTURE,
  {_pick(f"{k} % 12", ["Active", "Active", "Active", "Active", "Active", "Active", "Completed", "Signed", "Canceled",
                       "Amortized debt", "XNA", "Completed"])} as NAME_CONTRACT_STATUS
from events"""


def _card(dialect: str) -> str:
    k, value = "event_id", "floor(value * 1000)"
    return f"""
select user_id * 10 + {k} % 3 as SK_ID_PREV, user_id as SK_ID_CURR, {k} as ROW_ID,
  cast(-1 - (({k} * 5) % 96) as int) as MONTHS_BALANCE,
  cast(case when event_type = 'error' then ({k} * 11) % 90 else 0 end as int) as SK_DPD,
  cast(case when {k} % 5 = 0 then {k} % 8 else 0 end as int) as SK_DPD_DEF,
  cast({value} as double) as AMT_BALANCE,
  cast(case when {k} % 15 = 0 then 0 else 45000 * (1 + {k} % 5) end as double) as AMT_CREDIT_LIMIT_ACTUAL,
  cast(case when {k} % 6 = 0 then null else ({k} * 13) % 9000 end as double) as AMT_DRAWINGS_ATM_CURRENT,
  cast(({k} * 17) % 20000 as double) as AMT_DRAWINGS_CURRENT,
  cast(case when {k} % 6 = 0 then null else {k} % 10 end as double) as AMT_DRAWINGS_OTHER_CURRENT,
  cast(case when {k} % 6 = 0 then null else ({k} * 7) % 11000 end as double) as AMT_DRAWINGS_POS_CURRENT,
  cast(case when {k} % 14 = 0 then null when {k} % 3 = 0 then 0 else ({k} * 19) % 7000 end as double) as AMT_INST_MIN_REGULARITY,
  cast(case when {k} % 10 = 0 then null else ({k} * 23) % 15000 end as double) as AMT_PAYMENT_CURRENT,
  cast(({k} * 29) % 15000 as double) as AMT_PAYMENT_TOTAL_CURRENT,
  cast({value} - {k} % 900 as double) as AMT_RECEIVABLE_PRINCIPAL,
  cast({value} + {k} % 300 as double) as AMT_RECIVABLE,
  cast({value} + {k} % 700 as double) as AMT_TOTAL_RECEIVABLE,
  cast(case when {k} % 6 = 0 then null else {k} % 4 end as double) as CNT_DRAWINGS_ATM_CURRENT,
  cast({k} % 7 as double) as CNT_DRAWINGS_CURRENT,
  cast(case when {k} % 6 = 0 then null else {k} % 2 end as double) as CNT_DRAWINGS_OTHER_CURRENT,
  cast(case when {k} % 6 = 0 then null else {k} % 9 end as double) as CNT_DRAWINGS_POS_CURRENT,
  cast(case when {k} % 8 = 0 then null else {k} % 36 end as double) as CNT_INSTALMENT_MATURE_CUM,
  case when {k} % 9 = 0 then 'Completed' else 'Active' end as NAME_CONTRACT_STATUS
from events"""


ROLES = {
    "application": lambda d: _application(d, None),
    "application_train": lambda d: _application(d, True), "application_test": lambda d: _application(d, False),
    "bureau": _bureau, "bureau_balance": _bureau_balance, "previous_application": _previous,
    "installments_payments": _installments, "POS_CASH_balance": _pos, "credit_card_balance": _card,
}
BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A credit table as a DataFrame over the benchmark tables."""
    text = ROLES[name]("spark")
    for t in BASE:
        text = text.replace(f"from {t}", f"from {{{t}}}").replace(f"join {t}", f"join {{{t}}}")
    used = {t: base_table(spark, sf_dir, t) for t in BASE if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def role_sql(name: str) -> str:
    """The same table as an oracle subquery."""
    return f"({ROLES[name]('duckdb')})"
