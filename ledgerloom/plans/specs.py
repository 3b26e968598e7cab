"""Aggregation specs of the feature presets.

All tables below are fixed values: the column and function names define the
output column names and must stay as they are.
"""

BUREAU_GENERAL = {
    "SK_ID_BUREAU": ["nunique"],
    "DAYS_CREDIT": ["min", "max", "mean", "var", "count"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["max", "mean", "sum"],
    "AMT_ANNUITY": ["mean"],
    "DEBT_CREDIT_DIFF": ["mean", "sum"],
    "MONTHS_BALANCE_MEAN": ["mean", "var"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
    "CNT_CREDIT_PROLONG": ["mean"],
    "STATUS_0": ["mean"], "STATUS_1": ["mean"], "STATUS_SUM": ["mean"], "STATUS_C": ["mean"], "STATUS_X": ["mean"],
    "CREDIT_ACTIVE_Active": ["mean"], "CREDIT_ACTIVE_Closed": ["mean"], "CREDIT_ACTIVE_Sold": ["mean"],
    "CREDIT_TYPE_Consumer credit": ["mean"], "CREDIT_TYPE_Credit card": ["mean"], "CREDIT_TYPE_Car loan": ["mean"],
    "CREDIT_TYPE_Mortgage": ["mean"], "CREDIT_TYPE_Microloan": ["mean"],
    "LL_AMT_CREDIT_SUM_OVERDUE": ["mean"], "LL_DEBT_CREDIT_DIFF": ["mean"], "LL_STATUS_SUM": ["mean"],
}
BUREAU_ACTIVE = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "var", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_SUM": ["max", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["max", "mean"],
    "DAYS_CREDIT_UPDATE": ["min", "mean"],
    "DEBT_PERCENTAGE": ["mean"],
    "DEBT_CREDIT_DIFF": ["mean"],
    "CREDIT_TO_ANNUITY_RATIO": ["mean"],
    "MONTHS_BALANCE_MEAN": ["mean", "var"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
BUREAU_CLOSED = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "sum"],
    "DAYS_CREDIT_UPDATE": ["max"],
    "ENDDATE_DIF": ["mean"],
    "STATUS_SUM": ["mean"],
}
BUREAU_LOAN_TYPE = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean", "max"],
    "AMT_CREDIT_SUM": ["mean", "max"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "max"],
    "DEBT_PERCENTAGE": ["mean"],
    "DEBT_CREDIT_DIFF": ["mean"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
}
BUREAU_RECENT = {
    "AMT_CREDIT_MAX_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
    "DEBT_PERCENTAGE": ["mean"],
    "DEBT_CREDIT_DIFF": ["mean"],
    "STATUS_0": ["mean"],
    "STATUS_SUM": ["mean"],
}
BALANCE_MONTHS = {"MONTHS_BALANCE": ["min", "max", "mean", "size", "var"]}
BALANCE_STATUSES = ["0", "1", "2", "3", "4", "5", "C", "X"]
BUREAU_STATUSES = ["Active", "Closed", "Sold", "Bad debt"]
BUREAU_TYPES = ["Consumer credit", "Credit card", "Mortgage", "Car loan", "Microloan"]
COHORT_FEATURES = ["AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT",
                   "DEBT_PERCENTAGE", "DEBT_CREDIT_DIFF", "STATUS_0", "STATUS_SUM"]

PREVIOUS_GENERAL = {
    "SK_ID_PREV": ["nunique"],
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_DOWN_PAYMENT": ["max", "mean"],
    "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
    "RATE_DOWN_PAYMENT": ["max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["max", "mean"],
    "DAYS_TERMINATION": ["max"],
    "CREDIT_TO_ANNUITY_RATIO": ["mean", "max"],
    "APPLICATION_CREDIT_DIFF": ["min", "max", "mean"],
    "APPLICATION_CREDIT_RATIO": ["min", "max", "mean", "var"],
    "DOWN_PAYMENT_TO_CREDIT": ["mean"],
    "NEW_CREDIT_GOODS_RATE": ["mean", "max", "var", "min"],
    "NEW_END_DIFF": ["min", "max"],
    "NEW_DAYS_DUE_DIFF": ["min", "max"],
    "NEW_RETURN_DAY": ["min", "max"],
}
PREVIOUS_ACTIVE = {
    "SK_ID_PREV": ["nunique"],
    "SIMPLE_INTERESTS": ["mean"],
    "AMT_ANNUITY": ["max", "sum"],
    "AMT_APPLICATION": ["max", "mean"],
    "AMT_CREDIT": ["sum"],
    "AMT_DOWN_PAYMENT": ["max", "mean"],
    "DAYS_DECISION": ["min", "mean"],
    "CNT_PAYMENT": ["mean", "sum"],
    "DAYS_LAST_DUE_1ST_VERSION": ["min", "max", "mean"],
    "AMT_PAYMENT": ["sum"],
    "INSTALMENT_PAYMENT_DIFF": ["mean", "max"],
    "REMAINING_DEBT": ["max", "mean", "sum"],
    "REPAYMENT_RATIO": ["mean"],
}
PREVIOUS_APPROVED = {
    "SK_ID_PREV": ["nunique"],
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "AMT_DOWN_PAYMENT": ["max"],
    "AMT_GOODS_PRICE": ["max"],
    "HOUR_APPR_PROCESS_START": ["min", "max"],
    "DAYS_DECISION": ["min", "mean"],
    "CNT_PAYMENT": ["max", "mean"],
    "DAYS_TERMINATION": ["mean"],
    "CREDIT_TO_ANNUITY_RATIO": ["mean", "max"],
    "APPLICATION_CREDIT_DIFF": ["max"],
    "APPLICATION_CREDIT_RATIO": ["min", "max", "mean"],
    "DAYS_FIRST_DRAWING": ["max", "mean"],
    "DAYS_FIRST_DUE": ["min", "mean"],
    "DAYS_LAST_DUE_1ST_VERSION": ["min", "max", "mean"],
    "DAYS_LAST_DUE": ["max", "mean"],
    "DAYS_LAST_DUE_DIFF": ["min", "max", "mean"],
    "SIMPLE_INTERESTS": ["min", "max", "mean"],
    "AMT_INTEREST": ["min", "max", "mean"],
    "INTEREST_SHARE": ["min", "max", "mean"],
    "INTEREST_RATE": ["min", "max", "mean"],
}
PREVIOUS_REFUSED = {
    "AMT_APPLICATION": ["max", "mean"],
    "AMT_CREDIT": ["min", "max"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["max", "mean"],
    "APPLICATION_CREDIT_DIFF": ["min", "max", "mean", "var"],
    "APPLICATION_CREDIT_RATIO": ["min", "mean"],
    "NAME_CONTRACT_TYPE_Consumer loans": ["mean"],
    "NAME_CONTRACT_TYPE_Cash loans": ["mean"],
    "NAME_CONTRACT_TYPE_Revolving loans": ["mean"],
}
PREVIOUS_LATE = {
    "DAYS_DECISION": ["min", "max", "mean"],
    "DAYS_LAST_DUE_1ST_VERSION": ["min", "max", "mean"],
    "APPLICATION_CREDIT_DIFF": ["min"],
    "NAME_CONTRACT_TYPE_Consumer loans": ["mean"],
    "NAME_CONTRACT_TYPE_Cash loans": ["mean"],
    "NAME_CONTRACT_TYPE_Revolving loans": ["mean"],
}
PREVIOUS_LOAN_TYPE = {
    "AMT_CREDIT": ["sum"],
    "AMT_ANNUITY": ["mean", "max"],
    "SIMPLE_INTERESTS": ["min", "mean", "max", "var"],
    "APPLICATION_CREDIT_DIFF": ["min", "var"],
    "APPLICATION_CREDIT_RATIO": ["min", "max", "mean"],
    "DAYS_DECISION": ["max"],
    "DAYS_LAST_DUE_1ST_VERSION": ["max", "mean"],
    "CNT_PAYMENT": ["mean"],
}
PREVIOUS_RECENT = {
    "AMT_CREDIT": ["sum"],
    "AMT_ANNUITY": ["mean", "max"],
    "SIMPLE_INTERESTS": ["mean", "max"],
    "DAYS_DECISION": ["min", "mean"],
    "DAYS_LAST_DUE_1ST_VERSION": ["min", "max", "mean"],
    "APPLICATION_CREDIT_DIFF": ["min"],
    "APPLICATION_CREDIT_RATIO": ["min", "max", "mean"],
    "NAME_CONTRACT_TYPE_Consumer loans": ["mean"],
    "NAME_CONTRACT_TYPE_Cash loans": ["mean"],
    "NAME_CONTRACT_TYPE_Revolving loans": ["mean"],
}
PREVIOUS_SENTINEL_DAYS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE",
                          "DAYS_TERMINATION"]
PREVIOUS_CATEGORIES = ["NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "CHANNEL_TYPE", "NAME_TYPE_SUITE",
                       "NAME_YIELD_GROUP", "PRODUCT_COMBINATION", "NAME_PRODUCT_TYPE", "NAME_CLIENT_TYPE"]
PREVIOUS_TYPES = ["Consumer loans", "Cash loans"]

TREND_PERIODS = [12, 24, 60, 120]
INSTALLMENTS_GENERAL = {
    "SK_ID_PREV": ["size", "nunique"],
    "DAYS_ENTRY_PAYMENT": ["min", "max", "mean"],
    "AMT_INSTALMENT": ["min", "max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DPD": ["max", "mean", "var"],
    "DBD": ["max", "mean", "var"],
    "PAYMENT_DIFFERENCE": ["mean"],
    "PAYMENT_RATIO": ["mean"],
    "LATE_PAYMENT": ["mean", "sum"],
    "SIGNIFICANT_LATE_PAYMENT": ["mean", "sum"],
    "LATE_PAYMENT_RATIO": ["mean"],
    "DPD_7": ["mean"],
    "DPD_15": ["mean"],
    "PAID_OVER": ["mean"],
    "INS_IS_DPD_UNDER_120": ["mean", "sum"],
    "INS_IS_DPD_OVER_120": ["mean", "sum"],
}
INSTALLMENTS_DETAILED = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum", "var"],
    "DBD": ["max", "mean", "sum", "var"],
    "PAYMENT_PERC": ["max", "mean", "sum", "var"],
    "PAYMENT_DIFF": ["max", "mean", "sum", "var"],
    "AMT_INSTALMENT": ["max", "mean", "sum", "min"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum", "min"],
    "SK_ID_PREV": ["size", "nunique"],
    "PAYMENT_DIFFERENCE": ["mean"],
    "PAYMENT_RATIO": ["mean", "max"],
    "LATE_PAYMENT": ["mean", "sum"],
    "SIGNIFICANT_LATE_PAYMENT": ["mean", "sum"],
    "LATE_PAYMENT_RATIO": ["mean"],
    "DPD_7": ["mean"],
    "DPD_15": ["mean"],
    "PAID_OVER": ["mean"],
    "DPD_diff": ["mean", "min", "max"],
    "DBD_diff": ["mean", "min", "max"],
    "DAYS_INSTALMENT": ["mean", "max", "sum"],
    "INS_IS_DPD_UNDER_120": ["mean", "sum"],
    "INS_IS_DPD_OVER_120": ["mean", "sum"],
}
INSTALLMENTS_YEAR = {
    "SK_ID_CURR": ["count"],
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DAYS_ENTRY_PAYMENT": ["mean", "max", "sum"],
    "DAYS_INSTALMENT": ["mean", "max", "sum"],
    "AMT_INSTALMENT": ["mean", "max", "sum"],
    "AMT_PAYMENT": ["mean", "max", "sum"],
    "PAYMENT_DIFF": ["mean", "min", "max", "sum"],
    "PAYMENT_PERC": ["mean", "max"],
    "DPD_diff": ["mean", "min", "max"],
    "DPD": ["mean", "sum"],
    "INS_IS_DPD_UNDER_120": ["mean", "sum"],
    "INS_IS_DPD_OVER_120": ["mean", "sum"],
}
INSTALLMENTS_RECENT = {
    "SK_ID_PREV": ["size"],
    "DAYS_ENTRY_PAYMENT": ["min", "max", "mean"],
    "AMT_INSTALMENT": ["min", "max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DPD": ["max", "mean", "var"],
    "DBD": ["max", "mean", "var"],
    "PAYMENT_DIFFERENCE": ["mean"],
    "PAYMENT_RATIO": ["mean"],
    "LATE_PAYMENT": ["mean"],
    "SIGNIFICANT_LATE_PAYMENT": ["mean"],
    "LATE_PAYMENT_RATIO": ["mean"],
    "DPD_7": ["mean"],
    "DPD_15": ["mean"],
}
LAST_LOAN = {
    "DPD": ["sum", "mean", "max", "std"],
    "LATE_PAYMENT": ["count", "mean"],
    "PAID_OVER_AMOUNT": ["sum", "mean", "max", "min", "std"],
    "PAID_OVER": ["count", "mean"],
}
INSTALLMENT_WINDOWS = [12, 18, 36, 60]

POS_GENERAL = {
    "SK_ID_PREV": ["nunique"],
    "MONTHS_BALANCE": ["min", "max", "size"],
    "SK_DPD": ["max", "mean", "sum", "var"],
    "SK_DPD_DEF": ["max", "mean", "sum"],
    "LATE_PAYMENT": ["mean"],
    "EXP_CNT_INSTALMENT": ["last"],
    "EXP_CNT_INSTALMENT_FUTURE": ["last"],
}
POS_DROPPED_STATUSES = ["Canceled", "Amortized debt", "XNA"]

CARD_GENERAL = {
    "SK_ID_PREV": ["nunique"],
    "MONTHS_BALANCE": ["min"],
    "AMT_BALANCE": ["sum", "min", "max"],
    "AMT_CREDIT_LIMIT_ACTUAL": ["max", "sum", "min"],
    "AMT_DRAWINGS_ATM_CURRENT": ["max", "sum"],
    "AMT_DRAWINGS_CURRENT": ["max", "sum"],
    "AMT_DRAWINGS_POS_CURRENT": ["max", "sum"],
    "AMT_INST_MIN_REGULARITY": ["max", "mean", "min"],
    "AMT_PAYMENT_TOTAL_CURRENT": ["max", "mean", "sum", "var"],
    "AMT_TOTAL_RECEIVABLE": ["max", "mean", "sum"],
    "CNT_DRAWINGS_ATM_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_POS_CURRENT": ["mean", "sum", "max"],
    "SK_DPD": ["mean", "max", "sum"],
    "SK_DPD_DEF": ["max", "sum"],
    "LIMIT_USE": ["max", "mean"],
    "PAYMENT_DIV_MIN": ["min", "mean"],
    "LATE_PAYMENT": ["max", "sum"],
    "AMT_DRAWING_SUM": ["sum", "max"],
    "BALANCE_LIMIT_RATIO": ["mean", "max", "min"],
    "CNT_DRAWING_SUM": ["sum", "max"],
    "MIN_PAYMENT_RATIO": ["min", "mean"],
    "PAYMENT_MIN_DIFF": ["min", "mean"],
    "MIN_PAYMENT_TOTAL_RATIO": ["min", "mean"],
    "AMT_INTEREST_RECEIVABLE": ["min", "mean"],
    "SK_DPD_RATIO": ["max", "mean"],
    "EXP_AMT_DRAWING_SUM": ["last"],
    "EXP_BALANCE_LIMIT_RATIO": ["last"],
    "EXP_CNT_DRAWING_SUM": ["last"],
    "EXP_MIN_PAYMENT_RATIO": ["last"],
    "EXP_PAYMENT_MIN_DIFF": ["last"],
    "EXP_MIN_PAYMENT_TOTAL_RATIO": ["last"],
    "EXP_AMT_INTEREST_RECEIVABLE": ["last"],
    "EXP_SK_DPD_RATIO": ["last"],
    "EXP_AMT_BALANCE": ["last"],
    "EXP_AMT_CREDIT_LIMIT_ACTUAL": ["last"],
    "EXP_AMT_RECEIVABLE_PRINCIPAL": ["last"],
    "EXP_AMT_RECEIVABLE": ["last"],
    "EXP_AMT_TOTAL_RECEIVABLE": ["last"],
}
CARD_RECENT = {
    "CNT_DRAWINGS_ATM_CURRENT": ["mean"],
    "SK_DPD": ["max", "sum"],
    "AMT_BALANCE": ["mean", "max"],
    "LIMIT_USE": ["max", "mean"],
    "EXP_AMT_DRAWING_SUM": ["last"],
    "EXP_BALANCE_LIMIT_RATIO": ["last"],
    "EXP_CNT_DRAWING_SUM": ["last"],
    "EXP_MIN_PAYMENT_RATIO": ["last"],
    "EXP_PAYMENT_MIN_DIFF": ["last"],
    "EXP_MIN_PAYMENT_TOTAL_RATIO": ["last"],
    "EXP_AMT_INTEREST_RECEIVABLE": ["last"],
    "EXP_SK_DPD_RATIO": ["last"],
}
CARD_SMOOTHED = ["AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECEIVABLE",
                 "AMT_TOTAL_RECEIVABLE", "AMT_DRAWING_SUM", "BALANCE_LIMIT_RATIO", "CNT_DRAWING_SUM",
                 "MIN_PAYMENT_RATIO", "PAYMENT_MIN_DIFF", "MIN_PAYMENT_TOTAL_RATIO", "AMT_INTEREST_RECEIVABLE",
                 "SK_DPD_RATIO"]
CARD_WINDOWS = [12, 24, 48]

# (name, numerator, denominator) of the ratios computed on the joined table.
CROSS_TABLE_RATIOS = [
    ("BUREAU_INCOME_CREDIT_RATIO", "BUREAU_AMT_CREDIT_SUM_MEAN", "AMT_INCOME_TOTAL"),
    ("BUREAU_ACTIVE_CREDIT_TO_INCOME_RATIO", "BUREAU_ACTIVE_AMT_CREDIT_SUM_SUM", "AMT_INCOME_TOTAL"),
    ("CURRENT_TO_APPROVED_CREDIT_MIN_RATIO", "APPROVED_AMT_CREDIT_MIN", "AMT_CREDIT"),
    ("CURRENT_TO_APPROVED_CREDIT_MAX_RATIO", "APPROVED_AMT_CREDIT_MAX", "AMT_CREDIT"),
    ("CURRENT_TO_APPROVED_CREDIT_MEAN_RATIO", "APPROVED_AMT_CREDIT_MEAN", "AMT_CREDIT"),
    ("CURRENT_TO_APPROVED_ANNUITY_MAX_RATIO", "APPROVED_AMT_ANNUITY_MAX", "AMT_ANNUITY"),
    ("CURRENT_TO_APPROVED_ANNUITY_MEAN_RATIO", "APPROVED_AMT_ANNUITY_MEAN", "AMT_ANNUITY"),
    ("PAYMENT_MIN_TO_ANNUITY_RATIO", "INS_AMT_PAYMENT_MIN", "AMT_ANNUITY"),
    ("PAYMENT_MAX_TO_ANNUITY_RATIO", "INS_AMT_PAYMENT_MAX", "AMT_ANNUITY"),
    ("PAYMENT_MEAN_TO_ANNUITY_RATIO", "INS_AMT_PAYMENT_MEAN", "AMT_ANNUITY"),
    ("CTA_CREDIT_TO_ANNUITY_MAX_RATIO", "APPROVED_CREDIT_TO_ANNUITY_RATIO_MAX", "CREDIT_TO_ANNUITY_RATIO"),
    ("CTA_CREDIT_TO_ANNUITY_MEAN_RATIO", "APPROVED_CREDIT_TO_ANNUITY_RATIO_MEAN", "CREDIT_TO_ANNUITY_RATIO"),
    ("DAYS_DECISION_MEAN_TO_BIRTH", "APPROVED_DAYS_DECISION_MEAN", "DAYS_BIRTH"),
    ("DAYS_CREDIT_MEAN_TO_BIRTH", "BUREAU_DAYS_CREDIT_MEAN", "DAYS_BIRTH"),
    ("DAYS_DECISION_MEAN_TO_EMPLOYED", "APPROVED_DAYS_DECISION_MEAN", "DAYS_EMPLOYED"),
    ("DAYS_CREDIT_MEAN_TO_EMPLOYED", "BUREAU_DAYS_CREDIT_MEAN", "DAYS_EMPLOYED"),
]
DURATION_GROUP_FEATURES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "BUREAU_ACTIVE_DAYS_CREDIT_MEAN",
                           "APPROVED_CNT_PAYMENT_MEAN", "EXT_SOURCES_PROD", "CREDIT_TO_GOODS_RATIO",
                           "INS_DAYS_ENTRY_PAYMENT_MAX", "EMPLOYED_TO_BIRTH_RATIO", "EXT_SOURCES_MEAN",
                           "DAYS_REGISTRATION", "DAYS_EMPLOYED", "DAYS_BIRTH"]

# (name, numerator, denominator) of the applicant ratios.
APPLICANT_RATIOS = [
    ("PHONE_TO_EMPLOY_RATIO", "DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
    ("APP_SCORE1_TO_FAM_CNT_RATIO", "EXT_SOURCE_1", "CNT_FAM_MEMBERS"),
    ("APP_SCORE1_TO_GOODS_RATIO", "EXT_SOURCE_1", "AMT_GOODS_PRICE"),
    ("APP_SCORE1_TO_CREDIT_RATIO", "EXT_SOURCE_1", "AMT_CREDIT"),
    ("APP_SCORE1_TO_SCORE2_RATIO", "EXT_SOURCE_1", "EXT_SOURCE_2"),
    ("APP_SCORE1_TO_SCORE3_RATIO", "EXT_SOURCE_1", "EXT_SOURCE_3"),
    ("APP_SCORE2_TO_CREDIT_RATIO", "EXT_SOURCE_2", "AMT_CREDIT"),
    ("APP_SCORE2_TO_CITY_RATING_RATIO", "EXT_SOURCE_2", "REGION_RATING_CLIENT_W_CITY"),
    ("APP_SCORE2_TO_POP_RATIO", "EXT_SOURCE_2", "REGION_POPULATION_RELATIVE"),
    ("APP_SCORE2_TO_PHONE_CHANGE_RATIO", "EXT_SOURCE_2", "DAYS_LAST_PHONE_CHANGE"),
    ("CREDIT_TO_ANNUITY_RATIO", "AMT_CREDIT", "AMT_ANNUITY"),
    ("CREDIT_TO_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE"),
    ("GOODS_INCOME_RATIO", "AMT_GOODS_PRICE", "AMT_INCOME_TOTAL"),
    ("ANNUITY_TO_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    ("CREDIT_TO_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
    ("INCOME_TO_EMPLOYED_RATIO", "AMT_INCOME_TOTAL", "DAYS_EMPLOYED"),
    ("INCOME_TO_BIRTH_RATIO", "AMT_INCOME_TOTAL", "DAYS_BIRTH"),
    ("INCOME_EXT_RATIO", "AMT_INCOME_TOTAL", "EXT_SOURCE_3"),
    ("CREDIT_EXT_RATIO", "AMT_CREDIT", "EXT_SOURCE_3"),
    ("EMPLOYED_TO_BIRTH_RATIO", "DAYS_EMPLOYED", "DAYS_BIRTH"),
    ("ID_TO_BIRTH_RATIO", "DAYS_ID_PUBLISH", "DAYS_BIRTH"),
    ("CAR_TO_BIRTH_RATIO", "OWN_CAR_AGE", "DAYS_BIRTH"),
    ("CAR_TO_EMPLOYED_RATIO", "OWN_CAR_AGE", "DAYS_EMPLOYED"),
    ("PHONE_TO_BIRTH_RATIO", "DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    ("CHILDRE_RATIO", "CNT_CHILDREN", "CNT_FAM_MEMBERS"),
    ("PAYMENT_RATE", "AMT_ANNUITY", "AMT_CREDIT"),
    ("OBS_30_CREDIT_RATIO", "AMT_CREDIT", "OBS_30_CNT_SOCIAL_CIRCLE"),
    ("OBS_60_CREDIT_RATIO", "AMT_CREDIT", "OBS_60_CNT_SOCIAL_CIRCLE"),
    ("DEF_30_CREDIT_RATIO", "AMT_CREDIT", "DEF_30_CNT_SOCIAL_CIRCLE"),
    ("DEF_60_CREDIT_RATIO", "AMT_CREDIT", "DEF_60_CNT_SOCIAL_CIRCLE"),
    ("ENQ_CREDIT_RATIO", "AMT_ENQ_SUM", "AMT_CREDIT"),
    ("CHILD_TO_NON_CHILD_RATIO", "CNT_CHILDREN", "CNT_NON_CHILD"),
    ("INCOME_PER_NON_CHILD", "AMT_INCOME_TOTAL", "CNT_NON_CHILD"),
    ("CREDIT_PER_PERSON", "AMT_CREDIT", "CNT_FAM_MEMBERS"),
    ("CREDIT_PER_CHILD", "AMT_CREDIT", "CNT_CHILDREN"),
    ("CREDIT_PER_NON_CHILD", "AMT_CREDIT", "CNT_NON_CHILD"),
    ("INCOME_PER_CHILD", "AMT_INCOME_TOTAL", "CHILDREN_PLUS_ONE"),
    ("INCOME_PER_PERSON", "AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    ("INCOME_CREDIT_PERCENTAGE", "AMT_INCOME_TOTAL", "AMT_CREDIT"),
]
SUMMED_DOCUMENTS = [f"FLAG_DOCUMENT_{i}" for i in (3, 5, 6, 7, 8, 9, 11, 13, 14, 15, 16, 17, 18, 19, 21)]
INCOME_EDGES = [0, 30000, 65000, 95000, 130000, 160000, 190880, 220000, 275000, 325000, float("inf")]
AGE_UPPERS = [27, 40, 50, 65, 99]
DURATION_UPPERS = [6, 12, 18, 24, 30, 36]
ASSET_LABELS = {("N", "N"): 0, ("Y", "N"): 1, ("N", "Y"): 2, ("Y", "Y"): 3}
PEER_KEYS = ["ORGANIZATION_TYPE", "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE", "AGE_RANGE", "CODE_GENDER"]
PEER_STATS = {
    "GROUP_EXT_SOURCES_MEDIAN": ("EXT_SOURCES_MEAN", "median"),
    "GROUP_EXT_SOURCES_STD": ("EXT_SOURCES_MEAN", "std"),
    "GROUP_INCOME_MEAN": ("AMT_INCOME_TOTAL", "mean"),
    "GROUP_INCOME_STD": ("AMT_INCOME_TOTAL", "std"),
    "GROUP_CREDIT_TO_ANNUITY_MEAN": ("CREDIT_TO_ANNUITY_RATIO", "mean"),
    "GROUP_CREDIT_TO_ANNUITY_STD": ("CREDIT_TO_ANNUITY_RATIO", "std"),
    "GROUP_CREDIT_MEAN": ("AMT_CREDIT", "mean"),
    "GROUP_ANNUITY_MEAN": ("AMT_ANNUITY", "mean"),
    "GROUP_ANNUITY_STD": ("AMT_ANNUITY", "std"),
}
DURATION_KEYS = ["CREDIT_TO_ANNUITY_GROUP", "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE"]
DURATION_STATS = {
    f"GROUP1_{label}_{fn.upper()}": (column, fn)
    for label, column in (("EXT_SOURCES", "EXT_SOURCES_MEAN"), ("INCOME", "AMT_INCOME_TOTAL"),
                          ("CREDIT_TO_ANNUITY", "CREDIT_TO_ANNUITY_RATIO"), ("CREDIT", "AMT_CREDIT"),
                          ("ANNUITY", "AMT_ANNUITY"))
    for fn in ("median", "std")
}
INTERACTION_KEYS = [
    ["NAME_CONTRACT_TYPE", "NAME_INCOME_TYPE", "OCCUPATION_TYPE"],
    ["CODE_GENDER", "NAME_FAMILY_STATUS", "NAME_INCOME_TYPE"],
    ["FLAG_OWN_CAR", "FLAG_OWN_REALTY", "NAME_INCOME_TYPE"],
    ["NAME_EDUCATION_TYPE", "NAME_INCOME_TYPE", "OCCUPATION_TYPE"],
    ["OCCUPATION_TYPE", "ORGANIZATION_TYPE"],
    ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"],
]
INTERACTION_SPEC = {c: ["mean", "max", "min"] for c in (
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_ANNUITY", "AMT_INCOME_TOTAL", "APARTMENTS_SUM_AVG",
    "APARTMENTS_SUM_MEDI")}
APPLICANT_DROPS = [
    "CNT_CHILDREN", "CNT_FAM_MEMBERS", "HOUR_APPR_PROCESS_START", "FLAG_EMP_PHONE", "FLAG_MOBIL", "FLAG_CONT_MOBILE",
    "FLAG_EMAIL", "FLAG_PHONE", "FLAG_OWN_REALTY", "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION",
    "REG_CITY_NOT_WORK_CITY", "OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", "AMT_REQ_CREDIT_BUREAU_DAY",
    "AMT_REQ_CREDIT_BUREAU_MON", "AMT_REQ_CREDIT_BUREAU_YEAR", "COMMONAREA_MODE", "NONLIVINGAREA_MODE",
    "ELEVATORS_MODE", "NONLIVINGAREA_AVG", "FLOORSMIN_MEDI", "LANDAREA_MODE", "NONLIVINGAREA_MEDI",
    "LIVINGAPARTMENTS_MODE", "FLOORSMIN_AVG", "LANDAREA_AVG", "FLOORSMIN_MODE", "LANDAREA_MEDI", "COMMONAREA_MEDI",
    "YEARS_BUILD_AVG", "COMMONAREA_AVG", "BASEMENTAREA_AVG", "BASEMENTAREA_MODE", "NONLIVINGAPARTMENTS_MEDI",
    "BASEMENTAREA_MEDI", "LIVINGAPARTMENTS_AVG", "ELEVATORS_AVG", "YEARS_BUILD_MEDI", "ENTRANCES_MODE",
    "NONLIVINGAPARTMENTS_MODE", "LIVINGAREA_MODE", "LIVINGAPARTMENTS_MEDI", "YEARS_BUILD_MODE",
    "YEARS_BEGINEXPLUATATION_AVG", "ELEVATORS_MEDI", "LIVINGAREA_MEDI", "YEARS_BEGINEXPLUATATION_MODE",
    "NONLIVINGAPARTMENTS_AVG", "HOUSETYPE_MODE", "FONDKAPREMONT_MODE", "EMERGENCYSTATE_MODE",
    *[f"FLAG_DOCUMENT_{i}" for i in (2, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 16, 17, 19, 20, 21)],
]
