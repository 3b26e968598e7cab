"""Schemas and file names of the seven credit history tables.

Column lists hold every column the feature presets read; a scan by schema never
infers types and never reads a column it does not name.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"id": T.LongType(), "int": T.IntegerType(), "num": T.DoubleType(), "str": T.StringType()}

# Column names and file names of the source tables.
HOUSING = ["APARTMENTS", "BASEMENTAREA", "YEARS_BEGINEXPLUATATION", "YEARS_BUILD", "COMMONAREA", "ELEVATORS",
           "ENTRANCES", "FLOORSMAX", "FLOORSMIN", "LANDAREA", "LIVINGAPARTMENTS", "LIVINGAREA",
           "NONLIVINGAPARTMENTS", "NONLIVINGAREA"]
HOUSING_COLUMNS = [f"{m}_{s}" for s in ("AVG", "MODE", "MEDI") for m in HOUSING] + ["TOTALAREA_MODE"]
DOCUMENT_FLAGS = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
ENQUIRIES = [f"AMT_REQ_CREDIT_BUREAU_{p}" for p in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")]

COLUMNS = {
    "application": {
        "id": ["SK_ID_CURR"],
        "int": ["TARGET", "DAYS_BIRTH", "DAYS_ID_PUBLISH", "CNT_CHILDREN", "REGION_RATING_CLIENT",
                "REGION_RATING_CLIENT_W_CITY", "HOUR_APPR_PROCESS_START", *DOCUMENT_FLAGS,
                "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL",
                "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
                "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY"],
        "num": ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "EXT_SOURCE_2",
                "EXT_SOURCE_3", "OWN_CAR_AGE", "CNT_FAM_MEMBERS", "REGION_POPULATION_RELATIVE", "DAYS_EMPLOYED",
                "DAYS_LAST_PHONE_CHANGE", "DAYS_REGISTRATION", "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
                "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE", *ENQUIRIES, *HOUSING_COLUMNS],
        "str": ["NAME_CONTRACT_TYPE", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "NAME_INCOME_TYPE",
                "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "OCCUPATION_TYPE",
                "ORGANIZATION_TYPE", "WEEKDAY_APPR_PROCESS_START", "HOUSETYPE_MODE", "FONDKAPREMONT_MODE",
                "EMERGENCYSTATE_MODE"],
    },
    "bureau": {
        "id": ["SK_ID_BUREAU", "SK_ID_CURR"],
        "int": ["DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG"],
        "num": ["DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "DAYS_CREDIT_UPDATE", "AMT_CREDIT_MAX_OVERDUE",
                "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE", "AMT_ANNUITY"],
        "str": ["CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"],
    },
    "bureau_balance": {"id": ["SK_ID_BUREAU"], "int": ["MONTHS_BALANCE"], "str": ["STATUS"]},
    "previous_application": {
        "id": ["SK_ID_PREV", "SK_ID_CURR"],
        "int": ["DAYS_DECISION", "HOUR_APPR_PROCESS_START", "NFLAG_LAST_APPL_IN_DAY"],
        "num": ["AMT_APPLICATION", "AMT_CREDIT", "AMT_ANNUITY", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE",
                "RATE_DOWN_PAYMENT", "CNT_PAYMENT", "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE",
                "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION"],
        "str": ["NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "CHANNEL_TYPE", "NAME_TYPE_SUITE", "NAME_YIELD_GROUP",
                "PRODUCT_COMBINATION", "NAME_PRODUCT_TYPE", "NAME_CLIENT_TYPE", "FLAG_LAST_APPL_PER_CONTRACT"],
    },
    "installments_payments": {
        "id": ["SK_ID_PREV", "SK_ID_CURR"],
        "int": ["NUM_INSTALMENT_NUMBER"],
        "num": ["NUM_INSTALMENT_VERSION", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"],
    },
    "POS_CASH_balance": {
        "id": ["SK_ID_PREV", "SK_ID_CURR"],
        "int": ["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"],
        "num": ["CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"],
        "str": ["NAME_CONTRACT_STATUS"],
    },
    "credit_card_balance": {
        "id": ["SK_ID_PREV", "SK_ID_CURR"],
        "int": ["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"],
        "num": ["AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT",
                "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT", "AMT_INST_MIN_REGULARITY",
                "AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE",
                "AMT_TOTAL_RECEIVABLE", "CNT_DRAWINGS_ATM_CURRENT", "CNT_DRAWINGS_CURRENT",
                "CNT_DRAWINGS_OTHER_CURRENT", "CNT_DRAWINGS_POS_CURRENT", "CNT_INSTALMENT_MATURE_CUM"],
        "str": ["NAME_CONTRACT_STATUS"],
    },
}
FILES = {
    "application_train": "application_train", "application_test": "application_test", "bureau": "bureau",
    "bureau_balance": "bureau_balance", "previous_application": "previous_application",
    "installments_payments": "installments_payments", "POS_CASH_balance": "POS_CASH_balance",
    "credit_card_balance": "credit_card_balance",
}


def schema_of(table: str) -> T.StructType:
    """Schema of a source table; the two application files share one."""
    labelled = table != "application_test"
    columns = COLUMNS["application" if table.startswith("application") else table]
    return T.StructType([
        T.StructField(name, _TYPES[kind], True)
        for kind, names in columns.items() for name in names if labelled or name != "TARGET"
    ])
