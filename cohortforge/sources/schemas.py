"""Declared schemas of the eight source tables (no type inference at scan time).

Only the columns the feature code names are declared.  A file's other columns
are kept, with a type by their name (``other_type``).
"""

from pyspark.sql.types import DataType, DoubleType, LongType, StringType, StructField, StructType

# How the source tables name their columns.
LONG_STARTS = ("SK_ID_", "FLAG_")
STRING_STARTS = ("NAME_", "CODE_", "WEEKDAY_", "ORGANIZATION_", "OCCUPATION_", "CHANNEL_", "PRODUCT_", "CREDIT_ACTIVE",
                 "CREDIT_CURRENCY", "CREDIT_TYPE", "STATUS")
STRINGS = ("FLAG_OWN_CAR", "FLAG_OWN_REALTY", "FLAG_LAST_APPL_PER_CONTRACT", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE",
           "EMERGENCYSTATE_MODE")


def other_type(name: str) -> DataType:
    """The type of a column that no schema declares: text, whole number or (any other) double."""
    if name in STRINGS or name.startswith(STRING_STARTS):
        return StringType()
    return LongType() if name == "TARGET" or name.startswith(LONG_STARTS) else DoubleType()


def _schema(longs=(), doubles=(), strings=()) -> StructType:
    fields = ([StructField(c, LongType()) for c in longs]
              + [StructField(c, DoubleType()) for c in doubles]
              + [StructField(c, StringType()) for c in strings])
    return StructType(fields)


# Column names of the source tables.
APPLICATION = _schema(
    longs=["SK_ID_CURR", "TARGET", "CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED",
           "DAYS_LAST_PHONE_CHANGE", "HOUR_APPR_PROCESS_START"],
    doubles=["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
             "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "OWN_CAR_AGE"],
    strings=["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "ORGANIZATION_TYPE",
             "OCCUPATION_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
             "NAME_HOUSING_TYPE", "NAME_INCOME_TYPE", "NAME_TYPE_SUITE", "FONDKAPREMONT_MODE",
             "HOUSETYPE_MODE", "WALLSMATERIAL_MODE", "WEEKDAY_APPR_PROCESS_START"],
)

BUREAU = _schema(
    longs=["SK_ID_CURR", "SK_ID_BUREAU", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE",
           "DAYS_CREDIT_UPDATE", "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG"],
    doubles=["AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT",
             "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_LIMIT", "AMT_ANNUITY"],
    strings=["CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"],
)

BUREAU_BALANCE = _schema(longs=["SK_ID_BUREAU", "MONTHS_BALANCE"], strings=["STATUS"])

CREDIT_CARD_BALANCE = _schema(
    longs=["SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"],
    doubles=["AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_ATM_CURRENT",
             "AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT",
             "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT",
             "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE",
             "CNT_DRAWINGS_ATM_CURRENT", "CNT_DRAWINGS_CURRENT", "CNT_DRAWINGS_OTHER_CURRENT",
             "CNT_DRAWINGS_POS_CURRENT", "CNT_INSTALMENT_MATURE_CUM"],
    strings=["NAME_CONTRACT_STATUS"],
)

POS_CASH_BALANCE = _schema(
    longs=["SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"],
    doubles=["CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"],
    strings=["NAME_CONTRACT_STATUS"],
)

PREVIOUS_APPLICATION = _schema(
    longs=["SK_ID_PREV", "SK_ID_CURR", "HOUR_APPR_PROCESS_START", "DAYS_DECISION",
           "CNT_PAYMENT", "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
           "DAYS_LAST_DUE", "DAYS_TERMINATION"],
    doubles=["AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT",
             "AMT_GOODS_PRICE", "RATE_DOWN_PAYMENT"],
    strings=["NAME_CONTRACT_TYPE", "WEEKDAY_APPR_PROCESS_START", "NAME_CASH_LOAN_PURPOSE",
             "NAME_CONTRACT_STATUS", "NAME_PAYMENT_TYPE", "CODE_REJECT_REASON", "NAME_TYPE_SUITE",
             "NAME_CLIENT_TYPE", "NAME_GOODS_CATEGORY", "NAME_PORTFOLIO", "NAME_PRODUCT_TYPE",
             "CHANNEL_TYPE", "NAME_SELLER_INDUSTRY", "NAME_YIELD_GROUP", "PRODUCT_COMBINATION"],
)

INSTALLMENTS_PAYMENTS = _schema(
    longs=["SK_ID_PREV", "SK_ID_CURR"],
    doubles=["NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT",
             "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"],
)

TABLES = {
    "application_train": APPLICATION,
    "application_test": APPLICATION,
    "bureau": BUREAU,
    "bureau_balance": BUREAU_BALANCE,
    "credit_card_balance": CREDIT_CARD_BALANCE,
    "POS_CASH_balance": POS_CASH_BALANCE,
    "previous_application": PREVIOUS_APPLICATION,
    "installments_payments": INSTALLMENTS_PAYMENTS,
}
