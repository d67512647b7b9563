"""Feature catalogue of the credit tables, as data.

Fixed values: bounds, sentinels, excluded categories, price lists, column lists
and formulas that decide the results. Formulas are SQL over one row.
"""

from __future__ import annotations

from featloom.operators.clean import NullRule

KEY, LOAN, PREVIOUS, LABEL = "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "TARGET"
MISSING_DAY = 365243
ALL_SIX = ("min", "max", "mean", "var", "sum")  # the row count is added once per table

# --- rows and cells that count as missing -----------------------------------------------------

EXCLUDED_APPLICANTS = {
    "CODE_GENDER": "XNA",
    "NAME_INCOME_TYPE": "Maternity leave",
    "NAME_FAMILY_STATUS": "Unknown",
}
APPLICATION_NULLS = [
    NullRule("DAYS_EMPLOYED", equals=MISSING_DAY),
    NullRule("OWN_CAR_AGE", above=80),
    NullRule("REGION_RATING_CLIENT_W_CITY", below=0),
    NullRule("AMT_INCOME_TOTAL", above=1e8),
    NullRule("AMT_REQ_CREDIT_BUREAU_QRT", above=10),
    NullRule("OBS_30_CNT_SOCIAL_CIRCLE", above=40),
]
BUREAU_NULLS = [
    NullRule("AMT_ANNUITY", above=8e7),
    NullRule("AMT_CREDIT_SUM", above=3e8),
    NullRule("AMT_CREDIT_SUM_DEBT", above=1e8),
    NullRule("AMT_CREDIT_MAX_OVERDUE", above=8e7),
    NullRule("DAYS_ENDDATE_FACT", below=-10000),
    NullRule("DAYS_CREDIT_UPDATE", above=0, below=-40000),
    NullRule("DAYS_CREDIT_ENDDATE", below=-10000),
]
PREVIOUS_DAYS = [
    "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION",
]
PREVIOUS_SENTINELS = [NullRule(c, equals=MISSING_DAY) for c in PREVIOUS_DAYS]
PREVIOUS_NULLS = [
    NullRule("AMT_CREDIT", above=6e6),
    NullRule("SELLERPLACE_AREA", above=3.5e6),
    *PREVIOUS_SENTINELS,
]
POS_NULLS = [NullRule("CNT_INSTALMENT_FUTURE", above=60)]
INSTALMENT_NULLS = [NullRule("NUM_INSTALMENT_VERSION", above=70), NullRule("DAYS_ENTRY_PAYMENT", below=-4000)]
CARD_NULLS = [NullRule("AMT_PAYMENT_CURRENT", above=4e6), NullRule("AMT_CREDIT_LIMIT_ACTUAL", above=1e6)]

DROPPED_DOCUMENTS = [f"FLAG_DOCUMENT_{i}" for i in (2, 10, 12, 13, 14, 15, 16, 17, 19, 20, 21)]
DROPPED_DOCUMENTS_SECOND = [f"FLAG_DOCUMENT_{i}" for i in (2, *range(4, 22))]

# --- formulas ---------------------------------------------------------------------------------


def ratio(a: str, b: str) -> str:
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def flag(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INT)"


def ratios(prefix: str, pairs: list[tuple[str, str]]) -> dict[str, str]:
    return {f"{prefix}_{a}_per_{b}": ratio(a, b) for a, b in pairs}


def differences(prefix: str, pairs: list[tuple[str, str]]) -> dict[str, str]:
    return {f"{prefix}_{a}_minus_{b}": f"{a} - {b}" for a, b in pairs}


def products(prefix: str, pairs: list[tuple[str, str]]) -> dict[str, str]:
    return {f"{prefix}_{a}_times_{b}": f"{a} * {b}" for a, b in pairs}


SOURCES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
MOST_POPULAR_PRICES = [225000, 450000, 675000, 900000]
POPULAR_PRICES = [1125000, 1350000, 1575000, 1800000, 2250000]

APPLICATION_FEATURES = {
    "app_EXT_SOURCE_prod": " * ".join(SOURCES),
    **products("app", [("EXT_SOURCE_1", "EXT_SOURCE_2"), ("EXT_SOURCE_1", "EXT_SOURCE_3"), ("EXT_SOURCE_2", "EXT_SOURCE_3")]),
    **products("app", [(s, "DAYS_EMPLOYED") for s in SOURCES]),
    **ratios("app", [(s, "DAYS_BIRTH") for s in SOURCES]),
    **differences("app", [("AMT_CREDIT", "AMT_GOODS_PRICE"), ("AMT_INCOME_TOTAL", "AMT_GOODS_PRICE"), ("DAYS_EMPLOYED", "DAYS_BIRTH")]),
    **ratios(
        "app",
        [
            ("AMT_CREDIT", "AMT_GOODS_PRICE"),
            ("AMT_CREDIT", "AMT_ANNUITY"),
            ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
            ("AMT_INCOME_TOTAL", "AMT_ANNUITY"),
            ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
            ("OWN_CAR_AGE", "DAYS_BIRTH"),
            ("OWN_CAR_AGE", "DAYS_EMPLOYED"),
            ("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
            ("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
            ("DAYS_EMPLOYED", "DAYS_BIRTH"),
            ("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
        ],
    ),
    "app_AMT_INCOME_TOTAL_monthly_minus_AMT_ANNUITY": "CAST(AMT_INCOME_TOTAL AS DOUBLE) / 12 - AMT_ANNUITY",
    "app_AMT_INCOME_TOTAL_per_CNT_CHILDREN": ratio("AMT_INCOME_TOTAL", "(1 + CNT_CHILDREN)"),
    "app_most_popular_AMT_GOODS_PRICE": flag(f"AMT_GOODS_PRICE IN ({', '.join(map(str, MOST_POPULAR_PRICES))})"),
    "app_popular_AMT_GOODS_PRICE": flag(f"AMT_GOODS_PRICE IN ({', '.join(map(str, POPULAR_PRICES))})"),
}

BUREAU_FEATURES = differences(
    "bureau",
    [
        ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"),
        ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_LIMIT"),
        ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_OVERDUE"),
        ("DAYS_CREDIT", "CREDIT_DAY_OVERDUE"),
        ("DAYS_CREDIT", "DAYS_CREDIT_ENDDATE"),
        ("DAYS_CREDIT", "DAYS_ENDDATE_FACT"),
        ("DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT"),
        ("DAYS_CREDIT_UPDATE", "DAYS_CREDIT_ENDDATE"),
    ],
)

PREVIOUS_FEATURES = {
    **ratios("prev", [("AMT_APPLICATION", "AMT_CREDIT")]),
    **differences(
        "prev",
        [
            ("AMT_APPLICATION", "AMT_CREDIT"),
            ("AMT_APPLICATION", "AMT_GOODS_PRICE"),
            ("AMT_GOODS_PRICE", "AMT_CREDIT"),
            ("DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE"),
        ],
    ),
    "prev_DAYS_TERMINATION_less_500": flag("DAYS_TERMINATION < -500"),
}

POS_FEATURES = {"pos_CNT_INSTALMENT_more_FUTURE": flag("CNT_INSTALMENT > CNT_INSTALMENT_FUTURE")}

INSTALMENT_FEATURES = {
    **differences("ins", [("DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT"), ("AMT_INSTALMENT", "AMT_PAYMENT")]),
    **ratios("ins", [("AMT_PAYMENT", "AMT_INSTALMENT")]),
    "ins_NUM_INSTALMENT_NUMBER_100": flag("NUM_INSTALMENT_NUMBER = 100"),
    "ins_DAYS_INSTALMENT_above_line": flag(
        "DAYS_INSTALMENT > CAST(NUM_INSTALMENT_NUMBER AS DOUBLE) * 50 / 3 - CAST(11500 AS DOUBLE) / 3"
    ),
}

CARD_FEATURES = differences(
    "card",
    [
        ("SK_DPD", "MONTHS_BALANCE"),
        ("SK_DPD_DEF", "MONTHS_BALANCE"),
        ("SK_DPD", "SK_DPD_DEF"),
        ("AMT_TOTAL_RECEIVABLE", "AMT_RECIVABLE"),
        ("AMT_TOTAL_RECEIVABLE", "AMT_RECEIVABLE_PRINCIPAL"),
        ("AMT_RECIVABLE", "AMT_RECEIVABLE_PRINCIPAL"),
        ("AMT_BALANCE", "AMT_RECIVABLE"),
        ("AMT_BALANCE", "AMT_RECEIVABLE_PRINCIPAL"),
        ("AMT_BALANCE", "AMT_TOTAL_RECEIVABLE"),
        ("AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_ATM_CURRENT"),
        ("AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT"),
        ("AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_POS_CURRENT"),
    ],
)

STATUS_CLOSED = "C"
STATUS_COUNTED = ["0", "1", "2", "3", "4", "5"]
STATUS_LATE = ["1", "2", "3", "4", "5"]
BUREAU_SUBSETS = {"ACTIVE_": "Active", "CLOSED_": "Closed"}
PREVIOUS_SUBSETS = {"APPROVED_": "Approved", "REFUSED_": "Refused"}

# --- second feature set -----------------------------------------------------------------------

SECOND_BINARY = ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]
SECOND_APPLICATION_FEATURES = {
    "NEW_CREDIT_TO_ANNUITY_RATIO": ratio("AMT_CREDIT", "AMT_ANNUITY"),
    "NEW_CREDIT_TO_GOODS_RATIO": ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
    "NEW_INC_PER_CHLD": ratio("AMT_INCOME_TOTAL", "(1 + CNT_CHILDREN)"),
    "NEW_EMPLOY_TO_BIRTH_RATIO": ratio("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "NEW_ANNUITY_TO_INCOME_RATIO": ratio("AMT_ANNUITY", "(1 + AMT_INCOME_TOTAL)"),
    "NEW_SOURCES_PROD": " * ".join(SOURCES),
    "NEW_CAR_TO_BIRTH_RATIO": ratio("OWN_CAR_AGE", "DAYS_BIRTH"),
    "NEW_CAR_TO_EMPLOY_RATIO": ratio("OWN_CAR_AGE", "DAYS_EMPLOYED"),
    "NEW_PHONE_TO_BIRTH_RATIO": ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    "NEW_PHONE_TO_BIRTH_RATIO_EMPLOYER": ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
    "NEW_CREDIT_TO_INCOME_RATIO": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
}
SECOND_BUREAU = {
    "DAYS_CREDIT": ["mean", "var"],
    "DAYS_CREDIT_ENDDATE": ["mean"],
    "DAYS_CREDIT_UPDATE": ["mean"],
    "CREDIT_DAY_OVERDUE": ["mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum"],
    "MONTHS_BALANCE_MIN": ["min"],
    "MONTHS_BALANCE_MAX": ["max"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
SECOND_PREVIOUS = {
    **{
        c: ["max", "mean"]
        for c in (
            "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "APP_CREDIT_PERC", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE",
            "HOUR_APPR_PROCESS_START", "RATE_DOWN_PAYMENT", "DAYS_DECISION",
        )
    },
    "CNT_PAYMENT": ["mean", "sum"],
}
SECOND_POS = {"MONTHS_BALANCE": ["max", "mean"], "SK_DPD": ["max", "mean"], "SK_DPD_DEF": ["max", "mean"]}
SECOND_INSTALMENTS = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    **{c: ["max", "mean", "sum", "min", "std"] for c in ("DPD", "DBD")},
    **{c: ["max", "mean", "var", "min", "std"] for c in ("PAYMENT_PERC", "PAYMENT_DIFF")},
    **{c: ["max", "mean", "sum", "min", "std"] for c in ("AMT_INSTALMENT", "AMT_PAYMENT")},
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum", "std"],
}
SECOND_CARD = ["max", "mean", "sum", "var"]

# --- summarise-everything feature set ---------------------------------------------------------

SUMMARY_FUNCTIONS = ["mean", "std", "min", "max", "sum", "nunique"]
SUMMARY_APPLICATION_FEATURES = {
    "DAYS_EMPLOYED_PERC": f"sqrt({ratio('DAYS_EMPLOYED', 'DAYS_BIRTH')})",
    "INCOME_CREDIT_PERC": ratio("AMT_INCOME_TOTAL", "AMT_CREDIT"),
    "INCOME_PER_PERSON": f"log1p({ratio('AMT_INCOME_TOTAL', 'CNT_FAM_MEMBERS')})",
    "ANNUITY_INCOME_PERC": f"sqrt({ratio('AMT_ANNUITY', '(1 + AMT_INCOME_TOTAL)')})",
    "LOAN_INCOME_RATIO": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "ANNUITY_LENGTH": ratio("AMT_CREDIT", "AMT_ANNUITY"),
    "CHILDREN_RATIO": ratio("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
    "CREDIT_TO_GOODS_RATIO": ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
    "INC_PER_CHLD": ratio("AMT_INCOME_TOTAL", "(1 + CNT_CHILDREN)"),
    "SOURCES_PROD": " * ".join(SOURCES),
    "CAR_TO_BIRTH_RATIO": ratio("OWN_CAR_AGE", "DAYS_BIRTH"),
    "CAR_TO_EMPLOY_RATIO": ratio("OWN_CAR_AGE", "DAYS_EMPLOYED"),
    "PHONE_TO_BIRTH_RATIO": ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    "PHONE_TO_EMPLOY_RATIO": ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
}
