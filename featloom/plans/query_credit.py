"""The credit feature sets, table by table, on credit-shaped views of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.plans import credit
from featloom.plans.credit_roles import ROLES, credit_tables
from featloom.plans.registry import OFF_TIE, REGISTRY, query, round_sql

DAY = 365243
CATEGORIES = {
    "CREDIT_ACTIVE": ["Active", "Closed", "Sold"],
    "CREDIT_TYPE": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None],
    "PREV_STATUS": ["Approved", "Canceled", "Refused"],
    "PRIORITY": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "POS_STATUS": ["Active", "Completed", "Signed"],
    "CARD_STATUS": ["Active", "Completed"],
}
STATUSES = ["0", "1", "2", "3", "4", "5", "C", "X", None]


def published(df):
    """Numbers as rounded doubles, so that wide results compare by value."""

    def shown(f):
        if not isinstance(f.dataType, T.NumericType) or f.name in ("SK_ID_CURR", "SK_ID_BUREAU"):
            return F.col(f"`{f.name}`")
        digits = 0 if f.name.endswith(("_VAR", "_STD")) else 3
        return F.round(F.col(f"`{f.name}`").cast("double") + OFF_TIE, digits).alias(f.name)

    return df.select([shown(f) for f in df.schema])


def shown_sql(expr: str, name: str) -> str:
    return f"{round_sql(expr, 0 if name.endswith(('_VAR', '_STD')) else 3)} AS {name}"


def name_of(value) -> str:
    if value is None:
        return "NaN"
    return value.replace("-", "_").replace(" ", "_")


def share_sql(column: str, value) -> str:
    test = f"{column} IS NULL" if value is None else f"{column} = '{value}'"
    return f"CASE WHEN {test} THEN 1.0::DOUBLE ELSE 0 END"


FUNCTION_SQL = {
    "min": "min({c}) {f}",
    "max": "max({c}) {f}",
    "mean": "avg({c}) {f}",
    "var": "var_samp({c}) {f}",
    "std": "stddev_samp({c}) {f}",
    "sum": "CASE WHEN count(*) {f} > 0 THEN coalesce(sum({c}) {f}, 0) END",
    "nunique": "count(DISTINCT {c}) {f}",
}
FIVE = ["min", "max", "mean", "var", "sum"]


def rollup_sql(source: str, prefix: str, measures: dict, shares: dict, count_as: str | None = None,
               status: str | None = None, subsets: dict | None = None, subset_shares: bool = True) -> str:
    out = []
    for p, value in {prefix: None, **(subsets or {})}.items():
        f = f"FILTER (WHERE {status} = '{value}')" if value else ""
        for c, functions in measures.items():
            out += [shown_sql(FUNCTION_SQL[fn].format(c=c, f=f), f"{p}{c}_{fn.upper()}") for fn in functions]
        if value is None or subset_shares:
            for c, values in shares.items():
                out += [shown_sql(f"avg({share_sql(c, v)}) {f}", f"{p}{c}_{name_of(v)}_MEAN") for v in values]
        if count_as:
            count = f"nullif(count(*) {f}, 0)"
            out.append(shown_sql(count, count_as if value is None else f"{p}{count_as}"))
    return f"SELECT SK_ID_CURR, {', '.join(out)} FROM {source} GROUP BY SK_ID_CURR"


def nulled(columns: dict[str, str]) -> str:
    return ", ".join(f"CASE WHEN {test} THEN NULL ELSE {c} END AS {c}" for c, test in columns.items())


# --- applications -----------------------------------------------------------------------------

TEXT = ["CODE_GENDER", "NAME_INCOME_TYPE", "NAME_FAMILY_STATUS", "ORGANIZATION_TYPE", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]
LOST = ", ".join(f"FLAG_DOCUMENT_{i}" for i in (2, 10, 12, 13, 14, 15, 16, 17, 19, 20, 21))
NULLABLE = [
    "NAME_FAMILY_STATUS", "DAYS_EMPLOYED", "OWN_CAR_AGE", "REGION_RATING_CLIENT_W_CITY", "AMT_INCOME_TOTAL", "AMT_ANNUITY",
    "AMT_REQ_CREDIT_BUREAU_QRT", "OBS_30_CNT_SOCIAL_CIRCLE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
]
E3 = "[EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]"
PRESENT = f"list_filter({E3}, lambda x: x IS NOT NULL)"


def over(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def _both(pairs, word, sign):
    return {f"app_{a}_{word}_{b}": (over(a, b) if sign == "/" else f"{a} {sign} {b}") for a, b in pairs}


APP_SQL = {
    "app_missing": " + ".join(f"({c} IS NULL)::INTEGER" for c in NULLABLE),
    "app_EXT_SOURCE_mean": f"list_avg({PRESENT})",
    "app_EXT_SOURCE_prod": "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3",
    **_both([("EXT_SOURCE_1", "EXT_SOURCE_2"), ("EXT_SOURCE_1", "EXT_SOURCE_3"), ("EXT_SOURCE_2", "EXT_SOURCE_3"),
             ("EXT_SOURCE_1", "DAYS_EMPLOYED"), ("EXT_SOURCE_2", "DAYS_EMPLOYED"), ("EXT_SOURCE_3", "DAYS_EMPLOYED")], "times", "*"),
    **_both([("EXT_SOURCE_1", "DAYS_BIRTH"), ("EXT_SOURCE_2", "DAYS_BIRTH"), ("EXT_SOURCE_3", "DAYS_BIRTH"),
             ("AMT_CREDIT", "AMT_GOODS_PRICE"), ("AMT_CREDIT", "AMT_ANNUITY"), ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
             ("AMT_INCOME_TOTAL", "AMT_ANNUITY"), ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"), ("OWN_CAR_AGE", "DAYS_BIRTH"),
             ("OWN_CAR_AGE", "DAYS_EMPLOYED"), ("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"), ("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
             ("DAYS_EMPLOYED", "DAYS_BIRTH"), ("CNT_CHILDREN", "CNT_FAM_MEMBERS")], "per", "/"),
    **_both([("AMT_CREDIT", "AMT_GOODS_PRICE"), ("AMT_INCOME_TOTAL", "AMT_GOODS_PRICE"), ("DAYS_EMPLOYED", "DAYS_BIRTH")], "minus", "-"),
    "app_AMT_INCOME_TOTAL_monthly_minus_AMT_ANNUITY": "AMT_INCOME_TOTAL / 12 - AMT_ANNUITY",
    "app_AMT_INCOME_TOTAL_per_CNT_CHILDREN": over("AMT_INCOME_TOTAL", "(1 + CNT_CHILDREN)"),
    "app_most_popular_AMT_GOODS_PRICE": "CASE WHEN AMT_GOODS_PRICE IN (225000, 450000, 675000, 900000) THEN 1 ELSE 0 END",
    "app_popular_AMT_GOODS_PRICE": "CASE WHEN AMT_GOODS_PRICE IN (1125000, 1350000, 1575000, 1800000, 2250000) THEN 1 ELSE 0 END",
    "app_EXT_SOURCE_std": f"coalesce(list_stddev_samp({PRESENT}), avg(list_stddev_samp({PRESENT})) OVER ())",
}
APP_KEPT = [f"FLAG_DOCUMENT_{i}" for i in (3, 4, 5, 6, 7, 8, 9, 11, 18)] + [
    "TARGET", "FLAG_MOBIL", "FLAG_PHONE", "FLAG_EMAIL", "DAYS_EMPLOYED", "DAYS_BIRTH", "DAYS_LAST_PHONE_CHANGE", "OWN_CAR_AGE",
    "REGION_RATING_CLIENT_W_CITY", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "AMT_REQ_CREDIT_BUREAU_QRT",
    "OBS_30_CNT_SOCIAL_CIRCLE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "CNT_CHILDREN", "CNT_FAM_MEMBERS",
]


@query(
    "credit_application",
    f"""
WITH a AS ({ROLES['application']}), tr AS (SELECT * FROM a WHERE TARGET IS NOT NULL),
k AS (SELECT * REPLACE (nullif(DAYS_EMPLOYED, {DAY}) AS DAYS_EMPLOYED, {nulled({
    'OWN_CAR_AGE': 'OWN_CAR_AGE > 80', 'REGION_RATING_CLIENT_W_CITY': 'REGION_RATING_CLIENT_W_CITY < 0',
    'AMT_INCOME_TOTAL': 'AMT_INCOME_TOTAL > 100000000', 'AMT_REQ_CREDIT_BUREAU_QRT': 'AMT_REQ_CREDIT_BUREAU_QRT > 10',
    'OBS_30_CNT_SOCIAL_CIRCLE': 'OBS_30_CNT_SOCIAL_CIRCLE > 40'})})
  FROM a WHERE CODE_GENDER IS DISTINCT FROM 'XNA' AND NAME_INCOME_TYPE IS DISTINCT FROM 'Maternity leave'
    AND NAME_FAMILY_STATUS IS DISTINCT FROM 'Unknown')
SELECT SK_ID_CURR, {', '.join(shown_sql(f'(SELECT avg(TARGET) FROM tr WHERE tr.{c} = k.{c})', c) for c in TEXT)},
  {', '.join(shown_sql(c, c) for c in APP_KEPT)}, {', '.join(shown_sql(e, n) for n, e in APP_SQL.items())} FROM k""",
)
def credit_application(spark, folder):
    t = credit_tables(spark, folder)
    return published(credit.application(t["application_train"], t["application_test"]))


DOCS = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
SECOND_SQL = {
    "NEW_CREDIT_TO_ANNUITY_RATIO": over("AMT_CREDIT", "AMT_ANNUITY"),
    "NEW_CREDIT_TO_GOODS_RATIO": over("AMT_CREDIT", "AMT_GOODS_PRICE"),
    "NEW_DOC_IND_KURT": f"coalesce(list_kurtosis([{', '.join(f'{d}::DOUBLE' for d in DOCS)}]), 0)",
    "NEW_LIVE_IND_SUM": "FLAG_MOBIL + FLAG_PHONE + FLAG_EMAIL",
    "NEW_INC_PER_CHLD": over("AMT_INCOME_TOTAL", "(1 + CNT_CHILDREN)"),
    "NEW_INC_BY_ORG": "median(AMT_INCOME_TOTAL) OVER (PARTITION BY ORGANIZATION_TYPE)",
    "NEW_EMPLOY_TO_BIRTH_RATIO": over("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "NEW_ANNUITY_TO_INCOME_RATIO": over("AMT_ANNUITY", "(1 + AMT_INCOME_TOTAL)"),
    "NEW_SOURCES_PROD": "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3",
    "NEW_EXT_SOURCES_MEAN": f"list_avg({PRESENT})",
    "NEW_SCORES_STD": f"coalesce(list_stddev_samp({PRESENT}), avg(list_stddev_samp({PRESENT})) OVER ())",
    "NEW_CAR_TO_BIRTH_RATIO": over("OWN_CAR_AGE", "DAYS_BIRTH"),
    "NEW_CAR_TO_EMPLOY_RATIO": over("OWN_CAR_AGE", "DAYS_EMPLOYED"),
    "NEW_PHONE_TO_BIRTH_RATIO": over("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    "NEW_PHONE_TO_BIRTH_RATIO_EMPLOYER": over("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
    "NEW_CREDIT_TO_INCOME_RATIO": over("AMT_CREDIT", "AMT_INCOME_TOTAL"),
}
SECOND_ONE_HOT = {
    "NAME_INCOME_TYPE": ["Maternity leave", "Pensioner", "Working"],
    "NAME_FAMILY_STATUS": ["Married", "Single", "Unknown"],
    "ORGANIZATION_TYPE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}


def first_seen_sql(c: str) -> str:
    return f"(SELECT count(DISTINCT b.{c}) FROM f b WHERE b.first_{c} < f.first_{c})"


@query(
    "second_application",
    f"""
WITH a AS ({ROLES['application']}),
k AS (SELECT * REPLACE (nullif(DAYS_EMPLOYED, {DAY}) AS DAYS_EMPLOYED) FROM a WHERE CODE_GENDER IS DISTINCT FROM 'XNA'),
f AS (SELECT *, {', '.join(f'min(SK_ID_CURR) OVER (PARTITION BY {c}) AS first_{c}' for c in ('CODE_GENDER', 'FLAG_OWN_CAR', 'FLAG_OWN_REALTY'))} FROM k)
SELECT SK_ID_CURR, {', '.join(shown_sql(f'dense_rank() OVER (ORDER BY first_{c}) - 1', c) for c in ('CODE_GENDER', 'FLAG_OWN_CAR', 'FLAG_OWN_REALTY'))},
  FLAG_DOCUMENT_3::DOUBLE AS FLAG_DOCUMENT_3, {', '.join(shown_sql(c, c) for c in APP_KEPT if not c.startswith('FLAG_DOC'))},
  {', '.join(f'{share_sql(c, v)} AS {c}_{name_of(v)}' for c, vs in SECOND_ONE_HOT.items() for v in vs)},
  {', '.join(shown_sql(e, n) for n, e in SECOND_SQL.items())} FROM f""",
)
def second_application(spark, folder):
    t = credit_tables(spark, folder)
    return published(credit.second_application(t["application_train"], t["application_test"]))


# --- bureau -----------------------------------------------------------------------------------

HISTORY_SQL = f"""bal AS ({ROLES['bureau_balance']}),
r AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_BUREAU, STATUS IS NULL ORDER BY MONTHS_BALANCE, STATUS) AS lo,
  row_number() OVER (PARTITION BY SK_ID_BUREAU, STATUS IS NULL ORDER BY MONTHS_BALANCE DESC, STATUS DESC) AS hi FROM bal),
h AS (SELECT SK_ID_BUREAU, max(CASE WHEN lo = 1 THEN STATUS END) AS First_status, max(CASE WHEN hi = 1 THEN STATUS END) AS Last_status,
  abs(min(MONTHS_BALANCE)) AS "Month", abs(min(MONTHS_BALANCE) FILTER (WHERE STATUS = 'C')) AS When_closed,
  {', '.join(f"nullif(count(*) FILTER (WHERE STATUS = '{s}'), 0) AS DPD_{s}_cnt" for s in '012345')},
  min(MONTHS_BALANCE) AS MONTHS_BALANCE_MIN, max(MONTHS_BALANCE) AS MONTHS_BALANCE_MAX, count(*) AS MONTHS_BALANCE_SIZE,
  {', '.join(f"avg({share_sql('STATUS', s)}) AS STATUS_{name_of(s)}_MEAN" for s in STATUSES)} FROM r GROUP BY SK_ID_BUREAU),
loan AS (SELECT * EXCLUDE (First_status, Last_status), "Month" - When_closed AS Month_closed_to_end,
  {', '.join(f'DPD_{s}_cnt::DOUBLE / nullif("Month", 0) AS DPD_{s}_per_Month' for s in '012345')},
  {' + '.join(f'coalesce(DPD_{s}_cnt, 0)' for s in '12345')} AS Non_zero_DPD_cnt,
  {', '.join(f"{share_sql(e, s)} AS {e}_{name_of(s)}" for e in ('First_status', 'Last_status') for s in STATUSES)} FROM h)"""
LOAN_NUMBERS = (
    ["Month", "When_closed"]
    + [f"DPD_{s}_cnt" for s in "012345"]
    + ["MONTHS_BALANCE_MIN", "MONTHS_BALANCE_MAX", "MONTHS_BALANCE_SIZE", "Month_closed_to_end"]
    + [f"DPD_{s}_per_Month" for s in "012345"]
    + ["Non_zero_DPD_cnt"]
)
LOAN_SHARES = [f"STATUS_{name_of(s)}_MEAN" for s in STATUSES] + [
    f"{e}_{name_of(s)}" for e in ("First_status", "Last_status") for s in STATUSES
]


@query(
    "credit_bureau_balance",
    f"""WITH {HISTORY_SQL} SELECT SK_ID_BUREAU, {', '.join(shown_sql(f'"{c}"', c) for c in LOAN_NUMBERS + LOAN_SHARES)} FROM loan""",
)
def credit_bureau_balance(spark, folder):
    return published(credit.bureau_balance(credit_tables(spark, folder)["bureau_balance"]))


BUREAU_NUMBERS = [
    "AMT_ANNUITY", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_MAX_OVERDUE",
    "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "DAYS_CREDIT_UPDATE",
]
BUREAU_GAPS = [
    ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"), ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_LIMIT"), ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_OVERDUE"),
    ("DAYS_CREDIT", "CREDIT_DAY_OVERDUE"), ("DAYS_CREDIT", "DAYS_CREDIT_ENDDATE"), ("DAYS_CREDIT", "DAYS_ENDDATE_FACT"),
    ("DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT"), ("DAYS_CREDIT_UPDATE", "DAYS_CREDIT_ENDDATE"),
]
BUREAU_SHARES = {"CREDIT_ACTIVE": CATEGORIES["CREDIT_ACTIVE"], "CREDIT_TYPE": CATEGORIES["CREDIT_TYPE"]}
BUREAU_SUBSETS = {"ACTIVE_": "Active", "CLOSED_": "Closed"}
BUREAU_MEASURES = {
    **{c: FIVE for c in BUREAU_NUMBERS},
    **{f"bureau_{a}_minus_{b}": FIVE for a, b in BUREAU_GAPS},
    **{c: FIVE for c in LOAN_NUMBERS},
    **{c: ["mean"] for c in LOAN_SHARES},
}


@query(
    "credit_bureau",
    f"""
WITH {HISTORY_SQL}, b0 AS ({ROLES['bureau']}),
b1 AS (SELECT * REPLACE ({nulled({
    'AMT_ANNUITY': 'AMT_ANNUITY > 80000000', 'AMT_CREDIT_SUM': 'AMT_CREDIT_SUM > 300000000',
    'AMT_CREDIT_SUM_DEBT': 'AMT_CREDIT_SUM_DEBT > 100000000', 'AMT_CREDIT_MAX_OVERDUE': 'AMT_CREDIT_MAX_OVERDUE > 80000000',
    'DAYS_ENDDATE_FACT': 'DAYS_ENDDATE_FACT < -10000', 'DAYS_CREDIT_UPDATE': 'DAYS_CREDIT_UPDATE > 0 OR DAYS_CREDIT_UPDATE < -40000',
    'DAYS_CREDIT_ENDDATE': 'DAYS_CREDIT_ENDDATE < -10000'})}) FROM b0),
b AS (SELECT b1.*, loan.* EXCLUDE (SK_ID_BUREAU), {', '.join(f'{a} - {c} AS bureau_{a}_minus_{c}' for a, c in BUREAU_GAPS)}
  FROM b1 LEFT JOIN loan ON loan.SK_ID_BUREAU = b1.SK_ID_BUREAU WHERE NOT coalesce(DAYS_ENDDATE_FACT < DAYS_CREDIT, false))
{rollup_sql('b', 'BURO_', BUREAU_MEASURES, BUREAU_SHARES, 'BURO_COUNT', 'CREDIT_ACTIVE', BUREAU_SUBSETS)}""",
)
def credit_bureau(spark, folder):
    t = credit_tables(spark, folder)
    return published(credit.bureau(t["bureau"], t["bureau_balance"]))


SECOND_BUREAU = {
    "DAYS_CREDIT": ["mean", "var"], "DAYS_CREDIT_ENDDATE": ["mean"], "DAYS_CREDIT_UPDATE": ["mean"], "CREDIT_DAY_OVERDUE": ["mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"], "AMT_CREDIT_SUM": ["mean", "sum"], "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"], "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"], "AMT_ANNUITY": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum"], "MONTHS_BALANCE_MIN": ["min"], "MONTHS_BALANCE_MAX": ["max"], "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}


@query(
    "second_bureau",
    f"""
WITH bal AS ({ROLES['bureau_balance']}), m AS (SELECT SK_ID_BUREAU, min(MONTHS_BALANCE) AS MONTHS_BALANCE_MIN, max(MONTHS_BALANCE) AS MONTHS_BALANCE_MAX,
  count(*) AS MONTHS_BALANCE_SIZE, {', '.join(f"avg({share_sql('STATUS', s)}) AS STATUS_{name_of(s)}_MEAN" for s in STATUSES)} FROM bal GROUP BY 1),
b0 AS ({ROLES['bureau']}), b AS (SELECT b0.*, m.* EXCLUDE (SK_ID_BUREAU) FROM b0 LEFT JOIN m ON m.SK_ID_BUREAU = b0.SK_ID_BUREAU),
x AS ({rollup_sql('b', 'BURO_', SECOND_BUREAU, {**BUREAU_SHARES, 'CREDIT_ACTIVE': CATEGORIES['CREDIT_ACTIVE'] + [None]}, None, 'CREDIT_ACTIVE', BUREAU_SUBSETS, False)}),
y AS ({rollup_sql('b', 'BURO_', {f'STATUS_{name_of(s)}_MEAN': ['mean'] for s in STATUSES}, {})})
SELECT x.*, y.* EXCLUDE (SK_ID_CURR) FROM x JOIN y ON y.SK_ID_CURR = x.SK_ID_CURR""",
)
def second_bureau(spark, folder):
    t = credit_tables(spark, folder)
    return published(credit.second_bureau(t["bureau"], t["bureau_balance"]))


SIX = ["mean", "std", "min", "max", "sum", "nunique"]
SUMMARY_BALANCE = ["MONTHS_BALANCE", "STATUS"]
BALANCE_COLUMNS = [f"BAL_{c}_{fn.upper()}" for c in SUMMARY_BALANCE for fn in SIX]


def _steady(expr: str, function: str) -> str:
    """Deviations without their last bits, which depend on the order of the sum."""
    return f"round({expr}, 6)" if function == "std" else expr


@query(
    "summary_bureau",
    f"""
WITH bal AS (SELECT SK_ID_BUREAU, MONTHS_BALANCE, CASE WHEN STATUS IS NOT NULL THEN dense_rank() OVER (ORDER BY STATUS NULLS LAST) END AS STATUS
  FROM ({ROLES['bureau_balance']})),
s AS (SELECT SK_ID_BUREAU, {', '.join(f"{_steady(FUNCTION_SQL[fn].format(c=c, f=''), fn)} AS BAL_{c}_{fn.upper()}" for c in SUMMARY_BALANCE for fn in SIX)} FROM bal GROUP BY 1),
b0 AS (SELECT * REPLACE (dense_rank() OVER (ORDER BY CREDIT_ACTIVE) AS CREDIT_ACTIVE,
    CASE WHEN CREDIT_TYPE IS NOT NULL THEN dense_rank() OVER (ORDER BY CREDIT_TYPE NULLS LAST) END AS CREDIT_TYPE) FROM ({ROLES['bureau']})),
b AS (SELECT b0.*, s.* EXCLUDE (SK_ID_BUREAU) FROM b0 LEFT JOIN s ON s.SK_ID_BUREAU = b0.SK_ID_BUREAU)
{rollup_sql('b', 'BUR_', {c: SIX for c in [*BUREAU_NUMBERS, 'CREDIT_ACTIVE', 'CREDIT_TYPE', *BALANCE_COLUMNS]}, {})}""",
)
def summary_bureau(spark, folder):
    t = credit_tables(spark, folder)
    return published(credit.summary_bureau(t["bureau"], t["bureau_balance"]))


# --- previous applications --------------------------------------------------------------------

PREV_DAYS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION"]
PREV_NUMBERS = [
    "AMT_APPLICATION", "AMT_CREDIT", "AMT_ANNUITY", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE", "SELLERPLACE_AREA",
    "HOUR_APPR_PROCESS_START", "RATE_DOWN_PAYMENT", "CNT_PAYMENT", "DAYS_DECISION", *PREV_DAYS,
]
PREV_FORMULAS = {
    "prev_AMT_APPLICATION_per_AMT_CREDIT": "AMT_APPLICATION / nullif(AMT_CREDIT, 0)",
    "prev_AMT_APPLICATION_minus_AMT_CREDIT": "AMT_APPLICATION - AMT_CREDIT",
    "prev_AMT_APPLICATION_minus_AMT_GOODS_PRICE": "AMT_APPLICATION - AMT_GOODS_PRICE",
    "prev_AMT_GOODS_PRICE_minus_AMT_CREDIT": "AMT_GOODS_PRICE - AMT_CREDIT",
    "prev_DAYS_FIRST_DRAWING_minus_DAYS_FIRST_DUE": "DAYS_FIRST_DRAWING - DAYS_FIRST_DUE",
    "prev_DAYS_TERMINATION_less_500": "CASE WHEN DAYS_TERMINATION < -500 THEN 1 ELSE 0 END",
    "prev_missing": " + ".join(f"({c} IS NULL)::INTEGER" for c in PREV_NUMBERS),
}
PREV_SHARES = {"NAME_CONTRACT_STATUS": CATEGORIES["PREV_STATUS"], "NAME_CONTRACT_TYPE": CATEGORIES["PRIORITY"]}
PREV_SUBSETS = {"APPROVED_": "Approved", "REFUSED_": "Refused"}
PREV_NULLED = ", ".join(f"nullif({c}, {DAY}) AS {c}" for c in PREV_DAYS)


@query(
    "credit_previous",
    f"""
WITH p0 AS ({ROLES['previous_application']}),
p1 AS (SELECT * REPLACE ({nulled({'AMT_CREDIT': 'AMT_CREDIT > 6000000', 'SELLERPLACE_AREA': 'SELLERPLACE_AREA > 3500000'})}, {PREV_NULLED}) FROM p0),
p AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in PREV_FORMULAS.items())} FROM p1)
{rollup_sql('p', 'PREV_', {c: FIVE for c in [*PREV_NUMBERS, *PREV_FORMULAS]}, PREV_SHARES, 'PREV_COUNT', 'NAME_CONTRACT_STATUS', PREV_SUBSETS)}""",
)
def credit_previous(spark, folder):
    return published(credit.previous_application(credit_tables(spark, folder)["previous_application"]))


SECOND_PREV = {
    **{c: ["max", "mean"] for c in ("AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "APP_CREDIT_PERC", "AMT_DOWN_PAYMENT",
                                    "AMT_GOODS_PRICE", "HOUR_APPR_PROCESS_START", "RATE_DOWN_PAYMENT", "DAYS_DECISION")},
    "CNT_PAYMENT": ["mean", "sum"],
}


@query(
    "second_previous",
    f"""
WITH p AS (SELECT *, AMT_APPLICATION / nullif(AMT_CREDIT, 0) AS APP_CREDIT_PERC FROM ({ROLES['previous_application']}))
{rollup_sql('p', 'PREV_', SECOND_PREV, {c: [*v, None] for c, v in PREV_SHARES.items()}, None, 'NAME_CONTRACT_STATUS', PREV_SUBSETS, False)}""",
)
def second_previous(spark, folder):
    return published(credit.second_previous(credit_tables(spark, folder)["previous_application"]))


@query(
    "summary_previous",
    f"""
WITH p AS (SELECT * REPLACE ({PREV_NULLED}, dense_rank() OVER (ORDER BY NAME_CONTRACT_STATUS) AS NAME_CONTRACT_STATUS,
    dense_rank() OVER (ORDER BY NAME_CONTRACT_TYPE) AS NAME_CONTRACT_TYPE),
  AMT_APPLICATION / nullif(AMT_CREDIT, 0) AS APP_CREDIT_PERC FROM ({ROLES['previous_application']}))
{rollup_sql('p', 'PRE_', {c: SIX for c in [*PREV_NUMBERS, 'NAME_CONTRACT_STATUS', 'NAME_CONTRACT_TYPE', 'APP_CREDIT_PERC']}, {})}""",
)
def summary_previous(spark, folder):
    return published(credit.summary_previous(credit_tables(spark, folder)["previous_application"]))


# --- POS, instalments, card -------------------------------------------------------------------

POS_SHARES = {"NAME_CONTRACT_STATUS": CATEGORIES["POS_STATUS"]}


@query(
    "credit_pos",
    f"""
WITH p0 AS (SELECT * REPLACE ({nulled({'CNT_INSTALMENT_FUTURE': 'CNT_INSTALMENT_FUTURE > 60'})}) FROM ({ROLES['POS_CASH_balance']})),
p AS (SELECT *, CASE WHEN CNT_INSTALMENT > CNT_INSTALMENT_FUTURE THEN 1 ELSE 0 END AS pos_CNT_INSTALMENT_more_FUTURE FROM p0)
{rollup_sql('p', 'POS_', {c: FIVE for c in ('MONTHS_BALANCE', 'CNT_INSTALMENT', 'CNT_INSTALMENT_FUTURE', 'SK_DPD', 'SK_DPD_DEF', 'pos_CNT_INSTALMENT_more_FUTURE')}, POS_SHARES, 'POS_COUNT')}""",
)
def credit_pos(spark, folder):
    return published(credit.pos_cash(credit_tables(spark, folder)["POS_CASH_balance"]))


@query(
    "second_pos",
    f"""WITH p AS ({ROLES['POS_CASH_balance']})
{rollup_sql('p', 'POS_', {c: ['max', 'mean'] for c in ('MONTHS_BALANCE', 'SK_DPD', 'SK_DPD_DEF')}, {c: [*v, None] for c, v in POS_SHARES.items()}, 'POS_COUNT')}""",
)
def second_pos(spark, folder):
    return published(credit.second_pos_cash(credit_tables(spark, folder)["POS_CASH_balance"]))


INS_NUMBERS = ["NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"]
INS_FORMULAS = {
    "ins_DAYS_ENTRY_PAYMENT_minus_DAYS_INSTALMENT": "DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT",
    "ins_AMT_INSTALMENT_minus_AMT_PAYMENT": "AMT_INSTALMENT - AMT_PAYMENT",
    "ins_AMT_PAYMENT_per_AMT_INSTALMENT": "AMT_PAYMENT / nullif(AMT_INSTALMENT, 0)",
    "ins_NUM_INSTALMENT_NUMBER_100": "CASE WHEN NUM_INSTALMENT_NUMBER = 100 THEN 1 ELSE 0 END",
    "ins_DAYS_INSTALMENT_above_line": "CASE WHEN DAYS_INSTALMENT > NUM_INSTALMENT_NUMBER::DOUBLE * 50 / 3 - 11500::DOUBLE / 3 THEN 1 ELSE 0 END",
}


@query(
    "credit_instalments",
    f"""
WITH i0 AS (SELECT * REPLACE ({nulled({'NUM_INSTALMENT_VERSION': 'NUM_INSTALMENT_VERSION > 70', 'DAYS_ENTRY_PAYMENT': 'DAYS_ENTRY_PAYMENT < -4000'})})
  FROM ({ROLES['installments_payments']})),
i AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in INS_FORMULAS.items())} FROM i0)
{rollup_sql('i', 'INS_', {c: FIVE for c in [*INS_NUMBERS, *INS_FORMULAS]}, {}, 'INSTAL_COUNT')}""",
)
def credit_instalments(spark, folder):
    return published(credit.instalments(credit_tables(spark, folder)["installments_payments"]))


def payments_sql(null_as_zero: bool) -> str:
    rest = "ELSE 0" if null_as_zero else "WHEN {x} <= 0 THEN 0"
    late, early = "DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT", "DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT"
    clamp = lambda x: f"CASE WHEN {x} > 0 THEN {x} {rest.format(x=x)} END"
    return f"""SELECT *, AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS PAYMENT_PERC, AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
  {clamp(late)} AS DPD, {clamp(early)} AS DBD FROM ({ROLES['installments_payments']})"""


SECOND_INS = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum", "min", "std"], "DBD": ["max", "mean", "sum", "min", "std"],
    "PAYMENT_PERC": ["max", "mean", "var", "min", "std"], "PAYMENT_DIFF": ["max", "mean", "var", "min", "std"],
    "AMT_INSTALMENT": ["max", "mean", "sum", "min", "std"], "AMT_PAYMENT": ["min", "max", "mean", "sum", "std"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum", "std"],
}


@query("second_instalments", f"WITH i AS ({payments_sql(True)}) {rollup_sql('i', 'INSTAL_', SECOND_INS, {}, 'INSTAL_COUNT')}")
def second_instalments(spark, folder):
    return published(credit.second_instalments(credit_tables(spark, folder)["installments_payments"]))


@query(
    "summary_instalments",
    f"WITH i AS ({payments_sql(False)}) {rollup_sql('i', 'PAY_', {c: SIX for c in [*INS_NUMBERS, 'PAYMENT_PERC', 'PAYMENT_DIFF', 'DPD', 'DBD']}, {})}",
)
def summary_instalments(spark, folder):
    payments = credit.with_payment_features(credit_tables(spark, folder)["installments_payments"], null_as_zero=False)
    return published(credit.summary(payments, "SK_ID_CURR", "PAY_", ["SK_ID_PREV"]))


CARD_NUMBERS = [
    "MONTHS_BALANCE", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_PAYMENT_CURRENT", "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT",
    "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT", "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE", "SK_DPD", "SK_DPD_DEF",
]
CARD_GAPS = [
    ("SK_DPD", "MONTHS_BALANCE"), ("SK_DPD_DEF", "MONTHS_BALANCE"), ("SK_DPD", "SK_DPD_DEF"),
    ("AMT_TOTAL_RECEIVABLE", "AMT_RECIVABLE"), ("AMT_TOTAL_RECEIVABLE", "AMT_RECEIVABLE_PRINCIPAL"), ("AMT_RECIVABLE", "AMT_RECEIVABLE_PRINCIPAL"),
    ("AMT_BALANCE", "AMT_RECIVABLE"), ("AMT_BALANCE", "AMT_RECEIVABLE_PRINCIPAL"), ("AMT_BALANCE", "AMT_TOTAL_RECEIVABLE"),
    ("AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_ATM_CURRENT"), ("AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT"), ("AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_POS_CURRENT"),
]
CARD_FORMULAS = {
    "card_missing": " + ".join(f"({c} IS NULL)::INTEGER" for c in CARD_NUMBERS),
    **{f"card_{a}_minus_{b}": f"{a} - {b}" for a, b in CARD_GAPS},
}
CARD_SHARES = {"NAME_CONTRACT_STATUS": CATEGORIES["CARD_STATUS"]}


@query(
    "credit_card",
    f"""
WITH c0 AS (SELECT * REPLACE ({nulled({'AMT_PAYMENT_CURRENT': 'AMT_PAYMENT_CURRENT > 4000000', 'AMT_CREDIT_LIMIT_ACTUAL': 'AMT_CREDIT_LIMIT_ACTUAL > 1000000'})})
  FROM ({ROLES['credit_card_balance']})),
c AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in CARD_FORMULAS.items())} FROM c0)
{rollup_sql('c', 'CARD_', {c: FIVE for c in [*CARD_NUMBERS, *CARD_FORMULAS]}, CARD_SHARES, 'CARD_COUNT')}""",
)
def credit_card(spark, folder):
    return published(credit.card_balance(credit_tables(spark, folder)["credit_card_balance"]))


CARD_CODES = {f"NAME_CONTRACT_STATUS_{name_of(v)}": v for v in [*CATEGORIES["CARD_STATUS"], None]}


@query(
    "second_card",
    f"""
WITH c AS (SELECT *, {', '.join(f"{share_sql('NAME_CONTRACT_STATUS', v)} AS {n}" for n, v in CARD_CODES.items())} FROM ({ROLES['credit_card_balance']}))
{rollup_sql('c', 'CC_', {c: ['max', 'mean', 'sum', 'var'] for c in [*CARD_NUMBERS, *CARD_CODES]}, {}, 'CC_COUNT')}""",
)
def second_card(spark, folder):
    return published(credit.second_card_balance(credit_tables(spark, folder)["credit_card_balance"]))


# --- whole feature sets -----------------------------------------------------------------------


def joined_sql(first: str, *others: str) -> str:
    """Left joins of the tables' own SQL on the applicant."""
    joins = " ".join(f"LEFT JOIN ({REGISTRY[n].sql}) USING (SK_ID_CURR)" for n in others)
    return f"SELECT * FROM ({REGISTRY[first].sql}) {joins}"


@query(
    "wide_text_shares",
    f"""
WITH p AS ({ROLES['POS_CASH_balance']}), n AS (SELECT SK_ID_CURR, count(*) AS n FROM p GROUP BY SK_ID_CURR)
SELECT SK_ID_CURR, 'POS_' AS prefix, 'NAME_GOODS' AS "column", 'goods ' || SK_ID_PREV AS value, round(count(*)::DOUBLE / any_value(n), 6) AS share
FROM p JOIN n USING (SK_ID_CURR) GROUP BY SK_ID_CURR, SK_ID_PREV""",
)
def wide_text_shares(spark, folder):
    """What the canonical POS rollup leaves out: the shares of a text column of more than 1,000 values."""
    pos = credit_tables(spark, folder)["POS_CASH_balance"].withColumn("NAME_GOODS", F.concat(F.lit("goods "), F.col("SK_ID_PREV")))
    left_out: list = []
    credit.pos_cash(pos, left_out)
    return left_out[0].withColumn("share", F.round("share", 6))


@query("canonical_features", joined_sql("credit_application", "credit_bureau", "credit_previous", "credit_pos", "credit_instalments", "credit_card"))
def canonical_features(spark, folder):
    return published(credit.canonical_features(credit_tables(spark, folder)))


@query("second_features", joined_sql("second_application", "second_bureau", "second_previous", "second_pos", "second_instalments", "second_card"))
def second_features(spark, folder):
    return published(credit.second_features(credit_tables(spark, folder)))


@query("summary_features")
def summary_features(spark, folder):
    return credit.summary_features(credit_tables(spark, folder))
