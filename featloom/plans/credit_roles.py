"""Credit-shaped tables derived from the given tables.

The text is plain SQL that both Spark and the comparison engine run, so that a
query and its SQL counterpart start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featloom.sources.tables import table


def _flag(name: str, every: int) -> str:
    return f"CASE WHEN c_custkey % {every} = 0 THEN 1 ELSE 0 END AS {name}"


APPLICATION = f"""
SELECT c_custkey AS SK_ID_CURR,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 11 < 3 THEN 1 ELSE 0 END AS TARGET,
  CASE WHEN c_custkey % 97 = 0 THEN 'XNA' WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS CODE_GENDER,
  CASE WHEN c_custkey % 89 = 0 THEN 'Maternity leave' WHEN c_custkey % 4 = 0 THEN 'Pensioner' ELSE 'Working' END AS NAME_INCOME_TYPE,
  CASE WHEN c_custkey % 83 = 0 THEN 'Unknown' WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Married' ELSE 'Single' END AS NAME_FAMILY_STATUS,
  c_mktsegment AS ORGANIZATION_TYPE,
  CASE WHEN c_custkey % 3 = 1 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
  CASE WHEN c_custkey % 7 < 4 THEN 'Y' ELSE 'N' END AS FLAG_OWN_REALTY,
  1 AS FLAG_MOBIL, {_flag('FLAG_PHONE', 2)}, {_flag('FLAG_EMAIL', 9)},
  {', '.join(_flag(f'FLAG_DOCUMENT_{i}', i + 1) for i in range(2, 22))},
  CASE WHEN c_custkey % 7 = 0 THEN 365243 ELSE -(c_custkey * 37 % 9000) - 1 END AS DAYS_EMPLOYED,
  -(7000 + c_custkey * 91 % 18000) AS DAYS_BIRTH,
  -(c_custkey * 13 % 4000) AS DAYS_LAST_PHONE_CHANGE,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 91 END AS OWN_CAR_AGE,
  c_nationkey % 4 - 1 AS REGION_RATING_CLIENT_W_CITY,
  CASE WHEN c_custkey % 101 = 0 THEN CAST(200000000 AS DOUBLE) ELSE (c_acctbal + 2000) * 10 END AS AMT_INCOME_TOTAL,
  CAST(c_custkey * 7919 % 90000 AS DOUBLE) AS AMT_CREDIT,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_custkey * 31 % 2300 AS DOUBLE) END AS AMT_ANNUITY,
  CAST(225000 * (c_custkey % 11) AS DOUBLE) AS AMT_GOODS_PRICE,
  c_custkey % 14 AS AMT_REQ_CREDIT_BUREAU_QRT, c_custkey % 50 AS OBS_30_CNT_SOCIAL_CIRCLE,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey % 100 AS DOUBLE) / 100 END AS EXT_SOURCE_1,
  CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE CAST(c_custkey * 7 % 100 AS DOUBLE) / 100 END AS EXT_SOURCE_2,
  CASE WHEN c_custkey % 8 < 3 THEN NULL ELSE CAST(c_custkey * 13 % 100 AS DOUBLE) / 100 END AS EXT_SOURCE_3,
  c_custkey % 4 AS CNT_CHILDREN, c_custkey % 4 + c_custkey % 3 AS CNT_FAM_MEMBERS
FROM customer"""

BUREAU = """
SELECT o_orderkey AS SK_ID_BUREAU, o_custkey AS SK_ID_CURR,
  CASE WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Sold' END AS CREDIT_ACTIVE,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END AS CREDIT_TYPE,
  CASE WHEN o_orderkey % 301 = 0 THEN CAST(90000000 AS DOUBLE) WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 5000 AS DOUBLE) END AS AMT_ANNUITY,
  o_totalprice AS AMT_CREDIT_SUM,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey * 17 % 50000 AS DOUBLE) END AS AMT_CREDIT_SUM_DEBT,
  CAST(o_orderkey * 23 % 60000 AS DOUBLE) AS AMT_CREDIT_SUM_LIMIT, CAST(o_orderkey % 10 AS DOUBLE) AS AMT_CREDIT_SUM_OVERDUE,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 700 AS DOUBLE) END AS AMT_CREDIT_MAX_OVERDUE,
  o_orderkey % 60 AS CREDIT_DAY_OVERDUE, o_orderkey % 3 AS CNT_CREDIT_PROLONG,
  -(o_orderkey * 7 % 3000) AS DAYS_CREDIT,
  CASE WHEN o_orderkey % 211 = 0 THEN -20000 WHEN o_orderkey % 6 = 0 THEN NULL ELSE 2000 - o_orderkey * 11 % 5000 END AS DAYS_CREDIT_ENDDATE,
  CASE WHEN o_orderkey % 223 = 0 THEN -30000 WHEN o_orderkey % 2 = 0 THEN NULL ELSE -(o_orderkey * 5 % 2500) END AS DAYS_ENDDATE_FACT,
  CASE WHEN o_orderkey % 199 = 0 THEN 3 WHEN o_orderkey % 197 = 0 THEN -41000 ELSE -(o_orderkey % 900) END AS DAYS_CREDIT_UPDATE
FROM orders"""

BUREAU_BALANCE = """
SELECT l_orderkey AS SK_ID_BUREAU, -(l_partkey % 96) AS MONTHS_BALANCE,
  CASE WHEN l_suppkey % 9 < 6 THEN CAST(l_suppkey % 9 AS VARCHAR(1)) WHEN l_suppkey % 9 = 6 THEN 'C' WHEN l_suppkey % 9 = 7 THEN 'X' END AS STATUS
FROM lineitem"""

PREVIOUS_APPLICATION = """
SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
  CASE WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
  o_orderpriority AS NAME_CONTRACT_TYPE,
  CAST(o_orderkey * 29 % 40000 AS DOUBLE) AS AMT_APPLICATION,
  CASE WHEN o_orderkey % 151 = 0 THEN CAST(7000000 AS DOUBLE) ELSE CAST(o_orderkey * 31 % 41 AS DOUBLE) * 1000 END AS AMT_CREDIT,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 4000 AS DOUBLE) END AS AMT_ANNUITY,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_orderkey % 1500 AS DOUBLE) END AS AMT_DOWN_PAYMENT,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey * 37 % 45000 AS DOUBLE) END AS AMT_GOODS_PRICE,
  CASE WHEN o_orderkey % 149 = 0 THEN 4000000 ELSE o_orderkey % 300 END AS SELLERPLACE_AREA,
  o_orderkey % 24 AS HOUR_APPR_PROCESS_START,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_orderkey % 90 AS DOUBLE) / 100 END AS RATE_DOWN_PAYMENT,
  CAST(o_orderkey % 60 AS DOUBLE) AS CNT_PAYMENT, -(o_orderkey % 2900) AS DAYS_DECISION,
  CASE WHEN o_orderkey % 3 > 0 THEN 365243 ELSE -(o_orderkey % 2000) END AS DAYS_FIRST_DRAWING,
  CASE WHEN o_orderkey % 8 = 0 THEN 365243 ELSE -(o_orderkey * 3 % 2000) END AS DAYS_FIRST_DUE,
  CASE WHEN o_orderkey % 10 = 0 THEN 365243 ELSE -(o_orderkey * 7 % 2000) END AS DAYS_LAST_DUE_1ST_VERSION,
  CASE WHEN o_orderkey % 11 = 0 THEN 365243 ELSE -(o_orderkey * 9 % 2000) END AS DAYS_LAST_DUE,
  CASE WHEN o_orderkey % 12 = 0 THEN 365243 WHEN o_orderkey % 5 = 0 THEN NULL ELSE -(o_orderkey * 11 % 2000) END AS DAYS_TERMINATION
FROM orders"""

POS_CASH_BALANCE = """
SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, -(l_partkey % 96) AS MONTHS_BALANCE,
  CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(l_suppkey % 60 AS DOUBLE) END AS CNT_INSTALMENT,
  CAST(l_partkey % 70 AS DOUBLE) AS CNT_INSTALMENT_FUTURE,
  CASE WHEN l_returnflag = 'N' THEN 'Active' WHEN l_returnflag = 'R' THEN 'Completed' ELSE 'Signed' END AS NAME_CONTRACT_STATUS,
  l_partkey % 30 AS SK_DPD, l_suppkey % 5 AS SK_DPD_DEF
FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""

INSTALLMENTS_PAYMENTS = """
SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, CAST(l_partkey % 75 AS DOUBLE) AS NUM_INSTALMENT_VERSION,
  l_partkey % 120 AS NUM_INSTALMENT_NUMBER, CAST(-(l_partkey % 2900) AS DOUBLE) AS DAYS_INSTALMENT,
  CASE WHEN l_partkey % 131 = 0 THEN NULL WHEN l_partkey % 127 = 0 THEN CAST(-4500 AS DOUBLE)
    ELSE CAST(-(l_partkey % 2900) - 20 + l_suppkey % 40 AS DOUBLE) END AS DAYS_ENTRY_PAYMENT,
  CAST(l_partkey % 90 AS DOUBLE) * 100 AS AMT_INSTALMENT,
  CASE WHEN l_partkey % 131 = 0 THEN NULL ELSE l_quantity * 150 END AS AMT_PAYMENT
FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""

CREDIT_CARD_BALANCE = """
SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, -(l_partkey % 96) AS MONTHS_BALANCE,
  l_extendedprice AS AMT_BALANCE,
  CASE WHEN l_partkey % 137 = 0 THEN 2000000 ELSE l_partkey % 400 * 100 END AS AMT_CREDIT_LIMIT_ACTUAL,
  CASE WHEN l_partkey % 139 = 0 THEN CAST(5000000 AS DOUBLE) WHEN l_partkey % 6 = 0 THEN NULL ELSE l_quantity * 20 END AS AMT_PAYMENT_CURRENT,
  CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_quantity * 3 END AS AMT_DRAWINGS_ATM_CURRENT,
  l_quantity * 7 AS AMT_DRAWINGS_CURRENT, l_quantity AS AMT_DRAWINGS_OTHER_CURRENT,
  CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_quantity * 2 END AS AMT_DRAWINGS_POS_CURRENT,
  l_extendedprice - l_quantity AS AMT_RECEIVABLE_PRINCIPAL, l_extendedprice + l_quantity AS AMT_RECIVABLE,
  l_extendedprice + l_quantity * 2 AS AMT_TOTAL_RECEIVABLE,
  CASE WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Completed' END AS NAME_CONTRACT_STATUS,
  l_partkey % 30 AS SK_DPD, l_suppkey % 5 AS SK_DPD_DEF
FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""

ROLES = {
    "application": APPLICATION,
    "bureau": BUREAU,
    "bureau_balance": BUREAU_BALANCE,
    "previous_application": PREVIOUS_APPLICATION,
    "POS_CASH_balance": POS_CASH_BALANCE,
    "installments_payments": INSTALLMENTS_PAYMENTS,
    "credit_card_balance": CREDIT_CARD_BALANCE,
}
INPUTS = ("customer", "orders", "lineitem")


def role(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.sql(
        ROLES[name].replace("FROM customer", "FROM {customer}")
        .replace("FROM orders", "FROM {orders}")
        .replace("FROM lineitem", "FROM {lineitem}")
        .replace("JOIN orders", "JOIN {orders}"),
        **{t: table(spark, folder, t) for t in INPUTS},
    )


def credit_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    out = {name: role(spark, folder, name) for name in ROLES if name != "application"}
    everyone = role(spark, folder, "application")
    out["application_train"] = everyone.where("TARGET IS NOT NULL")
    out["application_test"] = everyone.where("TARGET IS NULL").drop("TARGET")
    return out
