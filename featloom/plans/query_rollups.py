"""Rollup, history, join and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.operators.assemble import stack_labelled, stack_runs, star_join, to_long
from featloom.operators.encode import group_median_lookup
from featloom.operators.rank import quantiles_by
from featloom.operators.rollup import (
    RollupSpec,
    category_shares,
    column_statistics,
    distinct_counts,
    first_and_last,
    rollup,
    rollup_subsets_by_join,
    rollup_with_subsets,
    share_of,
    status_history,
    summarise_all,
)
from featloom.plans.fixtures import (
    DOCS_SQL,
    FOLD_SCORES_SQL,
    GAPPED_SQL,
    LINE_ID,
    fold_scores,
    gapped_lines,
    labelled_documents,
)
from featloom.plans.registry import OFF_TIE, query, round_sql, rounded
from featloom.sources.tables import table
from featloom.workspace import lookup_join

SIX = ("min", "max", "mean", "var", "sum")
TWO_LEVEL_COLUMNS = ["o_totalprice", "LINE_l_extendedprice_SUM", "LINE_l_quantity_MEAN", "price_share"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SQL_FUNCTIONS = {
    "min": "min({c}) {f}",
    "max": "max({c}) {f}",
    "mean": "avg({c}) {f}",
    "var": "var_samp({c}) {f}",
    "std": "stddev_samp({c}) {f}",
    "sum": "CASE WHEN count(*) {f} > 0 THEN coalesce(sum({c}) {f}, 0) END",
}


def two_level_features(spark, folder):
    lines = rollup(
        table(spark, folder, "lineitem"),
        RollupSpec(
            "l_orderkey",
            "LINE_",
            {"l_extendedprice": ["sum", "max"], "l_quantity": ["mean"], "l_discount": ["min"]},
            {},
            "LINE_COUNT",
        ),
    )
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    loans = orders.join(lines, "l_orderkey", "left").withColumn(
        "price_share", F.try_divide("o_totalprice", "LINE_l_extendedprice_SUM")
    )
    spec = RollupSpec(
        "o_custkey", "ALL_", {c: SIX for c in TWO_LEVEL_COLUMNS}, {"o_orderpriority": PRIORITIES}, "COUNT"
    )
    features = rollup_with_subsets(loans, spec, "o_orderstatus", {"OPEN_": "O", "DONE_": "F"}, subset_shares=False)
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return star_join(base, [features], "o_custkey")


def variance_digits(column: str) -> int:
    """Squared prices have about ten digits before the point, so their last kept digit is in the thousands."""
    return -3 if "price" in column and column != "price_share" else 4


def _two_level_sql() -> str:
    out = []
    for prefix, f in (("ALL_", ""), ("OPEN_", "FILTER (WHERE o_orderstatus = 'O')"), ("DONE_", "FILTER (WHERE o_orderstatus = 'F')")):
        for c in TWO_LEVEL_COLUMNS:
            for fn in SIX:
                digits = variance_digits(c) if fn == "var" else 4
                out.append(f"{round_sql(SQL_FUNCTIONS[fn].format(c=c, f=f), digits)} AS {prefix}{c}_{fn.upper()}")
        name = "COUNT" if prefix == "ALL_" else f"{prefix}COUNT"
        out.append(f"nullif(count(*) {f}, 0) AS {name}")
    for p in PRIORITIES:
        name = p.replace("-", "_").replace(" ", "_")
        out.append(f"{round_sql(f'avg(CASE WHEN o_orderpriority = {chr(39)}{p}{chr(39)} THEN 1 ELSE 0 END)')} AS ALL_o_orderpriority_{name}_MEAN")
    return f"""
WITH li AS (
  SELECT l_orderkey, sum(l_extendedprice) AS LINE_l_extendedprice_SUM, avg(l_quantity) AS LINE_l_quantity_MEAN
  FROM lineitem GROUP BY l_orderkey),
loans AS (
  SELECT o.*, li.*, o_totalprice / nullif(LINE_l_extendedprice_SUM, 0) AS price_share
  FROM orders o LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
feats AS (SELECT o_custkey, {', '.join(out)} FROM loans GROUP BY o_custkey)
SELECT c_custkey AS o_custkey, c_mktsegment, {round_sql('c_acctbal')} AS c_acctbal, feats.* EXCLUDE (o_custkey)
FROM customer LEFT JOIN feats ON feats.o_custkey = c_custkey"""


@query("two_level_rollup", _two_level_sql())
def two_level_rollup(spark, folder):
    df = two_level_features(spark, folder)
    names = {f"{p}{c}_VAR": variance_digits(c) for p in ("ALL_", "OPEN_", "DONE_") for c in TWO_LEVEL_COLUMNS}
    coarse = {n: F.round(F.col(n) + OFF_TIE, d) for n, d in names.items() if d < 0}
    return rounded(df.withColumns(coarse), shift=OFF_TIE)


@query(
    "subset_rollup_distinct",
    """
SELECT o_custkey,
  count(DISTINCT o_orderpriority) AS ALL_o_orderpriority_NUNIQUE, round(max(o_totalprice), 4) AS ALL_o_totalprice_MAX,
  count(DISTINCT o_orderpriority) FILTER (WHERE o_orderstatus = 'F')
    + CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') = 0 THEN NULL ELSE 0 END AS DONE_o_orderpriority_NUNIQUE,
  round(max(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4) AS DONE_o_totalprice_MAX
FROM orders GROUP BY o_custkey""",
)
def subset_rollup_distinct(spark, folder):
    spec = RollupSpec("o_custkey", "ALL_", {"o_orderpriority": ["nunique"], "o_totalprice": ["max"]})
    return rounded(rollup_subsets_by_join(table(spark, folder, "orders"), spec, "o_orderstatus", {"DONE_": "F"}))


@query(
    "rollup_functions",
    f"""
WITH {GAPPED_SQL}
SELECT l_suppkey, round(min(l_quantity), 4) AS G_l_quantity_MIN, round(max(l_quantity), 4) AS G_l_quantity_MAX,
  round(avg(l_quantity), 4) AS G_l_quantity_MEAN, round(coalesce(sum(l_quantity), 0), 4) AS G_l_quantity_SUM,
  round(var_samp(l_quantity), 4) AS G_l_quantity_VAR, round(stddev_samp(l_quantity), 4) AS G_l_quantity_STD,
  count(l_quantity) AS G_l_quantity_COUNT, count(DISTINCT l_quantity) AS G_l_quantity_NUNIQUE,
  round(coalesce(sum(l_discount), 0), 4) AS G_l_discount_SUM, count(*) AS G_COUNT
FROM gapped GROUP BY l_suppkey""",
)
def rollup_functions(spark, folder):
    measures = {
        "l_quantity": ["min", "max", "mean", "sum", "var", "std", "count", "nunique"],
        "l_discount": ["sum"],
    }
    return rounded(rollup(gapped_lines(spark, folder), RollupSpec("l_suppkey", "G_", measures, {}, "G_COUNT")))


LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "status_first_last",
    """
WITH g AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'N' AND l_linenumber % 2 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
  l_shipdate, l_linenumber, l_partkey, l_suppkey FROM lineitem),
x AS (SELECT * FROM g WHERE l_returnflag IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS a,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS b FROM x)
SELECT l_orderkey, max(CASE WHEN a = 1 THEN l_returnflag END) AS first_status,
  max(CASE WHEN b = 1 THEN l_returnflag END) AS last_status FROM r GROUP BY l_orderkey""",
)
def status_first_last(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn(
        "l_returnflag",
        F.when(~((F.col("l_returnflag") == "N") & (F.col("l_linenumber") % 2 == 0)), F.col("l_returnflag")),
    )
    return first_and_last(lines, "l_orderkey", "l_returnflag", LINE_ORDER, "first_status", "last_status")


def loan_months(spark, folder):
    """Line items as periodic loan status rows; the offset counts 30-day months before a fixed day."""
    days = F.datediff(F.lit("2002-01-01").cast("date"), F.col("l_shipdate").cast("date"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", *LINE_ORDER[1:], "l_shipdate", "l_linestatus", "l_returnflag",
        (-F.floor(days / 30)).cast("int").alias("month"),
    )


MONTHS_SQL = """months AS (
  SELECT *, CAST(-floor(date_diff('day', l_shipdate::DATE, DATE '2002-01-01') / 30.0) AS INTEGER) AS month FROM lineitem)"""


@query(
    "months_open_closed",
    f"""
WITH {MONTHS_SQL}
SELECT l_orderkey, abs(min(month)) AS Month, abs(min(CASE WHEN l_linestatus = 'F' THEN month END)) AS When_closed,
  abs(min(month)) - abs(min(CASE WHEN l_linestatus = 'F' THEN month END)) AS Month_closed_to_end
FROM months GROUP BY l_orderkey""",
)
def months_open_closed(spark, folder):
    history = status_history(
        loan_months(spark, folder), "l_orderkey", "month", "l_linestatus", "F", ["F"], ["F"], LINE_ORDER
    )
    return history.select("l_orderkey", "Month", "When_closed", "Month_closed_to_end")


@query(
    "status_counts",
    f"""
WITH {MONTHS_SQL},
c AS (SELECT l_orderkey, abs(min(month)) AS m,
  nullif(count(*) FILTER (WHERE l_returnflag = 'A'), 0) AS a, nullif(count(*) FILTER (WHERE l_returnflag = 'N'), 0) AS n,
  nullif(count(*) FILTER (WHERE l_returnflag = 'R'), 0) AS r FROM months GROUP BY l_orderkey)
SELECT l_orderkey, a AS DPD_A_cnt, n AS DPD_N_cnt, r AS DPD_R_cnt,
  round(a::DOUBLE / nullif(m, 0), 4) AS DPD_A_per_Month, round(n::DOUBLE / nullif(m, 0), 4) AS DPD_N_per_Month,
  round(r::DOUBLE / nullif(m, 0), 4) AS DPD_R_per_Month, coalesce(a, 0) + coalesce(r, 0) AS Non_zero_DPD_cnt FROM c""",
)
def status_counts(spark, folder):
    history = status_history(
        loan_months(spark, folder), "l_orderkey", "month", "l_returnflag", "F", ["A", "N", "R"], ["A", "R"], LINE_ORDER
    )
    return rounded(history.drop("First_status", "Last_status", "Month", "When_closed", "Month_closed_to_end"))


@query(
    "category_share",
    """
SELECT o_custkey, """
    + ", ".join(
        f"round(avg(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END), 4) AS SHARE_o_orderpriority_{p.replace('-', '_').replace(' ', '_')}_MEAN"
        for p in PRIORITIES
    )
    + " FROM orders GROUP BY o_custkey",
)
def category_share(spark, folder):
    return rounded(share_of(table(spark, folder, "orders"), "o_custkey", "o_orderpriority", PRIORITIES, "SHARE_"))


def _summary_sql(columns, functions) -> str:
    sql = {**SQL_FUNCTIONS, "sum": "coalesce(sum({c}), 0)", "nunique": "count(DISTINCT {c})"}
    out = []
    for c, expr in columns.items():
        for fn in functions:
            e = sql[fn].format(c=expr, f="")
            if fn == "nunique":
                out.append(f"{e} AS {c}_NUNIQUE")
            else:
                out.append(f"{round_sql(e, 1 if fn in ('var', 'std') else 4)} AS {c}_{fn.upper()}")
    return ", ".join(out)


def _as_doubles(df, names):
    return df.withColumns({n: F.round(F.col(n).cast("double") + OFF_TIE, 1 if n.endswith(("_VAR", "_STD")) else 4) for n in names})


SUMMARY_COLUMNS = {"status_code": "status_code", "o_totalprice": "o_totalprice", "o_orderkey": "o_orderkey"}
SUMMARY_FUNCTIONS = ["mean", "std", "min", "max", "sum", "nunique"]


@query(
    "summarise_all",
    f"""
WITH x AS (SELECT o_custkey, dense_rank() OVER (ORDER BY o_orderstatus) AS status_code, o_totalprice, o_orderkey FROM orders)
SELECT o_custkey, {_summary_sql(SUMMARY_COLUMNS, SUMMARY_FUNCTIONS)} FROM x GROUP BY o_custkey""",
)
def summarise_all_query(spark, folder):
    from featloom.operators.encode import AlphabeticalCodes

    orders = table(spark, folder, "orders")
    coded = AlphabeticalCodes.fit(orders, "o_orderstatus").transform(orders, "status_code")
    df = summarise_all(coded.select("o_custkey", *SUMMARY_COLUMNS), "o_custkey", SUMMARY_FUNCTIONS)
    return _as_doubles(df, [c for c in df.columns if c != "o_custkey" and not c.endswith("_NUNIQUE")])


CARD_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "aggregate_all",
    f"""
WITH {GAPPED_SQL}
SELECT l_suppkey, {_summary_sql({c: c for c in CARD_COLUMNS}, ['max', 'mean', 'sum', 'var']).replace(' AS l_', ' AS CC_l_')},
  count(*) AS CC_COUNT FROM gapped GROUP BY l_suppkey""",
)
def aggregate_all(spark, folder):
    lines = gapped_lines(spark, folder).select("l_suppkey", "l_orderkey", *CARD_COLUMNS)
    df = summarise_all(lines, "l_suppkey", ["max", "mean", "sum", "var"], "CC_", ["l_orderkey"], "CC_COUNT")
    return _as_doubles(df, [c for c in df.columns if c.startswith("CC_l_")])


@query(
    "distinct_per_group",
    """SELECT user_id, count(DISTINCT event_type) AS E_event_type_NUNIQUE, count(*) AS E_COUNT FROM events GROUP BY user_id""",
)
def distinct_per_group(spark, folder):
    return rollup(table(spark, folder, "events"), RollupSpec("user_id", "E_", {"event_type": ["nunique"]}, {}, "E_COUNT"))


STAT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    "column_statistics",
    f"WITH {GAPPED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 4) AS mean, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM gapped"
        for c in STAT_COLUMNS
    ),
)
def column_statistics_query(spark, folder):
    return rounded(column_statistics(gapped_lines(spark, folder), STAT_COLUMNS))


@query(
    "column_distinct_counts",
    f"WITH {GAPPED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM gapped" for c in [*STAT_COLUMNS, "l_returnflag"]
    ),
)
def column_distinct_counts(spark, folder):
    return distinct_counts(gapped_lines(spark, folder), [*STAT_COLUMNS, "l_returnflag"])


@query(
    "median_by_group",
    f"WITH {GAPPED_SQL} SELECT l_returnflag, round(median(l_extendedprice), 4) AS median_price FROM gapped GROUP BY l_returnflag",
)
def median_by_group(spark, folder):
    return rounded(quantiles_by(gapped_lines(spark, folder), "l_extendedprice", {"median_price": 0.5}, ["l_returnflag"]))


@query(
    "percentiles_by_group",
    """SELECT event_type, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.75), 4) AS p75,
  round(quantile_cont(value, 0.9), 4) AS p90 FROM events GROUP BY event_type""",
)
def percentiles_by_group(spark, folder):
    return rounded(quantiles_by(table(spark, folder, "events"), "value", {"p25": 0.25, "p75": 0.75, "p90": 0.9}, ["event_type"]))


@query(
    "group_median_lookup",
    """
SELECT c_custkey, c_mktsegment, round(median(c_acctbal) OVER (PARTITION BY c_mktsegment), 4) AS segment_median FROM customer""",
)
def group_median_lookup_query(spark, folder):
    base = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return rounded(group_median_lookup(base, "c_mktsegment", "c_acctbal", "segment_median").drop("c_acctbal"))


@query(
    "star_assembly",
    f"""
WITH o AS (SELECT o_custkey AS k, {round_sql('avg(o_totalprice)')} AS ORD_o_totalprice_MEAN, count(*) AS ORD_COUNT FROM orders
    WHERE o_orderstatus = 'P' GROUP BY 1),
l AS (SELECT o_custkey AS k, round(sum(l_quantity), 4) AS LINE_l_quantity_SUM, count(*) AS LINE_COUNT
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
e AS (SELECT user_id AS k, round(max(value), 4) AS EV_value_MAX, count(*) AS EV_COUNT FROM events GROUP BY 1),
d AS (SELECT o_custkey AS k, count(DISTINCT o_orderpriority) AS PRI_o_orderpriority_NUNIQUE FROM orders GROUP BY 1),
m AS (SELECT o_custkey AS k, round(min(l_discount), 4) AS DISC_l_discount_MIN
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' GROUP BY 1)
SELECT c_custkey AS k, c_mktsegment, o.* EXCLUDE (k), l.* EXCLUDE (k), e.* EXCLUDE (k), d.* EXCLUDE (k), m.* EXCLUDE (k)
FROM customer LEFT JOIN o ON o.k = c_custkey LEFT JOIN l ON l.k = c_custkey LEFT JOIN e ON e.k = c_custkey
LEFT JOIN d ON d.k = c_custkey LEFT JOIN m ON m.k = c_custkey""",
)
def star_assembly(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "k")
    lines = table(spark, folder, "lineitem")
    keyed = lines.join(orders.select("k", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    tables = [
        rollup(orders.where(F.col("o_orderstatus") == "P"), RollupSpec("k", "ORD_", {"o_totalprice": ["mean"]}, {}, "ORD_COUNT")),
        rollup(keyed, RollupSpec("k", "LINE_", {"l_quantity": ["sum"]}, {}, "LINE_COUNT")),
        rollup(
            table(spark, folder, "events").withColumnRenamed("user_id", "k"),
            RollupSpec("k", "EV_", {"value": ["max"]}, {}, "EV_COUNT"),
        ),
        rollup(orders, RollupSpec("k", "PRI_", {"o_orderpriority": ["nunique"]})),
        rollup(keyed.where(F.col("l_returnflag") == "R"), RollupSpec("k", "DISC_", {"l_discount": ["min"]})),
    ]
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    return rounded(star_join(base, tables, "k"), shift=OFF_TIE)


@query(
    "lookup_map",
    """SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON n_nationkey = c_nationkey""",
)
def lookup_map(spark, folder):
    names = table(spark, folder, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup_join(table(spark, folder, "customer").select("c_custkey", "c_nationkey"), names, ["c_nationkey"])


@query(
    "group_size_aligned",
    """SELECT l_orderkey, count(*) AS POS_COUNT, round(max(l_quantity), 4) AS POS_l_quantity_MAX FROM lineitem GROUP BY l_orderkey""",
)
def group_size_aligned(spark, folder):
    return rounded(rollup(table(spark, folder, "lineitem"), RollupSpec("l_orderkey", "POS_", {"l_quantity": ["max"]}, {}, "POS_COUNT")))


@query(
    "union_label_null",
    """
SELECT d.doc_id, d.lang, d.n_chars, l.quality AS label FROM documents d JOIN labels l ON l.doc_id = d.doc_id
UNION ALL SELECT d.doc_id, d.lang, d.n_chars, NULL FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def union_label_null(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return stack_labelled(docs.join(labels, "doc_id"), docs.join(labels, "doc_id", "left_anti"))


@query(
    "append_runs",
    f"""
WITH {FOLD_SCORES_SQL}
SELECT fold AS run, part, count(*) AS n, round(avg(score), 4) AS mean_score FROM scores GROUP BY fold, part""",
)
def append_runs(spark, folder):
    scores = fold_scores(spark, folder)

    def one_run(f):
        rows = scores.where(F.col("fold") == f)
        return rows.groupBy("part").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"))

    return rounded(stack_runs({f: one_run(f) for f in range(5)}, "run"))


@query(
    "wide_to_long",
    f"""
WITH {DOCS_SQL}
SELECT doc_id, 'n_chars' AS feature, n_chars::DOUBLE AS value FROM docs UNION ALL
SELECT doc_id, 'n_spaces', n_spaces::DOUBLE FROM docs UNION ALL SELECT doc_id, 'toxic', toxic::DOUBLE FROM docs""",
)
def wide_to_long(spark, folder):
    return to_long(labelled_documents(spark, folder), ["doc_id"], ["n_chars", "n_spaces", "toxic"])


COLLIDING = """CASE l_linenumber % 5 WHEN 0 THEN 'a-b' WHEN 1 THEN 'a b' WHEN 2 THEN 'NaN' WHEN 3 THEN NULL ELSE l_returnflag END"""


@query(
    "share_name_collision",
    f"""
WITH x AS (SELECT l_suppkey, {COLLIDING} AS mark FROM lineitem)
SELECT l_suppkey, {', '.join(f"round(avg(CASE WHEN {test} THEN 1.0::DOUBLE ELSE 0 END), 6) AS {name}" for name, test in {
    'mark_NaN_MEAN': 'mark IS NULL', 'mark_NaN_2_MEAN': "mark = 'NaN'", 'mark_a_b_MEAN': "mark = 'a b'", 'mark_a_b_2_MEAN': "mark = 'a-b'"}.items())}
FROM x GROUP BY l_suppkey""",
)
def share_name_collision(spark, folder):
    """Values whose cleaned names agree, and null beside the text it is named after, keep a column each."""
    lines = table(spark, folder, "lineitem").select("l_suppkey", F.expr(COLLIDING).alias("mark"))
    spec = RollupSpec("l_suppkey", "", shares={"mark": ["a b", "a-b", "NaN", None]})
    return rounded(rollup(lines, spec), 6)


@query(
    "category_share_long",
    """
WITH c AS (SELECT o_custkey, unnest([struct_pack(c := 'o_orderpriority', v := o_orderpriority), struct_pack(c := 'day', v := strftime(o_orderdate, '%Y-%m-%d'))]) AS s FROM orders),
n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT o_custkey, s.c AS "column", s.v AS value, round(count(*)::DOUBLE / any_value(n), 6) AS share FROM c JOIN n USING (o_custkey) GROUP BY ALL""",
)
def category_share_long(spark, folder):
    """Shares of a column with thousands of values, one row for each value a customer has."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return rounded(category_shares(orders, "o_custkey", ["o_orderpriority", "day"]), 6)
