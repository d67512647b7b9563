"""Scan, projection, filter, flag, row-wise and imputation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.functions import rowwise as rw
from featloom.functions import values as v
from featloom.operators.clean import (
    NullRule,
    apply_null_rules,
    categorical_columns,
    columns_matching,
    exclude_values,
    exclude_where,
    feature_columns,
    narrow_types,
    non_finite_to_null,
    numeric_columns,
    split_labelled,
)
from featloom.operators.encode import (
    add_null_indicators,
    fill_derived_with_mean,
    fill_null_category,
    fill_with_literal,
    fill_with_mean,
)
from featloom.plans.fixtures import DOCS_SQL, GAPPED_SQL, LINE_ID, gapped_lines, labelled_documents
from featloom.plans.registry import OFF_TIE, query, round_sql, rounded
from featloom.sources.tables import (
    fill_template,
    first_rows,
    read_csv,
    save_features,
    table,
    write_csv,
    write_importances,
    write_out_of_fold,
    write_test_scores,
    write_train_with_prediction,
)
from featloom.workspace import scratch_path

ID_SQL = ", ".join(LINE_ID)
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("csv_scan", "SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_scan(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_totalprice", "o_orderpriority"
    )
    path = scratch_path(spark, "orders-csv")
    write_csv(orders.fillna("NA", ["o_orderstatus"]), path)
    return read_csv(spark, path, orders.schema)


@query("debug_sample", "SELECT * FROM customer ORDER BY c_custkey LIMIT 1000")
def debug_sample(spark, folder):
    return first_rows(table(spark, folder, "customer"), ["c_custkey"], 1000)


@query("reload_features", f"WITH {DOCS_SQL} SELECT * REPLACE (round(space_share, 4) AS space_share) FROM docs")
def reload_features(spark, folder):
    return save_features(rounded(labelled_documents(spark, folder)), scratch_path(spark, "features"))


@query(
    "submission_template",
    f"""WITH {DOCS_SQL}
SELECT doc_id, round(n_chars / (n_chars + 1500.0::DOUBLE), 5) AS TARGET FROM docs WHERE quality IS NULL""",
)
def submission_template(spark, folder):
    docs = labelled_documents(spark, folder)
    template = docs.where(F.col("quality").isNull()).select("doc_id", F.lit(0.5).alias("TARGET"))
    scores = docs.select("doc_id", (F.col("n_chars") / (F.col("n_chars") + 1500.0)).alias("score"))
    return fill_template(template, scores, "doc_id", "score", 5)


@query(
    "export_scores",
    f"""WITH {DOCS_SQL}
SELECT 'out_of_fold' AS file, doc_id, quality AS TARGET, round(space_share, 4) AS Prediction FROM docs WHERE quality IS NOT NULL
UNION ALL SELECT 'test', doc_id, NULL, round(space_share, 4) FROM docs WHERE quality IS NULL
UNION ALL SELECT 'train_table', doc_id, quality, round(space_share, 4) FROM docs WHERE quality IS NOT NULL
UNION ALL SELECT 'importance', n_chars, NULL, round(space_share, 4) FROM docs""",
)
def export_scores(spark, folder):
    docs = labelled_documents(spark, folder).withColumn("score", F.round("space_share", 4))
    train, test = split_labelled(docs, "quality")
    paths = {n: scratch_path(spark, n) for n in ("out_of_fold", "test", "train_table", "importance")}
    write_out_of_fold(train, paths["out_of_fold"], "doc_id", "quality", "score")
    write_test_scores(test, paths["test"], "doc_id", "score")
    write_train_with_prediction(train.drop("score"), train, paths["train_table"], "doc_id", "score")
    write_importances(docs.select(F.col("n_chars").alias("feature"), "score"), paths["importance"])
    oof = read_csv(spark, paths["out_of_fold"], "doc_id bigint, TARGET int, Prediction double")
    scored = read_csv(spark, paths["test"], "doc_id bigint, TARGET double")
    whole = spark.read.parquet(paths["train_table"])
    importance = read_csv(spark, paths["importance"], "feature bigint, score double")
    none = F.lit(None).cast("int").alias("TARGET")
    parts = {
        "out_of_fold": oof,
        "test": scored.select("doc_id", none, F.col("TARGET").alias("Prediction")),
        "train_table": whole.select("doc_id", F.col("quality").alias("TARGET"), "Prediction"),
        "importance": importance.select(F.col("feature").alias("doc_id"), none, F.col("score").alias("Prediction")),
    }
    out = None
    for name, df in parts.items():
        tagged = df.select(F.lit(name).alias("file"), "doc_id", "TARGET", "Prediction")
        out = tagged if out is None else out.unionByName(tagged)
    return out


@query("drop_columns", "SELECT p_partkey, p_type, p_size FROM part")
def drop_columns(spark, folder):
    return table(spark, folder, "part").drop("p_name", "p_brand", "p_retailprice")


@query("select_by_pattern", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def select_by_pattern(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select(columns_matching(lines, "key$|number|date", "shipdate"))


@query(
    "select_by_type",
    """SELECT c_custkey, c_nationkey, round(c_acctbal, 4) AS c_acctbal, length(c_name) + length(c_mktsegment) AS text_length FROM customer""",
)
def select_by_type(spark, folder):
    customers = table(spark, folder, "customer")
    text = sum((F.length(c) for c in categorical_columns(customers)), F.lit(0)).cast("bigint")
    return rounded(customers.select(*numeric_columns(customers), text.alias("text_length")))


@query("feature_id_split", f"WITH {DOCS_SQL} SELECT lang, source, n_chars, n_spaces, n_lines, n_stops, is_long FROM docs")
def feature_id_split(spark, folder):
    docs = labelled_documents(spark, folder).drop("space_share", "toxic")
    return docs.select(feature_columns(docs, "quality", ["doc_id"]))


@query("split_labelled", f"WITH {DOCS_SQL} SELECT doc_id, n_chars, CASE WHEN quality IS NULL THEN 'test' ELSE 'train' END AS part FROM docs")
def split_labelled_query(spark, folder):
    train, test = split_labelled(labelled_documents(spark, folder), "quality")
    pick = lambda df, part: df.select("doc_id", "n_chars", F.lit(part).alias("part"))
    return pick(train, "train").unionByName(pick(test, "test"))


@query(
    "row_filters",
    f"""
WITH {GAPPED_SQL}, x AS (SELECT *, nullif(l_returnflag, 'A') AS flag FROM gapped)
SELECT {ID_SQL}, flag, l_discount, l_tax FROM x
WHERE flag IS DISTINCT FROM 'N' AND l_linestatus IS DISTINCT FROM 'X' AND NOT coalesce(l_discount < l_tax, false)""",
)
def row_filters(spark, folder):
    lines = gapped_lines(spark, folder).withColumn("flag", F.nullif("l_returnflag", F.lit("A")))
    kept = exclude_values(lines, {"flag": "N", "l_linestatus": "X"})
    return exclude_where(kept, F.col("l_discount") < F.col("l_tax")).select(*LINE_ID, "flag", "l_discount", "l_tax")


@query("status_subset", "SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def status_subset(spark, folder):
    done = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    return rounded(done.select("o_orderkey", "o_custkey", "o_totalprice"))


@query(
    "sentinel_and_outlier_null",
    f"""
SELECT {ID_SQL}, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_discount < 0.02 THEN NULL ELSE l_discount END AS l_discount,
  nullif(l_tax, 0.03) AS l_tax,
  CASE WHEN l_extendedprice > 90000 OR l_extendedprice < 2000 THEN NULL ELSE round(l_extendedprice, 4) END AS l_extendedprice
FROM lineitem""",
)
def sentinel_and_outlier_null(spark, folder):
    rules = [
        NullRule("l_quantity", above=45),
        NullRule("l_discount", below=0.02),
        NullRule("l_tax", equals=0.03),
        NullRule("l_extendedprice", above=90000, below=2000),
    ]
    return rounded(apply_null_rules(table(spark, folder, "lineitem").select(*LINE_ID, *MEASURES), rules))


@query(
    "ratios",
    f"""
WITH {GAPPED_SQL}
SELECT {ID_SQL}, {round_sql("l_extendedprice / nullif(l_quantity, 0)")} AS unit_price,
  {round_sql("l_tax / nullif(l_discount, 0)")} AS tax_share, {round_sql("l_quantity / (1 + l_linenumber)")} AS per_line FROM gapped""",
)
def ratios(spark, folder):
    out = gapped_lines(spark, folder).select(
        *LINE_ID,
        v.ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        v.ratio("l_tax", "l_discount").alias("tax_share"),
        v.ratio("l_quantity", 1 + F.col("l_linenumber")).alias("per_line"),
    )
    return rounded(out, shift=OFF_TIE)


@query(
    "differences_and_products",
    f"""
WITH {GAPPED_SQL}
SELECT {ID_SQL}, round(l_discount - l_tax, 4) AS margin, {round_sql("l_quantity * l_discount * l_tax")} AS prod,
  {round_sql("l_extendedprice / 12 - l_quantity")} AS monthly FROM gapped""",
)
def differences_and_products(spark, folder):
    out = gapped_lines(spark, folder).select(
        *LINE_ID,
        F.round(v.difference("l_discount", "l_tax"), 4).alias("margin"),
        F.round(v.product("l_quantity", "l_discount", "l_tax") + OFF_TIE, 4).alias("prod"),
        F.round(v.difference(F.col("l_extendedprice") / 12, "l_quantity") + OFF_TIE, 4).alias("monthly"),
    )
    return out


@query(
    "flags",
    f"""
WITH {GAPPED_SQL}
SELECT {ID_SQL}, CASE WHEN l_quantity IN (1, 10, 20) THEN 1 ELSE 0 END AS popular,
  CASE WHEN l_quantity < 10 THEN 1 ELSE 0 END AS low, CASE WHEN l_discount > l_tax THEN 1 ELSE 0 END AS cheaper,
  CASE WHEN l_extendedprice > l_quantity * 50.0::DOUBLE / 3 * 60 - 11500.0::DOUBLE / 3 THEN 1 ELSE 0 END AS above_line,
  abs(l_tax - 0.04::DOUBLE) > 0.02::DOUBLE AS far FROM gapped""",
)
def flags(spark, folder):
    q, d, t, p = (F.col(c) for c in ("l_quantity", "l_discount", "l_tax", "l_extendedprice"))
    return gapped_lines(spark, folder).select(
        *LINE_ID,
        v.member_flag("l_quantity", [1, 10, 20]).alias("popular"),
        v.flag(q < 10).alias("low"),
        v.flag(d > t).alias("cheaper"),
        v.flag(p > q * 50.0 / 3 * 60 - 11500.0 / 3).alias("above_line"),
        (F.abs(t - 0.04) > 0.02).alias("far"),
    )


@query(
    "clamp",
    f"""
WITH {GAPPED_SQL}
SELECT {ID_SQL}, coalesce(greatest(round(l_discount - l_tax, 4), 0), 0) AS zero_for_null,
  CASE WHEN l_discount - l_tax > 0 THEN round(l_discount - l_tax, 4) WHEN l_discount - l_tax IS NOT NULL THEN 0 END AS null_kept FROM gapped""",
)
def clamp(spark, folder):
    gap = F.col("l_discount") - F.col("l_tax")
    return gapped_lines(spark, folder).select(
        *LINE_ID,
        v.clamp_zero(F.round(gap, 4), null_as_zero=True).alias("zero_for_null"),
        F.round(v.clamp_zero(gap, null_as_zero=False), 4).alias("null_kept"),
    )


@query(
    "clip",
    f"WITH {GAPPED_SQL} SELECT {ID_SQL}, round(CASE WHEN l_extendedprice IS NOT NULL THEN least(greatest(l_extendedprice, 5000), 60000) END, 4) AS price FROM gapped",
)
def clip(spark, folder):
    return rounded(gapped_lines(spark, folder).select(*LINE_ID, v.clip("l_extendedprice", 5000.0, 60000.0).alias("price")))


@query(
    "roots_and_logs",
    """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN round(sqrt(c_acctbal), 4) END AS root,
  CASE WHEN c_acctbal > -1 THEN round(ln(1 + c_acctbal), 4) END AS log FROM customer""",
)
def roots_and_logs(spark, folder):
    return rounded(
        table(spark, folder, "customer").select(
            "c_custkey", v.sqrt_or_null("c_acctbal").alias("root"), v.log1p_or_null("c_acctbal").alias("log")
        )
    )


@query(
    "non_finite_to_null",
    """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN round(sqrt(c_acctbal), 4) END AS root,
  CASE WHEN c_nationkey > 0 THEN round(c_acctbal / c_nationkey + 3e-7::DOUBLE, 4) END AS share FROM customer""",
)
def non_finite_to_null_query(spark, folder):
    infinite = F.when(F.col("c_nationkey") == 0, F.lit(float("inf")))
    raw = table(spark, folder, "customer").select(
        "c_custkey",
        F.sqrt("c_acctbal").alias("root"),
        F.coalesce(infinite, v.ratio("c_acctbal", "c_nationkey") + OFF_TIE).alias("share"),
    )
    return rounded(non_finite_to_null(raw))


@query(
    "narrow_types",
    """
SELECT (o_orderkey + 100000)::INTEGER AS o_orderkey, (o_custkey + 1000)::SMALLINT AS o_custkey, o_totalprice, (o_orderkey % 100)::TINYINT AS small,
  o_orderkey * 1000000000 AS large FROM orders""",
)
def narrow_types_query(spark, folder):
    wide = table(spark, folder, "orders").select(
        (F.col("o_orderkey") + 100000).alias("o_orderkey"),
        (F.col("o_custkey") + 1000).alias("o_custkey"),
        "o_totalprice",
        (F.col("o_orderkey") % 100).alias("small"),
        (F.col("o_orderkey") * 1000000000).alias("large"),
    )
    return narrow_types(wide)


@query("round_scores", f"WITH {DOCS_SQL} SELECT doc_id, round(n_chars / (n_chars + 1500.0::DOUBLE), 2) AS score FROM docs")
def round_scores(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.round(F.col("n_chars") / (F.col("n_chars") + 1500.0), 2).alias("score"))


def _row_list(cols) -> str:
    return "list_filter([" + ", ".join(f"{c}::DOUBLE" for c in cols) + "], lambda x: x IS NOT NULL)"


ROW_COLUMNS = [*MEASURES, "l_linenumber", "l_suppkey"]
ROW_SQL = f"WITH {GAPPED_SQL}, r AS (SELECT *, {_row_list(ROW_COLUMNS)} AS a, {len(ROW_COLUMNS)} AS width FROM gapped)"


@query("row_null_count", f"{ROW_SQL} SELECT {ID_SQL}, (width - len(a))::INTEGER AS missing FROM r")
def row_null_count(spark, folder):
    return gapped_lines(spark, folder).select(*LINE_ID, rw.row_null_count(ROW_COLUMNS).alias("missing"))


@query(
    "row_mean_std",
    f"""{ROW_SQL} SELECT {ID_SQL}, {round_sql('list_avg(a)')} AS mean, {round_sql('list_stddev_samp(a)')} AS std,
  {round_sql('CASE WHEN len(a) = width THEN list_avg(a) END')} AS strict_mean,
  {round_sql('CASE WHEN len(a) = width THEN list_stddev_samp(a) END')} AS strict_std FROM r""",
)
def row_mean_std(spark, folder):
    lines = gapped_lines(spark, folder)
    lines = rw.with_row_std(lines, ROW_COLUMNS, "std")
    lines = rw.with_row_std(lines, ROW_COLUMNS, "strict_std", skip_nulls=False)
    out = lines.select(
        *LINE_ID,
        rw.row_mean(ROW_COLUMNS).alias("mean"),
        "std",
        rw.row_mean(ROW_COLUMNS, skip_nulls=False).alias("strict_mean"),
        "strict_std",
    )
    return rounded(out, shift=OFF_TIE)


@query(
    "row_sum",
    f"""WITH {GAPPED_SQL} SELECT {ID_SQL}, round(coalesce(l_quantity, 0) + coalesce(l_discount, 0) + coalesce(l_tax, 0), 4) AS total,
  round(l_quantity + l_discount + l_tax, 4) AS strict_total FROM gapped""",
)
def row_sum(spark, folder):
    cols = ["l_quantity", "l_discount", "l_tax"]
    return rounded(
        gapped_lines(spark, folder).select(
            *LINE_ID, rw.row_sum(cols).alias("total"), rw.row_sum(cols, skip_nulls=False).alias("strict_total")
        )
    )


@query(
    "row_kurtosis_sample",
    f"""{ROW_SQL} SELECT {ID_SQL}, CASE WHEN len(a) >= 4 THEN round(coalesce(list_kurtosis(a), 0), 4) END AS kurtosis FROM r""",
)
def row_kurtosis_sample(spark, folder):
    lines = rw.with_row_kurtosis_sample(gapped_lines(spark, folder), ROW_COLUMNS, "kurtosis")
    return rounded(lines.select(*LINE_ID, "kurtosis"))


@query(
    "row_kurtosis_moment",
    f"""{ROW_SQL}, m AS (SELECT *, list_avg(a) AS mu FROM r),
p AS (SELECT *, list_sum(list_transform(a, lambda x: pow(x - mu, 2))) AS m2, list_sum(list_transform(a, lambda x: pow(x - mu, 4))) AS m4 FROM m)
SELECT {ID_SQL}, CASE WHEN len(a) = width THEN round(width * m4 / nullif(m2 * m2, 0), 4) END AS kurtosis FROM p""",
)
def row_kurtosis_moment(spark, folder):
    lines = rw.with_row_kurtosis_moment(gapped_lines(spark, folder), ROW_COLUMNS, "kurtosis")
    return rounded(lines.select(*LINE_ID, "kurtosis"))


@query(
    "fill_literal",
    f"""WITH {GAPPED_SQL} SELECT {ID_SQL}, coalesce(nullif(l_returnflag, 'R'), 'NaN') AS flag, coalesce(l_tax, 0) AS l_tax,
  CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END AS l_tax_isnull FROM gapped""",
)
def fill_literal(spark, folder):
    lines = gapped_lines(spark, folder).withColumn("flag", F.nullif("l_returnflag", F.lit("R")))
    marked = add_null_indicators(lines, ["l_tax"])
    return fill_with_literal(fill_null_category(marked, ["flag"]), {"l_tax": 0.0}).select(*LINE_ID, "flag", "l_tax", "l_tax_isnull")


@query(
    "impute_mean",
    f"""WITH {GAPPED_SQL} SELECT {ID_SQL}, {', '.join(round_sql(f'least(greatest(coalesce({c}, avg({c}) OVER ()), -30000), 30000)') + f' AS {c}' for c in MEASURES)} FROM gapped""",
)
def impute_mean(spark, folder):
    lines = gapped_lines(spark, folder).select(*LINE_ID, *MEASURES)
    return rounded(fill_with_mean(lines, MEASURES, limit=30000.0), shift=OFF_TIE)


@query(
    "impute_mean_train",
    f"""WITH {DOCS_SQL} SELECT doc_id, {round_sql('coalesce(toxic, (SELECT avg(toxic) FROM docs WHERE quality IS NOT NULL))')} AS toxic FROM docs""",
)
def impute_mean_train(spark, folder):
    docs = labelled_documents(spark, folder).select("doc_id", "toxic", "quality")
    return rounded(fill_with_mean(docs, ["toxic"], "quality", "train").drop("quality"), shift=OFF_TIE)


@query(
    "impute_derived_std",
    f"""WITH {GAPPED_SQL}, r AS (SELECT *, list_stddev_samp({_row_list(['l_quantity', 'l_discount', 'l_tax'])}) AS s FROM gapped)
SELECT {ID_SQL}, {round_sql('coalesce(s, avg(s) OVER ())')} AS std FROM r""",
)
def impute_derived_std(spark, folder):
    lines = rw.with_row_std(gapped_lines(spark, folder), ["l_quantity", "l_discount", "l_tax"], "std")
    return rounded(fill_derived_with_mean(lines.select(*LINE_ID, "std"), "std"), shift=OFF_TIE)


@query(
    "two_rules_one_column",
    "SELECT c_custkey, CASE WHEN c_acctbal > 9000 OR c_acctbal < -500 OR c_acctbal = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer",
)
def two_rules_one_column(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return apply_null_rules(customers, [NullRule("c_acctbal", above=9000), NullRule("c_acctbal", below=-500), NullRule("c_acctbal", equals=0.0)])
