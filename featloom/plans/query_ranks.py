"""Encoder, rank, separation, fold, metric and null-importance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.functions import special
from featloom.operators.assemble import to_long
from featloom.operators.encode import AlphabeticalCodes, FirstSeenCodes, OneHot, TargetMean, rank_gauss
from featloom.operators.folds import (
    fold_mean_score,
    in_sample_score,
    kfold,
    mean_importance,
    out_of_fold,
    stratified_holdout,
    stratified_kfold,
)
from featloom.operators.metrics import log_loss, precision_recall, roc_auc, score_summary
from featloom.operators.bijection import permute, permuted_classes, round_keys
from featloom.operators.rank import exact_rank, mid_ranks, top_k
from featloom.operators.selection import null_importance_log_score, null_importance_percent_score
from featloom.operators.separation import (
    class_separation,
    constant_columns,
    drifting_features,
    drop_features,
    remaining_features,
    train_test_drift,
    weak_features,
)
from featloom.plans.fixtures import (
    DOCS_SQL,
    FOLD_SCORES_SQL,
    TEXT_FEATURES,
    fold_scores,
    labelled_documents,
)
from featloom.plans.registry import OFF_TIE, hash32_sql, hash_text_sql, query, round_sql, rounded
from featloom.sources.tables import table
from featloom.workspace import materialise

PRIORITIES = {
    "1-URGENT": "1_URGENT",
    "2-HIGH": "2_HIGH",
    "3-MEDIUM": "3_MEDIUM",
    "4-NOT SPECIFIED": "4_NOT_SPECIFIED",
    "5-LOW": "5_LOW",
}


@query(
    "one_hot_observed",
    "SELECT o_orderkey, "
    + ", ".join(f"CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS o_orderpriority_{n}" for p, n in PRIORITIES.items())
    + """, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_orderstatus_F, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS o_orderstatus_O,
  CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS o_orderstatus_NaN FROM orders""",
)
def one_hot_observed(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus")
    )
    return OneHot.fit(orders, ["o_orderpriority", "o_orderstatus"]).transform(orders)


@query(
    "one_hot_with_null",
    f"""WITH {DOCS_SQL} SELECT doc_id, """
    + ", ".join(f"CASE WHEN lang = '{v}' THEN 1 ELSE 0 END AS lang_{v}" for v in ("de", "en", "es", "fr"))
    + ", 0 AS lang_NaN FROM docs",
)
def one_hot_with_null(spark, folder):
    docs = labelled_documents(spark, folder).select("doc_id", "lang")
    return OneHot.fit(docs, ["lang"], null_column="always").transform(docs)


@query(
    "target_mean_encode",
    f"""WITH {DOCS_SQL}, x AS (SELECT doc_id, source, CASE WHEN n_chars % 5 > 0 THEN lang END AS lang, quality FROM docs)
SELECT doc_id, source, lang, round((SELECT avg(quality) FROM x b WHERE b.lang = x.lang), 4) AS lang_mean,
  round((SELECT avg(quality) FROM x b WHERE b.source = x.source), 4) AS source_mean FROM x""",
)
def target_mean_encode(spark, folder):
    docs = labelled_documents(spark, folder).select(
        "doc_id", "source", F.when(F.col("n_chars") % 5 > 0, F.col("lang")).alias("lang"), "quality"
    )
    encoder = TargetMean.fit(docs, ["lang", "source"], "quality")
    return rounded(encoder.transform(docs, "_mean").drop("quality"))


@query(
    "target_mean_encode_out_of_fold",
    f"""WITH {DOCS_SQL}, x AS (SELECT doc_id, lang, quality,
  CASE WHEN quality IS NOT NULL THEN ({hash32_sql('doc_id', 3)} % 4)::INTEGER END AS fold FROM docs),
s AS (SELECT lang, fold, sum(quality) AS s, count(*) AS n FROM x WHERE quality IS NOT NULL GROUP BY ALL),
t AS (SELECT lang, sum(s) AS s, sum(n) AS n FROM s GROUP BY lang)
SELECT doc_id, x.fold AS fold, round(((t.s - coalesce(s.s, 0)) / nullif(t.n - coalesce(s.n, 0), 0))::DOUBLE, 4) AS lang_mean
FROM x LEFT JOIN t ON t.lang = x.lang LEFT JOIN s ON s.lang = x.lang AND s.fold = x.fold""",
)
def target_mean_encode_out_of_fold(spark, folder):
    docs = kfold(labelled_documents(spark, folder).select("doc_id", "lang", "quality"), "doc_id", 4, 3)
    docs = docs.withColumn("fold", F.when(F.col("quality").isNotNull(), F.col("fold")))
    encoder = TargetMean.fit(docs, ["lang"], "quality", fold="fold")
    return rounded(encoder.transform(docs, "_mean").select("doc_id", "fold", "lang_mean"))


@query(
    "factorize_first_seen",
    """
WITH x AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p FROM orders),
f AS (SELECT p, min(o_orderkey) AS k FROM x WHERE p IS NOT NULL GROUP BY p),
c AS (SELECT p, row_number() OVER (ORDER BY k) - 1 AS code FROM f)
SELECT o_orderkey, coalesce(code, -1) AS priority_code FROM x LEFT JOIN c ON c.p = x.p""",
)
def factorize_first_seen(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return FirstSeenCodes.fit(orders, "p", "o_orderkey").transform(orders, "priority_code").drop("p")


@query(
    "factor_alphabetical",
    """
WITH x AS (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS p FROM orders)
SELECT o_orderkey, CASE WHEN p IS NOT NULL THEN dense_rank() OVER (ORDER BY p NULLS LAST) END AS priority_code FROM x""",
)
def factor_alphabetical(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("p"))
    return AlphabeticalCodes.fit(orders, "p").transform(orders, "priority_code").drop("p")


@query(
    "factor_many_values",
    "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) AS name_code FROM customer",
)
def factor_many_values(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return AlphabeticalCodes.fit(customers, "c_name", max_small=0).transform(customers, "name_code").drop("c_name")


LINE_ORDER = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "global_rank",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) - 1 AS rank FROM lineitem",
)
def global_rank(spark, folder):
    return exact_rank(table(spark, folder, "lineitem").select(*LINE_ORDER), LINE_ORDER).drop("l_extendedprice")


@query(
    "mid_ranks",
    """
WITH c AS (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_quantity, n, sum(n) OVER (ORDER BY l_quantity)::DOUBLE - n + (n + 1) / 2.0::DOUBLE AS mid_rank FROM c""",
)
def mid_ranks_query(spark, folder):
    return mid_ranks(table(spark, folder, "lineitem"), "l_quantity")


def _poly(coefficients, x: str) -> str:
    out = f"({coefficients[0]!r})::DOUBLE"
    for k in coefficients[1:]:
        out = f"({out} * {x} + ({k!r})::DOUBLE)"
    return out


def probit_sql(p: str) -> str:
    def tail(q: str) -> str:
        r = f"sqrt(-2 * ln({q}))"
        return f"{_poly(special.TAIL_NUMERATOR, r)} / {_poly(special.TAIL_DENOMINATOR, r)}"

    d = f"({p} - 0.5::DOUBLE)"
    r = f"({d} * {d})"
    centre = f"{_poly(special.CENTRAL_NUMERATOR, r)} * {d} / {_poly(special.CENTRAL_DENOMINATOR, r)}"
    return (
        f"CASE WHEN {p} < {special.TAIL_BREAK} THEN {tail(p)} "
        f"WHEN {p} > 1 - {special.TAIL_BREAK} THEN -({tail(f'(1 - {p})')}) ELSE {centre} END"
    )


def two_sided_p_sql(z: str) -> str:
    x = f"(abs({z}) / sqrt(2))"
    t = f"(1 / (1 + 0.5::DOUBLE * {x}))"
    return f"{t} * exp(-{x} * {x} + {_poly(special.ERFC_COEFFICIENTS, t)})"


@query(
    "rank_gauss",
    f"""
WITH x AS (SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice FROM part),
r AS (SELECT p_partkey, count(*) OVER ()::DOUBLE AS n,
  row_number() OVER (ORDER BY p_size, p_partkey) - 1 AS a, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS b FROM x),
s AS (SELECT p_partkey, ((2 * a - (n - 1)) / n + 1) / 2 AS a, ((2 * b - (n - 1)) / n + 1) / 2 AS b FROM r)
SELECT p_partkey, round(({probit_sql('a')}) / sqrt(2), 4) AS p_size, round(({probit_sql('b')}) / sqrt(2), 4) AS p_retailprice FROM s""",
)
def rank_gauss_query(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(rank_gauss(parts, "p_partkey", ["p_size", "p_retailprice"]))


@query(
    "topk_importance",
    """
SELECT p_type AS feature, round(sum(l_extendedprice), 2) AS importance FROM lineitem JOIN part ON p_partkey = l_partkey
GROUP BY p_type ORDER BY importance DESC, feature LIMIT 3""",
)
def topk_importance(spark, folder):
    joined = table(spark, folder, "lineitem").join(
        table(spark, folder, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey"
    )
    importance = joined.groupBy(F.col("p_type").alias("feature")).agg(F.sum("l_extendedprice").alias("importance"))
    return top_k(rounded(importance, 2), "importance", 3, "feature")


def _step_sql(v: str) -> str:
    """One pass of the bijection's rounds over the digits of ``v``; the columns f0, s0, f1, ... hold a seed's factors and shifts."""
    x, y = f"({v} % a)", f"({v} // a)"
    for k in range(6):
        moved = lambda digit: f"(({digit} * f{k} + s{k}) % 2147483647)"
        x, y = (f"(({x} + {moved(y)}) % a)", y) if k % 2 == 0 else (x, f"(({y} + {moved(x)}) % b)")
    return f"({y} * a + {x})"


def _walk_sql(seeds, source: str = "labels") -> str:
    """walk(seed, r, v): the places r of ``source`` and where each seed's bijection sends them."""
    keys = ", ".join(f"('{s}', {', '.join(f'{f}::BIGINT, {c}::BIGINT' for f, c in round_keys(s))})" for s in seeds)
    names = ", ".join(f"f{k}, s{k}" for k in range(6))
    return f"""total AS (SELECT count(*) AS n FROM {source}),
grid AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT n, ceil(sqrt(n))::BIGINT AS a FROM total)),
keys(seed, {names}) AS (VALUES {keys}),
trip AS (
  SELECT seed, r, {_step_sql('r')} AS v, 1 AS w FROM keys, grid, range((SELECT n FROM total)) AS t(r)
  UNION ALL SELECT seed, r, {_step_sql('v')} AS v, w + 1 FROM trip JOIN keys USING (seed), grid WHERE v >= n),
walk AS (SELECT seed, r, v FROM trip, grid WHERE v < n)"""


def _permuted_sql(seeds) -> str:
    return f"""{_walk_sql(seeds)},
placed AS (SELECT doc_id, quality, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM labels),
permuted AS (SELECT seed, t.doc_id, d.quality FROM walk JOIN placed t ON t.r = walk.r JOIN placed d ON d.r = walk.v)"""


@query("permuted_labels", f"WITH RECURSIVE {_permuted_sql([11, 12])} SELECT * FROM permuted")
def permuted_labels(spark, folder):
    return permute(table(spark, folder, "labels"), "doc_id", ["quality"], [11, 12])


@query(
    "null_label_arrays",
    f"""WITH RECURSIVE {_walk_sql(range(80))},
placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM labels),
sizes AS (SELECT quality, sum(count(*)) OVER (ORDER BY quality) AS top, count(*) AS own FROM labels GROUP BY quality)
SELECT doc_id, sum(quality)::BIGINT AS n_good, sum(quality * (seed::INT + 1))::BIGINT AS good_seeds
FROM walk JOIN placed USING (r) JOIN sizes ON v < top AND v >= top - own GROUP BY doc_id""",
)
def null_label_arrays(spark, folder):
    """80 permuted labels of each row: how many are good, and the sum of their runs' numbers."""
    drawn = materialise(permuted_classes(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "quality", range(80)), "drawn")
    good = F.aggregate("labels", F.lit(0).cast("long"), lambda total, y: total + y)
    runs = F.aggregate(F.transform("labels", lambda y, i: y * (i + 1)), F.lit(0).cast("long"), lambda total, y: total + y)
    return drawn.select("doc_id", good.alias("n_good"), runs.alias("good_seeds"))


STAT_FEATURES = [*TEXT_FEATURES, "toxic"]


def _separation_sql(label: str, features=tuple(STAT_FEATURES)) -> str:
    """Per feature statistics over docs with the given 0/1/null label expression."""
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f}::DOUBLE AS v, {label} AS y FROM docs" for f in features)
    return f"""long AS ({long}),
ranked AS (SELECT feature, v, y, rank() OVER w + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0::DOUBLE AS r
  FROM long WHERE v IS NOT NULL AND y IS NOT NULL WINDOW w AS (PARTITION BY feature ORDER BY v)),
sums AS (SELECT feature, count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1,
  sum(r) FILTER (WHERE y = 0) AS rank_sum, median(v) FILTER (WHERE y = 0) AS med0, median(v) FILTER (WHERE y = 1) AS med1,
  avg(v) FILTER (WHERE y = 0) AS avg0, avg(v) FILTER (WHERE y = 1) AS avg1,
  count(DISTINCT v) = 2 AND min(v) = 0 AND max(v) = 1 AS two FROM ranked GROUP BY feature),
whole AS (SELECT feature, avg(v) AS mean_all, count(*) FILTER (WHERE y IS NOT NULL AND v IS NULL) AS gaps FROM long GROUP BY feature),
base AS (SELECT feature, n0, n1, mean_all,
  CASE WHEN two AND gaps = 0 THEN abs(avg0 - avg1) ELSE abs(med0 - med1) END AS diff,
  CASE WHEN n0 >= 20 AND n1 >= 20 THEN (rank_sum - n0 * (n0 + n1 + 1) / 2.0::DOUBLE) /
    sqrt(n0::DOUBLE * n1 * (n0 + n1 + 1) / 12) END AS z FROM sums JOIN whole USING (feature)),
stats AS (SELECT feature, n0, n1, diff, z, coalesce({two_sided_p_sql('z')}, 2) AS p, abs(diff / nullif(mean_all, 0)) AS diff_norm FROM base)"""


STATS_OUT = "feature, n0, n1, round(diff, 4) AS diff, round(z, 4) AS z, round(p, 4) AS p, round(diff_norm, 4) AS diff_norm"


@query("class_separation", f"WITH {DOCS_SQL}, {_separation_sql('quality')} SELECT {STATS_OUT} FROM stats")
def class_separation_query(spark, folder):
    return rounded(class_separation(labelled_documents(spark, folder), STAT_FEATURES, "quality"))


@query("rank_sum", f"WITH {DOCS_SQL}, {_separation_sql('toxic', tuple(TEXT_FEATURES))} SELECT feature, round(z, 4) AS z, round(p, 4) AS p FROM stats")
def rank_sum(spark, folder):
    return rounded(class_separation(labelled_documents(spark, folder), TEXT_FEATURES, "toxic").select("feature", "z", "p"))


@query(
    "train_test_drift",
    f"WITH {DOCS_SQL}, {_separation_sql('CASE WHEN quality IS NULL THEN 0 ELSE 1 END', tuple(TEXT_FEATURES))} SELECT {STATS_OUT} FROM stats",
)
def train_test_drift_query(spark, folder):
    return rounded(train_test_drift(labelled_documents(spark, folder), TEXT_FEATURES, "quality"))


# Documents with one more column that is null-free, moves between train and test, and is flat in the label.
DRIFT_DOCS_SQL = DOCS_SQL.replace("docs AS (", "docs0 AS (") + """, docs AS (
  SELECT *, CASE WHEN quality IS NULL THEN 10 + doc_id % 7 ELSE 1 END AS moving FROM docs0)"""


def moving_documents(spark, folder):
    moving = F.when(F.col("quality").isNull(), 10 + F.col("doc_id") % 7).otherwise(F.lit(1))
    return labelled_documents(spark, folder).withColumn("moving", moving)


@query(
    "drift_filter",
    f"""WITH {DRIFT_DOCS_SQL}, {_separation_sql('quality', (*TEXT_FEATURES, 'moving'))},
{_separation_sql('CASE WHEN quality IS NULL THEN 0 ELSE 1 END', (*TEXT_FEATURES, 'moving')).replace('long', 'long2').replace('ranked', 'ranked2').replace('sums', 'sums2').replace('whole', 'whole2').replace('base', 'base2').replace('stats', 'stats2').replace('is_long2', 'is_long')}
SELECT feature FROM stats2 WHERE p < 0.05 AND diff_norm > 1 AND feature IN (SELECT feature FROM stats WHERE diff_norm = 0)""",
)
def drift_filter(spark, folder):
    docs = moving_documents(spark, folder)
    features = [*TEXT_FEATURES, "moving"]
    classes = class_separation(docs, features, "quality")
    return drifting_features(classes, train_test_drift(docs, features, "quality"))


@query(
    "constant_columns",
    """SELECT 'all_null' AS feature UNION ALL SELECT 'always_one'""",
)
def constant_columns_query(spark, folder):
    docs = labelled_documents(spark, folder).withColumns(
        {
            "always_one": F.when(F.col("doc_id") % 3 > 0, F.lit(1)),
            "all_null": F.lit(None).cast("double"),
        }
    )
    found = constant_columns(docs, [c for c in docs.columns if c != "doc_id"])
    return spark.createDataFrame([(c,) for c in found], "feature string")


@query(
    "drop_by_separation",
    f"""WITH {DOCS_SQL}, {_separation_sql('quality')}
SELECT feature FROM stats WHERE NOT (p > 0.05 AND (diff = 0 OR coalesce(diff_norm < 0.5, false)) AND feature <> 'n_chars')""",
)
def drop_by_separation(spark, folder):
    docs = labelled_documents(spark, folder)
    statistics = class_separation(docs, STAT_FEATURES, "quality")
    dropped = weak_features(statistics, protected=["n_chars"])
    kept = drop_features(docs.select("doc_id", *STAT_FEATURES), dropped)
    return remaining_features(statistics, dropped).where(F.col("feature").isin(kept.columns))


@query("kfold", f"WITH {DOCS_SQL} SELECT doc_id, ({hash32_sql('doc_id', 1001)} % 5)::INTEGER AS fold FROM docs WHERE quality IS NOT NULL")
def kfold_query(spark, folder):
    return kfold(table(spark, folder, "labels").select("doc_id"), "doc_id", 5, 1001)


@query(
    "stratified_kfold",
    f"""SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY {hash_text_sql('doc_id', 47)}, doc_id) - 1) % 5)::INTEGER AS fold FROM labels""",
)
def stratified_kfold_query(spark, folder):
    return stratified_kfold(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "quality", 5, 47)


@query(
    "holdout",
    f"""SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY {hash_text_sql('doc_id', 0)}, doc_id) - 1
  < ceil(count(*) OVER (PARTITION BY quality) * 0.9::DOUBLE) THEN 1 ELSE 0 END AS in_train FROM labels""",
)
def holdout(spark, folder):
    return stratified_holdout(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "quality", 0.9)


@query("oof_scores", f"WITH {FOLD_SCORES_SQL} SELECT doc_id, label, fold, round(score, 4) AS score FROM scores WHERE part = 'valid'")
def oof_scores(spark, folder):
    return rounded(out_of_fold(fold_scores(spark, folder).drop("own_fold")))


@query("fold_mean_score", f"WITH {FOLD_SCORES_SQL} SELECT doc_id, round(avg(score), 4) AS score FROM scores WHERE part = 'test' GROUP BY doc_id")
def fold_mean_score_query(spark, folder):
    return rounded(fold_mean_score(fold_scores(spark, folder), "doc_id"))


IN_SAMPLE_SQL = """seen AS (SELECT doc_id, label, score, row_number() OVER (PARTITION BY doc_id ORDER BY fold DESC) AS b FROM scores WHERE part = 'train'),
in_sample AS (SELECT doc_id, label, score FROM seen WHERE b = 1)"""


@query("in_sample_last_fold", f"WITH {FOLD_SCORES_SQL}, {IN_SAMPLE_SQL} SELECT doc_id, label, round(score, 4) AS score FROM in_sample")
def in_sample_last_fold(spark, folder):
    return rounded(in_sample_score(fold_scores(spark, folder), "doc_id", "label"))


def _auc_sql(source: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    both = f"PARTITION BY {by}, score" if by else "PARTITION BY score"
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""SELECT {head}(sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0::DOUBLE)
  / nullif(count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0), 0) AS auc
FROM (SELECT *, rank() OVER ({part} ORDER BY score) + (count(*) OVER ({both}) - 1) / 2.0::DOUBLE AS r FROM {source} WHERE label IS NOT NULL){tail}"""


VALID_SQL = "valid AS (SELECT * FROM scores WHERE part = 'valid')"


@query("auc", f"WITH {FOLD_SCORES_SQL}, {VALID_SQL} SELECT round(auc, 4) AS auc FROM ({_auc_sql('valid')})")
def auc(spark, folder):
    return rounded(roc_auc(out_of_fold(fold_scores(spark, folder)), "label", "score"))


@query("auc_per_fold", f"WITH {FOLD_SCORES_SQL}, {VALID_SQL} SELECT fold, round(auc, 4) AS auc FROM ({_auc_sql('valid', 'fold')})")
def auc_per_fold(spark, folder):
    return rounded(roc_auc(out_of_fold(fold_scores(spark, folder)), "label", "score", ["fold"]))


def _class_sql(source: str) -> str:
    out = []
    for k in (0, 1):
        guess = f"(score >= 0.5) = ({k} = 1)"
        hit = f"count(*) FILTER (WHERE label = {k} AND {guess})"
        out.append(f"{hit}::DOUBLE / nullif(count(*) FILTER (WHERE {guess}), 0) AS precision_{k}")
        out.append(f"{hit}::DOUBLE / nullif(count(*) FILTER (WHERE label = {k}), 0) AS recall_{k}")
    return f"SELECT {', '.join(out)} FROM {source} WHERE label IS NOT NULL"


@query(
    "precision_recall",
    f"WITH {FOLD_SCORES_SQL}, {VALID_SQL} SELECT {', '.join(f'round({m}_{k}, 4) AS {m}_{k}' for m in ('precision', 'recall') for k in (0, 1))} FROM ({_class_sql('valid')})",
)
def precision_recall_query(spark, folder):
    return rounded(precision_recall(out_of_fold(fold_scores(spark, folder)), "label", "score"))


@query(
    "log_loss",
    f"WITH {FOLD_SCORES_SQL}, {VALID_SQL} SELECT fold, round(avg(-(label * ln(score) + (1 - label) * ln(1 - score))), 4) AS log_loss FROM valid GROUP BY fold",
)
def log_loss_query(spark, folder):
    return rounded(log_loss(out_of_fold(fold_scores(spark, folder)), "label", "score", ["fold"]))


@query(
    "score_summary",
    f"""WITH {FOLD_SCORES_SQL}, {VALID_SQL}, {IN_SAMPLE_SQL},
a AS ({_auc_sql('in_sample')}), b AS ({_auc_sql('valid')}), c AS ({_class_sql('in_sample')}), d AS ({_class_sql('valid')})
SELECT round(a.auc, 4) AS roc_auc_train, round(b.auc, 4) AS roc_auc_test, """
    + ", ".join(
        f"round({t}.{m}_{k}, 4) AS {m}_{s}_{k}" for m in ("precision", "recall") for k in (0, 1) for s, t in (("train", "c"), ("test", "d"))
    )
    + ", 0 AS board FROM a, b, c, d",
)
def score_summary_query(spark, folder):
    stacked = fold_scores(spark, folder)
    return rounded(score_summary(in_sample_score(stacked, "doc_id", "label"), out_of_fold(stacked), "label", "score"))


IMPORTANCE_FEATURES = ["n_chars", "n_spaces", "n_lines", "n_stops", "toxic"]


def _class_gap(df, by):
    """|mean in class 1 - mean in class 0| per feature: an importance that SQL can repeat exactly."""
    long = to_long(df, [*by, "y"], IMPORTANCE_FEATURES)
    mean = lambda k: F.avg(F.when(F.col("y") == k, F.col("value")))
    return long.groupBy(*by, "feature").agg(F.abs(mean(1) - mean(0)).alias("gain"), F.count("value").alias("split"))


GAP_SQL = "abs(avg(v) FILTER (WHERE y = 1) - avg(v) FILTER (WHERE y = 0)) AS gain, count(v) AS split"


def _gap_sql(source: str, by: str) -> str:
    long = " UNION ALL ".join(f"SELECT {by}y, '{f}' AS feature, {f}::DOUBLE AS v FROM {source}" for f in IMPORTANCE_FEATURES)
    return f"SELECT {by}feature, {GAP_SQL} FROM ({long}) GROUP BY {by}feature"


SEEDS = list(range(20))
NULL_RUNS_SQL = f"""{DOCS_SQL}, {_permuted_sql(SEEDS)},
act_rows AS (SELECT *, quality AS y FROM docs WHERE quality IS NOT NULL),
null_rows AS (SELECT d.* , p.seed, p.quality AS y FROM docs d JOIN permuted p ON p.doc_id = d.doc_id),
act AS ({_gap_sql('act_rows', '')}), nulls AS ({_gap_sql('null_rows', 'seed, ')})"""


def _importances(spark, folder):
    docs = labelled_documents(spark, folder).where(F.col("quality").isNotNull())
    actual = _class_gap(docs.withColumn("y", F.col("quality")), [])
    shuffled = permute(docs.select("doc_id", "quality"), "doc_id", ["quality"], SEEDS).withColumnRenamed("quality", "y")
    return actual, _class_gap(docs.join(shuffled, "doc_id"), ["seed"])


@query(
    "importance_mean",
    f"""WITH {DOCS_SQL}, r AS (SELECT *, quality AS y, {hash32_sql('doc_id', 5)} % 5 AS fold FROM docs WHERE quality IS NOT NULL),
g AS ({_gap_sql('r', 'fold, ')})
SELECT feature, round(sum(coalesce(gain, 0)) / 5, 4) AS mean FROM g GROUP BY feature""",
)
def importance_mean(spark, folder):
    docs = kfold(labelled_documents(spark, folder).where(F.col("quality").isNotNull()), "doc_id", 5, 5)
    return rounded(mean_importance(_class_gap(docs.withColumn("y", F.col("quality")), ["fold"]), 5, "gain"))


@query(
    "null_importance_log",
    f"""WITH RECURSIVE {NULL_RUNS_SQL}, q AS (SELECT feature, quantile_cont(gain, 0.75) AS g, quantile_cont(split, 0.75) AS s FROM nulls GROUP BY feature)
SELECT act.feature, round(ln(1e-10::DOUBLE + act.gain / (1 + q.g)), 4) AS gain_score, round(ln(1e-10::DOUBLE + act.split / (1 + q.s)), 4) AS split_score
FROM act JOIN q ON q.feature = act.feature""",
)
def null_importance_log(spark, folder):
    return rounded(null_importance_log_score(*_importances(spark, folder), ["gain", "split"]))


@query(
    "null_importance_percent",
    f"""WITH RECURSIVE {NULL_RUNS_SQL}, q AS (SELECT feature, quantile_cont(gain, 0.25) AS g, quantile_cont(split, 0.25) AS s FROM act GROUP BY feature)
SELECT n.feature, round(100.0::DOUBLE * count(*) FILTER (WHERE n.gain < q.g) / count(*), 4) AS gain_score,
  round(100.0::DOUBLE * count(*) FILTER (WHERE n.split < q.s) / count(*), 4) AS split_score
FROM nulls n JOIN q ON q.feature = n.feature GROUP BY n.feature""",
)
def null_importance_percent(spark, folder):
    return rounded(null_importance_percent_score(*_importances(spark, folder), ["gain", "split"]))


@query(
    "auc_null_group",
    f"WITH {FOLD_SCORES_SQL}, {VALID_SQL}, g AS (SELECT * REPLACE (nullif(fold, 1) AS fold) FROM valid) SELECT fold, round(auc, 4) AS auc FROM ({_auc_sql('g', 'fold')})",
)
def auc_null_group(spark, folder):
    """Rows of an unknown group are a group of their own."""
    scores = out_of_fold(fold_scores(spark, folder)).withColumn("fold", F.nullif("fold", F.lit(1)))
    return rounded(roc_auc(scores, "label", "score", ["fold"]))
