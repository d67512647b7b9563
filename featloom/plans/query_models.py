"""Training and model-based selection queries over the labelled and unlabelled documents.

Model output has no SQL counterpart; the coverage query checks in SQL that each
row is scored by the right folds.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.functions.hashing import hash32
from featloom.operators.encode import AlphabeticalCodes, OneHot, fill_with_mean, rank_gauss
from featloom.operators.folds import fold_mean_score, in_sample_score, out_of_fold, stratified_holdout, stratified_kfold
from featloom.operators.metrics import roc_auc, score_summary
from featloom.operators.models import (
    LABEL,
    Recipe,
    boosted_trees,
    forest,
    holdout_fit,
    importance_table,
    kfold_fit,
    net,
    search_parameters,
    vector_names,
    vector_table,
)
from featloom.operators.selection import (
    actual_importance,
    important_features,
    importance_runs,
    null_importance_log_score,
    principal_components,
    residual_rounds,
    shadow_selection,
    vector_components,
)
from featloom.operators.rollup import category_shares
from featloom.operators.sparse import SparseTable, sparse_vector_table
from featloom.operators.staged import Ensemble, early_stop, staged_auc, staged_margins
from featloom.plans.fixtures import DOCS_SQL, TEXT_FEATURES, labelled_documents
from featloom.plans.registry import hash32_sql, query
from featloom.sources.tables import table
from featloom.workspace import materialise

KEY = "doc_id"


def document_features(spark, folder) -> tuple[DataFrame, list[str]]:
    """Encoded documents with one noise column; the label is ``quality``."""
    docs = labelled_documents(spark, folder)
    docs = OneHot.fit(docs, ["lang"]).transform(docs)
    docs = AlphabeticalCodes.fit(docs, "source").transform(docs)
    docs = docs.withColumn("noise", hash32(KEY, "noise") / float(1 << 32))
    docs = materialise(docs.drop("toxic"), "documents")
    return docs, [c for c in docs.columns if c not in (KEY, "quality")]


def document_vectors(spark, folder) -> DataFrame:
    docs, features = document_features(spark, folder)
    return vector_table(docs, KEY, features, "quality")


def scores_of(result) -> DataFrame:
    """Out-of-fold scores of labelled rows and averaged scores of the rest."""
    oof = out_of_fold(result.stacked).select(KEY, LABEL, F.lit("out_of_fold").alias("part"), "score")
    test = fold_mean_score(result.stacked, KEY).select(
        KEY, F.lit(None).cast("double").alias(LABEL), F.lit("test").alias("part"), "score"
    )
    return oof.unionByName(test)


@query("gbt_kfold")
def gbt_kfold(spark, folder):
    recipe = Recipe(boosted_trees, {"maxIter": 10, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.9}, 1001, early_stop=True)
    return scores_of(kfold_fit(document_vectors(spark, folder), KEY, recipe, 5, 1001, with_importance=False))


@query("gbt_weighted_kfold")
def gbt_weighted_kfold(spark, folder):
    recipe = Recipe(
        boosted_trees, {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8}, 27, positive_weight=2.5, early_stop=True
    )
    return scores_of(kfold_fit(document_vectors(spark, folder), KEY, recipe, 5, 1001, with_importance=False))


@query("gbt_stratified_kfold")
def gbt_stratified_kfold(spark, folder):
    vectors = document_vectors(spark, folder)
    labelled = vectors.where(F.col(LABEL).isNotNull()).select(KEY, LABEL)
    folds = stratified_kfold(labelled, KEY, LABEL, 3, 1001).select(KEY, "fold")
    recipe = Recipe(boosted_trees, {"maxIter": 8, "maxDepth": 6, "stepSize": 0.09}, 17)
    return scores_of(kfold_fit(vectors, KEY, recipe, 3, with_importance=False, folds=folds))


@query("gbt_holdout")
def gbt_holdout(spark, folder):
    recipe = Recipe(boosted_trees, {"maxIter": 20, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.85}, 0, early_stop=True)
    return holdout_fit(document_vectors(spark, folder), KEY, recipe)


#: Fixed trees of one split: feature, threshold, value up to it, value above it.
STUMPS = [("n_spaces", 120, -0.3, 0.2), ("n_chars", 900, -0.1, 0.25), ("n_spaces", 400, 0.05, -0.2), ("n_lines", 3, -0.15, 0.1), ("n_chars", 2500, 0.02, -0.4), ("n_spaces", 60, -0.5, 0.01)]


def _stump_sql(feature: str, cut: float, low: float, high: float) -> str:
    return f"CASE WHEN coalesce({feature}, 0) <= {cut} THEN {low}::DOUBLE ELSE {high}::DOUBLE END"


@query(
    "staged_auc",
    f"""WITH {DOCS_SQL},
m AS (SELECT doc_id, quality, {", ".join(f"{' + '.join(_stump_sql(*s) for s in STUMPS[:k])} AS m{k}" for k in range(1, len(STUMPS) + 1))} FROM docs WHERE quality IS NOT NULL),
long AS ({" UNION ALL ".join(f"SELECT {k} AS stage, quality, m{k} AS v FROM m" for k in range(1, len(STUMPS) + 1))}),
ranked AS (SELECT stage, quality, rank() OVER (PARTITION BY stage ORDER BY v) + (count(*) OVER (PARTITION BY stage, v) - 1) / 2.0 AS r FROM long),
area AS (
  SELECT stage, round((sum(r) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2.0)
    / (count(*) FILTER (quality = 1) * count(*) FILTER (quality = 0)), 9) AS auc FROM ranked GROUP BY stage)
SELECT stage::INTEGER AS stage, auc, (stage = (SELECT min(stage) FROM area WHERE auc = (SELECT max(auc) FROM area))) AS best FROM area""",
)
def staged_auc_query(spark, folder):
    """Area after each tree of an ensemble that SQL can evaluate as well, and the best of them."""
    features = list(dict.fromkeys(s[0] for s in STUMPS))
    docs = labelled_documents(spark, folder).where(F.col("quality").isNotNull())
    trees = Ensemble.stumps([(features.index(f), cut, low, high) for f, cut, low, high in STUMPS])
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    areas = materialise(staged_auc(docs.select("quality", staged_margins(trees, x).alias("m")), "quality", "m").select("stage", F.round("auc", 9).alias("auc")), "areas")
    best = areas.agg(F.min_by("stage", F.struct(-F.col("auc"), F.col("stage"))).alias("first"))
    return areas.select("stage", "auc", (F.col("stage") == best.scalar()).alias("best"))


@query("gbt_early_stop")
def gbt_early_stop(spark, folder):
    """A training of 200 rounds on nine tenths of the labelled rows: the area on the rest after each round, and where patience of 30 rounds ends it."""
    vectors = document_vectors(spark, folder)
    split = materialise(stratified_holdout(vectors.where(F.col(LABEL).isNotNull()), KEY, LABEL, 0.9, 0), "split")
    held_out = split.where("in_train = 0")
    recipe = Recipe(boosted_trees, {"maxIter": 200, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.85}, 0)
    trees = Ensemble.of(recipe.fit(split.where("in_train = 1").drop("in_train")), spark)
    walked = held_out.select(LABEL, staged_margins(trees, vector_to_array("features")).alias("m"))
    areas = staged_auc(walked, LABEL, "m").orderBy("stage").collect()  # one row a round
    stop = early_stop([r["auc"] for r in areas], 30)
    rows = [(r["stage"], r["auc"], stop.best, stop.stopped) for r in areas]
    return spark.createDataFrame(rows, "stage int, auc double, best int, stopped int")


@query("mlp_kfold")
def mlp_kfold(spark, folder):
    docs, features = document_features(spark, folder)
    filled = fill_with_mean(docs, features, limit=1e11)
    vectors = vector_table(rank_gauss(filled, KEY, features), KEY, features, "quality")
    recipe = Recipe(net(len(features)), {"maxIter": 11}, 42)
    return scores_of(kfold_fit(vectors, KEY, recipe, 10, 42, with_importance=False))


@query("rf_importance")
def rf_importance(spark, folder):
    recipe = Recipe(forest, {"numTrees": 20, "maxDepth": 8, "subsamplingRate": 0.623, "featureSubsetStrategy": "0.7"}, 5)
    return actual_importance(document_vectors(spark, folder), recipe)


@query("fold_importance")
def fold_importance(spark, folder):
    recipe = Recipe(boosted_trees, {"maxIter": 5, "maxDepth": 4}, 1001)
    return kfold_fit(document_vectors(spark, folder), KEY, recipe, 3, 1001).importances


@query("model_score_summary")
def model_score_summary(spark, folder):
    stacked = kfold_fit(
        document_vectors(spark, folder), KEY, Recipe(boosted_trees, {"maxIter": 5, "maxDepth": 4}, 1001), 3, 1001, False
    ).stacked
    return score_summary(in_sample_score(stacked, KEY, LABEL), out_of_fold(stacked), LABEL, "score")


@query(
    "kfold_coverage",
    f"""WITH {DOCS_SQL}, f AS (SELECT doc_id, quality, ({hash32_sql('doc_id', 1001)} % 3) AS own FROM docs),
x AS (SELECT k.fold::INTEGER AS fold, CASE WHEN quality IS NULL THEN 'test' WHEN own = k.fold THEN 'valid' ELSE 'train' END AS part, doc_id
  FROM f, range(3) AS k(fold))
SELECT fold, part, count(*) AS n, sum(doc_id)::BIGINT AS id_sum, count(*) AS in_range FROM x GROUP BY fold, part""",
)
def kfold_coverage(spark, folder):
    recipe = Recipe(boosted_trees, {"maxIter": 3, "maxDepth": 3}, 1001)
    stacked = kfold_fit(document_vectors(spark, folder), KEY, recipe, 3, 1001, False).stacked
    return stacked.groupBy("fold", "part").agg(
        F.count("*").alias("n"), F.sum(KEY).alias("id_sum"), F.count_if(F.col("score").between(0, 1)).alias("in_range")
    )


@query("param_search")
def param_search(spark, folder):
    found = search_parameters(
        document_vectors(spark, folder),
        KEY,
        boosted_trees,
        {"stepSize": (0.05, 0.15), "maxDepth": (2, 5), "subsamplingRate": (0.8, 1.0)},
        trials=2,
        seed=1001,
        fixed={"maxIter": 5},
    )
    rows = [(i, p["stepSize"], p["maxDepth"], p["subsamplingRate"], a) for i, (p, a) in enumerate(found, 1)]
    return spark.createDataFrame(rows, "place int, step_size double, max_depth int, subsampling_rate double, auc double")


@query("importance_threshold")
def importance_threshold(spark, folder):
    return important_features(document_vectors(spark, folder), Recipe(boosted_trees, {"maxIter": 10, "maxDepth": 5}, 0))


@query("residual_selection")
def residual_selection(spark, folder):
    rounds = residual_rounds(document_vectors(spark, folder), KEY, Recipe(boosted_trees, {"maxIter": 3, "maxDepth": 2}, 0))
    rows = [(i, r.auc, f) for i, r in enumerate(rounds, 1) for f in r.features]
    return spark.createDataFrame(rows, "round int, auc double, feature string")


# The forest and the runs that null importances stand for.
NULL_IMPORTANCE_FOREST = {"numTrees": 200, "maxDepth": 8, "subsamplingRate": 0.623, "featureSubsetStrategy": "0.7"}
NULL_RUNS = 80


@query("null_importance_runs")
def null_importance_runs(spark, folder):
    recipe = Recipe(forest, NULL_IMPORTANCE_FOREST, 1)
    vectors = document_vectors(spark, folder)
    runs = importance_runs(vectors, KEY, recipe, range(NULL_RUNS), parallel=4)
    return null_importance_log_score(actual_importance(vectors, recipe), runs, ["gain", "split"])


@query("shadow_selection")
def shadow_selection_query(spark, folder):
    docs, features = document_features(spark, folder)
    recipe = Recipe(forest, {"numTrees": 20, "maxDepth": 5}, 42, balanced=True)
    state = shadow_selection(docs, KEY, features, "quality", recipe, rounds=20, seed=42)
    rows = [(f, state.hits[f], s, state.rounds) for f, s in state.status.items()]
    return spark.createDataFrame(rows, "feature string, hits int, status string, rounds int")


@query("pca_features")
def pca_features(spark, folder):
    docs, features = document_features(spark, folder)
    scores, shares = principal_components(docs, KEY, features, 10)
    return scores.select(KEY, *[c for c in scores.columns if c.startswith("PCA_")])


@query(
    "pca_variance",
    """
WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT i, var_samp(x) AS s FROM v GROUP BY i)
SELECT round(sum(s), 4) AS total_variance FROM m""",
)
def pca_variance(spark, folder):
    """All components of the embeddings carry the total variance of the coordinates."""
    vectors = table(spark, folder, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    width = len(table(spark, folder, "embeddings").first()["embedding"])
    scores, _ = vector_components(vectors, "v", width, "c")
    long = scores.select(F.posexplode(vector_to_array("c")).alias("i", "x"))
    return long.groupBy("i").agg(F.var_samp("x").alias("s")).agg(F.round(F.sum("s"), 4).alias("total_variance"))


@query(
    "sparse_category_entries",
    """
WITH c AS (SELECT o_custkey, unnest([struct_pack(c := 'day', v := strftime(o_orderdate, '%Y-%m-%d')), struct_pack(c := 'priority', v := CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END)]) AS s FROM orders),
n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
slots AS (SELECT c, v, row_number() OVER (ORDER BY c, v NULLS FIRST) AS slot FROM (SELECT DISTINCT s.c AS c, s.v AS v FROM c)),
shares AS (SELECT o_custkey, s.c AS c, s.v AS v, count(*)::DOUBLE / any_value(n) AS share FROM c JOIN n USING (o_custkey) GROUP BY ALL)
SELECT c_custkey AS o_custkey, 0::INTEGER AS slot, round(c_acctbal, 6) AS value FROM customer WHERE c_acctbal <> 0
UNION ALL SELECT o_custkey, slot::INTEGER, round(share, 6) FROM shares JOIN slots ON slots.c = shares.c AND slots.v IS NOT DISTINCT FROM shares.v
  JOIN customer ON c_custkey = o_custkey""",
)
def sparse_category_entries(spark, folder):
    """What the vectors of customers hold: the balance, then a slot for every day and priority of their orders."""
    orders = table(spark, folder, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority")
    )
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", (F.col("c_nationkey") % 2).alias("label"))
    shares = category_shares(orders, "o_custkey", ["day", "priority"])
    entries = sparse_vector_table(base, "o_custkey", ["c_acctbal"], "label", shares).entries()
    return entries.withColumn("value", F.round("value", 6))


def document_words(spark, folder) -> SparseTable:
    """Text measures, and the share of every word of a document in a slot of its own."""
    docs = labelled_documents(spark, folder)
    words = table(spark, folder, "documents").select("doc_id", F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).where("word <> ''")
    return sparse_vector_table(docs, KEY, TEXT_FEATURES, "quality", category_shares(words, KEY, ["word"]))


@query(
    "sparse_kfold_coverage",
    f"""WITH {DOCS_SQL}, f AS (SELECT doc_id, quality, ({hash32_sql('doc_id', 1001)} % 3) AS own FROM docs),
x AS (SELECT k.fold::INTEGER AS fold, CASE WHEN quality IS NULL THEN 'test' WHEN own = k.fold THEN 'valid' ELSE 'train' END AS part, doc_id
  FROM f, range(3) AS k(fold))
SELECT fold, part, count(*) AS n, sum(doc_id)::BIGINT AS id_sum, count(*) AS in_range FROM x GROUP BY fold, part""",
)
def sparse_kfold_coverage(spark, folder):
    """Boosted trees over every word of the documents, without a cap on the words."""
    recipe = Recipe(boosted_trees, {"maxIter": 3, "maxDepth": 3, "maxBins": 8}, 1001)
    stacked = kfold_fit(document_words(spark, folder).vectors, KEY, recipe, 3, 1001, False).stacked
    return stacked.groupBy("fold", "part").agg(
        F.count("*").alias("n"), F.sum(KEY).alias("id_sum"), F.count_if(F.col("score").between(0, 1)).alias("in_range")
    )
