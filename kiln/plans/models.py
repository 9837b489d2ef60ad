"""Queries for model fits, tuning and evaluation.

Datasets (all derived by Spark from the driver tables):
* documents with a quality label -> per-document text statistics (binary classification);
  unlabelled documents are the table to score;
* orders with line-item aggregates -> order total (regression);
* embeddings -> 10-class vectors (k-NN, naive Bayes, discriminant analysis).
Splits are hash-of-key, so they are identical on every run and partitioning.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators.models import bayes, boosting, discriminant, gradient, kernel_basis, kernel_svm, mllib, neighbors, tuning
from kiln.operators.ordering import stratified_folds, train_test_split
from kiln.operators.transform import fit_standard_scaler
from kiln.plans.catalog import register
from kiln.session import spread
from kiln.sources import Tables, submission
from kiln.sources.files import load_model, save_model, scratch_path

DOC_X = ["n_chars", "n_lines", "n_words", "upper_share", "digit_share", "punct_share"]
ORD_X = ["n_lines", "qty", "disc", "tax", "max_price"]


def _share(pattern: str):
    t = F.col("text")
    return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))) / F.greatest(F.length(t), F.lit(1))


def doc_table(spark, sf):
    """All documents with text statistics and the quality label (NULL when unlabelled)."""
    t = Tables(spark, sf)
    d = spread(t.documents.select("doc_id", "n_chars", "text"), "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        _share("[A-Z]").alias("upper_share"), _share("[0-9]").alias("digit_share"),
        _share(r"[^A-Za-z0-9\s]").alias("punct_share"))
    return d.join(t.labels.select("doc_id", "quality"), "doc_id", "left")


def doc_split(spark, sf, scaled: bool = False):
    d = doc_table(spark, sf)
    lab = d.filter(F.col("quality").isNotNull())
    train, test = train_test_split(lab, "doc_id", 0.7, seed=42)
    if scaled:
        sc = fit_standard_scaler(train, DOC_X)
        train, test = sc.apply(train), sc.apply(test)
    return train.cache(), test.cache()


def order_split(spark, sf, scaled: bool = False):
    t = Tables(spark, sf)
    # The target has a signal: what the order's line items come to, against counts, means and the top price.
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("qty"),
        F.avg("l_discount").alias("disc"), F.avg("l_tax").alias("tax"),
        F.max("l_extendedprice").alias("max_price"))
    o = t.orders.select("o_orderkey").join(li, F.col("o_orderkey") == F.col("l_orderkey")) \
        .drop("l_orderkey")
    train, test = train_test_split(o, "o_orderkey", 0.8, seed=42)
    if scaled:  # the target too; ``_unscaled`` takes predictions back
        sc = fit_standard_scaler(train, [*ORD_X, "revenue"])
        train, test = sc.apply(train), sc.apply(test)
        return train.cache(), test.cache(), sc
    return train.cache(), test.cache()


def _unscaled(df, scaler):
    """Target and prediction in the target's own units."""
    m, s = scaler.means["revenue"], scaler.scales["revenue"]
    return df.withColumns({"revenue": F.col("revenue") * s + m, "prediction": F.col("prediction") * s + m}).select(
        "o_orderkey", F.round("revenue", 4).alias("revenue"), F.round("prediction", 4).alias("prediction"))


def _clf_out(model, test):
    return model.transform(test).select("doc_id", "quality", F.col("prediction").cast("int").alias("prediction"))


def _reg_out(model, test):
    return model.transform(test).select("o_orderkey", "revenue", F.round("prediction", 4).alias("prediction"))


# ------------------------------------------------------------------ classifiers

@register("clf_logistic", "M1 V1")
def q_clf_logistic(spark, sf):
    train, test = doc_split(spark, sf, scaled=True)
    m = mllib.logistic(train, DOC_X, "quality")
    return m.transform(test).select("doc_id", "quality", F.col("prediction").cast("int").alias("prediction"),
                                    F.round("p1", 6).alias("p1"))


@register("clf_forest", "M2")
def q_clf_forest(spark, sf):
    train, test = doc_split(spark, sf)
    return _clf_out(mllib.random_forest_classifier(train, DOC_X, "quality", n_trees=50, max_features=2,
                                                   min_instances=5), test)


@register("feature_importance", "M3 O1")
def q_feature_importance(spark, sf):
    train, _ = doc_split(spark, sf)
    m = mllib.random_forest_classifier(train, DOC_X, "quality", n_trees=100, max_features=2)
    return mllib.feature_importance(m, spark)


@register("clf_svm", "M4")
def q_clf_svm(spark, sf):
    train, test = doc_split(spark, sf, scaled=True)
    return _clf_out(kernel_svm.svm_classifier(train, DOC_X, "quality"), test)


@register("clf_knn", "M5", """
WITH pairs AS (
  SELECT q.vec_id AS qid, t.vec_id AS tid, t.label,
         list_sum(list_transform(list_zip(CAST(q.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])),
                                 lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
  FROM embeddings q JOIN embeddings t ON q.vec_id <> t.vec_id),
top AS (SELECT qid, label FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM pairs)
        WHERE rn <= 4),
votes AS (SELECT qid, label, count(*) AS c FROM top GROUP BY 1, 2)
SELECT qid AS vec_id, arg_min(label, (-c, label)) AS prediction FROM votes GROUP BY qid""")
def q_clf_knn(spark, sf):
    emb = Tables(spark, sf).embeddings
    return neighbors.knn_classify(emb, emb, "embedding", "label", k=4, train_id="vec_id", query_id="vec_id",
                                  exclude_self=True)


@register("clf_gaussian_nb", "M6", """
WITH long AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
                     unnest(range(len(embedding))) AS f FROM embeddings),
     cls AS (SELECT label, f, avg(x) AS m, var_pop(x) AS v FROM long GROUP BY 1, 2),
     eps AS (SELECT 1e-9 * max(v) AS e FROM (SELECT f, var_pop(x) AS v FROM long GROUP BY f)),
     pri AS (SELECT label, ln(count(*) / (SELECT count(*) FROM embeddings)) AS lp FROM embeddings GROUP BY 1),
     sc AS (SELECT l.vec_id, c.label AS cls,
                   sum(-0.5 * ln(2 * pi() * (c.v + e.e)) - 0.5 * (l.x - c.m) * (l.x - c.m) / (c.v + e.e)) AS s
            FROM long l JOIN cls c ON l.f = c.f, eps e GROUP BY 1, 2)
SELECT vec_id, arg_max(cls, s + lp) AS prediction FROM sc JOIN pri ON sc.cls = pri.label GROUP BY vec_id""")
def q_clf_gaussian_nb(spark, sf):
    emb = Tables(spark, sf).embeddings
    fit = bayes.gaussian_nb(emb, "embedding", "label")
    return fit.transform(emb, "embedding").select("vec_id", "prediction")


@register("clf_tree", "M7")
def q_clf_tree(spark, sf):
    train, test = doc_split(spark, sf)
    return _clf_out(mllib.decision_tree_classifier(train, DOC_X, "quality", min_split=10), test)


@register("clf_adaboost", "M8")
def q_clf_adaboost(spark, sf):
    train, test = doc_split(spark, sf)
    fit = boosting.adaboost_classifier(train, DOC_X, "quality", n_estimators=50)
    return fit.transform(test).select("doc_id", "quality", F.col("prediction").cast("int").alias("prediction"))


@register("clf_lda", "M9")
def q_clf_lda(spark, sf):
    emb = Tables(spark, sf).embeddings
    fit = discriminant.lda(emb, "embedding", "label")
    return fit.transform(emb, "embedding").select("vec_id", "label", "prediction")


@register("clf_gbt", "M10")
def q_clf_gbt(spark, sf):
    train, test = doc_split(spark, sf)
    return _clf_out(mllib.gbt_classifier(train, DOC_X, "quality", n_estimators=100, max_depth=3), test)


@register("clf_mlp", "M11")
def q_clf_mlp(spark, sf):
    train, test = doc_split(spark, sf, scaled=True)
    return _clf_out(mllib.mlp_classifier(train, DOC_X, "quality", hidden=(16, 32, 32), max_iter=200), test)


@register("soft_vote", "M14", """
SELECT doc_id, round(0.7 * (n_chars / (n_chars + 1000.0)) + 0.3 * (1.0 / (1.0 + exp(-(n_chars - 2000) / 500.0))), 6)
       AS generated FROM documents""")
def q_soft_vote(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", F.col("n_chars").cast("double").alias("n"))
    d = d.select("doc_id", (F.col("n") / (F.col("n") + 1000.0)).alias("p_a"),
                 (1.0 / (1.0 + F.exp(-(F.col("n") - 2000) / 500.0))).alias("p_b"))
    v = tuning.soft_vote(d, ["p_a", "p_b"], [0.7, 0.3])
    return v.select("doc_id", F.round("generated", 6).alias("generated"))


# ------------------------------------------------------------------ regressors

@register("reg_linear", "M15")
def q_reg_linear(spark, sf):
    train, test = order_split(spark, sf)
    return _reg_out(mllib.linear_regression(train, ORD_X, "revenue"), test)


@register("reg_linear_1d", "M15 N5", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""")
def q_reg_linear_1d(spark, sf):
    li = Tables(spark, sf).lineitem
    m = mllib.linear_regression(li, ["l_quantity"], "l_extendedprice").model.stages[-1]
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))], "slope double, intercept double") \
        .select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


@register("reg_ridge", "M16")
def q_reg_ridge(spark, sf):
    train, test = order_split(spark, sf)
    return _reg_out(mllib.ridge(train, ORD_X, "revenue", alpha=1.0), test)


@register("reg_lasso", "M17")
def q_reg_lasso(spark, sf):
    train, test = order_split(spark, sf)
    return _reg_out(mllib.lasso(train, ORD_X, "revenue", alpha=1.0), test)


@register("reg_kernel_ridge", "M18")
def q_reg_kernel_ridge(spark, sf):
    train, test = order_split(spark, sf)
    return _reg_out(mllib.kernel_ridge(train, ORD_X, "revenue", alpha=1.0), test)


@register("reg_tree", "M19")
def q_reg_tree(spark, sf):
    train, test = order_split(spark, sf)
    return _reg_out(mllib.decision_tree_regressor(train, ORD_X, "revenue", max_depth=10), test)


@register("reg_svr", "M20")
def q_reg_svr(spark, sf):
    train, test, scaler = order_split(spark, sf, scaled=True)
    return _unscaled(kernel_basis.svm_regressor(train, ORD_X, "revenue").transform(test), scaler)


@register("reg_knn", "M21", """
WITH pairs AS (SELECT q.p_partkey AS qid, t.p_partkey AS tid, t.p_retailprice AS y,
                      (q.p_size - t.p_size) * (q.p_size - t.p_size) AS dist
               FROM part q JOIN part t ON q.p_partkey <> t.p_partkey),
     top AS (SELECT qid, y FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM pairs)
             WHERE rn <= 5)
SELECT qid AS p_partkey, round(avg(y), 6) AS prediction FROM top GROUP BY qid""")
def q_reg_knn(spark, sf):
    part = Tables(spark, sf).part.select("p_partkey", "p_retailprice",
                                         F.array(F.col("p_size").cast("double")).alias("x"))
    r = neighbors.knn_regress(part, part, "x", "p_retailprice", k=5, train_id="p_partkey", query_id="p_partkey",
                              exclude_self=True)
    return r.select("p_partkey", F.round("prediction", 6).alias("prediction"))


@register("reg_forest", "M22")
def q_reg_forest(spark, sf):
    train, test = order_split(spark, sf)
    return _reg_out(mllib.random_forest_regressor(train, ORD_X, "revenue", n_trees=100, max_depth=12), test)


@register("reg_adaboost", "M23")
def q_reg_adaboost(spark, sf):
    train, test = order_split(spark, sf)
    fit = boosting.adaboost_regressor(train, ORD_X, "revenue", n_estimators=50)
    return fit.transform(test).select("o_orderkey", "revenue", F.round("prediction", 4).alias("prediction"))


@register("reg_gbt", "M24")
def q_reg_gbt(spark, sf):
    train, test = order_split(spark, sf)
    # Reference tuning (lr .05, depth 4, min split 3); 100 rounds here to bound the check's run time,
    # the operator default stays at 500.
    m = mllib.gbt_regressor(train, ORD_X, "revenue", n_estimators=100, learning_rate=0.05, max_depth=4,
                            min_split=3)
    return _reg_out(m, test)


@register("reg_mlp", "M25")
def q_reg_mlp(spark, sf):
    train, test, scaler = order_split(spark, sf, scaled=True)
    fit = gradient.mlp_regressor(train, ORD_X, "revenue", epochs=100, lr=0.01)
    return _unscaled(fit.transform(test.select("o_orderkey", "revenue", *ORD_X), ORD_X), scaler)


# ------------------------------------------------------------------ tuning, ranking, output

@register("cross_validate", "M26 O6")
def q_cross_validate(spark, sf):
    d = doc_table(spark, sf).filter(F.col("quality").isNotNull())
    folds = stratified_folds(d, "quality", "doc_id", k=10).cache()
    return tuning.cross_validate(folds, "fold", 10, lambda tr: mllib.logistic(tr, DOC_X, "quality"), "quality")


@register("grid_search", "M27")
def q_grid_search(spark, sf):
    from pyspark.ml.classification import RandomForestClassifier

    d = doc_table(spark, sf).filter(F.col("quality").isNotNull())
    folds = stratified_folds(d, "quality", "doc_id", k=3).cache()
    est = RandomForestClassifier(seed=1)
    _, table = tuning.grid_search(folds, DOC_X, "quality", est, {"numTrees": [20, 50], "maxDepth": [3, 6]},
                                  "fold", 3, parallelism=4)
    return table.orderBy(F.desc("score"), "params")


@register("model_leaderboard", "M28 S5 V1")
def q_model_leaderboard(spark, sf):
    train, test = doc_split(spark, sf, scaled=True)
    fits = {
        "logistic": lambda: mllib.logistic(train, DOC_X, "quality"),
        "forest": lambda: mllib.random_forest_classifier(train, DOC_X, "quality", n_trees=50),
        "tree": lambda: mllib.decision_tree_classifier(train, DOC_X, "quality"),
        "boosted_trees": lambda: mllib.gbt_classifier(train, DOC_X, "quality", n_estimators=30),
        "adaboost": lambda: boosting.adaboost_classifier(train, DOC_X, "quality", n_estimators=10),
    }
    results = [(name, tuning.score(make().transform(test), "quality", "accuracy")) for name, make in fits.items()]
    return tuning.leaderboard(spark, results, "accuracy")


@register("submission", "S3 M29")
def q_submission(spark, sf):
    # The fit reads its rows several times; the texts are read once.
    d = doc_table(spark, sf).cache()
    labelled = d.filter(F.col("quality").isNotNull())
    unlabelled = d.filter(F.col("quality").isNull())
    m = mllib.random_forest_classifier(labelled, DOC_X, "quality", n_trees=100, max_features=2)
    return submission(m.transform(unlabelled), "doc_id", "prediction", name="quality", cast="int")


@register("model_roundtrip", "S4")
def q_model_roundtrip(spark, sf):
    from kiln.operators.models.base import SparkModel

    train, test = doc_split(spark, sf, scaled=True)
    m = mllib.logistic(train, DOC_X, "quality")
    path = save_model(m.model, scratch_path(spark, "model"))
    again = SparkModel(load_model(path), tuple(DOC_X), "quality", binary=True)
    a = m.transform(test).select("doc_id", F.col("prediction").alias("before"))
    b = again.transform(test).select("doc_id", F.col("prediction").alias("after"))
    return a.join(b, "doc_id")
