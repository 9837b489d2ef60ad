import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kiln.operators.models import bayes, boosting, discriminant, gradient, mllib, neighbors, tuning


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    rows = []
    for c, centre in enumerate([(0, 0, 0), (3, 3, 0), (0, 3, 3)]):
        for i in range(60):
            rows.append((c * 1000 + i, c, [float(v) for v in rng.normal(centre, 1.0)]))
    pdf = pd.DataFrame(rows, columns=["id", "label", "vec"])
    return spark.createDataFrame(pdf), pdf


def _brute_knn(pdf, k):
    x = np.stack(pdf.vec.to_numpy())
    out = {}
    for i, qid in enumerate(pdf.id):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        order = np.lexsort((pdf.id.to_numpy(), d))[:k]
        labels = pdf.label.to_numpy()[order]
        vals, counts = np.unique(labels, return_counts=True)
        out[qid] = vals[counts == counts.max()].min()
    return out


def test_knn_agrees_with_brute_force(spark, blobs):
    df, pdf = blobs
    got = {r["id"]: r["prediction"] for r in
           neighbors.knn_classify(df, df, "vec", "label", 4, "id", "id", exclude_self=True).collect()}
    assert got == _brute_knn(pdf, 4)


def test_gaussian_nb_matches_numpy(spark, blobs):
    df, pdf = blobs
    fit = bayes.gaussian_nb(df, "vec", "label")
    x = np.stack(pdf.vec.to_numpy())
    y = pdf.label.to_numpy()
    eps = 1e-9 * x.var(0).max()
    scores = []
    for c in range(3):
        xc = x[y == c]
        m, v = xc.mean(0), xc.var(0) + eps
        scores.append(np.log(len(xc) / len(x)) - 0.5 * np.log(2 * np.pi * v).sum() - 0.5 * ((x - m) ** 2 / v).sum(1))
    want = np.argmax(np.stack(scores, 1), 1)
    got = fit.transform(df, "vec").toPandas().sort_values("id")
    assert (got.prediction.to_numpy() == want[np.argsort(pdf.id.to_numpy())]).all()


def test_lda_matches_numpy(spark, blobs):
    df, pdf = blobs
    fit = discriminant.lda(df, "vec", "label")
    x, y = np.stack(pdf.vec.to_numpy()), pdf.label.to_numpy()
    means = np.stack([x[y == c].mean(0) for c in range(3)])
    within = sum(((x[y == c] - means[c]).T @ (x[y == c] - means[c])) for c in range(3)) / (len(x) - 3)
    prec = np.linalg.inv(within)
    assert np.allclose(fit.coef, means @ prec, rtol=1e-6, atol=1e-8)
    pred = fit.transform(df, "vec").select("label", "prediction").toPandas()
    assert (pred.label == pred.prediction).mean() > 0.85


def test_adaboost_beats_majority(spark, blobs):
    df, pdf = blobs
    d = df.select("id", (F.col("label") == 1).cast("int").alias("y"),
                  *[F.col("vec")[i].alias(f"x{i}") for i in range(3)])
    fit = boosting.adaboost_classifier(d, ["x0", "x1", "x2"], "y", n_estimators=10)
    acc = tuning.score(fit.transform(d), "y", "accuracy")
    assert acc > 2 / 3 + 0.1
    assert len(fit.stumps) >= 2


def test_ridge_and_lasso_match_closed_forms(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(scale=0.1, size=200)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y)
    df = spark.createDataFrame(pdf)
    m = mllib.ridge(df, ["a", "b", "c"], "y", alpha=5.0).model.stages[-1]
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), want, rtol=1e-4)


def test_model_save_load_roundtrip(spark, tmp_path):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(80, 2)), columns=["a", "b"])
    pdf["y"] = (pdf.a + pdf.b > 0).astype(int)
    df = spark.createDataFrame(pdf)
    m = mllib.logistic(df, ["a", "b"], "y")
    from kiln.operators.models.base import load_spark_model

    again = load_spark_model(m.save(str(tmp_path / "m")), ["a", "b"], "y", binary=True)
    a = m.transform(df).select("prediction").collect()
    b = again.transform(df).select("prediction").collect()
    assert a == b


def test_soft_vote_weights(spark):
    df = spark.createDataFrame([(0.2, 1.0)], "p_a double, p_b double")
    got = tuning.soft_vote(df, ["p_a", "p_b"], [0.7, 0.3]).first()["generated"]
    assert got == pytest.approx(0.7 * 0.2 + 0.3 * 1.0)


def test_network_rows_are_written_once_as_blocks_and_steps_equal_plain_descent(spark, monkeypatch):
    from kiln.operators.models import gradient as G

    r = np.random.default_rng(3)
    data = [(float(a), float(b), float(a - 2 * b)) for a, b in r.normal(size=(700, 2))]
    df = spark.createDataFrame(data, "a double, b double, y double").repartition(3)
    monkeypatch.setattr(G, "BLOCK_ROWS", 100)
    written, kept = [], G.staged
    monkeypatch.setattr(G, "staged", lambda d, name: written.append(kept(d, name)) or written[-1])
    fit = G.mlp_regressor(df, ["a", "b"], "y", hidden=(4,), epochs=5, lr=0.1)
    assert len(written) == 1
    assert sum(b["rows"] for b in written[0].collect()) == len(data)
    p = G.mlp_regressor(df, ["a", "b"], "y", hidden=(4,), epochs=0).params.copy()
    v = np.array(data)
    mom, vel = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, 6):
        g = G._grad(p, (2, 4, 1), v[:, :2], v[:, 2]) / len(v)
        mom, vel = 0.9 * mom + 0.1 * g, 0.999 * vel + 0.001 * g ** 2
        p = p - 0.1 * (mom / (1 - 0.9 ** t)) / (np.sqrt(vel / (1 - 0.999 ** t)) + 1e-8)
    assert np.allclose(fit.params, p, rtol=0, atol=1e-9)
    assert max(len(block) for b in G._blocks(iter(df.toArrow().to_batches())) for block in b["numbers"].to_pylist()) <= 100 * 3 * 8


def test_kernel_columns_equal_the_formula():
    from kiln.operators.models import kernel_basis as K

    a, b = np.random.default_rng(1).normal(size=(50, 3)), np.random.default_rng(2).normal(size=(7, 3))
    want = np.exp(-0.3 * ((a[:, None, :] - b[None, :, :]) ** 2).sum(2))
    assert np.allclose(K.rbf(a, b, 0.3), want, atol=1e-12)


def test_tree_fits_get_rows_spread_over_the_cores(spark, monkeypatch):
    cores, seen = spark.sparkContext.defaultParallelism, []
    monkeypatch.setattr(mllib, "fit_pipeline", lambda df, *a, **k: seen.append(df.rdd.glom().map(len).collect()))
    one = spark.range(0, 20000, 1, 1).selectExpr("cast(id as double) x", "id % 2 y")
    mllib.random_forest_classifier(one, ["x"], "y", n_trees=100)
    mllib.random_forest_regressor(spark.range(0, 20000, 1, 64).selectExpr("id x", "id y"), ["x"], "y", n_trees=100)
    mllib.gbt_regressor(one, ["x"], "y", n_estimators=100)
    for parts in seen:
        assert len(parts) == cores and sum(parts) == 20000 and max(parts) < 2 * 20000 / cores
    seen.clear()
    mllib.gbt_classifier(one.limit(100), ["x"], "y", n_estimators=100)  # few rows stay where they are
    assert len(seen[0]) == 1


def test_boosted_regressor_reads_errors_and_weights_in_two_passes_a_round(spark, monkeypatch):
    df = spark.range(0, 300, 1, 2).selectExpr("cast(id % 17 as double) x", "cast(id * id % 101 as double) y")
    calls, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *e: calls.append(1) or agg(self, *e))
    fit = boosting.adaboost_regressor(df, ["x"], "y", n_estimators=3)
    assert len(fit.stumps) == 3 and len(calls) <= 6
    assert fit.transform(df).where("prediction is null").count() == 0


def test_submission_reads_the_texts_once(spark, tmp_path):
    from kiln.plans import models

    docs = spark.range(40).selectExpr("id doc_id", "repeat('Some Words 12. ', cast(id % 7 as int)) text")
    docs.selectExpr("*", "length(text) n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(20).selectExpr("id doc_id", "cast(id % 2 as int) quality").write.parquet(str(tmp_path / "labels.parquet"))
    done = models.q_submission(spark, str(tmp_path))
    assert done.count() == 20
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan


def test_forest_in_parts_adds_up_the_votes_of_all_trees(spark, monkeypatch):
    from pyspark.ml import PipelineModel
    from kiln.operators.models import mllib
    r = np.random.default_rng(9)
    x = r.normal(0, 1, (400, 2))
    data = [(i, float(a), float(b), int(a + 0.3 * b + r.normal(0, 0.2) > 0)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(data, "id long, a double, b double, y int").cache()
    whole = mllib.random_forest_classifier(df, ["a", "b"], "y", n_trees=10)
    monkeypatch.setattr(mllib, "FOREST_VISITS", 1700)
    parts = mllib.random_forest_classifier(df, ["a", "b"], "y", n_trees=10)
    assert parts.trees == [4, 4, 2] and [len(PipelineModel.load(p).stages[-1].trees) for p in parts.paths] == parts.trees
    got = {q["id"]: (q["prediction"], q["p1"]) for q in parts.transform(df).collect()}
    votes = np.zeros((400, 2))
    for p in parts.paths:
        for q in PipelineModel.load(p).transform(df).select("id", "rawPrediction").collect():
            votes[q["id"]] += q["rawPrediction"].toArray()
    assert np.allclose(votes.sum(1), 10)
    assert all(got[i] == (float(v.argmax()), pytest.approx(v[1] / 10)) for i, v in enumerate(votes))
    assert parts.transform(df).columns == whole.transform(df).columns
    rows = mllib.feature_importance(parts, spark).collect()
    assert rows[0]["feature"] == "a" and sum(q["importance"] for q in rows) == pytest.approx(1)
    assert mllib.feature_importance(whole, spark).first()["feature"] == "a"
    df.unpersist()
