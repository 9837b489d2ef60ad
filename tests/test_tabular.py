import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kiln.operators import columns as P
from kiln.operators import encode as E
from kiln.operators import missing as N
from kiln.operators import recode as RC
from kiln.operators import stats as A
from kiln.operators import transform as T
from kiln.operators.ordering import stratified_folds, stratified_split, train_test_split
from kiln.operators.sets import dedup


def test_cut_is_right_closed_and_nulls_outside(spark):
    df = spark.createDataFrame([(0.0,), (12.0,), (12.5,), (120.0,), (121.0,), (None,)], "age double")
    got = [r[0] for r in RC.cut(df, "age", [0, 12, 20, 40, 120], ["C", "T", "A", "E"], out="b").select("b").collect()]
    assert got == [None, "C", "T", "E", None, None]


def test_mode_ties_take_smallest_and_fill(spark):
    df = spark.createDataFrame([("S",), ("C",), ("C",), ("S",), (None,), ("Q",)], "e string")
    fit = N.fit_mode(df, ["e"])
    assert fit.values["e"] == "C"
    assert [r[0] for r in fit.apply(df).collect()].count("C") == 3


def test_median_even_count_averages_middle(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,), (None,)], "x double")
    assert N.fit_median(df, ["x"]).values["x"] == pytest.approx(6.0)


def test_drop_value_keeps_nulls(spark):
    df = spark.createDataFrame([("TenC",), (None,), ("Shed",)], "m string")
    got = [r[0] for r in P.where_not_equal(df, "m", "TenC").collect()]
    assert len(got) == 2 and set(got) == {None, "Shed"}


def test_prefix_recode_keeps_null_and_unmatched(spark):
    df = spark.createDataFrame([("RL",), ("FV",), ("C (all)",), ("X",), (None,)], "z string")
    got = [r[0] for r in RC.recode_prefix(df, "z", [("R", "Res"), ("F", "Fl"), ("C", "Comm")]).collect()]
    assert got == ["Res", "Fl", "Comm", "X", None]


def test_one_hot_declared_unseen_and_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, c string")
    out = E.one_hot(df, ["c"], declared={"c": ["z"]})
    assert out.columns == ["id", "c_a", "c_b", "c_z"]
    rows = {r["id"]: (r["c_a"], r["c_b"], r["c_z"]) for r in out.collect()}
    assert rows == {1: (1, 0, 0), 2: (0, 0, 0), 3: (0, 1, 0)}


def test_one_hot_aligned_same_columns(spark):
    tr = spark.createDataFrame([(1, "a")], "id int, c string")
    te = spark.createDataFrame([(2, "b")], "id int, c string")
    a, b = E.one_hot_aligned(tr, te, ["c"])
    assert a.columns == b.columns == ["id", "c_a", "c_b"]


def test_population_std_zscore_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, k double")
    fz = T.fit_zscore(df, ["x", "k"])
    assert fz.stds["x"] == pytest.approx(np.std([1, 2, 3]))
    z = fz.apply(df).collect()
    assert [r["k"] for r in z if r["x"] is not None] == [0.0, 0.0, 0.0]
    kept = T.zscore_filter(df, ["x", "k"], threshold=1.0)
    assert kept.count() == 1  # only the mean row; the NULL row is dropped


def test_skewness_is_bias_corrected_g1(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, 11.0, 40.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = A.skewness(df, ["x"]).first()["skew"]
    assert got == pytest.approx(pd.Series(vals).skew())


def test_standard_scaler_zero_variance_unscaled(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    sc = T.fit_standard_scaler(df, ["x"])
    assert [r[0] for r in sc.apply(df).collect()] == [0.0, 0.0]


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "x double")
    assert N.fit_mean(empty, ["x"]).values["x"] is None
    assert N.fit_median(empty, ["x"]).values["x"] is None
    one = spark.createDataFrame([(7.0,)], "x double")
    assert N.fit_median(one, ["x"]).values["x"] == 7.0
    assert A.skewness(one, ["x"]).first()["skew"] is None


def test_null_counts_and_summary(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (None, "a", 1.0)], "a int, b string, c double")
    got = {r["column"]: r["nulls"] for r in N.null_counts(df).collect()}
    assert got == {"a": 1, "b": 1, "c": 1}
    s = N.frame_summary(df).first()
    assert (s.n_categorical, s.n_numerical, s.total_cells, s.total_nulls, s.null_columns) == (1, 2, 6, 3, 3)


def test_dedup_first_by_order(spark):
    df = spark.createDataFrame([(3, "t"), (1, "t"), (2, "u")], "id int, text string")
    got = sorted((r["id"], r["text"]) for r in dedup(df, "text", ["id"]).collect())
    assert got == [(1, "t"), (2, "u")]


def test_splits_are_disjoint_stable_and_stratified(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y")).repartition(7)
    tr, te = train_test_split(df, "id", 0.7, seed=42)
    a = {r[0] for r in tr.select("id").collect()}
    b = {r[0] for r in te.select("id").collect()}
    assert not a & b and len(a | b) == 1000 and 600 < len(a) < 800
    tr2, _ = train_test_split(df.repartition(3), "id", 0.7, seed=42)
    assert {r[0] for r in tr2.select("id").collect()} == a
    s_tr, s_te = stratified_split(df, "y", "id", 0.75, seed=1)
    by = s_tr.groupBy("y").count().toPandas().set_index("y")["count"].to_dict()
    assert by == {0: 500, 1: 251}  # 666 and 334 rows, 75 % rounded half up
    folds = stratified_folds(df, "y", "id", k=10).groupBy("y", "fold").count().toPandas()
    for _, g in folds.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1 and len(g) == 10


def test_histogram_last_bin_closed_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    h = A.histogram(df, "x", bins=5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 0, 0, 0, 1]


def test_correlation_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, None], "b": [2.0, 4.0, 7.0, 8.0, 1.0]})
    df = spark.createDataFrame(pdf)
    r = {(x["a"], x["b"]): x["r"] for x in A.correlation_matrix(df, ["a", "b"]).collect()}
    assert r[("a", "b")] == pytest.approx(pdf.corr().loc["a", "b"])
    assert r[("b", "a")] == r[("a", "b")]
    assert math.isclose(r[("a", "a")], 1.0)


def test_boxplot_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    b = A.boxplot_stats(df, "x").first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (b.q1, b.q3) == (pytest.approx(q1), pytest.approx(q3))
    assert b.whisker_hi == 5.0 and b.n_outliers == 1


def test_one_hot_vector_form_matches_columns(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "b", "x")], "id int, c string, d string")
    fit = E.fit_one_hot(df, ["c", "d"])
    cols = fit.apply(df, as_vector=False).orderBy("id").collect()
    vec = fit.apply(df, as_vector=True).orderBy("id").collect()
    names = fit.column_names()
    for rc, rv in zip(cols, vec):
        assert [float(rc[n]) for n in names] == rv["one_hot"].toArray().tolist()
