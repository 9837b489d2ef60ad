"""Ordinary data that is not tidy: line breaks, NaN, null groups, string ids, long mappings."""

import pytest

from kiln.operators import ordering, recode, stats, transform
from kiln.operators.encode import fit_one_hot
from kiln.operators.episodes import normalize_returns
from kiln.operators.models import neighbors
from kiln.plans import models as plans
from kiln.sources.files import read_csv, scratch_path, write_csv


def test_csv_keeps_line_breaks_quotes_blanks_and_nulls(spark):
    rows = [(1, "a\nb\r\nc"), (2, ' "x", y '), (3, None), (4, ""), (5, "plain"), (6, "\n")]
    df = spark.createDataFrame(rows, "id long, text string")
    back = read_csv(spark, write_csv(df, scratch_path(spark, "csv-test")), schema=df.schema)
    rows[3] = (4, None)  # an empty field is missing
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_csv_reads_nan_as_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "id long, x double")
    back = read_csv(spark, write_csv(df, scratch_path(spark, "csv-nan")), schema=df.schema)
    assert sorted((r["id"], r["x"]) for r in back.collect()) == [(1, None), (2, 1.5), (3, None)]


def test_nan_counts_as_missing(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    clean = spark.createDataFrame([(v,) for v in values], "x double")
    dirty = clean.unionByName(spark.createDataFrame([(float("nan"),), (None,)], "x double"))
    assert transform.zscore_filter(dirty, ["x"], 3.0).count() == 9
    assert stats.skew_values(dirty, ["x"]) == stats.skew_values(clean, ["x"])
    hist = lambda df: [tuple(r) for r in stats.histogram(df, "x", 4).orderBy("bin").collect()]
    assert hist(dirty) == hist(clean)
    one = lambda df: stats.basic_stats(df, ["x"]).first()
    assert one(dirty) == one(clean)
    kde = lambda df: [r["density"] for r in stats.kde_curve(df, "x", 20).orderBy("i").collect()]
    assert kde(dirty) == pytest.approx(kde(clean))


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(i, ["a", None, "b"][i % 3], float(i)) for i in range(12)], "id long, g string, x double")
    folds = ordering.stratified_folds(df, "g", "id", 2).collect()
    assert len(folds) == 12 and {r["fold"] for r in folds if r["g"] is None} == {0, 1}
    train, test = ordering.stratified_split(df, "g", "id", 0.5)
    assert train.count() == 6 and test.count() == 6
    hist = stats.histogram(df, "x", 2, by="g").collect()
    assert sum(r["count"] for r in hist if r["g"] is None) == 4
    assert {r["g"]: r["n"] for r in stats.boxplot_stats(df, "x", by="g").collect()} == {"a": 4, "b": 4, None: 4}
    assert normalize_returns(df, "g", "x").count() == 12


def test_knn_takes_string_ids_and_labels(spark):
    rows = [(f"r{i}", "lo" if i < 5 else "hi", [float(i)]) for i in range(10)] + [(None, "hi", [0.0]), ("rx", "hi", None)]
    df = spark.createDataFrame(rows, "id string, label string, v array<double>")
    nn = neighbors.neighbours(df, df.where("id IS NOT NULL AND v IS NOT NULL"), "v", "label", 3, "id", "id", exclude_self=True)
    assert nn.schema["nn"].dataType.elementType["tid"].dataType.typeName() == "string"
    got = {r["id"]: [(x["tid"], x["dist"]) for x in r["nn"]] for r in nn.collect()}
    assert len(got) == 10 and got["r0"] == [("r1", 1.0), ("r2", 4.0), ("r3", 9.0)]


def test_recodes_have_one_type_at_every_size(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "i int, s string")
    for n in (2, recode.CASE_LIMIT + 5):
        out = recode.replace_values(df, "i", {k: k + 10 for k in range(1, n + 1)})
        assert out.schema["i"].dataType.typeName() == "integer"
        assert sorted((r["i"] or 0) for r in out.collect()) == [0, 11, 12]
        out = recode.recode_groups(df, "i", {7: list(range(2, n + 2))})
        assert out.schema["i"].dataType.typeName() == "integer" and sorted((r["i"] or 0) for r in out.collect()) == [0, 1, 7]


def test_one_hot_form_is_asked_for_not_chosen(spark):
    df = spark.createDataFrame([(f"v{i}",) for i in range(1200)], "c string")
    fitted = fit_one_hot(df, ["c"])
    assert len(fitted.column_names()) == 1200
    vector = fitted.apply(df, as_vector=True)
    assert vector.columns == ["one_hot"] and vector.first()["one_hot"].size == 1200
    with pytest.raises(ValueError):
        fit_one_hot(df, ["c"], limit=1000)


@pytest.mark.parametrize("name", ["reg_linear", "reg_ridge", "reg_svr", "reg_mlp", "reg_tree"])
def test_regressors_beat_the_mean(spark, name):
    rows = getattr(plans, f"q_{name}")(spark, "/root/testdata/sf0.01").collect()
    y = [r["revenue"] for r in rows]
    mean = sum(y) / len(y)
    score = 1 - sum((r["revenue"] - r["prediction"]) ** 2 for r in rows) / sum((v - mean) ** 2 for v in y)
    assert score > 0.6, score


def test_hash_numbers_are_the_leading_md5_digits(spark):
    import hashlib

    df = spark.createDataFrame([(1,), (None,)], "k long").select("k", ordering.hash_number("k", 7).alias("h"))
    want = {k: int(hashlib.md5(f"7|{'NULL' if k is None else k}".encode()).hexdigest()[:13], 16) for k in (1, None)}
    assert {r["k"]: r["h"] for r in df.collect()} == want
