import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kiln.operators.positions import positions, running_sum
from kiln.operators.quantiles import column_quantiles, quantiles


def _frame(spark, values, groups=None):
    pdf = pd.DataFrame({"x": values})
    if groups is not None:
        pdf["g"] = groups
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("n", [1, 2, 5, 100, 1001])
def test_global_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.integers(0, 50, n).astype(float)
    got = {r["p"]: r["value"] for r in quantiles(_frame(spark, vals), "x", [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    for p in [0.0, 0.25, 0.5, 0.75, 1.0]:
        assert got[p] == pytest.approx(np.quantile(vals, p))


def test_grouped_quantiles_and_nulls(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=600)
    groups = np.where(np.arange(600) < 400, "hot", np.where(np.arange(600) % 2 == 0, "a", "b"))
    vals[::50] = np.nan
    df = _frame(spark, vals, groups)
    got = {(r["g"], r["p"]): r["value"] for r in quantiles(df, "x", [0.5, 0.9], ["g"]).collect()}
    pdf = pd.DataFrame({"x": vals, "g": groups})
    for (g, p), v in got.items():
        assert v == pytest.approx(pdf[pdf.g == g].x.dropna().quantile(p))
    assert len(got) == 6


def test_band_refinement_small_limit(spark):
    vals = np.arange(5000, dtype=float)[::-1]
    got = quantiles(_frame(spark, vals), "x", [0.5, 0.1], accuracy=20, band_distinct=10).collect()
    got = {r["p"]: r["value"] for r in got}
    assert got[0.5] == pytest.approx(np.quantile(vals, 0.5))
    assert got[0.1] == pytest.approx(np.quantile(vals, 0.1))


def test_positions_global_and_grouped(spark):
    df = spark.range(0, 997).selectExpr("id", "id % 3 AS g", "cast(997 - id AS double) AS v").repartition(7)
    got = positions(df, ["v"], name="pos").toPandas().sort_values("v")
    assert got.pos.tolist() == list(range(997))
    gp = positions(df, ["id"], ["g"], name="pos").toPandas()
    for g, part in gp.groupby("g"):
        assert part.sort_values("id").pos.tolist() == list(range(len(part)))


def test_running_sum(spark):
    df = spark.range(0, 300).selectExpr("id", "id % 2 AS g", "cast(id AS double) AS v").repartition(5)
    got = running_sum(df, ["id"], "v", ["g"], name="cum").toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("id")
        assert np.allclose(part.cum.values, np.cumsum(part.v.values))


def test_many_columns_and_groups_in_the_same_passes(spark):
    r = np.random.default_rng(11)
    n = 4000
    pdf = pd.DataFrame({"a": r.normal(size=n), "b": r.integers(0, 4, n).astype(float), "c": np.full(n, np.nan),
                        "d": np.where(r.random(n) < 0.5, 7.0, r.normal(0, 1e9, n)),
                        "g": r.choice(["hot"] * 8 + ["x", "y", None], n)})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf)
    for accuracy, band in ((10_000, 100_000), (50, 20)):
        got = {(x["column"], x["p"]): x["value"] for x in
               column_quantiles(df, ["a", "b", "c", "d"], [0.0, 0.3, 0.5, 1.0], accuracy=accuracy, band_distinct=band).collect()}
        assert {c for c, _ in got} == {"a", "b", "d"} and len(got) == 12
        for (c, p), v in got.items():
            assert v == pytest.approx(pdf[c].quantile(p))
        got = {(x["g"], x["column"], x["p"]): x["value"] for x in
               column_quantiles(df, ["a", "d"], [0.25, 0.5], ["g"], accuracy=accuracy, band_distinct=band).collect()}
        groups = {**dict(list(pdf.groupby("g"))), None: pdf[pdf["g"].isna()]}
        assert len(got) == 4 * len(groups)
        for (g, c, p), v in got.items():
            part = groups[g]
            assert v == pytest.approx(part[c].quantile(p))
    assert column_quantiles(df.where("false"), ["a", "b"], [0.5]).count() == 0
    assert column_quantiles(df.where("false"), ["a"], [0.5], ["g"]).count() == 0
