"""Results must not depend on how the input is partitioned."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kiln.operators import episodes as G
from kiln.operators.ordering import stratified_folds, train_test_split
from kiln.operators.positions import positions
from kiln.operators.quantiles import quantiles
from kiln.operators.sets import dedup


@pytest.fixture(scope="module")
def base(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": np.arange(800), "g": rng.integers(0, 3, 800), "v": rng.normal(size=800).round(3),
                        "t": rng.integers(0, 50, 800).astype(str)})
    return spark.createDataFrame(pdf)


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.mark.parametrize("parts", [1, 7])
def test_same_results_for_any_partitioning(spark, base, parts):
    df = base.repartition(parts)
    ref = base.coalesce(1)
    assert _rows(positions(df, ["v", "id"], ["g"]), ["id"]) == _rows(positions(ref, ["v", "id"], ["g"]), ["id"])
    assert _rows(quantiles(df, "v", [0.1, 0.5], ["g"]), ["g", "p"]) == _rows(quantiles(ref, "v", [0.1, 0.5], ["g"]),
                                                                              ["g", "p"])
    assert _rows(dedup(df, "t", ["id"]), ["t"]) == _rows(dedup(ref, "t", ["id"]), ["t"])
    assert _rows(stratified_folds(df, "g", "id", 5), ["id"]) == _rows(stratified_folds(ref, "g", "id", 5), ["id"])
    tr, _ = train_test_split(df, "id", 0.6, seed=3)
    tr_ref, _ = train_test_split(ref, "id", 0.6, seed=3)
    assert _rows(tr, ["id"]) == _rows(tr_ref, ["id"])
    ep = positions(df, ["id"], ["g"], name="step")
    ep_ref = positions(ref, ["id"], ["g"], name="step")
    a = G.discounted_returns(ep, "g", "step", "v", 0.9, block=16).select("id", F.round("ret", 9))
    b = G.discounted_returns(ep_ref, "g", "step", "v", 0.9, block=16).select("id", F.round("ret", 9))
    assert _rows(a, ["id"]) == _rows(b, ["id"])
