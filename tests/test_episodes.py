import numpy as np
import pandas as pd
import pytest

from kiln.operators import episodes as G


def _episodes(spark):
    rng = np.random.default_rng(3)
    rows = []
    for ep, n in ((1, 1), (2, 5), (3, 300)):
        for s in range(n):
            rows.append((ep, s, float(rng.normal())))
    return spark.createDataFrame(pd.DataFrame(rows, columns=["episode", "step", "reward"]))


def _recurrence(rewards, gamma):
    out, g = [], 0.0
    for r in reversed(rewards):
        g = r + gamma * g
        out.append(g)
    return out[::-1]


@pytest.mark.parametrize("gamma,block", [(0.99, None), (0.99, 7), (0.5, 3), (1.0, 16), (0.9, 1)])
def test_discounted_returns_match_recurrence(spark, gamma, block):
    df = _episodes(spark)
    got = G.discounted_returns(df, "episode", "step", "reward", gamma=gamma, block=block).toPandas()
    for ep, part in got.groupby("episode"):
        part = part.sort_values("step")
        want = _recurrence(part.reward.tolist(), gamma)
        assert np.allclose(part.ret.values, want, rtol=1e-9, atol=1e-9)


def test_trailing_mean_halo_buckets(spark):
    pdf = pd.DataFrame({"ep": np.arange(230), "score": np.arange(230, dtype=float) ** 0.5})
    df = spark.createDataFrame(pdf)
    got = G.trailing_mean(df, "ep", "score", n=50, bucket_rows=60).toPandas().sort_values("ep")
    want = pdf.score.rolling(50, min_periods=1).mean().values
    assert np.allclose(got.trailing_mean.values, want)


def test_with_next_and_td_target(spark):
    df = _episodes(spark)
    j = G.with_next(df, "episode", "step", ["reward"])
    t = G.td_target(j, "reward", j["next_reward"], gamma=0.9).toPandas()
    last = t[t.done == 1]
    assert sorted(last.episode.tolist()) == [1, 2, 3]
    assert np.allclose(last.td_target, last.reward)


def test_rows_to_arrays_bounded_batches(spark):
    df = _episodes(spark)
    arr = G.rows_to_arrays(df, "episode", "step", ["reward"], batch=32).toPandas()
    assert arr.step.map(len).max() <= 32
    ep3 = arr[arr.episode == 3].sort_values("batch")
    assert [s for chunk in ep3.step for s in chunk] == list(range(300))
