"""Queries for metrics (V1-V6) and episode tables.

Scored tables come from the driver data: documents with their quality label and
a length rule as the prediction (length as the score), line items with a
quantity-proportional price estimate. Episodes are the event stream: one
episode per user, steps in time order, reward = event value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import episodes as G
from kiln.operators import metrics as V
from kiln.plans.catalog import register
from kiln.sources import Tables

_SCORED_DOCS = """(SELECT d.doc_id, d.n_chars, l.quality,
                          CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS pred
                   FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
_SCORED_LINES = "(SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500.0 AS p FROM lineitem)"


def _scored_docs(t):
    d = t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id")
    return d.withColumn("pred", F.when(F.col("n_chars") > 2000, 1).otherwise(0))


def _scored_lines(t):
    return t.lineitem.select("l_returnflag", F.col("l_extendedprice").alias("y"),
                             (F.col("l_quantity") * 1500.0).alias("p"))


@register("metric_accuracy", "V1", f"""
SELECT round(avg(CASE WHEN quality = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM {_SCORED_DOCS}""")
def q_metric_accuracy(spark, sf):
    return V.accuracy(_scored_docs(Tables(spark, sf)), "quality", "pred").select(F.round("accuracy", 6).alias("accuracy"))


@register("metric_r2", "V2", f"""
SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2 FROM {_SCORED_LINES}""")
def q_metric_r2(spark, sf):
    return V.r2(_scored_lines(Tables(spark, sf)), "y", "p").select(F.round("r2", 6).alias("r2"))


@register("metric_medae", "V3", f"SELECT round(median(abs(y - p)), 6) AS medae FROM {_SCORED_LINES}")
def q_metric_medae(spark, sf):
    return V.median_abs_error(_scored_lines(Tables(spark, sf)), "y", "p").select(F.round("medae", 6).alias("medae"))


@register("metric_mse", "V4", f"""
SELECT l_returnflag, round(avg((y - p) * (y - p)), 2) AS mse FROM {_SCORED_LINES} GROUP BY 1""")
def q_metric_mse(spark, sf):
    m = V.mse(_scored_lines(Tables(spark, sf)), "y", "p", by=["l_returnflag"])
    return m.select("l_returnflag", F.round("mse", 2).alias("mse"))


@register("metric_auc", "V5", f"""
WITH s AS (SELECT n_chars AS score, sum(quality) AS pos, sum(1 - quality) AS neg FROM {_SCORED_DOCS} GROUP BY 1),
     c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS neg_below FROM s)
SELECT round(sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""")
def q_metric_auc(spark, sf):
    return V.roc_auc(_scored_docs(Tables(spark, sf)), "quality", "n_chars").select(F.round("auc", 6).alias("auc"))


@register("confusion_matrix", "V6", f"""
SELECT quality AS actual, pred AS predicted, count(*) AS n FROM {_SCORED_DOCS} GROUP BY 1, 2""")
def q_confusion_matrix(spark, sf):
    return V.confusion_matrix(_scored_docs(Tables(spark, sf)), "quality", "pred")


# ------------------------------------------------------------------ episodes

_STEPS = """(SELECT event_id, user_id, event_type, value,
                    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step FROM events)"""
_RETURNS = f"""(SELECT *, sum(value * pow(0.99, step)) OVER (PARTITION BY user_id ORDER BY step
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) / pow(0.99, step) AS ret FROM {_STEPS})"""


def _transitions(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", "ts", "user_id", "event_type", "value")
    return G.steps(ev, "user_id", ["ts", "event_id"], name="step").drop("ts")


def _returns(spark, sf):
    return G.discounted_returns(_transitions(spark, sf), "user_id", "step", "value", gamma=0.99, out="ret")


@register("discounted_returns", "G1", f"""
SELECT event_id, user_id, step, round(ret, 6) AS ret FROM {_RETURNS}""")
def q_discounted_returns(spark, sf):
    return _returns(spark, sf).select("event_id", "user_id", "step", F.round("ret", 6).alias("ret"))


@register("normalized_returns", "G2", f"""
SELECT event_id, round((ret - avg(ret) OVER (PARTITION BY user_id)) /
                       (stddev_pop(ret) OVER (PARTITION BY user_id) + 1e-8), 6) AS ret_norm FROM {_RETURNS}""")
def q_normalized_returns(spark, sf):
    r = G.normalize_returns(_returns(spark, sf), "user_id", "ret")
    return r.select("event_id", F.round("ret_norm", 6).alias("ret_norm"))


@register("normalized_returns_null", "G2", f"""
SELECT event_id, round((ret - avg(ret) OVER (PARTITION BY u)) / (stddev_pop(ret) OVER (PARTITION BY u) + 1e-8), 6) AS ret_norm
FROM (SELECT *, CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id END AS u FROM {_RETURNS})""")
def q_normalized_returns_null(spark, sf):
    r = _returns(spark, sf).withColumn("u", F.when(F.col("user_id") % 5 != 0, F.col("user_id")))
    r = G.normalize_returns(r, "u", "ret")
    return r.select("event_id", F.round("ret_norm", 6).alias("ret_norm"))


@register("episode_scores", "G3", """
SELECT user_id, round(sum(value), 4) AS score, count(*) AS steps FROM events GROUP BY 1""")
def q_episode_scores(spark, sf):
    s = G.episode_scores(Tables(spark, sf).events, "user_id", "value")
    return s.select("user_id", F.round("score", 4).alias("score"), "steps")


@register("trailing_mean", "G4", """
SELECT user_id, round(avg(score) OVER (ORDER BY user_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 6)
       AS trailing_mean
FROM (SELECT user_id, sum(value) AS score FROM events GROUP BY 1)""")
def q_trailing_mean(spark, sf):
    s = G.episode_scores(Tables(spark, sf).events, "user_id", "value")
    t = G.trailing_mean(s, "user_id", "score", n=50)
    return t.select("user_id", F.round("trailing_mean", 6).alias("trailing_mean"))


@register("td_target", "G5", f"""
WITH n AS (SELECT s.*, x.value AS next_value, CASE WHEN x.value IS NULL THEN 1 ELSE 0 END AS done
           FROM {_STEPS} s LEFT JOIN {_STEPS} x ON s.user_id = x.user_id AND x.step = s.step + 1)
SELECT event_id,
       round(value + 0.99 * coalesce(next_value, 0.0) * (1 - done), 6) AS td_target,
       round(value + 0.99 * coalesce(greatest(next_value, sqrt(next_value)), 0.0) * (1 - done), 6) AS td_max,
       round(value + 0.99 * coalesce(least(next_value, next_value * 0.9 + 1.0), 0.0) * (1 - done), 6) AS td_min,
       round(value + 0.99 * coalesce(CASE WHEN event_type IN ('click', 'view') THEN next_value
                                          ELSE sqrt(next_value) END, 0.0) * (1 - done), 6) AS td_taken
FROM n""")
def q_td_target(spark, sf):
    tr = _transitions(spark, sf)
    tr = tr.withColumn("q", F.array(F.col("value"), F.sqrt("value")))          # action values
    tr = tr.withColumn("action", F.when(F.col("event_type").isin("click", "view"), 0).otherwise(1))
    j = G.with_next(tr, "user_id", "step", ["value", "q"])
    j = G.td_target(j, "value", F.col("next_value"), out="td_target")
    j = G.td_target(j, "value", F.array_max("next_q"), out="td_max")
    j = G.td_target(j, "value", F.least(F.col("next_value"), F.col("next_value") * 0.9 + 1.0), out="td_min")
    j = G.td_target(j, "value", F.element_at("next_q", F.col("action") + 1), out="td_taken")
    return j.select("event_id", *[F.round(c, 6).alias(c) for c in ("td_target", "td_max", "td_min", "td_taken")])


@register("advantage", "G6", f"""
SELECT event_id, round(ret - value, 6) + 0.0 AS advantage FROM {_RETURNS}""")
def q_advantage(spark, sf):
    a = G.advantage(_returns(spark, sf), "ret", "value")
    return a.select("event_id", F.round("advantage", 6).alias("advantage"))


@register("recent_sample", "G7", """
SELECT event_id, ts, user_id, value FROM (SELECT event_id, ts, user_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)
ORDER BY CAST('0x' || left(md5('7|' || event_id), 13) AS BIGINT), event_id LIMIT 32""")
def q_recent_sample(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", "ts", "user_id", "value")
    return G.recent_sample(ev, "ts", "event_id", last_n=1000, k=32, seed=7)


@register("rows_to_arrays", "G8", f"""
SELECT user_id, CAST(floor(step / 16) AS BIGINT) AS batch,
       array_to_string(list(step ORDER BY step), ',') AS steps,
       array_to_string(list(CAST(value AS DECIMAL(12, 2)) ORDER BY step), ',') AS rewards
FROM {_STEPS} GROUP BY 1, 2""")
def q_rows_to_arrays(spark, sf):
    a = G.rows_to_arrays(_transitions(spark, sf), "user_id", "step", ["value"], batch=16)
    return a.select("user_id", "batch",
                    F.array_join(F.transform("step", lambda s: s.cast("string")), ",").alias("steps"),
                    F.array_join(F.transform("value", lambda v: v.cast("decimal(12,2)").cast("string")), ",")
                    .alias("rewards"))
