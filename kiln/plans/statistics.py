"""Queries for descriptive statistics and numeric transforms."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from kiln.operators import stats as A
from kiln.operators import transform as T
from kiln.operators.missing import mode_of
from kiln.plans.catalog import register
from kiln.sources import Tables

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _r(c, d=6):
    return F.round(c, d)


@register("basic_stats", "A2", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS count, round(sum({c}), 2) AS sum, round(avg({c}), 6) AS mean, "
    f"min({c}) AS min, max({c}) AS max FROM lineitem" for c in ["l_quantity", "l_extendedprice"]))
def q_basic_stats(spark, sf):
    s = A.basic_stats(Tables(spark, sf).lineitem, ["l_quantity", "l_extendedprice"])
    return s.select("column", "count", _r("sum", 2).alias("sum"), _r("mean").alias("mean"), "min", "max")


@register("median_mode", "A3 N3", " UNION ALL ".join(
    f"SELECT '{c}' AS column, median({c}) AS median, "
    f"(SELECT CAST({c} AS DOUBLE) FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode "
    f"FROM lineitem" for c in ["l_quantity", "l_linenumber"]))
def q_median_mode(spark, sf):
    li = Tables(spark, sf).lineitem
    cols = ["l_quantity", "l_linenumber"]
    med = A.medians(li, cols)
    modes = spark.createDataFrame([(c, float(mode_of(li, c))) for c in cols], "column string, mode double")
    return med.join(modes, "column")


@register("skewness", "A4", " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(skewness({c}), 6) AS skew FROM lineitem" for c in LI_NUM))
def q_skewness(spark, sf):
    return A.skewness(Tables(spark, sf).lineitem, LI_NUM).withColumn("skew", _r("skew"))


def _corr_sql(pairs):
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
                              for a, b in pairs)


@register("correlation_matrix", "A5", _corr_sql([(a, b) for a in LI_NUM for b in LI_NUM]))
def q_correlation_matrix(spark, sf):
    m = A.correlation_matrix(Tables(spark, sf).lineitem, LI_NUM)
    return m.select("a", "b", _r("r").alias("r"))


@register("correlation_lower", "A6", _corr_sql([(b, a) for a, b in combinations(LI_NUM, 2)]))
def q_correlation_lower(spark, sf):
    m = A.correlation_lower(Tables(spark, sf).lineitem, LI_NUM)
    return m.select("a", "b", _r("r").alias("r"))


@register("top_correlated", "A7 O2", """
SELECT "column", round(r, 6) AS r FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, corr({c}, l_extendedprice) AS r FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber"]) + ') ORDER BY abs(r) DESC, "column" LIMIT 2')
def q_top_correlated(spark, sf):
    li = Tables(spark, sf).lineitem
    t = A.top_correlated(li, "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "l_linenumber",
                                                 "l_extendedprice"], k=2)
    return t.select("column", _r("r").alias("r"))


@register("category_values", "A8", """
SELECT DISTINCT 'o_orderstatus' AS column, o_orderstatus AS value FROM orders
UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders""")
def q_category_values(spark, sf):
    return A.category_values(Tables(spark, sf).orders, ["o_orderstatus", "o_orderpriority"])


@register("distinct_count", "A9", "SELECT count(DISTINCT l_partkey) AS n_distinct FROM lineitem")
def q_distinct_count(spark, sf):
    return A.distinct_count(Tables(spark, sf).lineitem, "l_partkey")


# Events with a NULL kind (marked '~' inside the SQL) and every 17th value NaN, which counts as missing.
_ODD = """(SELECT event_id, user_id, coalesce(nullif(event_type, 'click'), '~') AS kind,
            CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value FROM events)"""


def _odd_events(spark, sf):
    return Tables(spark, sf).events.select(
        "event_id", "user_id", F.expr("nullif(event_type, 'click')").alias("kind"),
        F.when(F.col("event_id") % 17 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))


def _unmarked(sql: str) -> str:
    return f"SELECT nullif(kind, '~') AS kind, * EXCLUDE (kind) FROM ({sql})"


def _hist_sql(where: str, by: str | None, bins: int = 30, source: str = "events") -> str:
    g = f"{by}, " if by else ""
    join = f"USING ({by})" if by else "ON true"
    return f"""
WITH d AS (SELECT {g}value FROM {source} {where}),
     r AS (SELECT {g}min(value) AS lo, max(value) AS hi FROM d {'GROUP BY ' + by if by else ''}),
     c AS (SELECT {g}CAST(CASE WHEN (r.hi - r.lo) > 0
                  THEN least(floor((d.value - r.lo) / ((r.hi - r.lo) / {bins})), {bins - 1}) ELSE 0 END AS INTEGER) AS bin,
                  count(*) AS n
           FROM d JOIN r {join} GROUP BY ALL),
     g AS (SELECT {g}lo, hi, CAST(range AS INTEGER) AS bin FROM r, range({bins}))
SELECT {'g.' + g if by else ''}g.bin, round(lo + g.bin * ((hi - lo) / {bins}), 6) AS lo,
       round(lo + (g.bin + 1) * ((hi - lo) / {bins}), 6) AS hi, coalesce(c.n, 0) AS count
FROM g LEFT JOIN c ON {'g.' + by + ' = c.' + by + ' AND ' if by else ''}g.bin = c.bin"""


@register("histogram", "A10", _hist_sql("", None))
def q_histogram(spark, sf):
    h = A.histogram(Tables(spark, sf).events, "value", bins=30)
    return h.select("bin", _r("lo").alias("lo"), _r("hi").alias("hi"), "count")


@register("histogram_compare", "A10", _hist_sql("WHERE event_type IN ('click', 'view')", "event_type"))
def q_histogram_compare(spark, sf):
    ev = Tables(spark, sf).events.filter(F.col("event_type").isin("click", "view"))
    h = A.histogram(ev, "value", bins=30, by="event_type")
    return h.select("event_type", "bin", _r("lo").alias("lo"), _r("hi").alias("hi"), "count")


@register("histogram_odd", "A10", _unmarked(_hist_sql("WHERE value IS NOT NULL", "kind", source=_ODD)))
def q_histogram_odd(spark, sf):
    h = A.histogram(_odd_events(spark, sf), "value", bins=30, by="kind")
    return h.select("kind", "bin", _r("lo").alias("lo"), _r("hi").alias("hi"), "count")


def _box_sql(by: str | None, source: str = "events") -> str:
    g = f"{by}, " if by else ""
    gb = f"GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON true"
    return f"""
WITH q AS (SELECT {g}quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM {source} {gb}),
     j AS (SELECT {g}value, q1, q3, q3 - q1 AS iqr FROM {source} JOIN q {join} WHERE value IS NOT NULL)
SELECT {g}round(q.q1, 6) AS q1, round(q.median, 6) AS median, round(q.q3, 6) AS q3, round(q.q3 - q.q1, 6) AS iqr,
       min(value) FILTER (WHERE value >= j.q1 - 1.5 * iqr AND value <= j.q3 + 1.5 * iqr) AS whisker_lo,
       max(value) FILTER (WHERE value >= j.q1 - 1.5 * iqr AND value <= j.q3 + 1.5 * iqr) AS whisker_hi,
       count(*) FILTER (WHERE NOT (value >= j.q1 - 1.5 * iqr AND value <= j.q3 + 1.5 * iqr)) AS n_outliers,
       count(*) AS n
FROM j JOIN q {join} GROUP BY {g}q.q1, q.median, q.q3"""


def _box_round(df, groups):
    return df.select(*groups, *[_r(c).alias(c) for c in ("q1", "median", "q3", "iqr")],
                     "whisker_lo", "whisker_hi", "n_outliers", "n")


@register("boxplot_stats", "A11", _box_sql(None))
def q_boxplot_stats(spark, sf):
    return _box_round(A.boxplot_stats(Tables(spark, sf).events, "value"), [])


@register("boxplot_by", "A11", _box_sql("event_type"))
def q_boxplot_by(spark, sf):
    return _box_round(A.boxplot_stats(Tables(spark, sf).events, "value", by="event_type"), ["event_type"])


@register("boxplot_odd", "A11", _unmarked(_box_sql("kind", _ODD)))
def q_boxplot_odd(spark, sf):
    return _box_round(A.boxplot_stats(_odd_events(spark, sf), "value", by="kind"), ["kind"])


@register("kde_curve", "A12", """
WITH s AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS h,
                  min(value) AS lo, max(value) AS hi FROM events),
     g AS (SELECT CAST(range AS INTEGER) AS i, lo - 3 * h + range * ((hi - lo + 6 * h) / 199) AS x, n, h
           FROM s, range(200))
SELECT i, round(x, 6) AS x,
       round(sum(exp(-0.5 * pow((x - e.value) / h, 2))) / (n * h * sqrt(2 * pi())), 10) AS density
FROM g, events e GROUP BY i, x, n, h""")
def q_kde_curve(spark, sf):
    k = A.kde_curve(Tables(spark, sf).events, "value", grid=200)
    return k.select(F.col("i").cast("int").alias("i"), _r("x").alias("x"), _r("density", 10).alias("density"))


@register("zscore", "A13", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
                  avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS z_qty,
       round((l_extendedprice - mp) / sp, 6) AS z_price FROM lineitem, s""")
def q_zscore(spark, sf):
    li = Tables(spark, sf).lineitem
    fz = T.fit_zscore(li, ["l_quantity", "l_extendedprice"])
    return li.select("l_orderkey", "l_linenumber", _r(fz.expr("l_quantity")).alias("z_qty"),
                     _r(fz.expr("l_extendedprice")).alias("z_price"))


# ------------------------------------------------------------------ transforms

@register("zscore_filter", "T1 F5 A13", """
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd, avg(user_id) AS mu, stddev_pop(user_id) AS su
           FROM events)
SELECT event_id, value FROM events, s
WHERE abs((value - m) / sd) < 3 AND abs((user_id - mu) / su) < 3""")
def q_zscore_filter(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", "value", "user_id")
    return T.zscore_filter(ev, ["value", "user_id"], threshold=3.0).select("event_id", "value")


@register("zscore_filter_odd", "T1 A13", f"""
WITH e AS {_ODD}, s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM e)
SELECT event_id, value FROM e, s WHERE abs((value - m) / sd) < 1""")
def q_zscore_filter_odd(spark, sf):
    return T.zscore_filter(_odd_events(spark, sf), ["value"], threshold=1.0).select("event_id", "value")


@register("log1p", "T2", "SELECT event_id, round(ln(1 + value), 6) AS value FROM events")
def q_log1p(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", "value")
    return T.log1p_columns(ev, ["value"]).withColumn("value", _r("value"))


@register("log_skewed", "T3 A4", """
WITH s AS (SELECT skewness(value) AS sv, skewness(user_id) AS su, skewness(event_id) AS se FROM events)
SELECT event_id,
       round(CASE WHEN abs(sv) > 0.75 THEN ln(1 + value) ELSE value END, 6) AS value,
       round(CASE WHEN abs(su) > 0.75 THEN ln(1 + user_id) ELSE user_id END, 6) AS user_id
FROM events, s""")
def q_log_skewed(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", F.col("value").cast("double"),
                                         F.col("user_id").cast("double"))
    fitted = T.fit_log_skewed(ev, ["value", "user_id", "event_id"], 0.75)
    out = fitted.apply(ev)
    return out.select("event_id", _r("value").alias("value"), _r("user_id").alias("user_id"))


@register("standard_scale", "T4", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, round((o_totalprice - m) / sd, 6) AS o_totalprice FROM orders, s WHERE o_orderstatus <> 'F'""")
def q_standard_scale(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    scaler = T.fit_standard_scaler(o.filter(F.col("o_orderstatus") == "F"), ["o_totalprice"])
    out = scaler.apply(o.filter(F.col("o_orderstatus") != "F"))
    return out.select("o_orderkey", _r("o_totalprice").alias("o_totalprice"))


@register("swish", "T5", "SELECT event_id, round(value / (1 + exp(-value)), 6) AS value_swish FROM events")
def q_swish(spark, sf):
    ev = Tables(spark, sf).events.select("event_id", "value")
    out = T.swish_columns(ev, ["value"], suffix="_swish")
    return out.select("event_id", _r("value_swish").alias("value_swish"))
