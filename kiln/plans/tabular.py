"""Queries for sources, projections, filters and missing data (S, P, F, N)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kiln.operators import columns as P
from kiln.operators import missing as N
from kiln.operators.recode import cut
from kiln.operators.stats import conditional_rate
from kiln.plans.catalog import register
from kiln.sources import Tables, map_batches, read_csv, write_csv
from kiln.sources.files import scratch_path

PRICE_EDGES = [0, 100000, 200000, 300000, 400000, 500000]
PRICE_LABELS = ["p1", "p2", "p3", "p4", "p5"]


def _price_case(col: str) -> str:
    parts = [f"WHEN {col} > {lo} AND {col} <= {hi} THEN '{lab}'"
             for lo, hi, lab in zip(PRICE_EDGES[:-1], PRICE_EDGES[1:], PRICE_LABELS)]
    return "CASE " + " ".join(parts) + " END"


# ------------------------------------------------------------------ flagship slice

def order_completion_rates(spark, sf):
    """Median fill -> right-closed price bins -> completion rate per segment and bin."""
    t = Tables(spark, sf)
    o = t.orders.select("o_custkey", "o_orderstatus",
                        F.when(F.col("o_orderpriority") == "5-LOW", None)
                        .otherwise(F.col("o_totalprice")).alias("price"))
    j = o.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    j = N.fit_median(j, ["price"]).apply(j)
    j = cut(j, "price", PRICE_EDGES, PRICE_LABELS, out="price_bin")
    j = j.withColumn("finished", (F.col("o_orderstatus") == "F").cast("int"))
    r = conditional_rate(j, ["c_mktsegment", "price_bin"], "finished")
    return r.select("c_mktsegment", "price_bin", F.round("rate", 6).alias("rate"), "n")


register("conditional_rate", "A1 N2 E4", f"""
WITH j AS (SELECT o.o_orderstatus, c.c_mktsegment,
                  CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE o.o_totalprice END AS price
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
     f AS (SELECT c_mktsegment, o_orderstatus, coalesce(price, (SELECT median(price) FROM j)) AS price FROM j)
SELECT c_mktsegment, {_price_case('price')} AS price_bin,
       round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 100.0, 6) AS rate, count(*) AS n
FROM f GROUP BY 1, 2
""")(order_completion_rates)


# ------------------------------------------------------------------ sources

@register("csv_roundtrip", "S1 S2", """
SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE concat(text, ', "q" ', chr(10), chr(10), 'x ') END AS text, lang, source, n_chars
FROM documents""")
def q_csv_roundtrip(spark, sf):
    # Texts with line breaks, quotes, commas, outer blanks and nulls.
    docs = Tables(spark, sf).documents.withColumn("text", F.when(
        F.col("doc_id") % 10 != 0, F.concat("text", F.lit(', "q" \n\nx '))))
    path = write_csv(docs, scratch_path(spark, "csv"))
    return read_csv(spark, path, schema=docs.schema)


@register("csv_customers", "S1 S2", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_csv_customers(spark, sf):
    cust = Tables(spark, sf).customer
    path = write_csv(cust, scratch_path(spark, "csv"))
    return read_csv(spark, path, schema=cust.schema)


@register("batch_stats", "S6", r"""
SELECT doc_id, length(text) AS n_chars, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines
FROM documents""")
def q_batch_stats(spark, sf):
    def per_batch(pdf):
        return pdf.assign(n_chars=pdf.text.str.len(), n_lines=pdf.text.str.count("\n") + 1)[
            ["doc_id", "n_chars", "n_lines"]]

    docs = Tables(spark, sf).documents.select("doc_id", "text")
    return map_batches(docs, per_batch, "doc_id long, n_chars long, n_lines long", size=1000)


# ------------------------------------------------------------------ projections

@register("project", "P1", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def q_project(spark, sf):
    return P.select_columns(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber", "l_quantity",
                                                         "l_extendedprice"])


@register("typed_columns", "P2 P3", "SELECT o_orderkey, o_custkey FROM orders")
def q_typed_columns(spark, sf):
    o = Tables(spark, sf).orders
    numeric = o.select(P.columns_of_type(o, "number"))  # o_orderkey, o_custkey, o_totalprice
    return numeric.select(P.columns_by_position(numeric, 0, -1))


@register("drop_columns", "P4 P5", "SELECT p_partkey, p_type, p_size, p_retailprice FROM part")
def q_drop_columns(spark, sf):
    part = Tables(spark, sf).part
    return P.drop_columns(part, ["p_name", "p_brand", "p_type", "p_missing"], keep=["p_type"])


@register("rename_columns", "P6", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment AS segment FROM customer""")
def q_rename_columns(spark, sf):
    return P.rename_columns(Tables(spark, sf).customer, {"c_acctbal": "balance", "c_mktsegment": "segment"})


@register("tag_union", "P7 R1", """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       CAST(NULL AS VARCHAR) AS segment, 'supplier' AS origin FROM supplier
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'customer' FROM customer""")
def q_tag_union(spark, sf):
    from kiln.operators.sets import concat_rows

    t = Tables(spark, sf)
    s = t.supplier.toDF("key", "name", "nationkey", "acctbal")
    c = t.customer.toDF("key", "name", "nationkey", "acctbal", "segment")
    return concat_rows(P.add_literal(s, "origin", "supplier"), P.add_literal(c, "origin", "customer"))


@register("derive_sum", "P8", """
SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber + 1 AS units FROM lineitem""")
def q_derive_sum(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return P.derive(li, "units", F.col("l_quantity") + F.col("l_linenumber") + 1).drop("l_quantity")


@register("threshold_flag", "P9", """
SELECT l_orderkey, l_linenumber,
       coalesce((CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END) <= 0.05, false) AS cheap
FROM lineitem""")
def q_threshold_flag(spark, sf):
    li = Tables(spark, sf).lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_discount")).alias("disc"))
    return P.add_threshold_flag(li, "disc", 0.05, "cheap").drop("disc")


@register("cast_double", "P10", """
SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part""")
def q_cast_double(spark, sf):
    part = Tables(spark, sf).part.select("p_partkey", "p_size", "p_retailprice")
    return P.cast_all(part, ["p_partkey", "p_size"], "double")


@register("assemble", "P11", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS f0, CAST(l_discount AS DOUBLE) AS f1,
       CAST(l_tax AS DOUBLE) AS f2 FROM lineitem""")
def q_assemble(spark, sf):
    li = Tables(spark, sf).lineitem
    v = P.assemble_features(li, ["l_quantity", "l_discount", "l_tax"], keep=["l_orderkey", "l_linenumber"])
    f = vector_to_array("features")
    return v.select("l_orderkey", "l_linenumber", *[f[i].alias(f"f{i}") for i in range(3)])


@register("row_id", "P12", """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, o_orderkey, o_totalprice
FROM orders WHERE o_orderstatus = 'F'""")
def q_row_id(spark, sf):
    o = Tables(spark, sf).orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    return P.row_id(o, ["o_orderkey"]).select("row_id", "o_orderkey", "o_totalprice")


# ------------------------------------------------------------------ filters

_FLAG_NULLED = "CASE WHEN l_linestatus = 'O' AND l_quantity > 45 THEN NULL ELSE l_returnflag END"


def _flag_nulled(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(
        (F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45), None).otherwise(
        F.col("l_returnflag")).alias("flag"))


@register("drop_value", "F1", f"""
SELECT * FROM (SELECT l_orderkey, l_linenumber, {_FLAG_NULLED} AS flag FROM lineitem)
WHERE flag IS DISTINCT FROM 'R'""")
def q_drop_value(spark, sf):
    return P.where_not_equal(_flag_nulled(Tables(spark, sf)), "flag", "R")


@register("range_filter", "F2 F5", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity > 10 AND l_quantity <= 30 AND l_discount >= 0.02 AND l_discount < 0.05""")
def q_range_filter(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return P.range_filter(li, {"l_quantity": (10, 30, "right"), "l_discount": (0.02, 0.05, "left")})


@register("in_list", "F3", """
SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#13', 'Brand#22', 'Brand#5')""")
def q_in_list(spark, sf):
    part = Tables(spark, sf).part.select("p_partkey", "p_brand")
    return P.is_in(part, "p_brand", ["Brand#13", "Brand#1", "Brand#22", "Brand#5", "Brand#13"])


def _docs_labels(t):
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    return d.join(t.labels, "doc_id", "left")


_DOCS_LABELS = ("(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
                "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")


@register("drop_nulls", "F4", f"""
SELECT * FROM {_DOCS_LABELS} WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def q_drop_nulls(spark, sf):
    return P.drop_nulls(_docs_labels(Tables(spark, sf)), ["quality", "toxic"])


@register("update_where", "F7", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 45 THEN 0.0 ELSE l_discount END AS l_discount
FROM lineitem""")
def q_update_where(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return P.update_where(li, F.col("l_quantity") > 45, "l_discount", 0.0).drop("l_quantity")


# ------------------------------------------------------------------ missing data

@register("fill_constant", "N1", f"""
SELECT doc_id, lang, source, n_chars, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic
FROM {_DOCS_LABELS}""")
def q_fill_constant(spark, sf):
    return N.fill_constant(_docs_labels(Tables(spark, sf)), {"quality": -1, "toxic": 0})


_QTY_NULLED = "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE l_quantity END"


def _qty_nulled(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(
        (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), None).otherwise(
        F.col("l_quantity")).alias("qty"))


@register("fill_median", "N2", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, {_QTY_NULLED} AS qty FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(qty, (SELECT median(qty) FROM t)) AS qty FROM t""")
def q_fill_median(spark, sf):
    li = _qty_nulled(Tables(spark, sf))
    return N.fit_median(li, ["qty"]).apply(li)


@register("fill_mode", "N3", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, {_FLAG_NULLED} AS flag FROM lineitem),
     m AS (SELECT flag FROM t WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)
SELECT l_orderkey, l_linenumber, coalesce(flag, (SELECT flag FROM m)) AS flag FROM t""")
def q_fill_mode(spark, sf):
    li = _flag_nulled(Tables(spark, sf))
    return N.fit_mode(li, ["flag"]).apply(li)


@register("fill_mean", "N4", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, {_QTY_NULLED} AS qty FROM lineitem)
SELECT l_orderkey, l_linenumber, round(coalesce(qty, (SELECT avg(qty) FROM t)), 6) AS qty FROM t""")
def q_fill_mean(spark, sf):
    li = _qty_nulled(Tables(spark, sf))
    return N.fit_mean(li, ["qty"]).apply(li).withColumn("qty", F.round("qty", 6))


@register("impute_regression", "N5", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity,
                  CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_extendedprice END AS price FROM lineitem),
     f AS (SELECT regr_slope(price, l_quantity) AS s, regr_intercept(price, l_quantity) AS i FROM t)
SELECT l_orderkey, l_linenumber, round(coalesce(price, (SELECT i FROM f) + (SELECT s FROM f) * l_quantity), 4) AS price
FROM t""")
def q_impute_regression(spark, sf):
    li = Tables(spark, sf).lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_linestatus") == "O", None).otherwise(F.col("l_extendedprice")).alias("price"))
    fitted = N.fit_regression_fill(li, "price", "l_quantity")
    out = fitted.apply(li)
    return out.select("l_orderkey", "l_linenumber", F.round("price", 4).alias("price"))


_NULL_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@register("null_counts", "N6", " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM {_DOCS_LABELS}" for c in _NULL_COLS))
def q_null_counts(spark, sf):
    return N.null_counts(_docs_labels(Tables(spark, sf)))


@register("missing_report", "N7", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(*) - count({c}) AS BIGINT) AS total, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS percentage FROM {_DOCS_LABELS}"
    for c in _NULL_COLS) + ") WHERE total > 0")
def q_missing_report(spark, sf):
    r = N.missing_report(_docs_labels(Tables(spark, sf)))
    return r.withColumn("percentage", F.round("percentage", 6))


@register("frame_summary", "N8", f"""
SELECT CAST(2 AS BIGINT) AS n_categorical, CAST(4 AS BIGINT) AS n_numerical,
       CAST(count(*) * 6 AS BIGINT) AS total_cells,
       CAST(sum((quality IS NULL)::INT) + sum((toxic IS NULL)::INT) AS BIGINT) AS total_nulls,
       CAST((sum((quality IS NULL)::INT) > 0)::INT + (sum((toxic IS NULL)::INT) > 0)::INT AS BIGINT) AS null_columns,
       CAST(0 AS BIGINT) AS null_categorical_columns,
       CAST((sum((quality IS NULL)::INT) > 0)::INT + (sum((toxic IS NULL)::INT) > 0)::INT AS BIGINT)
           AS null_numerical_columns
FROM {_DOCS_LABELS}""")
def q_frame_summary(spark, sf):
    return N.frame_summary(_docs_labels(Tables(spark, sf)))

