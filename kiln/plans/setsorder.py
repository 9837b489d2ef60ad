"""Queries for set operations, ordering, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import ordering as O
from kiln.operators import sets as R
from kiln.plans.catalog import register
from kiln.sources import Tables

# ``ordering.hash_number("o_orderkey", 42)`` in DuckDB.
_HASH = "CAST('0x' || left(md5('42|' || o_orderkey), 13) AS BIGINT)"


@register("concat_rows", "R1", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) FROM orders WHERE o_orderstatus <> 'F'""")
def q_concat_rows(spark, sf):
    o = Tables(spark, sf).orders
    train = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice", "o_orderstatus")
    test = o.filter(F.col("o_orderstatus") != "F").select("o_orderkey", "o_totalprice")  # target absent
    return R.concat_rows(train, test)


@register("concat_columns", "R2", """
SELECT coalesce(a.nationkey, b.nationkey) AS nationkey, a.customers, b.suppliers
FROM (SELECT c_nationkey AS nationkey, count(*) AS customers FROM customer GROUP BY 1) a
FULL OUTER JOIN (SELECT s_nationkey AS nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) b
ON a.nationkey = b.nationkey""")
def q_concat_columns(spark, sf):
    t = Tables(spark, sf)
    a = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    return R.concat_columns(a, b, "nationkey")


@register("dedup_text", "R4", """
SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def q_dedup_text(spark, sf):
    d = Tables(spark, sf).documents
    return R.dedup(d, "text", ["doc_id"]).select("doc_id", "lang", "source", "n_chars")


@register("intersect_values", "R5", """
SELECT c_nationkey AS value FROM customer INTERSECT SELECT s_nationkey FROM supplier""")
def q_intersect_values(spark, sf):
    t = Tables(spark, sf)
    return R.intersect_values(t.customer, t.supplier, "c_nationkey", "s_nationkey")


@register("sort_desc", "O1", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def q_sort_desc(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return O.sort_desc(o, "o_totalprice", ["o_orderkey"])


@register("top_k", "O2", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10 OFFSET 5""")
def q_top_k(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return O.top_k(li, "l_extendedprice", 10, skip=5, key=["l_orderkey", "l_linenumber"])


@register("shuffle_rows", "O3", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_HASH}, o_orderkey")
def q_shuffle_rows(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return O.shuffle_rows(o, "o_orderkey", seed=42)


@register("train_test_split", "O4", f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN {_HASH} / 4503599627370496.0 < 0.7 THEN 'train' ELSE 'test' END AS split
FROM orders""")
def q_train_test_split(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    train, test = O.train_test_split(o, "o_orderkey", 0.7, seed=42)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@register("stratified_split", "O5", f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN pos < round(n * 0.75) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH}, o_orderkey) - 1 AS pos FROM orders)""")
def q_stratified_split(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    train, test = O.stratified_split(o, "o_orderstatus", "o_orderkey", 0.75, seed=42)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@register("folds_null_label", "O6", """
SELECT o_orderkey, status, CAST(ntile(10) OVER (PARTITION BY status ORDER BY o_orderkey) - 1 AS INTEGER) AS fold
FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status FROM orders)""")
def q_folds_null_label(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", F.expr("nullif(o_orderstatus, 'O')").alias("status"))
    return O.stratified_folds(o, "status", "o_orderkey", k=10)


@register("split_by_origin", "R3 P4", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def q_split_by_origin(spark, sf):
    from kiln.operators.columns import columns_except

    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    both = R.concat_rows(o.filter("o_orderstatus = 'F'").withColumn("origin", F.lit("train")),
                         o.filter("o_orderstatus <> 'F'").withColumn("origin", F.lit("test")))
    train = R.split_by_origin(both, "origin", "train")
    return train.select(columns_except(train, ["o_orderstatus", "origin"]))


@register("stratified_folds", "O6", """
SELECT o_orderkey, o_orderstatus,
       CAST(ntile(10) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS INTEGER) AS fold
FROM orders""")
def q_stratified_folds(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return O.stratified_folds(o, "o_orderstatus", "o_orderkey", k=10)
