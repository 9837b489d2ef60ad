"""Queries for recoding, binning and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import encode as E
from kiln.operators import recode as RC
from kiln.plans.catalog import register
from kiln.sources import Tables


@register("replace_values", "E1", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Rare'
            WHEN o_orderpriority = '1-URGENT' THEN 'Urgent'
            WHEN o_orderpriority = '2-HIGH' THEN 'High'
            ELSE o_orderpriority END AS prio
FROM orders""")
def q_replace_values(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority")
    out = RC.replace_values(o, "o_orderpriority", {"1-URGENT": "Urgent", "2-HIGH": "High"},
                            values=["4-NOT SPECIFIED", "5-LOW"], value="Rare", out="prio")
    return out.drop("o_orderpriority")


@register("recode_prefix", "E2 F6", """
SELECT p_partkey,
       CASE WHEN starts_with(p_brand, 'Brand#1') THEN 'B1x'
            WHEN starts_with(p_brand, 'Brand#2') THEN 'B2x'
            ELSE p_brand END AS brand
FROM part""")
def q_recode_prefix(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_brand")
    return RC.recode_prefix(p, "p_brand", [("Brand#1", "B1x"), ("Brand#2", "B2x")], out="brand").drop("p_brand")


@register("recode_groups", "E3", """
SELECT p_partkey,
       CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'cheap'
            WHEN p_type IN ('LARGE', 'STANDARD') THEN 'bulk'
            ELSE p_type END AS kind
FROM part""")
def q_recode_groups(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_type")
    groups = {"cheap": ["ECONOMY", "PROMO"], "bulk": ["LARGE", "STANDARD"]}
    return RC.recode_groups(p, "p_type", groups, out="kind").drop("p_type")


@register("cut_bins", "E4", """
SELECT o_orderkey,
       CASE WHEN o_totalprice > 0 AND o_totalprice <= 50000 THEN 'low'
            WHEN o_totalprice > 50000 AND o_totalprice <= 150000 THEN 'mid'
            WHEN o_totalprice > 150000 AND o_totalprice <= 300000 THEN 'high'
            WHEN o_totalprice > 300000 AND o_totalprice <= 450000 THEN 'top' END AS price_bin
FROM orders""")
def q_cut_bins(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return RC.cut(o, "o_totalprice", [0, 50000, 150000, 300000, 450000], ["low", "mid", "high", "top"],
                  out="price_bin").drop("o_totalprice")


@register("bin_rules", "E5", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity <= 10 THEN 'few'
            WHEN l_quantity > 10 AND l_quantity <= 30 THEN 'some'
            WHEN l_quantity > 30 AND l_quantity < 50 THEN 'many' END AS qty_level
FROM lineitem""")
def q_bin_rules(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    q = F.col("l_quantity")
    rules = [(q <= 10, "few"), ((q > 10) & (q <= 30), "some"), ((q > 30) & (q < 50), "many")]
    return RC.bin_by_rules(li, rules, "qty_level").drop("l_quantity")


@register("bin_by_mean", "E6", """
WITH m AS (SELECT avg(l_discount) AS mu FROM lineitem WHERE l_returnflag = 'R')
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount = 0 THEN 'none'
            WHEN l_discount > 0 AND l_discount < (SELECT mu FROM m) THEN 'below'
            WHEN l_discount >= (SELECT mu FROM m) THEN 'above' END AS disc_bin
FROM lineitem WHERE l_returnflag <> 'R'""")
def q_bin_by_mean(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_discount", "l_returnflag")
    train = li.filter(F.col("l_returnflag") == "R")
    test = li.filter(F.col("l_returnflag") != "R")
    fitted = RC.fit_mean_bins(train, ["l_discount"])  # fitted on train, applied to test
    return fitted.apply(test, suffix="_bin").select("l_orderkey", "l_linenumber",
                                                    F.col("l_discount_bin").alias("disc_bin"))


@register("presence_flag", "E7", """
SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 0 ELSE 1 END AS labelled,
       CASE WHEN l.toxic IS NULL THEN 'N' ELSE 'Y' END AS has_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_presence_flag(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    j = RC.presence_flag(j, "quality", out="labelled")
    j = RC.presence_flag(j, "toxic", yes="Y", no="N", out="has_toxic")
    return j.select("doc_id", "labelled", "has_toxic")


@register("nonzero_flag", "E8", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN 1 ELSE l_discount END AS discounted
FROM lineitem""")
def q_nonzero_flag(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_discount")
    return RC.nonzero_flag(li, "l_discount", out="discounted").drop("l_discount")


_STATUS = ["F", "O", "P", "X"]
_PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("one_hot", "E9", "SELECT o_orderkey, o_totalprice, " + ", ".join(
    [f"CASE WHEN o_orderstatus = '{v}' THEN 1 ELSE 0 END AS \"status_{v}\"" for v in _STATUS] +
    [f"CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END AS \"prio_{v}\"" for v in _PRIO]) + " FROM orders")
def q_one_hot(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return E.one_hot(o, ["o_orderstatus", "o_orderpriority"], prefixes=["status", "prio"],
                     declared={"o_orderstatus": ["X"]})


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("one_hot_auto", "E10 P2", "SELECT c_custkey, c_nationkey, c_acctbal, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS \"c_mktsegment_{v}\"" for v in _SEGMENTS) +
    " FROM customer")
def q_one_hot_auto(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return E.one_hot_auto(c)


@register("one_hot_aligned", "E11 R1 R3", "SELECT o_orderkey, origin, " + ", ".join(
    f"CASE WHEN o_orderstatus = '{v}' THEN 1 ELSE 0 END AS \"status_{v}\"" for v in ["F", "O", "P"]) +
    " FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'train' ELSE 'test' END AS origin FROM orders)")
def q_one_hot_aligned(spark, sf):
    from kiln.operators.sets import concat_rows

    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    train = o.filter(F.col("o_orderstatus") == "F")   # sees only 'F'
    test = o.filter(F.col("o_orderstatus") != "F")    # sees 'O' and 'P'
    tr, te = E.one_hot_aligned(train, test, ["o_orderstatus"], prefixes=["status"])
    return concat_rows(tr.withColumn("origin", F.lit("train")), te.withColumn("origin", F.lit("test")))


@register("one_hot_label", "E12", """
SELECT vec_id, label,
       array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN '1' ELSE '0' END), '') AS code
FROM embeddings""")
def q_one_hot_label(spark, sf):
    emb = Tables(spark, sf).embeddings.select("vec_id", "label")
    out = E.one_hot_label(emb, "label", k=10)
    code = F.array_join(F.transform("one_hot", lambda v: v.cast("int").cast("string")), "")
    return out.select("vec_id", "label", code.alias("code"))


@register("label_encode", "E13", """
SELECT p_partkey, p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS type_index FROM part""")
def q_label_encode(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_type")
    enc = E.fit_label_encoder(p, "p_type")
    return enc.apply(p, out="type_index")


@register("argmax_decode", "E14", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS label FROM embeddings""")
def q_argmax_decode(spark, sf):
    emb = Tables(spark, sf).embeddings.select("vec_id", "embedding")
    return E.argmax_decode(emb, "embedding").select("vec_id", "label")


@register("regex_extract", "E15", r"""
SELECT doc_id, regexp_extract(text, ' ([A-Za-z]+)\.', 1) AS title FROM documents""")
def q_regex_extract(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    return RC.extract_title(d, "text", out="title").select("doc_id", "title")

