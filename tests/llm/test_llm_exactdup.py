import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kiln.llm.exactdup import HOT_SHARE, exact_duplicates, sha256_hex

DIGESTS = {"sha256": sha256_hex, "length": lambda c: (F.length(c) % 3).cast("string"), "constant": lambda c: F.lit("x")}


def brute(rows):
    """Per content: largest id, number of rows."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("name", DIGESTS)
def test_equals_grouping_in_memory_whatever_the_digest(spark, name):
    r = random.Random(3)
    texts = [None, "", " ", "a", "A", "a ", "é", "é", "x" * 200_000, "x" * 200_000 + "y"]
    rows = [(i, r.choice(texts[:4] if i % 3 else texts)) for i in range(300)]
    rows += [(7, "twice"), (7, "twice"), (8, "other"), (8, "another"), (None, "no id"), (None, "no id"), (None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_duplicates(df, digest=DIGESTS[name], salts=2).select("doc_id", "keep_id", "group_size", "kept").collect()
    want = brute(rows)
    key = lambda x: tuple((v is not None, v) for v in x)
    assert (sorted((tuple(x)[:3] for x in got), key=key)
            == sorted(((i, *want[t or ""]) for i, t in rows), key=key))
    kept = [x for x in got if x["kept"]]
    assert len(kept) == len(want) and all(x["doc_id"] == x["keep_id"] for x in kept)


def test_rows_with_one_id_are_told_apart(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")]
    got = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(x["kept"] for x in got) == [False, False, True, True, True]


def test_hot_and_cold_groups(spark):
    """Groups above and below the hot share, spread over many tasks."""
    n = 3 * HOT_SHARE
    df = (spark.range(0, n, 1, 16)
          .select(F.col("id").alias("doc_id"),
                  F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 9973 < 2, F.concat(F.lit("cold"), F.col("id") % 9973))
                  .otherwise(F.concat(F.lit("own"), F.col("id"))).alias("text")))
    sizes = {r["group_size"]: r["n"] for r in exact_duplicates(df).groupBy("group_size").agg(F.count("*").alias("n")).collect()}
    want = defaultdict(int)
    for size in df.groupBy("text").count().select("count").toPandas()["count"]:
        want[size] += size
    assert sizes == want


def test_extra_and_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", 5, True, "z", 0), (2, "a", 6, False, "z", 1)],
                               "key long, body string, keep_id int, kept boolean, digest string, salt int")
    got = exact_duplicates(df, "key", "body")
    assert got.columns == ["key", "keep_id", "group_size", "kept", "digest"]
    assert [tuple(x)[:4] for x in got.orderBy("key").collect()] == [(1, 2, 2, False), (2, 2, 2, True)]
    assert exact_duplicates(df.where("false"), "key", "body").count() == 0


def test_no_python_on_the_main_path(spark):
    plan = exact_duplicates(spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string"))
    text = plan._jdf.queryExecution().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow"))
