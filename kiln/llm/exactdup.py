"""Exact duplicates with skew-safe combining, in DataFrame functions only.

Rows are equal when their whole contents are. The digest only says where contents meet; they are
compared in full at every stage, since the content is part of every grouping key:

1. Local: Spark's partial aggregate folds the copies inside each task to one winner before anything moves.
2. Salted: winners meet by (digest, salt). Cold digests have salt 0 and are finished here, so a content moves
   once. A hot digest, one with at least 1 / ``HOT_SHARE`` of all rows, gets its salt from the task that read
   the row: a task still sends one winner per content, and the winners of many tasks spread over ``SALTS`` keys.
3. Global: the salt winners of hot digests, ``SALTS`` per content at most, are combined.

No more than ``HOT_SHARE`` digests can be hot, so their list is broadcast. Rows get their group back by digest:
hot groups by broadcast, the others by a join in which no key holds more than 1 / ``HOT_SHARE`` of the rows. A
digest that holds several contents (none is known for SHA-256) takes rows back by content instead.

Defined results: a null text counts as empty, empty texts are copies of one another; the largest id stays, a
null id is smaller than any other; of rows that also share the id exactly one stays; an empty table gives an
empty result. Only the id and text columns are read, so other columns and their names do not matter. Very long
texts are hashed and compared whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import ready
from kiln.session import staged

SALTS = 32
HOT_SHARE = 10_000


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                     digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: (``id_col``, keep_id, group_size, kept, digest).

    digest: any function of the content (binary); a weak one costs time, not correctness.
    """
    ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"),
                        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("content"))
    texts = texts.withColumn("digest", digest(F.col("content")))
    rows = staged(texts.select("id", "digest").withColumn("row", F.monotonically_increasing_id()), "digests")
    total = rows.count()
    hot = rows.groupBy("digest").count().where(F.col("count") * HOT_SHARE >= total).where("count > 1")
    hot = staged(hot.select("digest", F.lit(True).alias("hot")), "hot-digests")

    groups = _groups(texts, hot, salts)
    # A digest with several groups holds several contents.
    clash = staged(groups.groupBy("digest").count().where("count > 1").select("digest"), "clashes")
    found = _by_digest(rows, groups.join(clash, "digest", "left_anti"), total)
    if not clash.isEmpty():
        found = found.join(clash, "digest", "left_anti").unionByName(_by_content(texts, clash))
        found = staged(found, "rows-with-groups")
    return _one_stays(found).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "digest")


def _groups(texts: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """(digest, keep_id, group_size): one row per distinct content."""
    merge = [F.max("id").alias("id"), F.count(F.lit(1)).alias("n")]
    salted = (texts.join(F.broadcast(hot), "digest", "left")
              .withColumn("salt", F.when(F.col("hot"), 1 + F.spark_partition_id() % salts).otherwise(0))
              .groupBy("digest", "salt", "content").agg(*merge))
    # Contents of cold groups are done with; those of hot ones are needed once more.
    winners = staged(salted.withColumn("content", F.when(F.col("salt") > 0, F.col("content"))), "salt-winners")
    combined = (winners.where("salt > 0").groupBy("digest", "content")
                .agg(F.max("id").alias("id"), F.sum("n").alias("n")))
    return staged(winners.where("salt = 0").select("digest", "id", "n")
                  .unionByName(combined.select("digest", "id", "n"))
                  .select("digest", F.col("id").alias("keep_id"), F.col("n").alias("group_size")), "groups")


def _by_digest(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Rows with the group of their digest; rows that share it with none are a group of their own."""
    large = groups.where("group_size > 1").select("digest", F.col("keep_id").alias("k"), F.col("group_size").alias("n"))
    hot = F.col("n") * HOT_SHARE >= total
    # At most HOT_SHARE groups hold 1 / HOT_SHARE of the rows each.
    top = F.broadcast(large.where(hot).withColumnsRenamed({"k": "hot_k", "n": "hot_n"}))
    met = rows.join(top, "digest", "left")
    # Rows already served get a key of their own, which meets nothing and spreads evenly.
    met = met.withColumn("key", F.when(F.col("hot_n").isNull(), F.col("digest"))
                         .otherwise(F.concat(F.lit("row "), F.col("row").cast("string"))))
    met = met.join(large.where(~hot).withColumnRenamed("digest", "key"), "key", "left")
    served = F.coalesce("hot_n", "n")
    return met.select("id", "digest", "row",
                      F.when(F.col("hot_n").isNotNull(), F.col("hot_k")).when(served.isNotNull(), F.col("k"))
                      .otherwise(F.col("id")).alias("keep_id"),
                      F.coalesce(served, F.lit(1)).cast("long").alias("group_size"),
                      F.lit(None).cast("string").alias("part"))


def _by_content(texts: DataFrame, clash: DataFrame) -> DataFrame:
    """Rows of clashing digests with their group, met by whole content; ``part`` tells the contents apart."""
    rows = texts.join(clash, "digest", "left_semi")
    groups = (rows.groupBy("digest", "content")
              .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    groups = staged(groups.withColumn("part", F.monotonically_increasing_id().cast("string")), "clash-groups")
    met = rows.join(groups, ["digest", "content"])
    return met.select("id", "digest", (-1 - F.monotonically_increasing_id()).alias("row"),
                      "keep_id", "group_size", "part")


def _one_stays(found: DataFrame) -> DataFrame:
    """``kept``: true for one row per group, the one with the kept id (the first of those that share it)."""
    top = found.where("group_size > 1").where(F.col("id").eqNullSafe(F.col("keep_id")))
    first = top.groupBy("digest", "part").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    return (found.join(first, "row", "left")
            .withColumn("kept", (F.col("group_size") == 1) | F.coalesce("first", F.lit(False))))


def op13_exactdup(spark, sf_dir: str) -> DataFrame:
    """Exact copies among all ``documents``: the largest id of each group stays."""
    from kiln.sources.tables import table

    return (exact_duplicates(table(spark, sf_dir, "documents"))
            .withColumnRenamed("digest", "text_sha256"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (
  SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
         row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS n
  FROM d)
SELECT doc_id, keep_id, group_size, n = 1 AS kept, sha256(t) AS text_sha256 FROM g
"""
