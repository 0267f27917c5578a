"""Stand-ins for the reference's labelled/unlabelled table, built from the driver tables.

``cases``: orders joined to their customer.  Pending orders (status ``P``) have
no known outcome and form the unlabelled split; for the others the target is
``status = 'F'``.  A negative account balance is treated as unknown, which gives
a numeric column with natural missing values.

``docs``: documents left-joined to labels; labelled documents are the train
split, the target is ``toxic``.

``scores``: two one-feature scorecards per case (``p_a`` from the balance,
``p_b`` from the nation) and a hash fold -- deterministic scores, so every
metric over them has an exact SQL twin.

Each frame has a DuckDB CTE twin in :data:`BASE_SQL`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.folds import hash_fold
from ..sources.frames import read_table


def cases(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    status = F.col("o_orderstatus")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cust"),
        F.when(status == "P", "test").otherwise("train").alias("split"),
        F.when(status == "P", F.lit(None)).when(status == "F", 1).otherwise(0).cast("int").alias("y"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("o_orderpriority").alias("priority"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("pclass"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("balance"),
    )


def scores(spark: SparkSession, d: str) -> DataFrame:
    c = cases(spark, d).select("id", "cust", "split", "y", "segment", "nation", "pclass", "balance")
    c = c.select(
        "id", "cust", "split", "y", "segment", "nation", "pclass",
        F.coalesce(F.col("balance") / F.lit(10000.0), F.lit(0.5)).alias("p_a"),
        ((F.col("nation").cast("double") + F.lit(0.5)) / F.lit(25.0)).alias("p_b"),
    )
    return hash_fold(c, "id", 5, 42, "fold")


def docs(spark: SparkSession, d: str) -> DataFrame:
    doc = read_table(spark, d, "documents")
    lab = read_table(spark, d, "labels")
    j = doc.join(lab, "doc_id", "left")
    return j.select(
        F.col("doc_id").alias("id"), "text", "lang", "source", "n_chars",
        F.when(lab["toxic"].isNull(), "test").otherwise("train").alias("split"),
        F.col("toxic").alias("y"), "quality",
    )


BASE_SQL = """
cases AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS cust,
         CASE WHEN o.o_orderstatus = 'P' THEN 'test' ELSE 'train' END AS split,
         CAST(CASE WHEN o.o_orderstatus = 'P' THEN NULL WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS y,
         c.c_name AS name, c.c_mktsegment AS segment, c.c_nationkey AS nation,
         o.o_orderpriority AS priority,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS pclass,
         o.o_totalprice AS price,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS balance
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
scores AS (
  SELECT id, cust, split, y, segment, nation, pclass,
         COALESCE(balance / 10000.0, 0.5) AS p_a,
         (CAST(nation AS DOUBLE) + 0.5) / 25.0 AS p_b,
         CAST(CAST(('0x' || substr(md5('42|' || CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold
  FROM cases
),
docs AS (
  SELECT d.doc_id AS id, d.text, d.lang, d.source, d.n_chars,
         CASE WHEN l.toxic IS NULL THEN 'test' ELSE 'train' END AS split,
         l.toxic AS y, l.quality
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)
"""
