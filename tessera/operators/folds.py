"""Deterministic fold assignment.

``stratified_fold`` is exact: within each class, rows are ordered by
``md5(seed|id)`` and dealt round-robin to k folds, so fold sizes per class
differ by at most one.  The hash's first digits cut a class into 4096 runs of even
size; a row's number is its place in its run plus the sizes of the runs before (no
single-task window even for a binary target).  The input is computed once: places are
written, and the runs' sizes are read from that table.
``hash_fold`` needs no ordering at all and is the cheap default at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def row_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def hash_fold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    h = F.conv(F.substring(row_hash(id_col, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(out, (h % k).cast("int"))


def stratified_fold(
    df: DataFrame, target: str, id_col: str, k: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    keyed = df.withColumn("_fh", row_hash(id_col, seed)).withColumn("_run", F.substring("_fh", 1, 3))
    within = Window.partitionBy(target, "_run").orderBy("_fh", id_col)
    placed = materialize(keyed.withColumn("_place", F.row_number().over(within)).drop("_fh"), "folds")
    runs = placed.groupBy(F.col(target).alias("_of"), F.col("_run").alias("_in")).agg(F.max("_place").alias("_size"))
    earlier = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(runs.select("_of", "_in", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")), "runs")
    own_run = F.col(target).eqNullSafe(F.col("_of")) & F.col("_run").eqNullSafe(F.col("_in"))
    ranked = placed.join(F.broadcast(runs), own_run, "left")  # 4096 runs a class
    return ranked.select(*df.columns, ((F.col("_before") + F.col("_place") - 1) % k).cast("int").alias(out))


def fold_balance(df: DataFrame, target: str, fold: str = "fold") -> DataFrame:
    return df.groupBy(fold, target).agg(F.count(F.lit(1)).alias("n"))
