"""Flagship pipeline: the reference's feature path end to end on one frame.

documents LEFT JOIN labels (labelled = train, target = toxic)
  -> whole-text token count
  -> group sizes over both splits (one key with a hot sentinel value)
  -> cascade imputation of a label-side column, statistics from train only
  -> hash folds for the labelled rows
  -> K-fold target encoding of two categorical columns
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import encode as en
from ..operators import folds as fo
from ..operators import groups as gr
from ..operators import impute as im
from ..session import materialize
from .tables import docs


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = docs(spark, sf_dir).withColumn("n_tokens", tx.token_count("text").cast("bigint")).drop("text")
    x = materialize(x, "flagship")  # without the texts; every statistic below reads this narrow table
    x = gr.group_size(x, "source", "source_size")
    x = gr.group_size(x, "lang", "lang_size", sentinel="en")
    train = x.where(F.col("split") == "train")
    x = im.impute_cascade(x, "quality", [["lang", "source"], ["lang"]], fit_on=train, out="quality_filled")
    x = fo.hash_fold(x, "id", 5, 42, "fold")
    x = en.target_encode(x, "y", ["lang", "source"], mode="kfold", fold="fold")
    return x.select(
        "id", "split", "y", "fold", "n_tokens", "source_size", "lang_size", "quality_filled", "lang_te", "source_te"
    )
