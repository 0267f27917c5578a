"""Corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, mix.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; ``run`` applies them
in order to the table ``documents``, writing every stage's result as Parquet to the
shared checkpoint folder and reading it again.  All stages but the last return the
columns of ``documents``; the last adds ``mix_shard`` and ``mix_position``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import crc_fold, read_table
from tessera.llm.decontaminate import decontaminated
from tessera.llm.line_dedup import without_frequent_lines
from tessera.llm.mix import mixed
from tessera.llm.simhash import keep_one_of_each
from tessera.llm.toxicity import fit_toxicity, toxicity_score
from tessera.session import Scratch

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC_FROM``; the model is fitted as in the query of operator 8."""
    model = fit_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), crc_fold(4, 2))
    return docs.where(toxicity_score(F.col("text"), model) < TOXIC_FROM)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three or more documents share (the largest doc_id keeps them)."""
    return without_frequent_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the least doc_id."""
    return keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources that are left, in shards."""
    return mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mix", mix_sources),
]

#: The stages' learned model, alignments and hashes have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        after = scratch.save(stage(spark, docs, sf_dir), f"stage-{name}")
        scratch.drop(docs)
        docs = after
    return docs
