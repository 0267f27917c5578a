"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """``names``, each lengthened until no column of ``df`` has it (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def q(name: str):
    """Column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(c):
    """Lower-case A-Z only; every other letter stays as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bounded_labelled_ids(labels: DataFrame, id_col: str, label_col: str, is_held_out, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fold: those of least hash.

    ``is_held_out`` maps the id column to a boolean column.  A doc_id labelled
    more than once takes the largest of its labels; null labels are none.
    """
    rated = (
        labels.select(q(id_col).alias("_id"), q(label_col).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isNotNull())
        .where(~is_held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    order = F.xxhash64(F.col("_id").cast("string"), F.lit("sample"))
    return least_of(rated, order, rows).orderBy(order_key(order), "_id").limit(rows)


def one_text_per_id(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _text, _y)`` of the sampled ids: of rows that share an id the text of least hash, so no more rows than ids."""
    texts = docs.select(q(id_col).alias("_id"), q(text_col).alias("_text"))
    least = F.struct(F.xxhash64("_text"), F.col("_text"))
    # broadcast: a bounded number of pairs of numbers
    return texts.join(F.broadcast(ids), "_id").groupBy("_id", "_y").agg(F.min_by("_text", least).alias("_text"))


HASH_BITS = 31


def order_key(hashed):
    """The hash's upper bits, as a number from 0."""
    return F.shiftrightunsigned(hashed, 64 - HASH_BITS)


def least_of(df: DataFrame, hashed, rows: int) -> DataFrame:
    """The rows of ``df`` of least hash, about twice ``rows`` (all, if it has no more).

    They are filtered within each task, so what a later ``limit(rows)`` gathers is bounded
    by ``rows``, not by ``rows`` times the number of tasks.
    """
    total = df.count()
    if total <= 2 * rows:
        return df
    return df.where(order_key(hashed) < -(-2 * rows * (1 << HASH_BITS) // total))


def crc_fold(buckets: int, held: int):
    """Predicate: crc32 of the id as text, modulo ``buckets``, is ``held``."""

    def is_held_out(c):
        return F.crc32(c.cast("string").cast("binary")) % buckets == held

    return is_held_out


def chunks(items: list, size: int) -> Iterable[list]:
    for i in range(0, len(items), size):
        yield items[i : i + size]
