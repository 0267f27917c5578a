"""Imputation: statistics fitted on an explicit frame (``fit_on``), applied by join.

``fit_on`` is the whole point: the reference alternates between statistics
taken over the union of both splits and over the labelled split only, and the
choice is made visible here instead of by which frame a loop happened to use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .groups import _keys, group_median, join_back, mode_table
from ..session import materialize
from .ordered import exact_median


def _global_median(src: DataFrame, value: str, out: str) -> DataFrame:
    return exact_median(src, value, (), out)  # one row


def impute_global_median(df: DataFrame, value: str, fit_on: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """``x.fillna(x.median())`` with the median taken over ``fit_on``."""
    out = out or value
    med = _global_median(fit_on if fit_on is not None else df, value, "_gmed")
    # one-row global median
    return df.crossJoin(F.broadcast(med)).withColumn(out, F.coalesce(F.col(value), F.col("_gmed"))).drop("_gmed")


def impute_group_median(
    df: DataFrame, value: str, keys, fit_on: DataFrame | None = None, out: str | None = None, approx: bool = False
) -> DataFrame:
    """``fillna(groupby(keys)[value].transform('median'))``; unmatched groups stay NULL."""
    keys, out = _keys(keys), out or value
    med = group_median(fit_on if fit_on is not None else df, keys, value, "_gmed", approx)
    return join_back(df, med, keys).withColumn(out, F.coalesce(F.col(value), F.col("_gmed"))).drop("_gmed")


def impute_sequential(df: DataFrame, value: str, levels: Sequence[Sequence[str]], out: str | None = None) -> DataFrame:
    """Sequential cascade: each level's median is taken over the already-filled column.

    ``groupby(l1)[v].transform(lambda x: x.fillna(x.median()))`` then the same
    for ``l2`` ... Medians of level i+1 therefore include values filled at level i.
    """
    out = out or value
    cur = df.withColumn("_v", F.col(value))
    for keys in levels:
        keys = _keys(keys)
        med = group_median(cur, keys, "_v", "_gmed")
        cur = join_back(cur, med, keys).withColumn("_v", F.coalesce(F.col("_v"), F.col("_gmed"))).drop("_gmed")
    return cur.withColumn(out, F.col("_v")).drop("_v") if out != "_v" else cur


def impute_cascade(
    df: DataFrame,
    value: str,
    levels: Sequence[Sequence[str]],
    fit_on: DataFrame | None = None,
    out: str | None = None,
    global_fallback: bool = True,
) -> DataFrame:
    """Key-exists cascade fitted on ``fit_on`` (train only or pooled).

    For a missing value the first level whose key tuple *exists* in ``fit_on``
    is used -- even when that group's median is NULL (all values missing), in
    which case the global median is used, not the next level.  Statistics are
    never taken over filled values.

    All levels and the global median come from ONE exact-quantile pass over a
    level-tagged long table ``(level, key, value)``; the small fitted table is
    materialised once and joined back once per level.
    """
    out = out or value
    src = fit_on if fit_on is not None else df
    levels = [_keys(k) for k in levels]
    tagged = [F.struct(F.lit(i).alias("_lvl"), _level_key(k).alias("_key")) for i, k in enumerate(levels)]
    if global_fallback:
        tagged.append(F.struct(F.lit(-1).alias("_lvl"), F.lit("").alias("_key")))
    long = src.select(F.col(value).cast("double").alias("_v"), F.explode(F.array(*tagged)).alias("_t")).select(
        "_t._lvl", "_t._key", "_v"
    )
    fitted = materialize(exact_median(long, "_v", ["_lvl", "_key"], "_m", keep_empty=True), "cascade")
    cur = df
    fill = None
    for i, keys in enumerate(levels):
        lvl = fitted.where(F.col("_lvl") == i).select(
            F.col("_key").alias(f"_k{i}"), F.lit(True).alias(f"_p{i}"), F.col("_m").alias(f"_m{i}")
        )
        # only rows with a value to fill seek it
        wanted = F.when(F.col(value).isNull(), _level_key(keys))
        cur = join_back(cur.withColumn(f"_k{i}", wanted), lvl, [f"_k{i}"])
        p, m = F.col(f"_p{i}"), F.col(f"_m{i}")
        fill = F.when(p.isNotNull(), m) if fill is None else fill.when(p.isNotNull(), m)
    parts = [F.col(value), fill]
    if global_fallback:
        glob = fitted.where(F.col("_lvl") == -1).select(F.col("_m").alias("_gmed"))  # one row
        cur = cur.crossJoin(F.broadcast(glob))
        parts.append(F.col("_gmed"))
    cur = cur.withColumn(out, F.coalesce(*parts))
    drop = [f"_{x}{i}" for i in range(len(levels)) for x in ("k", "p", "m")]
    return cur.drop(*drop, "_gmed")


def _level_key(keys: Sequence[str]):
    """Text key of one level; NULL when any part is NULL (such rows have no group)."""
    parts = F.array(*[F.col(k).cast("string") for k in keys])
    return F.when(~F.exists(parts, lambda x: x.isNull()), F.to_json(parts))


def impute_mode(df: DataFrame, col: str, fit_on: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """``fillna(mode()[0])``: most frequent value over ``fit_on``, smallest on ties."""
    out = out or col
    m = mode_table(fit_on if fit_on is not None else df, col, (), "_mode")
    # one-row mode
    return df.crossJoin(F.broadcast(m)).withColumn(out, F.coalesce(F.col(col), F.col("_mode"))).drop("_mode")


def impute_constant(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)
