"""Group statistics: fit a small table with ``groupBy().agg()``, apply it by join.

Why agg + join rather than ``Window.partitionBy(key)``: the aggregation combines
map-side (a hot key costs one partial row per task, not a third of the table in
one task), and the join back is a normal equi-join that AQE can turn into a
broadcast when the fitted table is small, or split when a key is skewed.

pandas semantics kept: rows with a NULL key get a NULL statistic (``groupby``
drops NaN keys), ``size`` counts rows and ``count`` counts non-null values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import dense_codes, exact_median, exact_quantiles, running_sums

_SALT = "_tsr_salt"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _non_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def fit_group_stats(df: DataFrame, keys, aggs: Mapping[str, Column]) -> DataFrame:
    """``(keys..., out...)``: one row per non-null key."""
    keys = _keys(keys)
    return _non_null_keys(df, keys).groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])


def join_back(df: DataFrame, stats: DataFrame, keys, alone: Column | None = None) -> DataFrame:
    """Left join of a fitted table whose keys are unique and not null.

    Rows with a NULL key (or those that ``alone`` marks) match nothing; a salt made from
    the row deals them out evenly, where a plain join would send them all to one task.
    """
    keys = _keys(keys)
    if df.isStreaming:  # fitted tables of a stream are static and joined as they are
        return df.join(stats, keys, "left")
    for k in keys:
        lost = F.col(k).isNull()
        alone = lost if alone is None else alone | lost
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    salt = F.when(alone, F.pmod(F.xxhash64(*hashable), F.lit(1024)).cast("int") + 1).otherwise(F.lit(0))
    res = df.withColumn(_SALT, salt).join(stats.withColumn(_SALT, F.lit(0)), [*keys, _SALT], "left")
    return res.drop(_SALT)


def apply_stats(df: DataFrame, stats: DataFrame, keys, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left-join a fitted table; optional defaults for unmatched rows."""
    keys = _keys(keys)
    out = join_back(df, stats, keys)
    if defaults:
        out = out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})
    return out


def with_group_stats(df: DataFrame, keys, aggs: Mapping[str, Column], defaults=None) -> DataFrame:
    return apply_stats(df, fit_group_stats(df, keys, aggs), keys, defaults)


def group_size(
    df: DataFrame,
    keys,
    out: str = "group_size",
    count_col: str | None = None,
    sentinel: object | None = None,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Rows per key on every row (``transform('size')``; ``count_col`` -> non-null count).

    ``sentinel``: rows whose (single) key equals it get size 1.  They are left out of
    the aggregate and dealt out evenly in the join -- such a key is typically the hot one.
    ``fit_on``: count over another frame (e.g. the union of both splits).
    """
    keys = _keys(keys)
    src = fit_on if fit_on is not None else df
    if sentinel is not None:
        src = src.where(F.col(keys[0]) != F.lit(sentinel))
    agg = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    stats = fit_group_stats(src, keys, {out: agg})
    if sentinel is None:
        return join_back(df, stats, keys)
    is_sentinel = F.coalesce(F.col(keys[0]) == F.lit(sentinel), F.lit(False))
    res = join_back(df, stats, keys, is_sentinel)
    return res.withColumn(out, F.when(F.col(keys[0]) == F.lit(sentinel), F.lit(1)).otherwise(F.col(out)))


def multi_key_group_sizes(df: DataFrame, specs: Mapping[str, Sequence[str]], sentinels: Mapping[str, object] | None = None) -> DataFrame:
    """Several group sizes with different keys on one frame (no re-union)."""
    sentinels = sentinels or {}
    out = df
    for name, keys in specs.items():
        out = group_size(out, keys, name, sentinel=sentinels.get(name))
    return out


def group_median(df: DataFrame, keys, value: str, out: str = "median", approx: bool = False) -> DataFrame:
    """Fitted table of exact (or approximate) group medians, NULL-key groups dropped."""
    keys = _keys(keys)
    src = _non_null_keys(df, keys)
    if approx:
        return src.groupBy(*keys).agg(F.percentile_approx(value, 0.5, 10000).cast("double").alias(out))
    # Groups whose values are all NULL keep a NULL median (pandas keeps them).
    return exact_median(src, value, keys, out, keep_empty=True)


def with_group_median(df: DataFrame, keys, value: str, out: str, approx: bool = False) -> DataFrame:
    return join_back(df, group_median(df, keys, value, out, approx), keys)


def mode_table(df: DataFrame, col: str, by: Sequence[str] = (), out: str = "mode") -> DataFrame:
    """Most frequent non-null value per ``by`` (smallest value on ties), scalably.

    Counts per ``(by, value)`` first, then ``min(struct(-count, value))`` -- a
    partial-aggregating reduce, so a hot group never gathers its values in one
    task.
    """
    by = list(by)
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("neg"), F.col(col).alias("v"))).alias("_m"))
    return best.select(*by, F.col("_m.v").alias(out))


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """``value_counts()``: non-null values with counts."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))


def value_share(df: DataFrame, col: str, by: Sequence[str] = (), out: str = "share") -> DataFrame:
    """``value_counts(normalize=True)`` per ``by``: NULLs excluded from the denominator."""
    by = list(by)
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_t"))
    joined = counts.join(totals, by, "inner") if by else counts.crossJoin(F.broadcast(totals))  # one row when ungrouped
    return joined.select(*by, col, (F.col("_n") / F.col("_t")).alias(out))


def collapse_rare(df: DataFrame, col: str, min_count: int = 5, other: str = "RARE", out: str | None = None) -> DataFrame:
    """Values seen fewer than ``min_count`` times (over ``df``) become ``other``."""
    out = out or col
    counts = value_counts(df, col, "_freq")
    res = join_back(df, counts, [col])
    return res.withColumn(
        out, F.when(F.col(col).isNull(), F.lit(None)).when(F.col("_freq") >= min_count, F.col(col)).otherwise(F.lit(other))
    ).drop("_freq")


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Wide -> long ``(ids..., feature, value)``, values cast to string (one scan)."""
    return df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), name, value
    )


def target_rate_by_category(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Mean target and count per (feature, value) for many columns in one groupBy."""
    long = unpivot(df.where(F.col(target).isNotNull()), [target], cols)
    return long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.avg(target).alias("target_rate"), F.count(F.lit(1)).alias("n")
    )


def describe_exact(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max per column (and ``by``), exact quartiles."""
    by = list(by)
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        by, list(cols), "column", "x"
    )
    keys = by + ["column"]
    moments = long.groupBy(*keys).agg(
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    q = exact_quantiles(long, "x", [0.25, 0.5, 0.75], keys)
    wide = q.groupBy(*keys).pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    wide = wide.withColumnsRenamed({"0.25": "q25", "0.5": "q50", "0.75": "q75"})
    return moments.join(wide, keys, "left")


def dense_rank_in_group(df: DataFrame, keys, value: str, out: str = "dense_rank") -> DataFrame:
    """``groupby(k)[v].rank(method='dense')``: 1-based, NULL value -> NULL rank.

    Ranks come from distinct ``(k, v)`` pairs ranked with a range-partitioned
    running count, so a hot key is spread over many tasks.
    """
    keys = _keys(keys)
    codes = dense_codes(_non_null_keys(df, keys), value, keys, out, start=1)
    return join_back(df, codes, keys + [value])


def average_rank_desc(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """Descending rank with ties sharing the mean rank (``rank(ascending=False)``); NULL has none."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(counts.withColumn("_neg", -F.col(value)), ["_neg"], ["_c"])
    ranks = cum.select(value, (F.col("cum__c") - (F.col("_c") - 1) / 2.0).alias(out))
    return join_back(df, ranks, [value])


def top_fraction(df: DataFrame, score: str, share: float, tiebreak: str) -> DataFrame:
    """The ``int(n * share)`` rows of highest ``score`` (ties: smaller ``tiebreak``, which is unique)."""
    ordered = df.withColumns({"_neg": F.coalesce(-F.col(score), F.lit(float("inf"))), "_one": F.lit(1)})
    ranked = running_sums(ordered, ["_neg", tiebreak], ["_one"])
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))  # one row
    kept = ranked.crossJoin(F.broadcast(n)).where(F.col("cum__one") <= F.floor(F.col("_n") * F.lit(share)))
    return kept.select(*df.columns)


def outlier_flag(df: DataFrame, col: str, k: float = 2.0, out: str = "is_outlier") -> DataFrame:
    """``x > mean + k * std`` with global mean/std (one-row agg, cross-joined)."""
    stats = df.agg(F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd"))
    res = df.crossJoin(F.broadcast(stats))  # one row
    return res.withColumn(
        out, F.coalesce(F.col(col) > F.col("_mu") + F.lit(k) * F.col("_sd"), F.lit(False)).cast("int")
    ).drop("_mu", "_sd")


def diff_from_group_mean(df: DataFrame, keys, value: str, out: str) -> DataFrame:
    keys = _keys(keys)
    stats = fit_group_stats(df, keys, {"_gm": F.avg(value)})
    return join_back(df, stats, keys).withColumn(out, F.col(value) - F.col("_gm")).drop("_gm")


def top_k(df: DataFrame, score: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """Top ``k`` rows by score desc, deterministic tie-break (a per-task top-k merge)."""
    return df.orderBy(F.col(score).desc(), *[F.col(t).asc() for t in tiebreak]).limit(k)


def argmax_first(df: DataFrame, metric: str, position: str) -> DataFrame:
    """Row with the largest ``metric``; the first ``position`` among ties."""
    return df.orderBy(F.col(metric).desc(), F.col(position).asc()).limit(1)


def missing_share(df: DataFrame, cols: Sequence[str], out: str = "missing_pct") -> DataFrame:
    """``isnull().mean() * 100`` for each column, one scan, one row per column."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"_m{i}") for i, c in enumerate(cols)])
    rows = F.array(
        *[F.struct(F.lit(c).alias("feature"), (F.col(f"_m{i}") * 100).alias(out)) for i, c in enumerate(cols)]
    )
    return one.select(F.inline(rows))
