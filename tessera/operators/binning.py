"""Fitted bins: equal-width and exact-quantile edges, fitted once, applied by join.

``pd.qcut`` semantics: edges are interpolated quantiles, duplicate edges are
dropped, bins are right-closed with the lowest edge included, so equal values
never land in different bins (unlike ``ntile``).  A value outside the fitted
range (when applying to another split) gets NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import exact_quantiles


def equal_width_bins(df: DataFrame, col: str, bins: int = 10, out: str = "bin", fit_on: DataFrame | None = None) -> DataFrame:
    """``pd.cut(x, bins=n, labels=False)``: 0-based index over [min, max] of ``fit_on``."""
    src = fit_on if fit_on is not None else df
    mm = src.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))  # one row
    width = (F.col("_mx") - F.col("_mn")) / F.lit(bins)
    # a constant column is the middle of its range: pd.cut widens the range evenly on both sides
    offset = F.col(col).cast("double") - F.col("_mn")
    at = F.when(width == 0, F.lit(bins / 2.0) + offset * bins).otherwise(F.try_divide(offset, width.cast("double")))
    idx = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.ceil(at) - 1))
    idx = F.when(F.col(col).isNotNull(), idx)  # least and greatest skip NULLs
    return df.crossJoin(F.broadcast(mm)).withColumn(out, idx.cast("int")).drop("_mn", "_mx")  # one row


def quantile_edges(df: DataFrame, col: str, q: int, by: Sequence[str] = ()) -> DataFrame:
    """Sorted distinct exact quantile edges ``(by..., _edges array<double>)``."""
    probs = [i / q for i in range(q + 1)]
    qs = exact_quantiles(df, col, probs, by)
    return qs.groupBy(*by).agg(F.array_sort(F.collect_set("quantile")).alias("_edges"))


def quantile_bins(
    df: DataFrame,
    col: str,
    q: int,
    out: str = "bin",
    labels: Sequence[str] | None = None,
    by: Sequence[str] = (),
    fit_on: DataFrame | None = None,
    approx: bool = False,
) -> DataFrame:
    """``pd.qcut(x, q, labels, duplicates='drop')`` with edges fitted per ``by`` group.

    ``approx=True`` swaps the exact edges for ``percentile_approx`` (bounded
    memory per group) at the price of edges that no longer match pandas.
    """
    by = list(by)
    src = fit_on if fit_on is not None else df
    if approx:
        probs = [i / q for i in range(q + 1)]
        edges = src.groupBy(*by).agg(
            F.array_sort(F.array_distinct(F.percentile_approx(col, probs, 10000).cast("array<double>"))).alias("_edges")
        )
    else:
        edges = quantile_edges(src, col, q, by)
    j = df.join(edges, by, "left") if by else df.crossJoin(F.broadcast(edges))  # unpartitioned: q+1 numbers
    e, x = F.col("_edges"), F.col(col).cast("double")
    inner_below = F.size(F.filter(e, lambda v, i: (i > 0) & (i < F.size(e) - 1) & (v < x)))
    in_range = (x >= F.element_at(e, 1)) & (x <= F.element_at(e, -1))
    idx = F.when(x.isNotNull() & in_range, inner_below)
    val = F.element_at(F.array(*[F.lit(s) for s in labels]), idx + 1) if labels is not None else idx
    return j.withColumn(out, val).drop("_edges")
