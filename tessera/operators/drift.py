"""Train/test drift, key-overlap and prior-shift audits.

Every report handles all requested columns in one scan: the frame is
unpivoted to ``(split, feature, value)`` and aggregated once.  Statistics that
need a distribution function (chi-square and KS p-values) are evaluated on the
already reduced one-row-per-feature table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import round_to
from .groups import describe_exact, unpivot
from ..session import ship_package
from .ordered import running_sums


def _is(split: str, value: str):
    return F.col(split) == F.lit(value)


def drift_missing(df: DataFrame, cols: Sequence[str], split: str = "split", a: str = "train", b: str = "test") -> DataFrame:
    """Missing share (%) of each column in each split, side by side."""
    aggs = []
    for c in cols:
        for s in (a, b):
            aggs.append(F.avg(F.when(_is(split, s), F.col(c).isNull().cast("double"))).alias(f"{c}|{s}"))
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                (F.col(f"`{c}|{a}`") * 100).alias(f"{a}_missing_pct"),
                (F.col(f"`{c}|{b}`") * 100).alias(f"{b}_missing_pct"),
            )
            for c in cols
        ]
    )
    return one.select(F.inline(rows))


def _category_counts(df: DataFrame, cols: Sequence[str], split: str) -> DataFrame:
    long = unpivot(df, [split], cols)
    return long.where(F.col("value").isNotNull()).groupBy("feature", "value", split).agg(F.count(F.lit(1)).alias("n"))


def drift_category(df: DataFrame, cols: Sequence[str], split: str = "split", a: str = "train", b: str = "test") -> DataFrame:
    """Share (%) of each category per split and the difference (one-sided shares filled with 0 first)."""
    counts = _category_counts(df, cols, split)
    wide = counts.groupBy("feature", "value").agg(
        F.sum(F.when(_is(split, a), F.col("n")).otherwise(0)).alias("_na"),
        F.sum(F.when(_is(split, b), F.col("n")).otherwise(0)).alias("_nb"),
    )
    totals = wide.groupBy("feature").agg(F.sum("_na").alias("_ta"), F.sum("_nb").alias("_tb"))
    j = wide.join(totals, ["feature"], "inner")
    pa = F.coalesce(F.try_divide(F.col("_na") * 100.0, F.col("_ta").cast("double")), F.lit(0.0))
    pb = F.coalesce(F.try_divide(F.col("_nb") * 100.0, F.col("_tb").cast("double")), F.lit(0.0))
    return j.select("feature", "value", pa.alias(f"{a}_pct"), pb.alias(f"{b}_pct"), (pb - pa).alias("diff"))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution: the regularised incomplete gamma Q(dof/2, x/2).

    The power series below the mean, Lentz's continued fraction above it, each until
    it no longer changes; the common factor is taken in log space, so any number of
    degrees of freedom is exact to rounding.
    """
    if x is None or dof is None or dof <= 0 or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    a, h = dof / 2.0, x / 2.0
    if h <= 0:
        return 1.0
    front = math.exp(-h + a * math.log(h) - math.lgamma(a))
    if h < a + 1:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= h / n
            total += term
        return max(0.0, min(1.0, 1.0 - front * total))
    tiny = 1e-300
    b = h + 1 - a
    c, d = 1 / tiny, 1 / b
    out, i, step = d, 0, 0.0
    while abs(step - 1) > 1e-16:
        i += 1
        factor = -i * (i - a)
        b += 2
        d = 1 / (factor * d + b or tiny)
        c = b + factor / c or tiny
        step = d * c
        out *= step
    return max(0.0, min(1.0, front * out))


def ks_sf(d: float, n1: int, n2: int) -> float:
    """Asymptotic two-sample KS p-value (Kolmogorov distribution with Stephens' correction).

    Small arguments take the theta-transformed series, large ones the alternating
    one; both are summed until a term no longer counts.
    """
    if d is None or not n1 or not n2:
        return float("nan")
    ne = n1 * n2 / (n1 + n2)
    lam = (math.sqrt(ne) + 0.12 + 0.11 / math.sqrt(ne)) * d
    if lam <= 0:
        return 1.0
    total, j, term = 0.0, 0, 1.0
    if lam < 1.18:
        while term > 1e-18:
            j += 1
            term = math.exp(-((2 * j - 1) ** 2) * math.pi**2 / (8 * lam * lam))
            total += term
        return max(0.0, min(1.0, 1.0 - math.sqrt(2 * math.pi) / lam * total))
    while term > 1e-18:
        j += 1
        term = math.exp(-2.0 * j * j * lam * lam)
        total += term if j % 2 else -term
    return max(0.0, min(1.0, 2.0 * total))


def ks_exact_sf(d: float, n1: int, n2: int) -> float:
    """Exact two-sample KS p-value: the share of lattice paths that stray as far as ``d`` from the diagonal.

    A path of n1 steps right and n2 steps up is one order of the pooled sample, all equally
    likely.  The chance that a path through a point has strayed by then follows from the two
    points before it, so all numbers stay between 0 and 1; points of one diagonal are done
    at once.  Distances are compared as whole numbers.  Time grows with (n1 + n2) * n1.
    """
    if not n1 or not n2:
        return float("nan")
    n1, n2 = min(n1, n2), max(n1, n2)
    least = round(d * n1 * n2)
    if least <= 0:
        return 1.0
    strayed = np.zeros(n1 + 2)  # strayed[i + 1]: at (i, t - i)
    for t in range(1, n1 + n2 + 1):
        i = np.arange(max(0, t - n2), min(n1, t) + 1)
        j = t - i
        here = (strayed[i] * i + strayed[i + 1] * j) / t  # from (i - 1, j) and (i, j - 1)
        strayed[i + 1] = np.where(np.abs(i * n2 - j * n1) >= least, 1.0, here)
    return float(min(1.0, strayed[n1 + 1]))


#: Sizes up to which KS p-values are exact.
KS_EXACT_LIMIT = 10_000


@F.pandas_udf(T.DoubleType())
def _chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(a), int(b)) if pd.notna(a) and pd.notna(b) else float("nan") for a, b in zip(x, dof)])


@F.pandas_udf(T.DoubleType())
def _ks_sf_udf(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    sf = lambda a, b, c: (ks_exact_sf if max(b, c) <= KS_EXACT_LIMIT else ks_sf)(a, b, c)
    return pd.Series([sf(float(a), int(b), int(c)) if pd.notna(a) else float("nan") for a, b, c in zip(d, n1, n2)])


def drift_chi2(
    df: DataFrame, cols: Sequence[str], split: str = "split", a: str = "train", b: str = "test",
    yates: bool = True, with_pvalue: bool = False,
) -> DataFrame:
    """Chi-square homogeneity test of each column's categories between two splits.

    Statistic as ``scipy.stats.chi2_contingency``: expected = row x column
    totals / N, Yates' continuity correction (capped at |o - e|) when dof = 1.
    All-zero rows are dropped; ``has_zero_cell`` flags tables the reference
    would have skipped.
    """
    counts = _category_counts(df.where(F.col(split).isin(a, b)), cols, split)
    cells = counts.groupBy("feature", "value").agg(
        F.sum(F.when(_is(split, a), F.col("n")).otherwise(0)).alias("_oa"),
        F.sum(F.when(_is(split, b), F.col("n")).otherwise(0)).alias("_ob"),
    )
    tot = cells.groupBy("feature").agg(
        F.sum("_oa").alias("_ta"), F.sum("_ob").alias("_tb"), F.count(F.lit(1)).alias("_r")
    )
    j = cells.join(F.broadcast(tot), ["feature"], "inner")  # one row per requested column
    n = (F.col("_ta") + F.col("_tb")).cast("double")
    row = (F.col("_oa") + F.col("_ob")).cast("double")
    dof = (F.col("_r") - 1)
    terms = []
    for o, t in (("_oa", "_ta"), ("_ob", "_tb")):
        e = row * F.col(t) / n
        diff = F.abs(F.col(o) - e)
        corr = F.least(F.lit(0.5), diff) if yates else F.lit(0.0)
        adj = F.when(dof == 1, diff - corr).otherwise(diff)
        terms.append(F.try_divide(adj * adj, e))
    j = j.withColumn("_term", terms[0] + terms[1]).withColumn(
        "_zero", ((F.col("_oa") == 0) | (F.col("_ob") == 0)).cast("int")
    )
    out = j.groupBy("feature").agg(
        F.sum("_term").alias("chi2"),
        (F.first("_r") - 1).cast("int").alias("dof"),
        F.max("_zero").alias("has_zero_cell"),
    )
    if with_pvalue:
        ship_package(df.sparkSession)
        out = out.withColumn("p_value", _chi2_sf_udf(F.col("chi2"), F.col("dof")))
    return out


def drift_ks(
    df: DataFrame, cols: Sequence[str], split: str = "split", a: str = "train", b: str = "test", with_pvalue: bool = False
) -> DataFrame:
    """Two-sample KS statistic per numeric column: max |F_a(x) - F_b(x)| over distinct x.

    The p-value is exact where both splits have at most ``KS_EXACT_LIMIT`` values, else asymptotic.
    """
    long = df.where(F.col(split).isin(a, b)).select(
        split, *[F.col(c).cast("double").alias(c) for c in cols]
    ).unpivot([split], list(cols), "feature", "x").where(F.col("x").isNotNull())
    counts = long.groupBy("feature", "x").agg(
        F.count_if(_is(split, a)).alias("ca"), F.count_if(_is(split, b)).alias("cb")
    )
    cum = running_sums(counts, ["x"], ["ca", "cb"], by=["feature"])
    tot = cum.groupBy("feature").agg(F.max("cum_ca").alias("_na"), F.max("cum_cb").alias("_nb"))
    j = cum.join(F.broadcast(tot), ["feature"], "inner")  # one row per requested column
    share = lambda c, n: F.try_divide(F.col(c).cast("double"), F.col(n).cast("double"))
    gap = F.abs(share("cum_ca", "_na") - share("cum_cb", "_nb"))  # NULL where a split has no value
    out = j.groupBy("feature").agg(
        F.max(gap).alias("ks_stat"), F.first("_na").alias(f"n_{a}"), F.first("_nb").alias(f"n_{b}")
    )
    if with_pvalue:
        ship_package(df.sparkSession)
        out = out.withColumn("p_value", _ks_sf_udf(F.col("ks_stat"), F.col(f"n_{a}"), F.col(f"n_{b}")))
    return out


def drift_numeric(df: DataFrame, cols: Sequence[str], split: str = "split") -> DataFrame:
    """Mean and exact median of each numeric column per split."""
    d = describe_exact(df, cols, [split])
    return d.select(split, F.col("column").alias("feature"), "mean", F.col("q50").alias("median"))


def drift_describe(df: DataFrame, cols: Sequence[str], split: str = "split", a: str = "train", b: str = "test") -> DataFrame:
    """describe() per split side by side with ``diff = b - a`` and ``pct = diff / a * 100``."""
    d = describe_exact(df.where(F.col(split).isin(a, b)), cols, [split])
    stats = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    long = d.select(split, "column", *[F.col(s).cast("double").alias(s) for s in stats]).unpivot(
        [split, "column"], stats, "stat", "v"
    )
    wide = long.groupBy("column", "stat").agg(
        F.max(F.when(_is(split, a), F.col("v"))).alias(a), F.max(F.when(_is(split, b), F.col("v"))).alias(b)
    )
    diff = F.col(b) - F.col(a)
    return wide.select(
        "column", "stat", a, b, diff.alias("diff"), round_to(F.try_divide(diff * 100.0, F.col(a)), 2).alias("pct_diff")
    )


def _pct(part: str, whole: str):
    """Percentage as a double; NULL of nothing."""
    return F.try_divide(F.col(part).cast("double") * 100.0, F.col(whole).cast("double"))


def key_overlap_audit(df: DataFrame, keys: Sequence[str], split: str = "split", a: str = "train", b: str = "test") -> DataFrame:
    """Per key column: distinct keys per side, common keys, overlap %, row coverage per side."""
    long = unpivot(df.where(F.col(split).isin(a, b)), [split], keys, "key", "k").where(F.col("k").isNotNull())
    per = long.groupBy("key", "k").agg(
        F.count_if(_is(split, a)).alias("_ra"), F.count_if(_is(split, b)).alias("_rb")
    )
    common = (F.col("_ra") > 0) & (F.col("_rb") > 0)
    rep = per.groupBy("key").agg(
        F.count_if(F.col("_ra") > 0).alias(f"{a}_distinct"),
        F.count_if(F.col("_rb") > 0).alias(f"{b}_distinct"),
        F.count_if(common).alias("common"),
        F.sum("_ra").alias(f"{a}_rows"),
        F.sum("_rb").alias(f"{b}_rows"),
        F.sum(F.when(common, F.col("_ra")).otherwise(0)).alias(f"{a}_rows_covered"),
        F.sum(F.when(common, F.col("_rb")).otherwise(0)).alias(f"{b}_rows_covered"),
    )
    return rep.withColumns(
        {
            "overlap_pct": _pct("common", f"{b}_distinct"),
            f"{a}_coverage_pct": _pct(f"{a}_rows_covered", f"{a}_rows"),
            f"{b}_coverage_pct": _pct(f"{b}_rows_covered", f"{b}_rows"),
        }
    )


def leak_risk(
    audit: DataFrame,
    limits: dict[str, tuple[float, float]] | None = None,
    cv_score: float | None = None,
    cv_limits: tuple[float, float] = (0.95, 0.90),
    b: str = "test",
) -> DataFrame:
    """Risk that features by key, or the CV score, promise more than split ``b`` will keep.

    ``(factor, value, risk, overall_risk)``: a key whose groups cover few rows of ``b`` is
    risky (below the first limit, a share, HIGH; below the second MEDIUM; ``limits`` by key,
    else 0.3 and 0.5), and so is a CV score that is too good (above the first limit HIGH,
    above the second MEDIUM).  A key without rows in ``b`` is UNKNOWN.  Overall HIGH if any
    factor is.
    """
    value = F.col(f"{b}_coverage_pct") / 100.0
    low, middle = F.lit(0.3), F.lit(0.5)
    for key, (lo, mid) in (limits or {}).items():
        low = F.when(F.col("key") == key, lo).otherwise(low)
        middle = F.when(F.col("key") == key, mid).otherwise(middle)
    risk = F.when(value.isNull(), "UNKNOWN").when(value < low, "HIGH").when(value < middle, "MEDIUM").otherwise("LOW")
    out = audit.select(F.col("key").alias("factor"), value.alias("value"), risk.alias("risk"))
    if cv_score is not None:
        level = "HIGH" if cv_score > cv_limits[0] else "MEDIUM" if cv_score > cv_limits[1] else "LOW"
        row = [("cv_score", float(cv_score), level)]
        out = out.unionByName(audit.sparkSession.createDataFrame(row, "factor string, value double, risk string"))
    overall = out.agg(F.when(F.count_if(F.col("risk") == "HIGH") > 0, "HIGH").otherwise("LOW").alias("overall_risk"))
    return out.crossJoin(F.broadcast(overall))  # one row


def expected_rate(df: DataFrame, cat: str, target: str, split: str = "split", a: str = "train", b: str = "test") -> DataFrame:
    """Expected target rate under each split's category mix (train rates), and the shift."""
    rates = df.where(_is(split, a) & F.col(target).isNotNull() & F.col(cat).isNotNull()).groupBy(cat).agg(
        F.avg(F.col(target).cast("double")).alias("_rate")
    )
    counts = df.where(F.col(split).isin(a, b) & F.col(cat).isNotNull()).groupBy(cat).agg(
        F.count_if(_is(split, a)).alias("_ca"), F.count_if(_is(split, b)).alias("_cb")
    )
    j = counts.join(rates, [cat], "inner")
    tot = counts.agg(F.sum("_ca").alias("_ta"), F.sum("_cb").alias("_tb"))
    r = j.crossJoin(F.broadcast(tot)).agg(  # one-row totals
        F.sum(F.try_divide(F.col("_ca").cast("double"), F.col("_ta")) * F.col("_rate")).alias(f"expected_{a}"),
        F.sum(F.try_divide(F.col("_cb").cast("double"), F.col("_tb")) * F.col("_rate")).alias(f"expected_{b}"),
    )
    return r.withColumn("shift", F.col(f"expected_{b}") - F.col(f"expected_{a}"))


def adjusted_threshold(shift: DataFrame, best: DataFrame, col: str, lo: float = 0.4, hi: float = 0.6) -> DataFrame:
    """Prior-shift threshold: ``best + shift`` clipped to ``[lo, hi]``; ``best`` is one row with ``col``."""
    clipped = F.least(F.lit(hi), F.greatest(F.lit(lo), F.col(col) + F.col("shift")))
    return shift.crossJoin(F.broadcast(best.select(col))).select("shift", clipped.alias("adjusted_threshold"))


def split_profile(df: DataFrame, alone_col: str, size_col: str, split: str = "split") -> DataFrame:
    """Share of rows alone (``alone_col == 1``) and mean group size per split."""
    return df.groupBy(split).agg(
        F.avg(F.col(alone_col).cast("double")).alias("alone_share"),
        F.avg(F.col(size_col).cast("double")).alias("mean_group_size"),
        F.count(F.lit(1)).alias("n"),
    )
