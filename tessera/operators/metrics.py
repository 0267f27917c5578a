"""Classification metrics computed as aggregations, never by collecting scores.

* AUC / ROC: scores are first reduced to distinct values with positive and
  negative counts (map-side combined), then cumulated in score order with a
  range-partitioned running sum.
* Threshold sweeps: one pass builds a score histogram over the (bounded)
  threshold grid; all thresholds are then suffix sums on that tiny table
  (no loop of scans, no cross join with the rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_sums


def accuracy_by_fold(df: DataFrame, y: str, pred: str, fold: str = "fold") -> DataFrame:
    """Accuracy per fold plus the overall row (fold NULL) via ``rollup``."""
    return df.rollup(fold).agg(
        F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def _score_counts(df: DataFrame, y: str, score: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by, score).agg(
        F.sum(F.col(y).cast("long")).alias("pos"),
        F.sum((1 - F.col(y)).cast("long")).alias("neg"),
    )


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC with ties counted one half; one row per ``by`` group.

    AUC = 1 - (sum(neg_s * cumpos_s) - sum(neg_s * pos_s) / 2) / (P * N), where
    ``cumpos_s`` counts positives with score <= s.
    """
    by = list(by)
    counts = _score_counts(df.where(F.col(y).isNotNull() & F.col(score).isNotNull()), y, score, by)
    cum = running_sums(counts, [score], ["pos"], by)
    agg = cum.groupBy(*by).agg(
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.sum(F.col("neg").cast("double") * F.col("cum_pos")).alias("_a"),
        F.sum(F.col("neg").cast("double") * F.col("pos")).alias("_t"),
    )
    auc = F.lit(1.0) - F.try_divide(F.col("_a") - F.col("_t") / 2.0, F.col("P").cast("double") * F.col("N"))
    return agg.select(*by, auc.alias("auc"), F.col("P").alias("n_pos"), F.col("N").alias("n_neg"))


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """``(threshold, fpr, tpr)`` for ``score >= threshold``: a (0, 0) start point at
    +inf, then one point per distinct score (collinear points are kept)."""
    counts = _score_counts(df.where(F.col(y).isNotNull() & F.col(score).isNotNull()), y, score, [])
    # Cumulate from the top: order by the negated score.
    keyed = counts.withColumn("_neg_s", -F.col(score))
    cum = running_sums(keyed, ["_neg_s"], ["pos", "neg"])
    totals = counts.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    points = cum.crossJoin(F.broadcast(totals)).select(  # one-row totals
        F.col(score).cast("double").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("_N").cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("_P").cast("double")).alias("tpr"),
    )
    # scikit-learn's first point: nothing predicted positive, threshold +inf.
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(points)


def youden_threshold(df: DataFrame, y: str, score: str) -> DataFrame:
    """Threshold maximising ``tpr - fpr``; the highest threshold among ties."""
    curve = roc_curve(df, y, score).withColumn("youden_j", F.col("tpr") - F.col("fpr"))
    return curve.orderBy(F.col("youden_j").desc(), F.col("threshold").desc()).limit(1)


def grid_bucket(score, lo: int, hi: int, scale: int = 100, inclusive: bool = True):
    """Largest grid index ``i`` in ``[lo - 1, hi]`` with ``i / scale <= p`` (``<`` if not inclusive).

    ``floor(p * scale)`` can be off by one in floating point; the bucket is
    corrected by comparing with the exact grid values ``i / scale`` -- the same
    doubles the sweep compares against -- so ``p >= t_i`` iff ``bucket >= i``.
    """
    p = F.col(score)
    s = F.lit(scale)
    if inclusive:
        b0 = F.floor(p * s)
        b = F.when(b0 / s > p, b0 - 1).when((b0 + 1) / s <= p, b0 + 1).otherwise(b0)
    else:
        b0 = F.ceil(p * s) - 1
        b = F.when(b0 / s >= p, b0 - 1).when((b0 + 1) / s < p, b0 + 1).otherwise(b0)
    return F.greatest(F.lit(lo - 1), F.least(F.lit(hi), b)).cast("int")


def threshold_sweep(
    df: DataFrame, y: str, score: str, lo: int = 30, hi: int = 70, scale: int = 100, inclusive: bool = True
) -> DataFrame:
    """Accuracy / precision / recall / F1 at every grid threshold ``i / scale``.

    One pass over the rows: a score histogram over at most ``hi - lo + 2``
    clamped grid buckets (map-side combined), then suffix sums on that tiny
    table against the grid.  Returns ``(grid_pos, threshold, tp, pred_pos,
    accuracy, precision, recall, f1)``.
    """
    spark = df.sparkSession
    yy = F.col(y)
    hist = (
        df.where(yy.isNotNull() & F.col(score).isNotNull())
        .groupBy(grid_bucket(score, lo, hi, scale, inclusive).alias("_b"))
        .agg(F.count(F.lit(1)).alias("_cnt"), F.sum(yy.cast("long")).alias("_pos"))
    )
    grid = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("grid_pos"))
    grid = grid.withColumn("threshold", F.col("grid_pos") / F.lit(scale))
    hit = F.col("_b") >= F.col("grid_pos")
    k = F.broadcast(grid).crossJoin(hist).groupBy("grid_pos", "threshold").agg(  # (hi-lo+1) x (hi-lo+2) rows
        F.sum(F.when(hit, F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("_cnt")).otherwise(0)).alias("pred_pos"),
        F.sum("_cnt").alias("_n"),
        F.sum("_pos").alias("_P"),
    )
    tp, pp, n, P = F.col("tp"), F.col("pred_pos"), F.col("_n"), F.col("_P")
    return k.select(
        "grid_pos",
        "threshold",
        "tp",
        "pred_pos",
        ((2 * tp + n - pp - P).cast("double") / n).alias("accuracy"),
        F.coalesce(F.try_divide(tp.cast("double"), pp.cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp.cast("double"), P.cast("double")), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide((2 * tp).cast("double"), (pp + P).cast("double")), F.lit(0.0)).alias("f1"),
    )


def best_threshold(sweep: DataFrame, base: float = 0.5) -> DataFrame:
    """One row: best threshold by accuracy and by F1 (first on ties), baseline and gain."""
    best_acc = F.min_by(F.struct("threshold", "accuracy"), F.struct(-F.col("accuracy"), F.col("grid_pos")))
    best_f1 = F.min_by(F.struct("threshold", "f1"), F.struct(-F.col("f1"), F.col("grid_pos")))
    base_acc = F.max(F.when(F.abs(F.col("threshold") - base) < 1e-9, F.col("accuracy")))
    s = sweep.agg(best_acc.alias("_ba"), best_f1.alias("_bf"), base_acc.alias("base_accuracy"))
    return s.select(
        F.col("_ba.threshold").alias("best_acc_threshold"),
        F.col("_ba.accuracy").alias("best_accuracy"),
        F.col("_bf.threshold").alias("best_f1_threshold"),
        F.col("_bf.f1").alias("best_f1"),
        "base_accuracy",
        (F.col("_ba.accuracy") - F.col("base_accuracy")).alias("gain"),
    )


def changed_predictions(df: DataFrame, score: str, t1: float, t2: float) -> DataFrame:
    a, b = F.col(score) >= t1, F.col(score) >= t2
    return df.agg(F.count_if(a != b).alias("n_changed"), F.count(F.lit(1)).alias("n"))


def prediction_agreement(a: DataFrame, b: DataFrame, key: str, label: str = "label", prob: str | None = None) -> DataFrame:
    """Agreement report of two prediction tables aligned on ``key`` (not row order).

    ``n`` counts the keys in both tables, ``n_only_a`` and ``n_only_b`` the rows that
    only one has; those neither agree nor disagree.
    """
    j = a.select(key, F.lit(1).alias("_ia"), F.col(label).alias("_la"), *([F.col(prob).alias("_pa")] if prob else [])).join(
        b.select(key, F.lit(1).alias("_ib"), F.col(label).alias("_lb"), *([F.col(prob).alias("_pb")] if prob else [])),
        [key],
        "full",
    )
    agree = F.col("_la") == F.col("_lb")
    aggs = [
        F.count_if(F.col("_ia").isNotNull() & F.col("_ib").isNotNull()).alias("n"),
        F.count_if(F.col("_ib").isNull()).alias("n_only_a"),
        F.count_if(F.col("_ia").isNull()).alias("n_only_b"),
        F.count_if(agree).alias("n_agree"),
        F.count_if(~agree).alias("n_disagree"),
        F.count_if((F.col("_la") == 1) & (F.col("_lb") == 0)).alias("a1_b0"),
        F.count_if((F.col("_la") == 0) & (F.col("_lb") == 1)).alias("a0_b1"),
    ]
    if prob:
        d = F.abs(F.col("_pa") - F.col("_pb"))
        aggs += [
            F.avg(d).alias("abs_diff_mean"),
            F.max(d).alias("abs_diff_max"),
            F.stddev_samp(d).alias("abs_diff_std"),
            F.avg(F.when(~agree, d)).alias("abs_diff_mean_disagree"),
        ]
    out = j.agg(*aggs)
    pct = lambda c: F.try_divide(F.col(c).cast("double") * 100.0, F.col("n").cast("double"))
    return out.withColumn("agree_pct", pct("n_agree")).withColumn("disagree_pct", pct("n_disagree"))


def agreement_band(disagree_pct: Column, minor: float = 5.0) -> Column:
    return F.when(disagree_pct == 0, "identical").when(disagree_pct < minor, "minor").otherwise("major")


def blend_grid(df: DataFrame, y: str, a: str, b: str, steps: int = 20, threshold: float = 0.5) -> DataFrame:
    """Accuracy of ``w * a + (1 - w) * b`` for ``w = i / steps``, all weights in ONE aggregation."""
    aggs = []
    for i in range(steps + 1):
        w, rest = i / steps, (steps - i) / steps
        blended = F.lit(w) * F.col(a) + F.lit(rest) * F.col(b)
        hit = (blended >= threshold).cast("int") == F.col(y)
        aggs.append(F.avg(hit.cast("double")).alias(f"_acc{i}"))
    one = df.where(F.col(y).isNotNull()).agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("grid_pos"), F.lit(i / steps).alias("weight"), F.col(f"_acc{i}").alias("accuracy"))
            for i in range(steps + 1)
        ]
    )
    # The first weight with the highest accuracy wins (a strict ">" search).
    best = F.min_by(F.col("_r.grid_pos"), F.struct(-F.col("_r.accuracy"), F.col("_r.grid_pos")))
    table = one.select(F.explode(rows).alias("_r"))
    pick = table.agg(best.alias("_best"))
    return table.crossJoin(pick).select(  # one-row pick
        "_r.grid_pos", "_r.weight", "_r.accuracy", (F.col("_r.grid_pos") == F.col("_best")).alias("is_best")
    )
