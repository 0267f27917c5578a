"""Encodings, folds, metrics, drift audits and score-level compositions
(B3-B6, E*, F1-F3, M*, G*, L7, L8, L12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import binning as bn
from ..operators import drift as dr
from ..operators import encode as en
from ..operators import folds as fo
from ..operators import groups as gr
from ..operators import metrics as me
from .registry import register
from .tables import cases, docs, scores

# ---------------------------------------------------------------- B3-B6: fitted bins


@register(
    "bin_equal_width",
    """SELECT id, CAST(least(9, greatest(0, ceil((price - s.mn) / ((s.mx - s.mn) / 10)) - 1)) AS INTEGER) AS price_bin
       FROM cases CROSS JOIN (SELECT min(price) AS mn, max(price) AS mx FROM cases) s""",
)
def bin_equal_width(spark, d):
    """10 equal-width bins over min..max (min in bin 0, right-closed)."""
    return bn.equal_width_bins(cases(spark, d), "price", 10, "price_bin").select("id", "price_bin")


_QLABELS = ["VeryLow", "Low", "Med", "High", "VeryHigh"]


@register(
    "bin_quantile",
    """WITH e AS (SELECT list_sort(list_distinct(quantile_cont(price, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM cases)
       SELECT id, CASE WHEN price < e[1] OR price > e[len(e)] OR price IS NULL THEN NULL
                  ELSE (['VeryLow', 'Low', 'Med', 'High', 'VeryHigh'])[len(list_filter(e[2:len(e) - 1], lambda v: v < price)) + 1]
                  END AS price_bin
       FROM cases CROSS JOIN e""",
)
def bin_quantile(spark, d):
    """Exact quantile edges, right-closed, lowest included, labelled."""
    return bn.quantile_bins(cases(spark, d), "price", 5, "price_bin", labels=_QLABELS).select("id", "price_bin")


@register(
    "bin_quantile_dedup",
    """WITH e AS (SELECT list_sort(list_distinct(quantile_cont(pclass, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
                  FROM cases)
       SELECT id, CASE WHEN pclass < e[1] OR pclass > e[len(e)] OR pclass IS NULL THEN NULL
                  ELSE CAST(len(list_filter(e[2:len(e) - 1], lambda v: v < pclass)) AS INTEGER) END AS class_bin
       FROM cases CROSS JOIN e""",
)
def bin_quantile_dedup(spark, d):
    """Deciles on a tied column; duplicate edges dropped, equal values never split."""
    return bn.quantile_bins(cases(spark, d), "pclass", 10, "class_bin").select("id", "class_bin")


@register(
    "bin_quantile_per_split",
    """WITH e AS (SELECT split, list_sort(list_distinct(quantile_cont(price, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS e
                  FROM cases GROUP BY split)
       SELECT c.id, CAST(len(list_filter(e.e[2:len(e.e) - 1], lambda v: v < c.price)) AS INTEGER) AS price_q,
              CAST(c.pclass AS VARCHAR) || '_' || CAST(len(list_filter(e.e[2:len(e.e) - 1], lambda v: v < c.price)) AS VARCHAR)
                AS class_price_q
       FROM cases c JOIN e ON c.split = e.split""",
)
def bin_quantile_per_split(spark, d):
    """Quartile edges fitted per split, then a string interaction."""
    out = bn.quantile_bins(cases(spark, d), "price", 4, "price_q", by=["split"])
    return out.select("id", "price_q", fx.string_interaction("pclass", "price_q").alias("class_price_q"))


# ---------------------------------------------------------------- E: encodings

_TE_STATS = """
te_f AS (
  SELECT 'segment' AS feature, CAST(segment AS VARCHAR) AS value, fold, CAST(sum(y) AS DOUBLE) AS s, count(*) AS n
  FROM scores WHERE y IS NOT NULL GROUP BY 2, 3
  UNION ALL
  SELECT 'nation', CAST(nation AS VARCHAR), fold, CAST(sum(y) AS DOUBLE), count(*)
  FROM scores WHERE y IS NOT NULL GROUP BY 2, 3),
te_t AS (SELECT feature, value, sum(s) AS s, sum(n) AS n FROM te_f GROUP BY feature, value),
prior AS (SELECT avg(y) AS p FROM scores WHERE y IS NOT NULL)"""


def _te_sql(expr_labelled: str) -> str:
    parts = []
    for col in ("segment", "nation"):
        e = expr_labelled.format(t=f"t_{col}", f=f"f_{col}")
        parts.append(
            f"COALESCE(CASE WHEN c.y IS NOT NULL THEN {e} ELSE t_{col}.s / t_{col}.n END, prior.p) AS {col}_te"
        )
    joins = []
    for col in ("segment", "nation"):
        joins.append(
            f"LEFT JOIN te_t t_{col} ON t_{col}.feature = '{col}' AND t_{col}.value = CAST(c.{col} AS VARCHAR)"
        )
        joins.append(
            f"LEFT JOIN te_f f_{col} ON f_{col}.feature = '{col}' AND f_{col}.value = CAST(c.{col} AS VARCHAR)"
            f" AND f_{col}.fold = c.fold"
        )
    return (
        f"WITH {_TE_STATS.strip()}\nSELECT c.id, {', '.join(parts)}\n"
        f"FROM scores c CROSS JOIN prior {' '.join(joins)}"
    )


@register("target_encode_full", _te_sql("{t}.s / {t}.n"), ["segment_te", "nation_te"])
def target_encode_full(spark, d):
    """Leaky mean over all labelled rows, prior for unseen values; many columns, one groupBy."""
    out = en.target_encode(scores(spark, d), "y", ["segment", "nation"], mode="full")
    return out.select("id", "segment_te", "nation_te")


@register(
    "target_encode_kfold",
    _te_sql("({t}.s - COALESCE({f}.s, 0)) / NULLIF({t}.n - COALESCE({f}.n, 0), 0)"),
    ["segment_te", "nation_te"],
)
def target_encode_kfold(spark, d):
    """Labelled rows see the other folds only (total minus own fold, one pass)."""
    out = en.target_encode(scores(spark, d), "y", ["segment", "nation"], mode="kfold", fold="fold")
    return out.select("id", "segment_te", "nation_te")


@register(
    "target_encode_loo",
    _te_sql("({t}.s - c.y) / NULLIF({t}.n - 1, 0)"),
    ["segment_te", "nation_te"],
)
def target_encode_loo(spark, d):
    """Leave-one-out mean for labelled rows."""
    out = en.target_encode(scores(spark, d), "y", ["segment", "nation"], mode="loo")
    return out.select("id", "segment_te", "nation_te")


@register(
    "target_encode_ordered",
    """WITH prior AS (SELECT avg(y) AS p FROM scores WHERE y IS NOT NULL),
       tot AS (SELECT segment, CAST(sum(y) AS DOUBLE) AS s, count(*) AS n FROM scores WHERE y IS NOT NULL GROUP BY segment),
       o AS (SELECT id, avg(y) OVER (PARTITION BY segment ORDER BY md5('42|' || CAST(id AS VARCHAR)), id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ts
             FROM scores WHERE y IS NOT NULL AND segment IS NOT NULL)
       SELECT c.id, COALESCE(CASE WHEN c.y IS NOT NULL THEN o.ts ELSE tot.s / tot.n END, prior.p) AS segment_te
       FROM scores c CROSS JOIN prior LEFT JOIN o ON c.id = o.id LEFT JOIN tot ON c.segment = tot.segment""",
    ["segment_te"],
)
def target_encode_ordered(spark, d):
    """E5: ordered target statistic (earlier labelled rows in a seeded hash order)."""
    out = en.target_encode(scores(spark, d), "y", ["segment"], mode="ordered", seed=42, id_col="id")
    return out.select("id", "segment_te")


@register(
    "group_target_stats",
    """SELECT c.id, COALESCE(g.m, 0.5) AS cust_mean, COALESCE(g.k, 0) AS cust_known, COALESCE(g.sd, 0.0) AS cust_std
       FROM cases c LEFT JOIN (SELECT cust, avg(y) AS m, count(y) AS k, stddev_samp(y) AS sd FROM cases GROUP BY cust) g
       ON c.cust = g.cust""",
    ["cust_mean", "cust_std"],
)
def group_target_stats(spark, d):
    """Group target mean / known-label count / std with defaults."""
    out = en.group_target_stats(cases(spark, d), "y", "cust", "cust")
    return out.select("id", "cust_mean", "cust_known", "cust_std")


@register(
    "label_encode",
    """SELECT id, CAST(dense_rank() OVER (ORDER BY COALESCE(CAST(priority AS VARCHAR), 'nan')) - 1 AS INTEGER) AS priority_code
       FROM cases""",
)
def label_encode(spark, d):
    """Sorted distinct text values -> 0..k-1."""
    coded = en.label_encode(cases(spark, d), "priority", "priority_code")
    return coded.select("id", F.col("priority_code").cast("int").alias("priority_code"))


@register(
    "category_codes",
    """SELECT id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS lang_code,
              CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS source_code
       FROM docs""",
)
def category_codes(spark, d):
    """One dictionary per column fitted on both splits; NULL -> -1."""
    coded = en.category_codes(docs(spark, d), ["lang", "source"])
    return coded.select("id", *[F.col(c).cast("int").alias(c) for c in ("lang_code", "source_code")])


# ---------------------------------------------------------------- F: folds


STRAT_SQL = """SELECT id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5('42|' || CAST(id AS VARCHAR)), id) - 1) % 5
                  AS INTEGER) AS fold FROM cases WHERE split = 'train'"""


@register("stratified_fold", STRAT_SQL)
def stratified_fold(spark, d):
    """exact stratified round-robin folds over a seeded hash order."""
    train = cases(spark, d).where(F.col("split") == "train").select("id", "y")
    return fo.stratified_fold(train, "y", "id", 5, 42)


@register(
    "hash_fold",
    "SELECT id, fold FROM scores",
)
def hash_fold(spark, d):
    """scalable hash folds (no ordering)."""
    return fo.hash_fold(cases(spark, d).select("id"), "id", 5, 42)


@register(
    "fold_balance",
    f"SELECT fold, y, count(*) AS n FROM ({STRAT_SQL}) f GROUP BY fold, y",
)
def fold_balance(spark, d):
    """class balance of every fold."""
    train = cases(spark, d).where(F.col("split") == "train").select("id", "y")
    return fo.fold_balance(fo.stratified_fold(train, "y", "id", 5, 42), "y")


# ---------------------------------------------------------------- M: metrics


def _train_scores(spark, d):
    return scores(spark, d).where(F.col("split") == "train")


@register(
    "accuracy_by_fold",
    """SELECT fold, avg(CAST(y = CAST(p_a >= 0.5 AS INTEGER) AS DOUBLE)) AS accuracy, count(*) AS n
       FROM scores WHERE split = 'train' GROUP BY ROLLUP (fold)""",
    ["accuracy"],
)
def accuracy_by_fold(spark, d):
    """Accuracy per fold plus the overall row (fold NULL)."""
    s = _train_scores(spark, d).withColumn("pred", fx.binarize("p_a"))
    return me.accuracy_by_fold(s, "y", "pred", "fold")


_AUC_SQL = """
WITH sc AS (SELECT 'a' AS model, p_a AS s, y FROM scores WHERE split = 'train'
            UNION ALL SELECT 'b', p_b, y FROM scores WHERE split = 'train'),
c AS (SELECT model, s, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY model, s),
cu AS (SELECT model, s, pos, neg, sum(pos) OVER (PARTITION BY model ORDER BY s ROWS UNBOUNDED PRECEDING) AS cp FROM c)
SELECT model,
       1.0 - (sum(CAST(neg AS DOUBLE) * cp) - sum(CAST(neg AS DOUBLE) * pos) / 2.0)
             / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM cu GROUP BY model"""


def _model_long(spark, d):
    s = _train_scores(spark, d)
    return s.select("id", "y", "fold", F.lit("a").alias("model"), F.col("p_a").alias("s")).unionByName(
        s.select("id", "y", "fold", F.lit("b").alias("model"), F.col("p_b").alias("s"))
    )


@register("roc_auc", _AUC_SQL, ["auc"])
def roc_auc(spark, d):
    """M3: exact ROC AUC (ties count one half) for two score columns."""
    return me.roc_auc(_model_long(spark, d), "y", "s", ["model"])


@register(
    "roc_auc_by_fold",
    """WITH c AS (SELECT fold, p_a AS s, sum(y) AS pos, sum(1 - y) AS neg FROM scores WHERE split = 'train' GROUP BY fold, p_a),
       cu AS (SELECT fold, s, pos, neg, sum(pos) OVER (PARTITION BY fold ORDER BY s ROWS UNBOUNDED PRECEDING) AS cp FROM c)
       SELECT fold, 1.0 - (sum(CAST(neg AS DOUBLE) * cp) - sum(CAST(neg AS DOUBLE) * pos) / 2.0)
                    / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
              CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
       FROM cu GROUP BY fold""",
    ["auc"],
)
def roc_auc_by_fold(spark, d):
    """AUC per fold."""
    return me.roc_auc(_train_scores(spark, d), "y", "p_a", ["fold"])


_ROC_SQL = """
WITH c AS (SELECT p_b AS s, sum(y) AS pos, sum(1 - y) AS neg FROM scores WHERE split = 'train' GROUP BY p_b),
cu AS (SELECT s, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
              sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp,
              sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM c)
SELECT CAST(s AS DOUBLE) AS threshold, CAST(fp AS DOUBLE) / CAST(n AS DOUBLE) AS fpr, CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) AS tpr FROM cu
UNION ALL SELECT CAST('infinity' AS DOUBLE), 0.0, 0.0"""


@register("roc_curve", _ROC_SQL, ["threshold", "fpr", "tpr"])
def roc_curve(spark, d):
    """M4: ROC points for every distinct score."""
    return me.roc_curve(_train_scores(spark, d), "y", "p_b")


@register(
    "youden_threshold",
    f"SELECT threshold, fpr, tpr, tpr - fpr AS youden_j FROM ({_ROC_SQL}) r ORDER BY tpr - fpr DESC, threshold DESC LIMIT 1",
    ["threshold", "fpr", "tpr", "youden_j"],
)
def youden_threshold(spark, d):
    """M5: threshold maximising tpr - fpr."""
    return me.youden_threshold(_train_scores(spark, d), "y", "p_b")


_SWEEP_SQL = """
WITH g AS (SELECT CAST(i AS INTEGER) AS grid_pos, i / 100 AS threshold FROM generate_series(30, 70) t(i)),
tot AS (SELECT count(*) AS n, sum(y) AS p FROM scores WHERE split = 'train'),
k AS (SELECT g.grid_pos, g.threshold,
             count(*) FILTER (WHERE s.p_a >= g.threshold AND s.y = 1) AS tp,
             count(*) FILTER (WHERE s.p_a >= g.threshold) AS pred_pos
      FROM g CROSS JOIN (SELECT p_a, y FROM scores WHERE split = 'train') s GROUP BY g.grid_pos, g.threshold)
SELECT grid_pos, threshold, tp, pred_pos,
       CAST(2 * tp + tot.n - pred_pos - tot.p AS DOUBLE) / tot.n AS accuracy,
       COALESCE(CAST(tp AS DOUBLE) / NULLIF(pred_pos, 0), 0.0) AS precision,
       COALESCE(CAST(tp AS DOUBLE) / NULLIF(tot.p, 0), 0.0) AS recall,
       COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(pred_pos + tot.p, 0), 0.0) AS f1
FROM k CROSS JOIN tot"""


def _sweep(spark, d):
    return me.threshold_sweep(_train_scores(spark, d), "y", "p_a", 30, 70)


@register("threshold_sweep", _SWEEP_SQL, ["threshold", "accuracy", "precision", "recall", "f1"])
def threshold_sweep(spark, d):
    """M2/M6/M7: accuracy, precision, recall, F1 at 41 thresholds in one aggregation pass."""
    return _sweep(spark, d)


@register(
    "best_threshold",
    f"""WITH sw AS ({_SWEEP_SQL})
        SELECT (SELECT threshold FROM sw ORDER BY accuracy DESC, grid_pos LIMIT 1) AS best_acc_threshold,
               (SELECT accuracy FROM sw ORDER BY accuracy DESC, grid_pos LIMIT 1) AS best_accuracy,
               (SELECT threshold FROM sw ORDER BY f1 DESC, grid_pos LIMIT 1) AS best_f1_threshold,
               (SELECT f1 FROM sw ORDER BY f1 DESC, grid_pos LIMIT 1) AS best_f1,
               (SELECT accuracy FROM sw WHERE grid_pos = 50) AS base_accuracy,
               (SELECT accuracy FROM sw ORDER BY accuracy DESC, grid_pos LIMIT 1)
                 - (SELECT accuracy FROM sw WHERE grid_pos = 50) AS gain""",
    ["best_acc_threshold", "best_accuracy", "best_f1_threshold", "best_f1", "base_accuracy", "gain"],
)
def best_threshold(spark, d):
    """Best threshold by accuracy and by F1 (first on ties), baseline at 0.5, gain."""
    return me.best_threshold(_sweep(spark, d), 0.5)


@register(
    "nearest_row",
    f"SELECT grid_pos, threshold, accuracy FROM ({_SWEEP_SQL}) sw ORDER BY abs(threshold - 0.5), grid_pos LIMIT 1",
    ["threshold", "accuracy"],
)
def nearest_row(spark, d):
    """Grid row nearest a value."""
    sw = _sweep(spark, d)
    return sw.orderBy(F.abs(F.col("threshold") - 0.5), "grid_pos").limit(1).select("grid_pos", "threshold", "accuracy")


@register(
    "changed_predictions",
    """SELECT CAST(count_if((p_a >= 0.5) <> (p_a >= 0.44)) AS BIGINT) AS n_changed, count(*) AS n
       FROM scores WHERE split = 'test'""",
)
def changed_predictions(spark, d):
    """M8: predictions that change between two thresholds."""
    return me.changed_predictions(scores(spark, d).where(F.col("split") == "test"), "p_a", 0.5, 0.44)


_AGREE_SQL = """
WITH j AS (SELECT CAST(p_a >= 0.5 AS INTEGER) AS la, CAST(p_b >= 0.5 AS INTEGER) AS lb, p_a AS pa, p_b AS pb
           FROM scores WHERE split = 'test')
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_only_a, CAST(0 AS BIGINT) AS n_only_b, CAST(count_if(la = lb) AS BIGINT) AS n_agree, CAST(count_if(la <> lb) AS BIGINT) AS n_disagree,
       CAST(count_if(la = 1 AND lb = 0) AS BIGINT) AS a1_b0, CAST(count_if(la = 0 AND lb = 1) AS BIGINT) AS a0_b1,
       avg(abs(pa - pb)) AS abs_diff_mean, max(abs(pa - pb)) AS abs_diff_max, stddev_samp(abs(pa - pb)) AS abs_diff_std,
       avg(CASE WHEN la <> lb THEN abs(pa - pb) END) AS abs_diff_mean_disagree,
       count_if(la = lb) * 100.0 / count(*) AS agree_pct, count_if(la <> lb) * 100.0 / count(*) AS disagree_pct
FROM j"""
_AGREE_D = ["abs_diff_mean", "abs_diff_max", "abs_diff_std", "abs_diff_mean_disagree", "agree_pct", "disagree_pct"]


def _agreement(spark, d):
    """Two prediction tables are written as CSV, re-read and aligned on the key."""
    from ..sources import frames as fr

    s = scores(spark, d).where(F.col("split") == "test")
    tables = []
    for score in ("p_a", "p_b"):
        pred = s.select("id", fx.binarize(score).alias("label"), F.col(score).alias("p"))
        path = fr.output_path(spark, f"predictions_{score}")
        pred.write.mode("overwrite").option("header", True).csv(path)
        tables.append(fr.read_csv(spark, path, "id BIGINT, label INT, p DOUBLE"))
    return me.prediction_agreement(tables[0], tables[1], "id", "label", "p")


@register("prediction_agreement", _AGREE_SQL, _AGREE_D)
def prediction_agreement(spark, d):
    """Agreement of two prediction tables aligned on the key."""
    return _agreement(spark, d)


@register(
    "agreement_band",
    f"""SELECT disagree_pct, CASE WHEN disagree_pct = 0 THEN 'identical' WHEN disagree_pct < 5 THEN 'minor'
                               ELSE 'major' END AS band FROM ({_AGREE_SQL}) a""",
    ["disagree_pct"],
)
def agreement_band(spark, d):
    """Disagreement band."""
    a = _agreement(spark, d)
    return a.select("disagree_pct", me.agreement_band(F.col("disagree_pct")).alias("band"))


# ---------------------------------------------------------------- G: drift and leakage


@register(
    "drift_missing",
    """SELECT 'balance' AS feature,
              avg(CASE WHEN split = 'train' THEN CAST(balance IS NULL AS DOUBLE) END) * 100 AS train_missing_pct,
              avg(CASE WHEN split = 'test' THEN CAST(balance IS NULL AS DOUBLE) END) * 100 AS test_missing_pct FROM cases
       UNION ALL
       SELECT 'price', avg(CASE WHEN split = 'train' THEN CAST(price IS NULL AS DOUBLE) END) * 100,
              avg(CASE WHEN split = 'test' THEN CAST(price IS NULL AS DOUBLE) END) * 100 FROM cases""",
    ["train_missing_pct", "test_missing_pct"],
)
def drift_missing(spark, d):
    """G1: missing share per column and split."""
    return dr.drift_missing(cases(spark, d), ["balance", "price"])


def _cat_counts_sql(cols):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, "
        f"count_if(split = 'train') AS na, count_if(split = 'test') AS nb FROM cases "
        f"WHERE {c} IS NOT NULL AND split IN ('train', 'test') GROUP BY {c}"
        for c in cols
    )


@register(
    "drift_category",
    f"""WITH w AS ({_cat_counts_sql(['segment', 'priority'])}),
        t AS (SELECT feature, sum(na) AS ta, sum(nb) AS tb FROM w GROUP BY feature)
        SELECT w.feature, w.value, COALESCE(w.na * 100.0 / t.ta, 0.0) AS train_pct, COALESCE(w.nb * 100.0 / t.tb, 0.0) AS test_pct,
               COALESCE(w.nb * 100.0 / t.tb, 0.0) - COALESCE(w.na * 100.0 / t.ta, 0.0) AS diff
        FROM w JOIN t ON w.feature = t.feature""",
    ["train_pct", "test_pct", "diff"],
)
def drift_category(spark, d):
    """Category shares per split side by side, one-sided shares filled first."""
    return dr.drift_category(cases(spark, d), ["segment", "priority"])


@register(
    "align_distributions",
    f"""WITH w AS ({_cat_counts_sql(['lang'])} ),
        t AS (SELECT feature, sum(na) AS ta, sum(nb) AS tb FROM w GROUP BY feature)
        SELECT w.feature, w.value, COALESCE(w.na * 100.0 / t.ta, 0.0) AS train_pct, COALESCE(w.nb * 100.0 / t.tb, 0.0) AS test_pct,
               COALESCE(w.nb * 100.0 / t.tb, 0.0) - COALESCE(w.na * 100.0 / t.ta, 0.0) AS diff
        FROM w JOIN t ON w.feature = t.feature""".replace("FROM cases", "FROM docs"),
    ["train_pct", "test_pct", "diff"],
)
def align_distributions(spark, d):
    """Full-outer alignment of two category distributions (docs language)."""
    return dr.drift_category(docs(spark, d), ["lang"])


_CHI_COLS = ["segment", "priority", "nation"]


@register(
    "drift_chi2",
    f"""WITH w AS ({_cat_counts_sql(_CHI_COLS)}),
        t AS (SELECT feature, sum(na) AS ta, sum(nb) AS tb, count(*) AS r FROM w GROUP BY feature),
        e AS (SELECT w.feature, w.na, w.nb, t.r,
                     CAST(w.na + w.nb AS DOUBLE) * t.ta / CAST(t.ta + t.tb AS DOUBLE) AS ea,
                     CAST(w.na + w.nb AS DOUBLE) * t.tb / CAST(t.ta + t.tb AS DOUBLE) AS eb
              FROM w JOIN t ON w.feature = t.feature)
        SELECT feature,
               sum(pow(CASE WHEN r - 1 = 1 THEN abs(na - ea) - least(0.5, abs(na - ea)) ELSE abs(na - ea) END, 2) / ea
                 + pow(CASE WHEN r - 1 = 1 THEN abs(nb - eb) - least(0.5, abs(nb - eb)) ELSE abs(nb - eb) END, 2) / eb) AS chi2,
               CAST(max(r) - 1 AS INTEGER) AS dof,
               max(CAST(na = 0 OR nb = 0 AS INTEGER)) AS has_zero_cell
        FROM e GROUP BY feature""",
    ["chi2"],
)
def drift_chi2(spark, d):
    """Chi-square homogeneity statistic and dof (Yates for 2x2)."""
    return dr.drift_chi2(cases(spark, d), _CHI_COLS)


@register("drift_chi2_pvalue")
def drift_chi2_pvalue(spark, d):
    """Chi-square statistic with its p-value (closed form on the reduced table)."""
    return dr.drift_chi2(cases(spark, d), _CHI_COLS, with_pvalue=True)


def _ks_sql(cols):
    long = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, split FROM cases WHERE {c} IS NOT NULL AND split IN ('train','test')"
        for c in cols
    )
    return f"""WITH l AS ({long}),
        c AS (SELECT feature, x, count_if(split = 'train') AS ca, count_if(split = 'test') AS cb FROM l GROUP BY feature, x),
        cu AS (SELECT feature, x, sum(ca) OVER (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING) AS fa,
                      sum(cb) OVER (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING) AS fb,
                      sum(ca) OVER (PARTITION BY feature) AS na, sum(cb) OVER (PARTITION BY feature) AS nb FROM c)
        SELECT feature, max(abs(fa / na - fb / nb)) AS ks_stat, CAST(max(na) AS BIGINT) AS n_train,
               CAST(max(nb) AS BIGINT) AS n_test FROM cu GROUP BY feature"""


@register("drift_ks", _ks_sql(["price", "balance"]), ["ks_stat"])
def drift_ks(spark, d):
    """Two-sample KS statistic per numeric column over distinct values."""
    return dr.drift_ks(cases(spark, d), ["price", "balance"])


@register("drift_ks_pvalue")
def drift_ks_pvalue(spark, d):
    """KS statistic with its asymptotic p-value."""
    return dr.drift_ks(cases(spark, d), ["price", "balance"], with_pvalue=True)


@register(
    "drift_numeric",
    """SELECT split, 'price' AS feature, avg(price) AS mean, median(price) AS median FROM cases GROUP BY split
       UNION ALL SELECT split, 'balance', avg(balance), median(balance) FROM cases GROUP BY split""",
    ["mean", "median"],
)
def drift_numeric(spark, d):
    """Mean and exact median per split."""
    return dr.drift_numeric(cases(spark, d), ["price", "balance"])


def _desc_long_sql(col):
    stats = {
        "count": f"CAST(count({col}) AS DOUBLE)", "mean": f"avg({col})", "std": f"stddev_samp({col})",
        "min": f"min({col})", "q25": f"quantile_cont({col}, 0.25)", "q50": f"quantile_cont({col}, 0.5)",
        "q75": f"quantile_cont({col}, 0.75)", "max": f"max({col})",
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{col}' AS \"column\", '{k}' AS stat, split, {v} AS v FROM cases WHERE split IN ('train','test') GROUP BY split"
        for k, v in stats.items()
    )


@register(
    "drift_describe",
    f"""WITH l AS ({_desc_long_sql('price')}
        UNION ALL
        {_desc_long_sql('balance')}),
        w AS (SELECT "column", stat, max(CASE WHEN split = 'train' THEN v END) AS train,
                     max(CASE WHEN split = 'test' THEN v END) AS test FROM l GROUP BY "column", stat)
        SELECT "column", stat, train, test, test - train AS diff, round((test - train) * 100.0 / NULLIF(train, 0), 2) AS pct_diff
        FROM w""",
    ["train", "test", "diff", "pct_diff"],
)
def drift_describe(spark, d):
    """describe() per split with difference and rounded % difference."""
    return dr.drift_describe(cases(spark, d), ["price", "balance"])


def _overlap_sql(keys):
    per = "\nUNION ALL\n".join(
        f"SELECT '{k}' AS key, CAST({k} AS VARCHAR) AS k, count_if(split = 'train') AS ra, count_if(split = 'test') AS rb "
        f"FROM cases WHERE {k} IS NOT NULL AND split IN ('train','test') GROUP BY {k}"
        for k in keys
    )
    return f"""WITH p AS ({per}),
        r AS (SELECT key, CAST(count_if(ra > 0) AS BIGINT) AS train_distinct, CAST(count_if(rb > 0) AS BIGINT) AS test_distinct,
                     CAST(count_if(ra > 0 AND rb > 0) AS BIGINT) AS common, CAST(sum(ra) AS BIGINT) AS train_rows, CAST(sum(rb) AS BIGINT) AS test_rows,
                     CAST(sum(CASE WHEN ra > 0 AND rb > 0 THEN ra ELSE 0 END) AS BIGINT) AS train_rows_covered,
                     CAST(sum(CASE WHEN ra > 0 AND rb > 0 THEN rb ELSE 0 END) AS BIGINT) AS test_rows_covered
              FROM p GROUP BY key)
        SELECT *, common * 100.0 / test_distinct AS overlap_pct, train_rows_covered * 100.0 / train_rows AS train_coverage_pct,
               test_rows_covered * 100.0 / test_rows AS test_coverage_pct FROM r"""


@register(
    "key_overlap_audit", _overlap_sql(["cust", "nation"]), ["overlap_pct", "train_coverage_pct", "test_coverage_pct"]
)
def key_overlap_audit(spark, d):
    """Key overlap between splits for several keys in one pass."""
    return dr.key_overlap_audit(cases(spark, d), ["cust", "nation"])


@register(
    "leak_risk",
    f"""WITH g AS (
          SELECT key AS factor, test_coverage_pct / 100.0 AS value,
                 CASE WHEN test_coverage_pct / 100.0 < (CASE key WHEN 'nation' THEN 0.1 ELSE 0.3 END) THEN 'HIGH'
                      WHEN test_coverage_pct / 100.0 < (CASE key WHEN 'nation' THEN 0.3 ELSE 0.5 END) THEN 'MEDIUM'
                      ELSE 'LOW' END AS risk
          FROM ({_overlap_sql(['cust', 'nation'])}) a
          UNION ALL
          SELECT 'cv_score', CAST(0.9921 AS DOUBLE), 'HIGH')
        SELECT factor, value, risk,
               CASE WHEN (SELECT count(*) FROM g WHERE risk = 'HIGH') > 0 THEN 'HIGH' ELSE 'LOW' END AS overall_risk
        FROM g""",
    ["value"],
)
def leak_risk(spark, d):
    """Risk of each key's coverage and of a given CV score, and overall."""
    audit = dr.key_overlap_audit(cases(spark, d), ["cust", "nation"])
    return dr.leak_risk(audit, {"nation": (0.1, 0.3)}, cv_score=0.9921)


_EXP_SQL = """
WITH r AS (SELECT segment, avg(CAST(y AS DOUBLE)) AS rate FROM cases WHERE split = 'train' AND y IS NOT NULL
           AND segment IS NOT NULL GROUP BY segment),
c AS (SELECT segment, count_if(split = 'train') AS ca, count_if(split = 'test') AS cb FROM cases
      WHERE split IN ('train', 'test') AND segment IS NOT NULL GROUP BY segment),
t AS (SELECT sum(ca) AS ta, sum(cb) AS tb FROM c),
x AS (SELECT sum(c.ca / t.ta * r.rate) AS expected_train, sum(c.cb / t.tb * r.rate) AS expected_test
      FROM c JOIN r ON c.segment = r.segment CROSS JOIN t)
SELECT expected_train, expected_test, expected_test - expected_train AS shift FROM x"""


@register("expected_rate", _EXP_SQL, ["expected_train", "expected_test", "shift"])
def expected_rate(spark, d):
    """Expected target rate under each split's category mix."""
    return dr.expected_rate(cases(spark, d), "segment", "y")


@register(
    "adjusted_threshold",
    f"""SELECT x.shift, least(0.6, greatest(0.4, b.t + x.shift)) AS adjusted_threshold
        FROM ({_EXP_SQL}) x CROSS JOIN (SELECT threshold AS t FROM ({_SWEEP_SQL}) sw ORDER BY accuracy DESC, grid_pos LIMIT 1) b""",
    ["shift", "adjusted_threshold"],
)
def adjusted_threshold(spark, d):
    """Prior-shift adjusted threshold, clipped to [0.4, 0.6]."""
    shift = dr.expected_rate(cases(spark, d), "segment", "y")
    return dr.adjusted_threshold(shift, me.best_threshold(_sweep(spark, d)), "best_acc_threshold")


@register(
    "split_profile",
    """SELECT c.split, avg(CAST(g.n = 1 AS DOUBLE)) AS alone_share, avg(CAST(g.n AS DOUBLE)) AS mean_group_size, count(*) AS n
       FROM cases c JOIN (SELECT cust, count(*) AS n FROM cases GROUP BY cust) g ON c.cust = g.cust GROUP BY c.split""",
    ["alone_share", "mean_group_size"],
)
def split_profile(spark, d):
    """Share of rows alone in their group and mean group size per split."""
    c = gr.group_size(cases(spark, d), "cust", "n")
    c = c.withColumn("alone", fx.flag(F.col("n") == 1))
    return dr.split_profile(c, "alone", "n")


# ---------------------------------------------------------------- L7/L8/L12: score-level compositions


@register(
    "blend_grid",
    """WITH g AS (SELECT CAST(i AS INTEGER) AS grid_pos, i / 20 AS weight, (20 - i) / 20 AS rest FROM generate_series(0, 20) t(i)),
       a AS (SELECT g.grid_pos, g.weight,
                    avg(CAST(CAST(g.weight * s.p_a + g.rest * s.p_b >= 0.5 AS INTEGER) = s.y AS DOUBLE)) AS accuracy
             FROM g CROSS JOIN (SELECT p_a, p_b, y FROM scores WHERE split = 'train') s GROUP BY g.grid_pos, g.weight)
       SELECT grid_pos, weight, accuracy,
              grid_pos = (SELECT grid_pos FROM a ORDER BY accuracy DESC, grid_pos LIMIT 1) AS is_best
       FROM a""",
    ["weight", "accuracy"],
)
def blend_grid(spark, d):
    """Two-score blend weights 0..1 step 0.05, accuracy of each in one pass; first best flagged."""
    return me.blend_grid(_train_scores(spark, d), "y", "p_a", "p_b", 20, 0.5)


@register(
    "blend_auc_weighted",
    f"""WITH a AS ({_AUC_SQL}),
        w AS (SELECT max(CASE WHEN model = 'a' THEN auc END) AS aa, max(CASE WHEN model = 'b' THEN auc END) AS ab FROM a)
        SELECT s.id, aa / (aa + ab) * s.p_a + ab / (aa + ab) * s.p_b AS p_blend FROM scores s CROSS JOIN w
        WHERE s.split = 'test'""",
    ["p_blend"],
)
def blend_auc_weighted(spark, d):
    """Ensemble weights proportional to each model's AUC."""
    aucs = me.roc_auc(_model_long(spark, d), "y", "s", ["model"])
    w = aucs.agg(
        F.max(F.when(F.col("model") == "a", F.col("auc"))).alias("aa"),
        F.max(F.when(F.col("model") == "b", F.col("auc"))).alias("ab"),
    )
    s = scores(spark, d).where(F.col("split") == "test").crossJoin(F.broadcast(w))
    tot = F.col("aa") + F.col("ab")
    return s.select("id", (F.col("aa") / tot * F.col("p_a") + F.col("ab") / tot * F.col("p_b")).alias("p_blend"))


@register(
    "pseudo_label_rows",
    """SELECT id, y, 0 AS is_pseudo FROM scores WHERE split = 'train'
       UNION ALL
       SELECT id, CAST(p_a >= 0.5 AS INTEGER), 1 FROM scores
       WHERE split = 'test' AND (p_a >= 0.9 OR p_a <= 0.1)""",
)
def pseudo_label_rows(spark, d):
    """Confident unlabelled rows labelled and appended to the training rows."""
    from ..operators.learn import pseudo_label_rows as plr

    s = scores(spark, d)
    return plr(s, "y", "p_a", 0.9, 0.1, id_col="id").select("id", "y", "is_pseudo")


@register(
    "predictions_by_threshold",
    f"""WITH sw AS ({_SWEEP_SQL}), x AS ({_EXP_SQL}),
        adj AS (SELECT (SELECT threshold FROM sw ORDER BY accuracy DESC, grid_pos LIMIT 1) + (SELECT shift FROM x) AS t),
        c AS (SELECT DISTINCT round(t, 2) AS threshold FROM (
                SELECT CAST(0.47 AS DOUBLE) AS t UNION ALL SELECT CAST(0.48 AS DOUBLE) UNION ALL SELECT CAST(0.49 AS DOUBLE)
                UNION ALL SELECT CAST(0.5 AS DOUBLE) UNION ALL SELECT t FROM adj) u
              WHERE t >= 0.4 AND t <= 0.6)
        SELECT s.id, c.threshold, CAST(s.p_a >= c.threshold AS INTEGER) AS label
        FROM scores s CROSS JOIN c WHERE s.split = 'test'""",
    ["threshold"],
)
def predictions_by_threshold(spark, d):
    """One output folder per candidate threshold, read back.

    Candidates: fixed values plus the prior-shift adjusted best threshold,
    kept inside [0.4, 0.6], rounded to 2 places, distinct (at most 5 rows).
    """
    from ..sources import frames as fr

    best = me.best_threshold(_sweep(spark, d)).select(F.col("best_acc_threshold").alias("_b"))
    shift = dr.expected_rate(cases(spark, d), "segment", "y").select("shift")
    adj = best.crossJoin(shift).select((F.col("_b") + F.col("shift")).alias("threshold"))
    fixed = spark.createDataFrame([(0.47,), (0.48,), (0.49,), (0.5,)], "threshold double")
    cands = (
        fixed.unionByName(adj)
        .where((F.col("threshold") >= 0.4) & (F.col("threshold") <= 0.6))
        .select(fx.round_to("threshold", 2).alias("threshold"))
        .distinct()
    )
    test = scores(spark, d).where(F.col("split") == "test").select("id", "p_a")
    out = test.crossJoin(F.broadcast(cands)).select(  # <= 5 candidate rows
        "id", "threshold", fx.flag(F.col("p_a") >= F.col("threshold")).alias("label")
    )
    path = fr.output_path(spark, "by_threshold")
    fr.write_partitioned(out, path, "threshold")
    back = spark.read.schema("id BIGINT, label INT, threshold DOUBLE").parquet(fr.committed_path(spark, path))
    return back.select("id", "threshold", "label")
