"""Learner-backed queries.

Model scores are not SQL-expressible, so the queries that return them are rows-only
checks.  What SQL can state about them -- which rows are scored, in which fold, by how
many features -- is a query of its own with a twin (``*_coverage``, ``*_check``).

Every query builds its feature table and fits its models itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as en
from ..operators import folds as fo
from ..operators import groups as gr
from ..operators import impute as im
from ..operators import learn as ln
from ..session import Scratch
from .q_model import STRAT_SQL
from .registry import register
from .tables import cases

K = 5
FEATURES = ["pclass", "nation", "price", "balance_f", "cust_size", "segment_code"]
NOMINAL = ["nation", "segment_code"]
GBT = {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
FOREST = {"numTrees": 20, "maxDepth": 6}
PARAMS = {"gbt": GBT, "rf": FOREST, "rf_nobootstrap": {**FOREST, "bootstrap": False}}
LEARNERS = ["gbt", "rf", "rf_nobootstrap", "lr", "nb"]
SEEDS = [1, 2, 3, 4, 5]
STACKED = ["gbt", "rf", "lr"]
BANDS = [(0.95, 0.05), (0.90, 0.10), (0.85, 0.15), (0.60, 0.40), (0.55, 0.45)]  # the last two suit weak targets
MIN_PSEUDO = 10
TRIALS = 30
SPACE = {
    "maxDepth": ("int", 2, 5),
    "stepSize": ("logfloat", 0.03, 0.3),
    "maxIter": ("int", 5, 15),
    "minInstancesPerNode": ("int", 1, 20),
    "subsamplingRate": ("float", 0.6, 1.0),
    "validationTol": ("choice", [0.0, 0.001, 0.01]),
}
SETS = {
    "all": FEATURES,
    "no_group_size": [f for f in FEATURES if f != "cust_size"],
    "no_balance": [f for f in FEATURES if f != "balance_f"],
}
RATIOS = [0.9, 0.8, 0.7, 0.6]
TOP = 2


def _features(spark, d):
    used = ["id", "cust", "split", "y", "segment", "nation", "pclass", "price", "balance"]
    c = Scratch(spark).save(cases(spark, d).select(*used), "cases")  # read by every step below
    c = en.label_encode(c, "segment", "segment_code")
    train = c.where(F.col("split") == "train")
    c = im.impute_cascade(c, "balance", [["nation", "segment"], ["segment"]], fit_on=train, out="balance_f")
    c = gr.group_size(c, "cust", "cust_size")
    c = fo.stratified_fold(c.select("id", "y", *FEATURES), "y", "id", K, 42)
    return c.withColumn("fold", F.when(F.col("y").isNull(), F.lit(-1)).otherwise(F.col("fold")))


def _prepared(spark, d):
    """The feature table, written once per query and partitioned by fold."""
    return ln.prepare(_features(spark, d), FEATURES, "y", fold="fold", keep=["id"], categorical=NOMINAL)


def _unlabelled(prep):
    return prep.where(F.col("y").isNull())


def _gbt_oof(prep):
    return ln.oof_predict(prep, "y", K, "fold", "gbt", GBT)


def _test_scores(prep, kind, params=None):
    return ln.predict(ln.fit_model(prep, "y", kind, params), _unlabelled(prep), "p").select("id", "p")


@register("fit_gbt")
def fit_gbt(spark, d):
    """L1: gradient-boosted trees fitted on the labelled split, unlabelled rows scored."""
    return _test_scores(_prepared(spark, d), "gbt", GBT)


@register("fit_rf")
def fit_rf(spark, d):
    """L2: random forest."""
    return _test_scores(_prepared(spark, d), "rf", FOREST)


@register("fit_rf_nobootstrap")
def fit_rf_nobootstrap(spark, d):
    """L3: forest without bootstrap (nearest Spark analogue of extra-trees)."""
    return _test_scores(_prepared(spark, d), "rf_nobootstrap", PARAMS["rf_nobootstrap"])


@register("fit_lr")
def fit_lr(spark, d):
    """L4: logistic regression (standardised internally)."""
    return _test_scores(_prepared(spark, d), "lr")


@register("fit_gbt_early_stop")
def fit_gbt_early_stop(spark, d):
    """Boosting with a separate inner validation set (tolerance-based stopping)."""
    prep = ln.with_validation_flag(_prepared(spark, d), "id")
    params = dict(GBT, maxIter=30, validationIndicatorCol="_is_val", validationTol=0.001)
    return _test_scores(prep, "gbt", params)


@register("oof_predict")
def oof_predict(spark, d):
    """out-of-fold scores, every labelled row scored by a model that did not see it."""
    return _gbt_oof(_prepared(spark, d))[0]


@register("oof_coverage", f"SELECT id, y, fold, true AS in_range FROM ({STRAT_SQL}) f")
def oof_coverage(spark, d):
    """each labelled row scored exactly once, in its own fold, by a probability."""
    oof, _ = _gbt_oof(_prepared(spark, d))
    return oof.select("id", F.col("y").cast("int").alias("y"), "fold", F.col("p").between(0, 1).alias("in_range"))


@register("fold_mean_predict")
def fold_mean_predict(spark, d):
    """unlabelled rows scored by the mean of the fold models."""
    prep = _prepared(spark, d)
    _, models = _gbt_oof(prep)
    return ln.fold_mean_predict(models, _unlabelled(prep), "p", ["id"])


@register("fold_mean_coverage", "SELECT id, true AS in_range FROM cases WHERE split = 'test'")
def fold_mean_coverage(spark, d):
    """each unlabelled row has one mean probability."""
    return fold_mean_predict(spark, d).select("id", F.col("p").between(0, 1).alias("in_range"))


@register("cv_accuracy")
def cv_accuracy(spark, d):
    """Per-fold accuracy and AUC with mean / std over folds."""
    return ln.cv_report(_gbt_oof(_prepared(spark, d))[0], "y")


@register(
    "cv_report_scores",
    """WITH t AS (SELECT fold, y, p_a FROM scores WHERE y IS NOT NULL),
       c AS (SELECT fold, p_a, sum(y) AS pos, sum(1 - y) AS neg FROM t GROUP BY GROUPING SETS ((fold, p_a), (p_a))),
       cu AS (SELECT fold, pos, neg, sum(pos) OVER (PARTITION BY fold ORDER BY p_a ROWS UNBOUNDED PRECEDING) AS cp FROM c),
       auc AS (SELECT fold, 1.0 - (sum(CAST(neg AS DOUBLE) * cp) - sum(CAST(neg AS DOUBLE) * pos) / 2.0)
                 / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM cu GROUP BY fold),
       acc AS (SELECT fold, avg(CAST(y = CAST(p_a >= 0.5 AS INTEGER) AS DOUBLE)) AS accuracy FROM t GROUP BY ROLLUP (fold)),
       per AS (SELECT acc.fold, accuracy, auc FROM acc JOIN auc ON acc.fold = auc.fold)
       SELECT *, avg(accuracy) OVER () AS cv_mean, stddev_pop(accuracy) OVER () AS cv_std, avg(auc) OVER () AS auc_mean,
              (SELECT accuracy FROM acc WHERE fold IS NULL) AS oof_accuracy,
              (SELECT auc FROM auc WHERE fold IS NULL) AS oof_auc
       FROM per""",
    ["accuracy", "auc", "cv_mean", "cv_std", "auc_mean", "oof_accuracy", "oof_auc"],
)
def cv_report_scores(spark, d):
    """The same report over a given score table, which SQL can state in full."""
    from .tables import scores

    return ln.cv_report(scores(spark, d).where(F.col("y").isNotNull()), "y", "p_a")


@register("overfit_gap")
def overfit_gap(spark, d):
    """Training accuracy next to held-out accuracy per fold model."""
    prep = _prepared(spark, d)
    _, models = _gbt_oof(prep)
    return ln.train_accuracy_gap(models, prep, "y")


@register("seed_bagging")
def seed_bagging(spark, d):
    """OOF score averaged over learners x seeds."""
    return ln.seed_bagging(_prepared(spark, d), "y", K, LEARNERS, SEEDS, params=PARAMS)[0]


def _importance(spark, prep):
    _, models = _gbt_oof(prep)
    return ln.feature_importance(models, FEATURES, spark)


@register("feature_importance")
def feature_importance(spark, d):
    """Importance per fold, mean over folds, ranked (ties share the mean rank)."""
    return ln.importance_ranking(_importance(spark, _prepared(spark, d)))


@register(
    "importance_check",
    f"""SELECT fold, CAST(1.0 AS DOUBLE) AS total, CAST({len(FEATURES)} AS BIGINT) AS n_features
        FROM ({STRAT_SQL}) f GROUP BY fold""",
    ["total"],
)
def importance_check(spark, d):
    """The importances of each fold's model sum to 1 over all features."""
    imp = _importance(spark, _prepared(spark, d))
    return imp.groupBy("fold").agg(F.sum("importance").alias("total"), F.count("*").alias("n_features"))


@register("select_by_importance")
def select_by_importance(spark, d):
    """CV of the top shares of features by importance and of a fixed number; the winner is marked."""
    prep = _prepared(spark, d)
    ranking = ln.importance_ranking(_importance(spark, prep))
    return ln.select_by_importance(prep, FEATURES, "y", K, ranking, RATIOS, "gbt", params=GBT, top=[TOP])


@register("ablation_table")
def ablation_table(spark, d):
    """OOF accuracy / AUC of several feature sets in one table."""
    return ln.ablation_table(_prepared(spark, d), FEATURES, "y", K, SETS, "gbt", params=GBT)


@register("pseudo_label_fit")
def pseudo_label_fit(spark, d):
    """Score unlabelled rows, add the confident ones as labels, refit, rescore."""
    prep = _prepared(spark, d)
    _, models = _gbt_oof(prep)
    model, _ = ln.pseudo_label_fit(prep, "y", models, 0.6, 0.4, "gbt", GBT, MIN_PSEUDO)
    return ln.predict(model, _unlabelled(prep), "p").select("id", "p")


@register("pseudo_label_search")
def pseudo_label_search(spark, d):
    """Pseudo-label bands scored on original rows, and on the extended ones; baseline is a row."""
    return ln.pseudo_label_search(_prepared(spark, d), "y", K, BANDS, "gbt", min_rows=MIN_PSEUDO, params=GBT, extended=True)


@register("stacking_fit")
def stacking_fit(spark, d):
    """Base OOF scores -> logistic meta-learner, itself scored out of fold."""
    return ln.stacking(_prepared(spark, d), "y", K, STACKED, params=PARAMS)[0]


@register("stacking_coverage", f"SELECT id, fold, true AS in_range FROM ({STRAT_SQL}) f")
def stacking_coverage(spark, d):
    """The stack scores each labelled row exactly once, in its own fold."""
    return stacking_fit(spark, d).select("id", "fold", F.col("p_meta").between(0, 1).alias("in_range"))


@register("stacking_coefficients")
def stacking_coefficients(spark, d):
    """Meta-learner coefficients per base model."""
    return ln.stacking(_prepared(spark, d), "y", K, STACKED, params=PARAMS)[1]


@register("stacking_seed_average")
def stacking_seed_average(spark, d):
    """Stacked test scores averaged over seeds."""
    _, _, t = ln.stacking(_prepared(spark, d), "y", K, STACKED, seed=SEEDS[:4], params=PARAMS)
    return t.withColumnRenamed("p_meta", "p")


def _search(prep):
    base = {**GBT, "validationIndicatorCol": "_is_val"}
    return ln.hyper_search(prep, "y", SPACE, TRIALS, K, "gbt", base=base)


@register("hyper_search")
def hyper_search(spark, d):
    """Seeded random search of parameters, stopping tolerance and threshold on OOF accuracy."""
    return _search(ln.with_validation_flag(_prepared(spark, d), "id"))[0]


@register("hyper_refit")
def hyper_refit(spark, d):
    """Best searched parameters refitted by fold: OOF scores and fold-mean scores."""
    prep = ln.with_validation_flag(_prepared(spark, d), "id")
    _, best, threshold = _search(prep)
    return ln.hyper_refit(prep, "y", best, threshold, K, "gbt")
