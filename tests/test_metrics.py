import itertools

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import metrics as me


def _brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def _frame(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.4).astype(int)
    s = np.round(0.3 * y + 0.7 * rng.random(n), 2)  # many ties
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], "id int, y int, s double"), y, s


def test_auc_matches_brute_force_with_ties(spark):
    df, y, s = _frame(spark)
    got = me.roc_auc(df, "y", "s").collect()[0]["auc"]
    assert abs(got - _brute_auc(y, s)) < 1e-12


def test_auc_invariant_under_monotone_transform(spark):
    df, _, _ = _frame(spark)
    a = me.roc_auc(df, "y", "s").collect()[0]["auc"]
    b = me.roc_auc(df.withColumn("s", F.exp(F.col("s") * 3) - 7), "y", "s").collect()[0]["auc"]
    assert abs(a - b) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert me.roc_auc(df, "y", "s").collect()[0]["auc"] is None


def test_sweep_matches_brute_force(spark):
    df, y, s = _frame(spark)
    sw = {r["grid_pos"]: r for r in me.threshold_sweep(df, "y", "s", 30, 70).collect()}
    for i in (30, 44, 50, 70):
        t = i / 100
        pred = (s >= t).astype(int)
        acc = (pred == y).mean()
        tp = ((pred == 1) & (y == 1)).sum()
        f1 = 2 * tp / (pred.sum() + y.sum())
        assert abs(sw[i]["accuracy"] - acc) < 1e-12 and abs(sw[i]["f1"] - f1) < 1e-12
    best = me.best_threshold(me.threshold_sweep(df, "y", "s", 30, 70)).collect()[0]
    accs = [(sw[i]["accuracy"], -i) for i in sw]
    assert abs(best["best_acc_threshold"] - (-max(accs)[1]) / 100) < 1e-12


def test_youden_and_roc_endpoints(spark):
    df, _, _ = _frame(spark)
    curve = me.roc_curve(df, "y", "s").orderBy(F.col("threshold")).collect()
    assert curve[0]["tpr"] == 1.0 and curve[0]["fpr"] == 1.0
    j = me.youden_threshold(df, "y", "s").collect()[0]
    assert j["youden_j"] == max(r["tpr"] - r["fpr"] for r in curve)


def test_blend_grid_endpoints(spark):
    df = spark.createDataFrame([(1, 0.9, 0.1), (0, 0.2, 0.8), (1, 0.6, 0.4)], "y int, a double, b double")
    g = {r["grid_pos"]: r["accuracy"] for r in me.blend_grid(df, "y", "a", "b", 20).collect()}
    assert g[20] == 1.0 and g[0] == 0.0


def test_agreement_aligns_on_key(spark):
    a = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1), (3, 1, 0.6)], "id int, label int, p double")
    b = spark.createDataFrame([(3, 0, 0.4), (1, 1, 0.8), (2, 0, 0.2)], "id int, label int, p double")
    r = me.prediction_agreement(a, b, "id", "label", "p").collect()[0]
    assert (r["n_agree"], r["n_disagree"], r["a1_b0"]) == (2, 1, 1)


def test_agreement_counts_unmatched_keys(spark):
    a = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1), (3, 1, 0.8)], "id int, label int, p double")
    b = spark.createDataFrame([(1, 1, 0.7), (9, 0, 0.2)], "id int, label int, p double")
    r = me.prediction_agreement(a, b, "id", "label", "p").collect()[0]
    assert (r["n"], r["n_only_a"], r["n_only_b"], r["agree_pct"]) == (1, 2, 1, 100.0)
    none = me.prediction_agreement(a, b.where("id = 9"), "id").collect()[0]
    assert none["n"] == 0 and none["agree_pct"] is None
