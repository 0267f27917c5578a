import numpy as np
from pyspark.sql import functions as F

from tessera.operators import folds as fo
from tessera.operators import learn as ln


def _planted(spark, n=2000, seed=11):
    rng = np.random.default_rng(seed)
    x1, x2, x3 = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    y = ((1.5 * x1 - x2 + 0.3 * rng.normal(size=n)) > 0).astype(int)
    labelled = rng.random(n) < 0.8
    rows = [(i, float(a), float(b), float(c), int(t) if l else None) for i, (a, b, c, t, l) in
            enumerate(zip(x1, x2, x3, y, labelled))]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, x3 double, y int")
    df = fo.stratified_fold(df, "y", "id", 3, 42)
    return ln.prepare(df.withColumn("fold", F.when(F.col("y").isNull(), -1).otherwise(F.col("fold"))), ["x1", "x2", "x3"], "y")


def test_oof_covers_every_labelled_row_once_and_learns(spark):
    prep = _planted(spark)
    oof, models = ln.oof_predict(prep, "y", 3, "fold", "lr")
    pdf = oof.toPandas()
    n_lab = prep.where(F.col("y").isNotNull()).count()
    assert len(pdf) == n_lab and pdf["id"].is_unique
    rep = ln.cv_report(oof, "y").collect()[0]
    assert rep["oof_auc"] > 0.9
    test = ln.fold_mean_predict(models, prep.where(F.col("y").isNull()), "p", ["id"]).toPandas()
    assert test["p"].between(0, 1).all()


def test_same_seed_same_scores(spark):
    prep = _planted(spark)
    a, _ = ln.oof_predict(prep, "y", 3, "fold", "gbt", {"maxIter": 5}, seed=3)
    b, _ = ln.oof_predict(prep, "y", 3, "fold", "gbt", {"maxIter": 5}, seed=3)
    pa = a.toPandas().sort_values("id")["p"].to_numpy()
    pb = b.toPandas().sort_values("id")["p"].to_numpy()
    assert np.allclose(pa, pb)


def test_importance_ranks_planted_features_first(spark):
    prep = _planted(spark)
    _, models = ln.oof_predict(prep, "y", 3, "fold", "gbt", {"maxIter": 5})
    rank = {r["feature"]: r["rank"] for r in ln.importance_ranking(ln.feature_importance(models, ["x1", "x2", "x3"], spark)).collect()}
    assert rank["x3"] == 3.0


def test_stacking_and_search(spark):
    prep = _planted(spark, n=600)
    meta_oof, coef, test = ln.stacking(prep, "y", 3, ["lr", "rf"])
    assert meta_oof.count() == prep.where(F.col("y").isNotNull()).count()
    assert {r["term"] for r in coef.collect()} == {"p_lr", "p_rf", "intercept"}
    table, best, threshold = ln.hyper_search(prep, "y", {"maxDepth": ("int", 2, 4)}, 2, 3, "gbt", base={"maxIter": 3})
    rows = table.collect()
    assert len(rows) == 2 and "maxDepth" in best and 0.3 <= threshold <= 0.7
    assert [r for r in rows if r["is_best"]] == [max(rows, key=lambda r: (r["oof_accuracy"], -r["trial"]))]
    assert all(r["oof_accuracy"] >= r["accuracy_at_half"] for r in rows)


def test_pseudo_label_rows(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, None, 0.95), (3, None, 0.5), (4, None, 0.02)], "id int, y int, p double")
    got = {r["id"]: (r["y"], r["is_pseudo"]) for r in ln.pseudo_label_rows(df, "y", "p", 0.9, 0.1).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 4: (0, 1)}


def test_boosting_seed_matters_and_missing_values_fail_early(spark):
    import numpy as np
    import pytest
    from tessera.operators import learn as ln

    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), int(a + b + rng.normal() > 0)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = ln.prepare(spark.createDataFrame(rows, "id long, a double, b double, y int"), ["a", "b"], "y")
    one, two = (ln.fit_model(df, "y", "gbt", {"maxIter": 3}, seed=s).treeWeights and
                ln.fit_model(df, "y", "gbt", {"maxIter": 3}, seed=s).toDebugString for s in (1, 2))
    assert one != two
    bad = spark.createDataFrame([(1, None, 1)], "id long, a double, y int")
    with pytest.raises(Exception):
        ln.prepare(bad, ["a"], "y")


def test_checkpoint_folder_must_be_named_off_local_mode():
    from tessera.session import is_local_master

    assert is_local_master("local[8]") and is_local_master("local")
    assert not is_local_master("local-cluster[3,2,1024]") and not is_local_master("yarn")


X = ["x1", "x2", "x3"]
FAST = {"maxIter": 3, "maxDepth": 3, "subsamplingRate": 0.8}


def test_search_judges_by_the_accuracy_of_its_own_oof_scores(spark):
    prep = _planted(spark, n=600)
    table, best, threshold = ln.hyper_search(prep, "y", {"maxDepth": ("int", 2, 4)}, 3, 3, "gbt", base=FAST)
    both = ln.hyper_refit(prep, "y", best, threshold, 3).toPandas()
    y = prep.select("id", "y").toPandas()
    merged = both.merge(y, on="id")
    lab = merged[merged["y"].notna()]
    assert len(both) == 600 and both["id"].is_unique and (lab["is_oof"]).all()
    won = table.where("is_best").first()["oof_accuracy"]
    assert abs((lab["predicted"] == lab["y"]).mean() - won) < 1e-9


def test_bagging_is_the_mean_of_its_learners_and_learns(spark):
    prep = _planted(spark, n=600)
    oof, models = ln.seed_bagging(prep, "y", 3, ["gbt", "rf", "lr"], [1, 2], params={"gbt": FAST, "rf": {"numTrees": 5}},
                                  weights={"lr": 2.0})
    pdf = oof.toPandas()
    assert np.allclose(pdf["p"], (pdf["p_gbt"] + pdf["p_rf"] + 2 * pdf["p_lr"]) / 4)
    assert len(models) == 3 * (2 + 2 + 1) and ((pdf["p"] > 0.5) == pdf["y"]).mean() > 0.85


def test_selection_and_ablation_tell_signal_from_noise(spark):
    prep = _planted(spark)
    ranking = spark.createDataFrame([("x1", 0.6), ("x2", 0.3), ("x3", 0.1)], "feature string, importance double")
    got = ln.select_by_importance(prep, X, "y", 3, ranking, [0.7, 0.4], "lr").collect()
    by_n = {r["n_features"]: r for r in got}
    assert by_n[2]["features"] == ["x1", "x2"] and by_n[1]["features"] == ["x1"]
    assert by_n[2]["cv_mean"] > by_n[1]["cv_mean"]
    assert [r["n_features"] for r in got if r["is_selected"]] == [max(got, key=lambda r: (r["cv_mean"], r["n_features"]))["n_features"]]
    fixed = ln.select_by_importance(prep, X, "y", 3, ranking, [], "lr", top=[1]).collect()
    assert [(r["n_features"], r["is_selected"]) for r in fixed] == [(3, True), (1, False)]
    sets = {"all": X, "no_noise": ["x1", "x2"], "noise": ["x3"]}
    auc = {r["feature_set"]: r["oof_auc"] for r in ln.ablation_table(prep, X, "y", 3, sets, "lr").collect()}
    assert auc["all"] > 0.9 and auc["no_noise"] > 0.9 and 0.4 < auc["noise"] < 0.6
    alone, _ = ln.oof_predict(ln.subset(prep, X, ["x1", "x2"]), "y", 3, "fold", "lr")
    assert abs(ln.cv_report(alone, "y").first()["oof_auc"] - auc["no_noise"]) < 1e-9


def test_pseudo_labels_are_searched_without_a_leak(spark):
    prep = _planted(spark, n=600)
    args = (prep, "y", 3, [(0.9, 0.1), (1.1, -0.1)], "lr")
    table = ln.pseudo_label_search(*args, min_rows=5).collect()
    assert [r["n_pseudo"] for r in table][0] == 0 and table[1]["n_pseudo"] > 5
    assert table[2]["oof_accuracy"] is None and table[2]["n_pseudo"] == 0  # no row is that sure
    chosen = [r for r in table if r["is_selected"]]
    assert len(chosen) == 1 and chosen[0]["oof_accuracy"] == max(r["oof_accuracy"] for r in table[:2])
    both = ln.pseudo_label_search(*args, min_rows=5, labels_from="all", extended=True).collect()
    assert (both[0]["ext_accuracy"], both[0]["ext_auc"]) == (both[0]["oof_accuracy"], both[0]["oof_auc"])
    assert both[1]["ext_accuracy"] > both[1]["oof_accuracy"]  # pseudo-labels agree with the models that gave them
    assert both[2]["ext_accuracy"] is None and table[1]["ext_accuracy"] is None
    _, models = ln.oof_predict(prep, "y", 3, "fold", "lr")
    few, n = ln.pseudo_label_fit(prep, "y", models, 0.9, 0.1, "lr", min_rows=10_000)
    plain = ln.fit_model(prep, "y", "lr")
    assert 5 < n < 10_000 and np.allclose(few.coefficients.toArray(), plain.coefficients.toArray())
    more, _ = ln.pseudo_label_fit(prep, "y", models, 0.9, 0.1, "lr")
    assert not np.allclose(more.coefficients.toArray(), plain.coefficients.toArray())


def test_overfit_gap_and_early_stopping(spark):
    prep = _planted(spark, n=600)
    _, models = ln.oof_predict(prep, "y", 3, "fold", "gbt", {"maxIter": 8, "maxDepth": 5})
    gap = {r["fold"]: r for r in ln.train_accuracy_gap(models, prep, "y").collect()}
    assert set(gap) == {0, 1, 2}
    lab = prep.where(F.col("y").isNotNull())
    one = ln.predict(models[1], lab, "p").toPandas()
    held = one["fold"] == 1
    hit = (one["p"] >= 0.5) == (one["y"] == 1)
    assert abs(gap[1]["valid_accuracy"] - hit[held].mean()) < 1e-9 and abs(gap[1]["train_accuracy"] - hit[~held].mean()) < 1e-9
    assert all(r["gap"] > 0 for r in gap.values())
    flagged = ln.with_validation_flag(prep, "id")
    stopped = ln.fit_model(flagged, "y", "gbt", {"maxIter": 40, "maxDepth": 5, "validationIndicatorCol": "_is_val", "validationTol": 0.01})
    assert len(stopped.trees) < 40


def test_stack_averages_its_seeds(spark):
    prep = _planted(spark, n=600)
    params = {"rf": {"numTrees": 5}}
    each = [ln.stacking(prep, "y", 3, ["lr", "rf"], seed=s, params=params)[2].toPandas().set_index("id")["p_meta"] for s in (1, 2)]
    oof, coef, both = ln.stacking(prep, "y", 3, ["lr", "rf"], seed=[1, 2], params=params)
    got = both.toPandas().set_index("id")["p_meta"]
    assert np.allclose(got, (each[0] + each[1]).loc[got.index] / 2) and not np.allclose(each[0], each[1].loc[each[0].index])
    assert coef.count() == 3 and oof.count() == prep.where(F.col("y").isNotNull()).count()


def test_stack_fits_unseeded_learners_once(spark, monkeypatch):
    prep = _planted(spark, n=300)
    fitted, fit = [], ln.fit_model
    monkeypatch.setattr(ln, "fit_model", lambda df, label, kind, *rest: fitted.append(kind) or fit(df, label, kind, *rest))
    oof, _, test = ln.stacking(prep, "y", 3, ["lr", "rf"], seed=[1, 2], params={"rf": {"numTrees": 2}})
    # a base fit of "lr" for each fold; meta-learners for each seed: one for each fold and one on all rows
    assert fitted.count("rf") == 2 * 3 and fitted.count("lr") == 3 + 2 * 3 + 2
    assert oof.columns == ["id", "fold", "y", "p_meta"] and test.columns == ["id", "p_meta"]


def test_nominal_features_split_by_sets_and_are_bounded(spark):
    import pytest

    rows = [(i, "abcdefgh"[i % 8], int(i % 8 in (0, 3, 5)), i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, c string, y int, fold int")
    prep = ln.prepare(df, ["c"], "y", fold="fold", keep=["id"], categorical=["c"])
    assert set(prep.columns) == {"id", "fold", "y", "_features"}
    oof, models = ln.oof_predict(prep, "y", 3, "fold", "rf", {"numTrees": 1, "maxDepth": 1})
    assert ((oof.toPandas()["p"] > 0.5) == oof.toPandas()["y"]).all()  # one split tells {a, d, f} from the rest
    with pytest.raises(ValueError):
        ln.prepare(df, ["c"], "y", categorical=["c"], max_categories=3)


def test_folds_are_read_alone(spark):
    prep = _planted(spark, n=100)
    part = ln.prepare(prep.drop("_features"), X, "y", fold="fold", keep=["id"])
    plan = part.where(F.col("fold") != 1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan


def test_categories_are_found_in_one_pass(spark):
    import pytest

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("id", "cast(id % 2 AS int) AS y", "cast(id % 7 AS string) AS a", "cast(id % 3 AS int) AS b")
    df = df.mapInArrow(counted, df.schema)
    prep = ln.prepare(df, ["a", "b"], "y", categorical=["a", "b"])
    assert seen.value == 2000  # the dictionaries' pass and the written one
    rows = {(r["a"], r["b"]): tuple(r[ln.FEATURES].toArray()) for r in prep.select("a", "b", ln.FEATURES).collect()}
    assert rows["6", 2] == (6.0, 2.0) and ln._categories(prep) == 7
    with pytest.raises(ValueError, match="categories"):
        ln.prepare(df, ["a", "b"], "y", categorical=["a", "b"], max_categories=5)


def test_fewer_fits_at_once_on_more_rows(spark, monkeypatch):
    prep = spark.range(100).selectExpr("id", "if(id < 60, 1.0, null) AS y")
    assert ln._fits_at_once(prep, "y", None) == 8
    monkeypatch.setattr(ln, "ROWS_AT_ONCE", 150)
    assert ln._fits_at_once(prep, "y", None) == 2 and ln._fits_at_once(prep, "y", 5) == 5
    monkeypatch.setattr(ln, "ROWS_AT_ONCE", 10)
    assert ln._fits_at_once(prep, "y", None) == 1


def test_fits_on_the_same_folds_read_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(300).selectExpr("id", "cast(id % 3 AS int) AS fold", "cast(id % 7 AS double) AS a", "cast(id % 2 AS int) AS y")
    prep = ln.prepare(df.mapInArrow(counted, df.schema), ["a"], "y", checkpoint=False)
    specs = {f"p{s}": ("gbt", FAST, s) for s in range(3)}
    oof, _ = ln.oof_matrix(prep, "y", 3, specs, parallelism=2)
    assert seen.value == 3 * 300 + 3 * 300  # each fold's training rows, and each fold's scored rows
    assert oof.count() == 300


def test_shared_training_rows_are_released(spark, monkeypatch):
    import pytest

    prep, frames, fit = _planted(spark, n=200), [], ln.fit_model

    def watched(train, label, kind, *rest):
        frames.append((train, train.storageLevel.useMemory))
        return fit(train, label, kind, *rest)

    monkeypatch.setattr(ln, "fit_model", watched)
    ln.oof_matrix(prep, "y", 3, {"a": ("lr", None, 1), "b": ("lr", {"regParam": 0.1}, 1)})
    assert len(frames) == 6 and all(kept for _, kept in frames)
    assert set(frames[0][0].columns) == {"y", ln.FEATURES}
    with pytest.raises(ValueError, match="unknown learner"):
        ln.oof_matrix(prep, "y", 3, {"a": ("lr", None, 1), "b": ("no", None, 1)}, parallelism=1)
    assert not any(train.storageLevel.useMemory for train, _ in frames)
