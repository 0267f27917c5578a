"""Learners and model compositions on ``pyspark.ml``.

Shape of every fit-heavy operator:

* the feature table (id, fold, label, vector) is written once to the shared
  checkpoint folder, partitioned by fold: a fit reads only its training folds and
  scoring reads each fold once, and a lost executor re-reads a file instead of
  replaying the feature plan;
* fits that train on the same folds share their rows, persisted while they run: a fit
  reads its input three or four times before its first tree;
* independent fits (learners, seeds, trials, folds) are submitted concurrently from
  a small driver thread pool -- each fit is a distributed Spark job -- the fewer at once,
  the more rows each keeps in memory (``ROWS_AT_ONCE``);
* all learners' out-of-fold (OOF) scores are columns of one table, written once:
  every row is read once, by the models that did not see it (no joins);
* the test score is the mean of the fold models, as columns on the same rows;
* feature subsets are slices of the one vector, not copies of the table.

Gradient boosting is ``GBTClassifier``; boosted-tree options that Spark has no
equivalent for (leaf-wise growth, L1/L2 leaf penalties) are not offered.
"""

from __future__ import annotations

import json
import random
import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import binarize, confident
from ..session import Scratch, materialize
from .metrics import grid_bucket, roc_auc

FEATURES = "_features"

#: Training rows of the fits that run at once: each fit keeps its own rows in the executors' memory.
ROWS_AT_ONCE = 40_000_000

#: Learners without a seed: one fit serves all seeds.
UNSEEDED = ("lr", "nb")

# Tree counts are parameters; these defaults suit tables of few features.
DEFAULT_PARAMS = {
    # rows and columns are sampled for each tree, so the seed matters
    "gbt": {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"},
    "rf": {"numTrees": 30, "maxDepth": 6},
    "rf_nobootstrap": {"numTrees": 30, "maxDepth": 6, "bootstrap": False},
    "lr": {"maxIter": 100},
    "nb": {"modelType": "gaussian"},
}


def make_estimator(kind: str, label: str, params: Mapping | None = None, seed: int = 42):
    p = dict(DEFAULT_PARAMS.get(kind, {}))
    p.update(params or {})
    common = {"featuresCol": FEATURES, "labelCol": label}
    if kind == "gbt":
        return GBTClassifier(seed=seed, **common, **p)
    if kind in ("rf", "rf_nobootstrap"):
        return RandomForestClassifier(seed=seed, **common, **p)
    if kind == "lr":
        return LogisticRegression(**common, **p)
    if kind == "nb":
        return NaiveBayes(**common, **p)
    raise ValueError(f"unknown learner {kind!r}")


def prepare(df: DataFrame, features: Sequence[str], label: str, checkpoint: bool = True, fold: str | None = None,
            keep: Sequence[str] | None = None, categorical: Sequence[str] = (), max_categories: int = 1000) -> DataFrame:
    """Assemble the feature vector once (label cast to double) and cut lineage.

    Features must have been imputed: a missing value is an error in this step, not in a
    later fit.  ``categorical`` features are nominal to the trees (split by sets of values,
    not by order); more than ``max_categories`` values in one are an error, and so its
    dictionary stays small.  ``keep`` names the columns kept beside label and vector
    (default: all).  With ``fold``, the table is written partitioned by it.
    """
    df = df.withColumn(label, F.col(label).cast("double"))
    inputs = list(features)
    if categorical:
        # one pass over the rows: sizes and dictionaries are those of their distinct values
        values = materialize(df.select(*categorical).distinct(), "categories")
        sizes = values.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
        wide = [c for c in categorical if sizes[c] > max_categories]
        if wide:
            raise ValueError(f"more than {max_categories} categories in {wide}")
        codes = {c: f"_nominal_{c}" for c in categorical}
        indexer = StringIndexer(inputCols=list(codes), outputCols=list(codes.values()), stringOrderType="alphabetAsc")
        df = indexer.fit(values).transform(df)
        inputs = [codes.get(f, f) for f in features]
    out = VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="error").transform(df)
    if keep is not None:
        out = out.select(*dict.fromkeys([*keep, *([fold] if fold else []), label, FEATURES]))
    if not checkpoint:
        return out
    return Scratch(out.sparkSession).save(out, "features", (fold,) if fold else ())


def subset(prepared: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The same table with only the features ``keep`` in its vector (``features``: all, in order)."""
    at = [list(features).index(f) for f in keep]
    sliced = VectorSlicer(inputCol=FEATURES, outputCol="_sliced", indices=at).transform(prepared)
    return sliced.drop(FEATURES).withColumnRenamed("_sliced", FEATURES)


def _categories(df: DataFrame) -> int:
    """Most values of any nominal feature in the vector (0: none)."""
    attrs = df.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    return max((len(a.get("vals", ())) for a in attrs), default=0)


def fit_model(train: DataFrame, label: str, kind: str = "gbt", params: Mapping | None = None, seed: int = 42):
    est = make_estimator(kind, label, params, seed)
    if est.hasParam("maxBins"):
        est.setMaxBins(max(est.getMaxBins(), _categories(train)))  # a nominal feature needs one bin per value
    return est.fit(train.where(F.col(label).isNotNull()))


def predict(model, df: DataFrame, out: str = "p") -> DataFrame:
    """Add the positive-class probability as ``out`` (helper columns dropped)."""
    m = model.copy()
    m.setPredictionCol(f"_pred_{out}").setRawPredictionCol(f"_raw_{out}").setProbabilityCol(f"_prob_{out}")
    res = m.transform(df)
    return res.withColumn(out, vector_to_array(F.col(f"_prob_{out}"))[1]).drop(
        f"_pred_{out}", f"_raw_{out}", f"_prob_{out}"
    )


def _pool_map(fn, items, parallelism: int | None):
    items = list(items)
    # One driver thread per independent fit (capped): each fit is a Spark job,
    # so the threads only submit work; the executors do it.
    with ThreadPoolExecutor(max_workers=max(1, min(len(items), parallelism or 8))) as ex:
        return list(ex.map(fn, items))


def _fits_at_once(prepared: DataFrame, label: str, parallelism: int | None) -> int:
    """``parallelism``, or as many fits as keep about ``ROWS_AT_ONCE`` rows in memory (8 at most)."""
    rows = prepared.where(F.col(label).isNotNull()).count() if parallelism is None else 0
    return parallelism or max(1, min(8, ROWS_AT_ONCE // max(1, rows)))


class _Shared:
    """Frames used ``uses`` times each: persisted from the first use to the end of the last."""

    def __init__(self, build: Callable[[int], DataFrame], uses: int):
        self._build, self._uses, self._lock = build, uses, threading.Lock()
        self._frames: dict[int, DataFrame] = {}
        self._left: dict[int, int] = {}

    def run(self, key: int, use: Callable[[DataFrame], object]):
        with self._lock:
            if key not in self._frames:
                df = self._build(key)
                self._frames[key] = df.persist() if self._uses > 1 else df
                self._left[key] = self._uses
            df = self._frames[key]
        try:
            return use(df)
        finally:
            with self._lock:
                self._left[key] -= 1
                if not self._left[key] and self._uses > 1:
                    self._frames.pop(key).unpersist()

    def close(self) -> None:
        """Release what uses that never ran (an earlier one failed) would have released."""
        while self._uses > 1 and self._frames:
            self._frames.popitem()[1].unpersist()


def _mean(names: Sequence[str]):
    return reduce(lambda a, b: a + b, [F.col(n) for n in names]) / F.lit(float(len(names)))


def oof_matrix(
    prepared: DataFrame,
    label: str,
    k: int,
    specs: Mapping[str, tuple],
    fold: str = "fold",
    id_col: str = "id",
    parallelism: int | None = None,
    train_extra: Callable[[int], DataFrame] | None = None,
    features: Sequence[str] = (),
    score_extra: Callable[[int], DataFrame] | None = None,
):
    """Out-of-fold scores of several learners side by side.

    ``specs`` maps a score column to ``(kind, params, seed)`` or ``(kind, params, seed,
    kept features)``; the last needs ``features``, the vector's names.  Each labelled row is
    scored by the models that did not see its fold.  ``train_extra(i)`` gives rows (such as
    pseudo-labelled ones) that join the training rows of fold ``i``; ``score_extra(i)`` gives
    rows that are scored with fold ``i``, beside its own.
    Returns ``(oof, models)``: ``oof`` has ``(id, fold, label, *specs)`` and is a written
    table; ``models`` maps a score column to its ``k`` models.
    """
    lab = prepared.where(F.col(label).isNotNull())

    def view(df, spec):
        return subset(df, features, spec[3]) if len(spec) > 3 else df

    # columns that a fit reads: parameters may name some (weights, a validation flag)
    named = {v for spec in specs.values() for v in (spec[1] or {}).values() if isinstance(v, str)}

    def train_on(i):
        train = lab.where(F.col(fold) != i)
        if train_extra is not None:
            train = train.unionByName(train_extra(i).select(*train.columns))
        return train.select(*[c for c in train.columns if c in {label, FEATURES, *named}])

    shared = _Shared(train_on, len(specs))

    def fit_one(item):
        name, i = item
        spec = specs[name]
        return shared.run(i, lambda train: fit_model(view(train, spec), label, *spec[:3]))

    jobs = [(name, i) for i in range(k) for name in specs]  # fold by fold: few folds' rows are held at once
    try:
        fitted = dict(zip(jobs, _pool_map(fit_one, jobs, _fits_at_once(prepared, label, parallelism))))
    finally:
        shared.close()
    parts = []
    for i in range(k):
        cur = lab.where(F.col(fold) == i)
        if score_extra is not None:
            cur = cur.unionByName(score_extra(i).select(*cur.columns))
        cur = cur.withColumn("_all", F.col(FEATURES))
        for name, spec in specs.items():
            cur = predict(fitted[name, i], view(cur.withColumn(FEATURES, F.col("_all")), spec), name)
        parts.append(cur.select(id_col, fold, label, *specs))
    oof = Scratch(prepared.sparkSession).save(reduce(DataFrame.unionByName, parts), "oof")
    return oof, {name: [fitted[name, i] for i in range(k)] for name in specs}


def oof_predict(
    prepared: DataFrame,
    label: str,
    k: int,
    fold: str = "fold",
    kind: str = "gbt",
    params: Mapping | None = None,
    seed: int = 42,
    id_col: str = "id",
    out: str = "p",
    parallelism: int | None = None,
):
    """Out-of-fold scores of one learner: ``((id, fold, label, out), models)``; see :func:`oof_matrix`."""
    oof, models = oof_matrix(prepared, label, k, {out: (kind, params, seed)}, fold, id_col, parallelism)
    return oof, models[out]


def with_scores(models, df: DataFrame, prefix: str = "_m") -> DataFrame:
    """One probability column per model, ``prefix0``, ``prefix1``, ..."""
    for i, m in enumerate(models):
        df = predict(m, df, f"{prefix}{i}")
    return df


def predict_mean_keep(models, df: DataFrame, out: str = "_p") -> DataFrame:
    """Mean probability of several models added to ``df``, which keeps all its columns."""
    names = [f"_m{i}" for i in range(len(models))]
    return with_scores(models, df).withColumn(out, _mean(names)).drop(*names)


def fold_mean_predict(models, df: DataFrame, out: str = "p", keep: Sequence[str] = ("id",)) -> DataFrame:
    """Mean positive probability of several models, as columns on the same rows."""
    return predict_mean_keep(models, df, out).select(*keep, out)


def cv_report(oof: DataFrame, label: str, score: str = "p", fold: str = "fold", threshold: float = 0.5) -> DataFrame:
    """Per-fold accuracy and AUC plus mean / population std over folds (one row per fold)."""
    hit = F.avg((binarize(score, threshold) == F.col(label)).cast("double"))
    both = oof.rollup(fold).agg(hit.alias("accuracy"), F.grouping(fold).alias("_total"))
    per = both.where(F.col("_total") == 0).drop("_total")
    overall = both.where(F.col("_total") == 1).select(F.col("accuracy").alias("oof_accuracy"))
    aucs = roc_auc(oof, label, score, [fold]).select(fold, "auc")
    table = per.join(aucs, [fold], "left")
    summary = table.agg(
        F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std"), F.avg("auc").alias("auc_mean")
    )
    oof_auc = roc_auc(oof, label, score).select(F.col("auc").alias("oof_auc"))
    for one_row in (summary, overall, oof_auc):
        table = table.crossJoin(F.broadcast(one_row))
    return table


def train_accuracy_gap(models, prepared: DataFrame, label: str, fold: str = "fold", threshold: float = 0.5) -> DataFrame:
    """Training-rows accuracy of each fold model next to its held-out accuracy (overfit gap).

    One scan scores every row by all models; the aggregates are one row.
    """
    aggs = []
    for i in range(len(models)):
        hit = (binarize(f"_m{i}", threshold) == F.col(label)).cast("double")
        aggs.append(
            F.struct(
                F.lit(i).alias(fold),
                F.avg(F.when(F.col(fold) != i, hit)).alias("train_accuracy"),
                F.avg(F.when(F.col(fold) == i, hit)).alias("valid_accuracy"),
            ).alias(f"_r{i}")
        )
    one = with_scores(models, prepared.where(F.col(label).isNotNull())).agg(*aggs)
    t = one.select(F.inline(F.array(*[F.col(f"_r{i}") for i in range(len(models))])))
    return t.withColumn("gap", F.col("train_accuracy") - F.col("valid_accuracy"))


def with_validation_flag(df: DataFrame, id_col: str, share: float = 0.2, seed: int = 7, out: str = "_is_val") -> DataFrame:
    """Inner validation rows for early stopping, independent of the scored fold (Q15)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|v|"), F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(out, (h % 1000) < int(share * 1000))


def feature_importance(models, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """``(feature, fold, importance)`` from tree models, a table of #features x #models rows."""
    rows = []
    for i, m in enumerate(models):
        imp = m.featureImportances.toArray()
        rows += [(f, i, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, fold int, importance double")


def importance_ranking(imp: DataFrame) -> DataFrame:
    from .groups import average_rank_desc

    mean = imp.groupBy("feature").agg(F.avg("importance").alias("importance"))
    return average_rank_desc(mean, "importance", "rank")


def seed_bagging(prepared: DataFrame, label: str, k: int, kinds: Sequence[str], seeds: Sequence[int], fold: str = "fold",
                 id_col: str = "id", parallelism: int | None = None, weights: Mapping[str, float] | None = None,
                 params: Mapping[str, Mapping] | None = None):
    """OOF score averaged over seeds, then over learners by ``weights`` (default: equal).

    Learners without a seed (``lr``, ``nb``) are fitted once.  Returns ``(oof, models)``;
    ``oof`` has ``(id, fold, label, p, p_<kind>...)``.
    """
    groups = {kind: list(seeds)[:1] if kind in UNSEEDED else list(seeds) for kind in kinds}
    specs = {f"_{kind}_{s}": (kind, (params or {}).get(kind), s) for kind, ss in groups.items() for s in ss}
    oof, models = oof_matrix(prepared, label, k, specs, fold, id_col, parallelism)
    w = {kind: float((weights or {}).get(kind, 1.0)) for kind in kinds}
    per_kind = {f"p_{kind}": _mean([f"_{kind}_{s}" for s in ss]) for kind, ss in groups.items()}
    oof = oof.withColumns(per_kind)
    total = reduce(lambda a, b: a + b, [F.col(f"p_{kind}") * F.lit(w[kind]) for kind in kinds])
    mean = total / F.lit(sum(w.values()))
    return oof.select(id_col, fold, label, mean.alias("p"), *per_kind), [m for ms in models.values() for m in ms]


def select_by_importance(prepared: DataFrame, features: Sequence[str], label: str, k: int, ranking: DataFrame,
                         ratios: Sequence[float], kind: str = "gbt", fold: str = "fold", id_col: str = "id",
                         parallelism: int | None = None, params: Mapping | None = None, top: Sequence[int] = ()) -> DataFrame:
    """CV of the most important features, one row per set; ``is_selected`` marks the winner.

    The sets are all features, the first ``int(n * ratio)`` for each ratio, and the first
    ``n`` for each of ``top``.  The best mean CV accuracy wins, the earlier set on ties.
    """
    # one row per feature
    ordered = [r["feature"] for r in ranking.orderBy(F.col("importance").desc(), "feature").select("feature").collect()]
    sizes = [len(ordered), *(max(1, int(len(ordered) * r)) for r in ratios), *(min(max(1, n), len(ordered)) for n in top)]
    sets = {f"{i}": ordered[:n] for i, n in enumerate(dict.fromkeys(sizes))}
    reps = ablation_table(prepared, features, label, k, sets, kind, fold, id_col, parallelism, params)
    rows = {r["feature_set"]: r for r in reps.collect()}  # one row per set
    best = max(sets, key=lambda name: (rows[name]["cv_mean"], -int(name)))
    return prepared.sparkSession.createDataFrame(
        [(len(fs), rows[n]["cv_mean"], rows[n]["cv_std"], fs, n == best) for n, fs in sets.items()],
        "n_features int, cv_mean double, cv_std double, features array<string>, is_selected boolean",
    )


def ablation_table(prepared: DataFrame, features: Sequence[str], label: str, k: int,
                   feature_sets: Mapping[str, Sequence[str]], kind: str = "gbt", fold: str = "fold", id_col: str = "id",
                   parallelism: int | None = None, params: Mapping | None = None) -> DataFrame:
    """One row per named feature set: OOF accuracy and AUC (replaces one script per ablation).

    All sets are slices of one vector and are scored into one table.
    """
    cols = {name: f"_s{i}" for i, name in enumerate(feature_sets)}
    specs = {cols[name]: (kind, params, 42, list(fs)) for name, fs in feature_sets.items()}
    oof, _ = oof_matrix(prepared, label, k, specs, fold, id_col, parallelism, features=features)

    def report(item):
        name, fs = item
        rep = cv_report(oof, label, cols[name], fold).select("cv_mean", "cv_std", "oof_accuracy", "oof_auc").limit(1)
        return rep.select(F.lit(name).alias("feature_set"), F.lit(len(fs)).alias("n_features"), "*")

    return reduce(DataFrame.unionByName, _pool_map(report, feature_sets.items(), None))


def pseudo_label_rows(df: DataFrame, target: str, score: str, hi: float, lo: float, id_col: str = "id",
                      inclusive: bool = True, threshold: float = 0.5) -> DataFrame:
    """Labelled rows plus confident unlabelled rows labelled by their score (``is_pseudo`` = 1)."""
    lab = df.where(F.col(target).isNotNull()).withColumn("is_pseudo", F.lit(0))
    conf = df.where(F.col(target).isNull() & confident(score, hi, lo, inclusive))
    conf = conf.withColumn(target, binarize(score, threshold)).withColumn("is_pseudo", F.lit(1))
    return lab.unionByName(conf)


def pseudo_label_fit(prepared: DataFrame, label: str, models, hi: float, lo: float, kind: str = "gbt",
                     params: Mapping | None = None, min_rows: int = 1, seed: int = 42):
    """Refit on the labelled rows plus the confident unlabelled ones, labelled by the models' mean.

    Fewer than ``min_rows`` confident rows are not used.  Returns ``(model, n_pseudo)``.
    """
    lab = prepared.where(F.col(label).isNotNull()).withColumn("_p", F.lit(None).cast("double"))
    scored = predict_mean_keep(models, prepared.where(F.col(label).isNull()), "_p")
    scratch = Scratch(prepared.sparkSession)
    rows = scratch.save(pseudo_label_rows(lab.unionByName(scored), label, "_p", hi, lo), "pseudo")
    n = rows.where(F.col("is_pseudo") == 1).count()
    model = fit_model(rows if n >= min_rows else rows.where(F.col("is_pseudo") == 0), label, kind, params, seed)
    scratch.drop(rows)
    return model, n


def pseudo_label_search(prepared: DataFrame, label: str, k: int, bands: Sequence[tuple[float, float]], kind: str = "gbt",
                        fold: str = "fold", id_col: str = "id", min_rows: int = 1, parallelism: int | None = None,
                        params: Mapping | None = None, labels_from: str = "fold", extended: bool = False) -> DataFrame:
    """Score bands of pseudo-labels; ``oof_accuracy`` and ``oof_auc`` are taken on original rows only.

    ``extended``: the pseudo-labelled rows have folds too (by hash), train the models of the
    other folds only, and are scored out of fold beside the original rows; ``ext_accuracy``
    and ``ext_auc`` are over both (against the pseudo-labels, so they flatter a band).

    ``labels_from='fold'``: the labels added when fold ``i`` is scored come from the model
    that did not see fold ``i`` (no leak).  ``'all'``: from the mean of all fold models, most
    of which saw the scored fold.  ``n_pseudo`` counts the rows that the mean of all models
    is confident of; a band with fewer than ``min_rows`` is not fitted.  The baseline (no
    pseudo-labels) is a row of the table; ``is_selected`` marks the best OOF accuracy, the
    baseline on ties (Q16).
    """
    if labels_from not in ("fold", "all"):
        raise ValueError(f"unknown labels_from {labels_from!r}")
    spark = prepared.sparkSession
    scratch = Scratch(spark)
    base_oof, models = oof_predict(prepared, label, k, fold, kind, params, 42, id_col, "p", parallelism)
    names = [f"_m{i}" for i in range(k)]
    test = with_scores(models, prepared.where(F.col(label).isNull())).withColumn("_mean", _mean(names))
    scored = scratch.save(test, "scored")
    counts = scored.agg(*[F.count_if(confident("_mean", hi, lo)).alias(f"_b{j}") for j, (hi, lo) in enumerate(bands)])
    n_of = list(counts.first()) if bands else []  # one number per band

    def report(oof):
        rep = cv_report(oof, label, "p", fold).select("oof_accuracy", "oof_auc").first()  # one row
        return float(rep["oof_accuracy"]), float(rep["oof_auc"])

    rows = [(None, None, 0, *report(base_oof), *(report(base_oof) if extended else (None, None)))]
    own = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(k))
    for (hi, lo), n in zip(bands, n_of):
        if n < min_rows:
            rows.append((hi, lo, n, None, None, None, None))
            continue

        def sure(i, hi=hi, lo=lo):
            score = "_mean" if labels_from == "all" else names[i]
            rows = scored.where(confident(score, hi, lo)).withColumn(label, binarize(score).cast("double"))
            return rows.withColumn(fold, F.lit(-1))

        extra, held = sure, None
        if extended:
            extra, held = (lambda i, sure=sure: sure(i).where(own != i)), (lambda i, sure=sure: sure(i).where(own == i))
        oof, _ = oof_matrix(prepared, label, k, {"p": (kind, params, 42)}, fold, id_col, parallelism, extra, score_extra=held)
        rows.append((hi, lo, n, *report(oof.where(F.col(fold) >= 0)), *(report(oof) if extended else (None, None))))
    scratch.drop(scored)
    best = max(range(len(rows)), key=lambda j: (rows[j][3] if rows[j][3] is not None else -1.0, -j))
    return spark.createDataFrame(
        [(*r, j == best) for j, r in enumerate(rows)],
        "hi double, lo double, n_pseudo bigint, oof_accuracy double, oof_auc double, ext_accuracy double, ext_auc double, "
        "is_selected boolean",
    )


def stacking(prepared: DataFrame, label: str, k: int, base_kinds: Sequence[str], fold: str = "fold", id_col: str = "id",
             seed: int | Sequence[int] = 42, parallelism: int | None = None, params: Mapping[str, Mapping] | None = None):
    """Two-level stacking: base OOF scores -> logistic meta-learner scored out of fold too (Q14).

    With several seeds, one stack is fitted for each and the scores are their means.  Learners
    without a seed (``lr``, ``nb``) are fitted once for all stacks; the meta-learners' fits of
    all stacks run in one pool and their scores are columns of one table.
    Returns ``(meta_oof, coefficients, test_scores)``.
    """
    spark = prepared.sparkSession
    seeds = [seed] if isinstance(seed, int) else list(seed)
    stacks = {s: [f"p_{kind}_{seeds[0] if kind in UNSEEDED else s}" for kind in base_kinds] for s in seeds}
    specs = {name: (kind, (params or {}).get(kind), s) for s, names in stacks.items() for kind, name in zip(base_kinds, names)}
    base, models = oof_matrix(prepared, label, k, specs, fold, id_col, parallelism)
    test = prepared.where(F.col(label).isNull())
    for name, ms in models.items():
        test = predict_mean_keep(ms, test, name)
    test = Scratch(spark).save(test.select(id_col, label, *specs), "base_scores")

    meta_in = prepare(base, list(specs), label, checkpoint=False)
    meta_specs = {f"_meta_{s}": ("lr", None, s, names) for s, names in stacks.items()}
    oof, _ = oof_matrix(meta_in, label, k, meta_specs, fold, id_col, parallelism, features=list(specs))
    oof = oof.select(id_col, fold, label, _mean([f"_meta_{s}" for s in seeds]).alias("p_meta"))
    if len(seeds) > 1:
        oof = oof.groupBy(id_col, fold, label).agg(F.avg("p_meta").alias("p_meta"))

    fit_meta = lambda s: fit_model(subset(meta_in, list(specs), stacks[s]), label, "lr")
    metas = dict(zip(stacks, _pool_map(fit_meta, stacks, _fits_at_once(meta_in, label, parallelism))))
    terms, coefs = [*[f"p_{kind}" for kind in base_kinds], "intercept"], []
    for s in seeds:
        coefs += list(zip(terms, [*map(float, metas[s].coefficients.toArray()), float(metas[s].intercept)]))
        test = predict(metas[s], prepare(test, stacks[s], label, checkpoint=False), f"_meta_{s}").drop(FEATURES)
    coef = spark.createDataFrame(coefs, "term string, coefficient double").groupBy("term").agg(
        F.avg("coefficient").alias("coefficient")
    )
    test = test.withColumn("p_meta", _mean([f"_meta_{s}" for s in seeds]))
    return oof, coef, test.select(id_col, "p_meta")


def sample_params(space: Mapping[str, tuple], n_trials: int, seed: int = 42) -> list[dict]:
    """Seeded random search over ``{name: ('int'|'float'|'logfloat', lo, hi) | ('choice', [..])}``."""
    import math

    rng = random.Random(seed)
    trials = []
    for _ in range(n_trials):
        p = {}
        for name, spec in space.items():
            kind = spec[0]
            if kind == "int":
                p[name] = rng.randint(spec[1], spec[2])
            elif kind == "float":
                p[name] = rng.uniform(spec[1], spec[2])
            elif kind == "logfloat":
                p[name] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
            elif kind == "choice":
                p[name] = rng.choice(list(spec[1]))
            else:
                raise ValueError(kind)
        trials.append(p)
    return trials


def hyper_search(prepared: DataFrame, label: str, space: Mapping[str, tuple], n_trials: int = 30, k: int = 5,
                 kind: str = "gbt", fold: str = "fold", seed: int = 42, parallelism: int | None = None,
                 id_col: str = "id", base: Mapping | None = None, grid: tuple[int, int] = (30, 70)):
    """Random search over parameters and the decision threshold, judged by OOF accuracy.

    Every trial (``base`` parameters overlaid by its own) is fitted on each fold; its OOF
    scores are compared with the thresholds ``grid[0]/100 ... grid[1]/100``, and the trial
    counts with its best one (ties: the smaller).  A tolerance for early stopping is one more
    parameter of the space (``validationTol``, with ``validationIndicatorCol`` in ``base``).
    Returns ``(trials_table, best_params, best_threshold)``; first trial on ties.
    """
    trials = sample_params(space, n_trials, seed)
    specs = {f"_t{i}": (kind, {**(base or {}), **t}, seed) for i, t in enumerate(trials)}
    oof, _ = oof_matrix(prepared, label, k, specs, fold, id_col, parallelism)
    lo, hi = grid
    long = oof.select(label, F.posexplode(F.array(*specs)).alias("trial", "p"))
    hist = long.groupBy("trial", grid_bucket("p", lo, hi).alias("_b")).agg(
        F.count("*").alias("_n"), F.sum(F.col(label).cast("bigint")).alias("_pos")
    )  # at most trials x (hi - lo + 2) rows
    g = hist.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("g"))
    right = F.when(F.col("_b") >= F.col("g"), F.col("_pos")).otherwise(F.col("_n") - F.col("_pos"))
    acc = hist.crossJoin(F.broadcast(g)).groupBy("trial", "g").agg(
        (F.sum(right).cast("double") / F.sum("_n")).alias("accuracy")
    )
    best_of = acc.groupBy("trial").agg(
        F.min_by(F.struct("g", "accuracy"), F.struct(-F.col("accuracy"), F.col("g"))).alias("_best"),
        F.max(F.when(F.col("g") == 50, F.col("accuracy"))).alias("accuracy_at_half"),
    )
    table = best_of.collect()  # one row per trial
    table = sorted((r["trial"], json.dumps(trials[r["trial"]], sort_keys=True), r["_best"]["g"] / 100,
                    r["_best"]["accuracy"], r["accuracy_at_half"]) for r in table)
    best = max(table, key=lambda r: (r[3], -r[0]))
    frame = prepared.sparkSession.createDataFrame(
        [(*r, r[0] == best[0]) for r in table],
        "trial int, params string, threshold double, oof_accuracy double, accuracy_at_half double, is_best boolean",
    )
    return frame, {**(base or {}), **trials[best[0]]}, best[2]


def hyper_refit(prepared: DataFrame, label: str, params: Mapping, threshold: float = 0.5, k: int = 5, kind: str = "gbt",
                fold: str = "fold", seed: int = 42, id_col: str = "id", parallelism: int | None = None) -> DataFrame:
    """Searched parameters refitted fold by fold, the seed kept (Q18).

    One row per row of ``prepared``: labelled rows carry their out-of-fold score, the others
    the mean of the fold models (``is_oof`` tells which); ``predicted`` applies the threshold.
    """
    oof, models = oof_predict(prepared, label, k, fold, kind, params, seed, id_col, "p", parallelism)
    test = fold_mean_predict(models, prepared.where(F.col(label).isNull()), "p", [id_col])
    both = oof.select(id_col, "p", F.lit(True).alias("is_oof")).unionByName(test.withColumn("is_oof", F.lit(False)))
    return both.withColumn("predicted", binarize("p", threshold))
