"""Leaf-wise boosting, staged scores, adaptive search, random-threshold trees, tree tables.

Missing balances stay missing: these learners take them as they are.  All folds of a query
grow in lockstep.  What SQL can state -- the sums and gains of a first split, the rows a model
is grown on, accuracies over a given table of staged scores -- has a twin.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import boost as bo
from ..operators import encode as en
from ..operators import extra as ex
from ..operators import folds as fo
from ..operators import groups as gr
from ..operators import learn as ln
from ..operators import search as se
from ..session import Scratch
from .q_model import STRAT_SQL
from .registry import register
from .tables import cases, scores

K = 5
NUMERIC = ["pclass", "price", "balance", "cust_size"]
NOMINAL = ["nation", "segment"]
FEATURES = [*NUMERIC, *NOMINAL]
MAX_BINS = 64
#: Rounds are a limit: models stop after 50 rounds without a better validation loss (10 where only the scores count).
LONG = bo.Params(rounds=500, learning_rate=0.1, num_leaves=16, max_depth=4, l1=0.1, l2=0.1, row_fraction=0.8,
                 feature_fraction=0.8, patience=50)
BOOST = replace(LONG, patience=10)
SEARCHED = bo.Params(rounds=60, max_depth=4, patience=5)
SPACE = {
    "num_leaves": ("int", 4, 16, 4),
    "learning_rate": ("logfloat", 0.03, 0.3),
    "min_leaf_rows": ("int", 5, 50, 5),
    "l1": ("float", 0.0, 1.0, 0.1),
    "l2": ("float", 0.0, 1.0, 0.1),
    "row_fraction": ("float", 0.6, 1.0, 0.1),
}
TRIALS, BATCH = 30, 15
VALID = "conv(substr(md5(concat('7|v|', CAST(id AS STRING))), 1, 8), 16, 10) % 1000 < 200"
VALID_SQL = "CAST(('0x' || substr(md5('7|v|' || CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 < 200"


def _table(spark, d):
    c = gr.group_size(cases(spark, d), "cust", "cust_size").select("id", "y", *FEATURES)
    c = fo.stratified_fold(c, "y", "id", K, 42)
    c = c.withColumn("fold", F.when(F.col("y").isNull(), F.lit(-1)).otherwise(F.col("fold")))
    return Scratch(spark).save(ln.with_validation_flag(c, "id"), "cases")


def _binner(df):
    return bo.fit_bins(df.where(F.col("y").isNotNull()), FEATURES, NOMINAL, MAX_BINS)


def _fold_models(spark, d, params=BOOST):
    df = _table(spark, d)
    binner = _binner(df)
    fit = bo.Boosting(df, binner, "y", "id", "fold", "_is_val")
    return df, binner, fit.fit([bo.Spec(params, fold_out=i) for i in range(K)])


@register("boost_oof")
def boost_oof(spark, d):
    """Out-of-fold scores of leaf-wise boosting at each fold's best round; fold mean elsewhere."""
    df, binner, models = _fold_models(spark, d)
    best = [m.best for m in models]
    return bo.scored_out_of_fold(df, binner, best, "fold").select("id", "y", "fold", "p")


@register("boost_rounds")
def boost_rounds(spark, d):
    """Rounds grown and kept by each fold's model, and the validation losses at both."""
    _, _, models = _fold_models(spark, d, LONG)
    rows = [(m.fold_out, m.rounds, m.best_round, m.valid_loss[m.best_round], m.valid_loss[-1]) for m in models]
    return spark.createDataFrame(rows, "fold int, rounds int, best_round int, best_loss double, last_loss double")


@register(
    "boost_root_rows",
    f"""WITH t AS (SELECT id, y, fold, {VALID_SQL} AS is_val FROM ({STRAT_SQL}) f)
        SELECT k.fold_out, CAST(count(*) AS BIGINT) AS n FROM t, (SELECT unnest(range(5)) AS fold_out) k
        WHERE t.fold <> k.fold_out AND NOT is_val GROUP BY k.fold_out""",
)
def boost_root_rows(spark, d):
    """The rows a fold's trees are grown on: neither its own fold nor validation rows."""
    _, binner, models = _fold_models(spark, d, bo.Params(rounds=2, num_leaves=4))
    nodes = bo.tree_table(spark, models, binner)
    return nodes.where("round = 0 AND node = 0").select(F.col("fold_out").cast("long").alias("fold_out"), "n")


_GAINS_SQL = """
WITH r AS (SELECT y, pclass, nation FROM cases WHERE y IS NOT NULL),
p AS (SELECT avg(CAST(y AS DOUBLE)) AS p FROM r),
g AS (SELECT CAST(round((p - y) * 16777216) AS BIGINT) AS g, CAST(round(p * (1 - p) * 16777216) AS BIGINT) AS h, pclass, nation FROM r, p),
t AS (SELECT sum(g) / 16777216.0 AS tg, sum(h) / 16777216.0 AS th, count(*) AS tn FROM g),
v AS (SELECT 'pclass' AS feature, pclass AS v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM g GROUP BY pclass
      UNION ALL SELECT 'nation', nation, sum(g), sum(h), count(*) FROM g GROUP BY nation),
c AS (SELECT feature, v, sum(g) OVER w / 16777216.0 AS g, sum(h) OVER w / 16777216.0 AS h, sum(n) OVER w AS n
      FROM v WINDOW w AS (PARTITION BY feature ORDER BY v)),
s AS (SELECT feature, CAST(v AS DOUBLE) AS upto, CAST(n AS BIGINT) AS n_left,
             pow(greatest(abs(g) - 0.5, 0), 2) / (h + 2) + pow(greatest(abs(tg - g) - 0.5, 0), 2) / (th - h + 2)
               - pow(greatest(abs(tg) - 0.5, 0), 2) / (th + 2) AS gain
      FROM c, t WHERE n >= 20 AND tn - n >= 20)
SELECT feature, upto, n_left, gain FROM s WHERE gain > 0
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, upto) = 1
"""


@register("boost_split_gains", _GAINS_SQL, ["gain"])
def boost_split_gains(spark, d):
    """L1: the best first split on each of two features, with L1 and L2 penalties: threshold, rows, gain."""
    df = cases(spark, d).where(F.col("y").isNotNull()).select("id", "y", "pclass", "nation")
    binner = bo.fit_bins(df, ["pclass", "nation"], (), MAX_BINS)
    rows = []
    for name in binner.features:
        alone = bo.Binner([name], binner.ends, {})
        one = bo.Boosting(df, alone, "y", "id")
        model = one.fit([bo.Spec(bo.Params(rounds=1, num_leaves=2, l1=0.5, l2=2.0))])
        nodes = bo.tree_table(spark, model, alone)
        root = nodes.where("node = 0 AND feature IS NOT NULL").select("feature", "upto", "gain")
        left = nodes.where("node = 1").select(F.col("n").alias("n_left"))
        rows.append(root.crossJoin(F.broadcast(left)))  # one row each
    return rows[0].unionByName(rows[1]).select("feature", "upto", "n_left", "gain")


@register("boost_importance")
def boost_importance(spark, d):
    """Raw gain and split counts of the fold models, as aggregates over their nodes."""
    _, binner, models = _fold_models(spark, d)
    nodes = bo.tree_table(spark, [m.best for m in models], binner)
    return bo.gain_importance(nodes, ["fold_out"])


@register(
    "node_importance",
    """WITH n AS (SELECT nation AS tree, segment AS feature, abs(balance) / 100 AS gain FROM cases WHERE balance IS NOT NULL)
       SELECT tree, feature, sum(gain) AS gain, count(*) AS splits FROM n GROUP BY tree, feature""",
    ["gain"],
)
def node_importance(spark, d):
    """The importance aggregates over a given table of nodes (here one node per case)."""
    nodes = cases(spark, d).where(F.col("balance").isNotNull())
    nodes = nodes.select(F.col("nation").alias("tree"), F.col("segment").alias("feature"), (F.abs("balance") / 100).alias("gain"))
    return bo.gain_importance(nodes, ["tree"])


_SURFACE_SQL = """
WITH s AS (SELECT y, 0 AS round, p_a AS p FROM scores WHERE y IS NOT NULL
           UNION ALL SELECT y, 1, p_b FROM scores WHERE y IS NOT NULL
           UNION ALL SELECT y, 2, (p_a + p_b) / 2 FROM scores WHERE y IS NOT NULL),
g AS (SELECT CAST(unnest(range(30, 71)) AS INTEGER) AS threshold)
SELECT CAST(0 AS INTEGER) AS trial, CAST(round AS INTEGER) AS round, threshold,
       avg(CAST(y = CAST(p >= threshold / 100.0 AS INTEGER) AS DOUBLE)) AS accuracy
FROM s, g GROUP BY round, threshold
"""


@register("staged_accuracy", _SURFACE_SQL, ["accuracy"])
def staged_accuracy(spark, d):
    """Accuracies of every (round, threshold), from one histogram of a given table of staged scores."""
    s = scores(spark, d).where(F.col("y").isNotNull())
    stages = F.posexplode(F.array("p_a", "p_b", (F.col("p_a") + F.col("p_b")) / 2)).alias("round", "p")
    return bo.accuracy_surface(bo.score_histogram(s.select("y", stages), "y", "p", ["round"]).withColumn("trial", F.lit(0)))


@register("adaptive_search")
def adaptive_search(spark, d):
    """Parzen search over leaves, step, penalties and sampling; all rounds and thresholds of a trial from one fit."""
    df = _table(spark, d)
    fit = bo.Boosting(df, _binner(df), "y", "id", "fold", "_is_val")
    objective = se.boosting_objective(fit, df, "y", "fold", range(K), SEARCHED)
    return se.adaptive_search(spark, SPACE, objective, TRIALS, BATCH)


@register("fit_extra_trees")
def fit_extra_trees(spark, d):
    """Out-of-fold scores of trees with one random threshold per feature and node; fold mean elsewhere."""
    df = _table(spark, d)
    numeric = [*NUMERIC, "nation"]
    forests = ex.fit_extra_trees(df, numeric, "y", n_trees=100, max_depth=6, min_leaf_rows=2, fold="fold", folds=range(K))
    return ex.forest_scores(df, numeric, forests, "fold").select("id", "y", "fold", "p")


ORDERS = [1, 2]


def _ordered_sql() -> str:
    parts = []
    for c in NOMINAL:
        for o in ORDERS:
            w = f"(PARTITION BY {c} ORDER BY md5('{o}|' || CAST(id AS VARCHAR)), id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
            parts.append(f"(coalesce(sum(y) OVER {w}, 0) + p) / (count(*) OVER {w} + 1) AS {c}_ots{o}")
    names = [f"{c}_ots{o}" for c in NOMINAL for o in ORDERS]
    means = ", ".join(f"coalesce((SELECT (sum(y) + p) / (count(*) + 1) FROM l WHERE l.{c} = t.{c}), p) AS {c}_ots{o}" for c in NOMINAL for o in ORDERS)
    return f"""
WITH t AS (SELECT id, y, nation, segment FROM cases),
l AS (SELECT * FROM t WHERE y IS NOT NULL),
p AS (SELECT avg(CAST(y AS DOUBLE)) AS p FROM l),
seen AS (SELECT id, {", ".join(parts)} FROM l, p),
other AS (SELECT id, {means} FROM t, p WHERE y IS NULL)
SELECT id, {", ".join(names)} FROM seen UNION ALL SELECT id, {", ".join(names)} FROM other"""


@register("ordered_statistics", _ordered_sql(), [f"{c}_ots{o}" for c in NOMINAL for o in ORDERS])
def ordered_statistics(spark, d):
    """E5: ordered target statistics of two columns in two row orders, from one range-partitioned pass."""
    c = cases(spark, d).select("id", "y", *NOMINAL)
    return en.ordered_statistics(c, "y", NOMINAL, ORDERS).select("id", *[f"{c}_ots{o}" for c in NOMINAL for o in ORDERS])


@register("boost_ordered")
def boost_ordered(spark, d):
    """E5/L1: ordered boosting over ordered statistics, a model per row order; mean scores of all rows."""
    df = ln.with_validation_flag(cases(spark, d).select("id", "y", *NUMERIC[:3], *NOMINAL), "id")
    df = df.withColumn("trained", ~F.col("_is_val"))
    df = Scratch(spark).save(en.ordered_statistics(df, "y", NOMINAL, ORDERS, trained="trained"), "ordered")
    own = {o: (*NUMERIC[:3], *(f"{c}_ots{o}" for c in NOMINAL)) for o in ORDERS}
    binner = bo.fit_bins(df.where(F.col("y").isNotNull()), sorted({f for fs in own.values() for f in fs}), (), MAX_BINS)
    fit = bo.Boosting(df, binner, "y", "id", valid="_is_val")
    params = bo.Params(rounds=500, num_leaves=8, max_depth=4, patience=10)
    models = fit.fit([bo.Spec(params, order=o, features=own[o]) for o in ORDERS])
    return bo.scored(df, binner, [m.best for m in models]).select("id", "y", "p")
