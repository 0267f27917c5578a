import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import boost as bo


def frame(spark, pdf, schema):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), schema).repartition(3)


@pytest.fixture(scope="module")
def planted(spark):
    """Labels from an interaction of a and b, from categories of c, and from d being missing."""
    rng = np.random.default_rng(0)
    n = 2500
    x = pd.DataFrame({"id": range(n), "a": rng.normal(size=n), "b": rng.normal(size=n), "c": rng.choice(list("uvwxyz"), n)})
    missing = rng.random(n) < 0.3
    x["d"] = np.where(missing, np.nan, rng.normal(size=n))
    z = 3 * ((x.a > 0) ^ (x.b > 0)) - 1.5 + 1.5 * x.c.isin(["u", "y"]) + 2.0 * missing
    x["y"] = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    x["fold"], x["val"] = x.id % 3, x.id % 5 == 0
    df = frame(spark, x, "id long, a double, b double, c string, d double, y int, fold int, val boolean").cache()
    binner = bo.fit_bins(df, ["a", "b", "c", "d"], ["c"], 32)
    return df, x, binner, bo.Boosting(df, binner, "y", "id", "fold", "val")


PARAMS = bo.Params(rounds=60, learning_rate=0.3, num_leaves=6, max_depth=4, min_leaf_rows=10, patience=5)


@pytest.fixture(scope="module")
def models(planted):
    return planted[3].fit([bo.Spec(PARAMS, fold_out=k) for k in range(3)])


def test_bins_are_quantiles_and_categories(planted):
    _, x, binner, _ = planted
    assert binner.sizes.tolist() == [32, 32, 6, 32] and binner.nominal.tolist() == [False, False, True, False]
    at = np.searchsorted(np.array(binner.ends["a"]), x.a, side="left")
    counts = np.bincount(at, minlength=32)
    assert counts.min() >= len(x) // 32 - 1 and counts.max() <= len(x) // 32 + 2


def test_few_values_have_a_bin_each(spark):
    df = spark.createDataFrame([(float(i % 3), str(i % 9)) for i in range(90)] + [(None, None), (float("nan"), "x")], "v double, c string")
    b = bo.fit_bins(df, ["v", "c"], ["c"], 5)
    assert b.ends["v"] == [0.0, 1.0] and len(b.categories["c"]) == 5
    got = {(r["v"], r["c"]): tuple(r[bo.BINS]) for r in b.transform(df).collect()}
    assert got[None, None] == (3, 5) and got[1.0, "1"] == (1, 1)


def test_learns_interaction_categories_and_missing_values(planted, models):
    df, x, binner, _ = planted
    got = bo.scored_out_of_fold(df, binner, [m.best for m in models], "fold").toPandas()
    best_possible = ((3 * ((x.a > 0) ^ (x.b > 0)) - 1.5 + 1.5 * x.c.isin(["u", "y"]) + 2.0 * x.d.isna()) > 0).astype(int)
    assert ((got.p >= 0.5) == got.y).mean() > (best_possible == x.y).mean() - 0.04
    from tessera.operators.metrics import roc_auc

    assert roc_auc(bo.scored_out_of_fold(df, binner, [m.best for m in models], "fold"), "y", "p").first()["auc"] > 0.82


def test_patience_keeps_the_round_of_least_loss(planted, models):
    df, _, binner, _ = planted
    for m in models:
        assert len(m.valid_loss) == len(m.train_loss) == m.rounds + 1
        assert m.valid_loss[m.best_round] == min(m.valid_loss)
        assert m.rounds == PARAMS.rounds or m.rounds - m.best_round == PARAMS.patience
        assert m.best.rounds == m.best_round
    assert any(m.rounds < PARAMS.rounds for m in models)
    staged = bo.staged_losses(df.where("val AND fold <> 0"), binner, models[:1], "y").orderBy("round").toPandas()
    assert np.allclose(staged["loss"], models[0].valid_loss, atol=1e-12)


def test_lockstep_and_partitioning_change_nothing(spark, planted, models):
    df, _, binner, _ = planted
    alone = bo.Boosting(df.repartition(7, "a"), binner, "y", "id", "fold", "val").fit([bo.Spec(PARAMS, fold_out=1)])[0]
    assert bo.to_json(alone) == bo.to_json(models[1])


def test_resumed_training_is_the_same(planted, models):
    fit = planted[3]
    half = models[0].truncated(4)
    resumed = fit.fit([bo.Spec(PARAMS, fold_out=0, start=bo.from_json(bo.to_json(half)))])[0]
    assert resumed.rounds == models[0].rounds
    for a, b in zip(resumed.trees, models[0].trees):
        assert a.feature.tolist() == b.feature.tolist() and np.allclose(a.value, b.value)


def test_margins_written_in_between_change_nothing(planted, monkeypatch):
    fit = planted[3]
    p = bo.Params(rounds=5, num_leaves=4, learning_rate=0.3)
    whole = fit.fit([bo.Spec(p)])[0]
    monkeypatch.setattr(bo, "MARGIN_ROUNDS", 2)
    cut = fit.fit([bo.Spec(p)])[0]
    assert np.allclose(whole.train_loss, cut.train_loss) and len(whole.train_loss) == 6


def brute_split(x, g, h, p):
    """Every cut of every numeric feature, missing values on either side."""
    q = lambda a, b: max(abs(a) - p.l1, 0) ** 2 / (b + p.l2)
    best = (0.0, None, None)
    for f in range(x.shape[1]):
        gone = np.isnan(x[:, f])
        for t in [*np.unique(x[~gone, f])]:
            for side in (False, True):
                go = np.where(gone, side, x[:, f] <= t)
                if go.sum() < p.min_leaf_rows or (~go).sum() < p.min_leaf_rows:
                    continue
                gain = q(g[go].sum(), h[go].sum()) + q(g[~go].sum(), h[~go].sum()) - q(g.sum(), h.sum())
                if gain > best[0] + 1e-9:
                    best = (gain, f, t)
    return best


@pytest.mark.parametrize("l1,l2", [(0.0, 0.0), (0.7, 3.0)])
def test_every_split_has_the_best_gain(spark, l1, l2):
    rng = np.random.default_rng(1)
    n = 120
    x = rng.integers(0, 12, (n, 3)).astype(float)
    x[rng.random((n, 3)) < 0.2] = np.nan
    y = (np.nan_to_num(x[:, 0], nan=9) + rng.normal(size=n) * 3 > 6).astype(int)
    pdf = pd.DataFrame({"id": range(n), "u": x[:, 0], "v": x[:, 1], "w": x[:, 2], "y": y})
    df = frame(spark, pdf, "id long, u double, v double, w double, y int")
    binner = bo.fit_bins(df, ["u", "v", "w"], (), 32)
    p = bo.Params(rounds=2, learning_rate=0.5, num_leaves=6, min_leaf_rows=5, l1=l1, l2=l2)
    model = bo.Boosting(df, binner, "y", "id").fit([bo.Spec(p)])[0]
    margin = np.full(n, model.base)
    bins = binner.binned([__import__("pyarrow").array(c, from_pandas=True) for c in x.T])
    for tree in model.trees:
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        reached = {0: np.arange(n)}
        for node in range(len(tree.left)):
            rows = reached[node]
            gain, f, _ = brute_split(x[rows], g[rows], h[rows], p)
            if tree.left[node] >= 0:
                assert tree.gain[node] == pytest.approx(gain, rel=1e-5, abs=1e-5)
                go = tree.goes_left[node, bins[rows, tree.feature[node]]]
                reached[tree.left[node]], reached[tree.right[node]] = rows[go], rows[~go]
            else:
                assert tree.count[node] == len(rows)
                want = -0.5 * np.sign(g[rows].sum()) * max(abs(g[rows].sum()) - l1, 0) / (h[rows].sum() + l2)
                assert tree.value[node] == pytest.approx(want, rel=1e-4, abs=1e-5)
        # best first: no leaf could have gained more than a split that was taken
        taken = [tree.gain[i] for i in range(len(tree.left)) if tree.left[i] >= 0]
        left = [brute_split(x[r], g[r], h[r], p)[0] for i, r in reached.items() if tree.left[i] < 0]
        assert len(taken) == p.num_leaves - 1 or max(left) <= 1e-6
        assert not left or max(left) <= max(taken) + 1e-5
        margin += tree.scores(bins)


def test_nominal_features_split_by_sets(spark):
    """Categories of odd code are positive: one split, which no cut in their order could make."""
    rows = [(i, f"c{i % 8}", int(i % 8 % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, c string, y int")
    binner = bo.fit_bins(df, ["c"], ["c"], 16)
    model = bo.Boosting(df, binner, "y", "id").fit([bo.Spec(bo.Params(rounds=1, num_leaves=2))])
    root = bo.tree_table(spark, model, binner).where("node = 0").first()
    assert set(root["categories"]) in ({"c0", "c2", "c4", "c6"}, {"c1", "c3", "c5", "c7"})


def test_nothing_to_learn_grows_nothing(spark):
    df = spark.createDataFrame([(i, 1.0, i % 2) for i in range(60)], "id long, v double, y int")
    binner = bo.fit_bins(df, ["v"], (), 8)
    model = bo.Boosting(df, binner, "y", "id").fit([bo.Spec(bo.Params(rounds=20))])[0]
    assert model.rounds == 0 and len(model.train_loss) == 1
    assert bo.scored(df, binner, [model]).first()["p"] == pytest.approx(0.5)


def test_surface_is_brute_force(spark, planted, models):
    df, x, binner, _ = planted
    trials = [[m.truncated(r) for m in models] for r in (6, 3)]
    surface = bo.accuracy_surface(bo.staged_histogram(df, binner, trials, "y", "fold"))
    got = {(r["trial"], r["round"], r["threshold"]): r["accuracy"] for r in surface.collect()}
    bins = binner.transform(df).select("y", "fold", bo.BINS).toPandas()
    b = np.frombuffer(b"".join(map(bytes, bins[bo.BINS])), dtype=np.uint8).reshape(-1, 4)
    for t, ms in enumerate(trials):
        for r in range(max(m.rounds for m in ms) + 1):
            p = np.zeros(len(bins))
            for m in ms:
                own = (bins.fold == m.fold_out).to_numpy()
                p[own] = bo.sigmoid(m.truncated(min(r, m.rounds)).margins(b[own]))
            for g in (30, 44, 50, 70):
                assert got[t, r, g] == pytest.approx(((p >= g / 100) == bins.y).mean())
    best = {r["trial"]: r for r in bo.best_of_surface(surface).collect()}
    top = max(v for k, v in got.items() if k[0] == 0)
    assert best[0]["accuracy"] == top and (0, best[0]["round"], best[0]["threshold"]) in got


def test_tree_table_and_raw_gain(spark):
    """A hand-made table of nodes: gains and splits by feature."""
    rows = [(0, "a", 2.0), (0, "b", 1.0), (0, "a", 0.5), (0, None, 0.0), (1, "b", 4.0)]
    nodes = spark.createDataFrame(rows, "model int, feature string, gain double")
    got = {(r["model"], r["feature"]): (r["gain"], r["splits"]) for r in bo.gain_importance(nodes).collect()}
    assert got == {(0, "a"): (2.5, 2), (0, "b"): (1.0, 1), (1, "b"): (4.0, 1)}


def test_tree_table_holds_every_node(spark, planted, models):
    binner = planted[2]
    nodes = bo.tree_table(spark, models, binner).toPandas()
    assert len(nodes) == sum(len(t.left) for m in models for t in m.trees)
    first = nodes[(nodes.model == 0) & (nodes["round"] == 0)].set_index("node")
    inner = first[first.feature.notna()]
    for node, row in inner.iterrows():
        assert first[first.parent == node].n.sum() == row.n
    assert first.loc[0, "depth"] == 0 and (first[first.parent >= 0].depth >= 1).all()


def test_sums_of_one_pass_are_limited(planted, monkeypatch):
    monkeypatch.setattr(bo, "MOST_SUMS", 10)
    with pytest.raises(ValueError):
        planted[3].fit([bo.Spec(bo.Params(rounds=1))])


def auc_of(pdf, p, y="y"):
    ranks = pdf[p].rank()
    pos = pdf[y] == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_ordered_statistics_are_brute_force(spark):
    import hashlib

    from tessera.operators.encode import ordered_statistics

    rng = np.random.default_rng(4)
    rows = [(i, None if i % 17 == 0 else f"k{rng.integers(0, 6)}", f"m{i % 2}", None if i % 11 == 0 else int(rng.integers(0, 2))) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, k string, m string, y int").repartition(4)
    got = {r["id"]: r for r in ordered_statistics(df, "y", ["k", "m"], [3, 8], weight=2.0).collect()}
    assert len(got) == 150
    prior = np.mean([r[3] for r in rows if r[3] is not None])
    for at, name in ((1, "k"), (2, "m")):
        for order in (3, 8):
            place = lambda r, o=order: (hashlib.md5(f"{o}|{r[0]}".encode()).hexdigest(), r[0])
            for r in rows:
                if r[at] is None:
                    want = prior
                else:
                    before = [x[3] for x in rows if x[at] == r[at] and x[3] is not None and (r[3] is None or place(x) < place(r))]
                    want = (sum(before) + 2 * prior) / (len(before) + 2)
                assert got[r[0]][f"{name}_ots{order}"] == pytest.approx(want)


def test_ordered_boosting_does_not_leak_through_a_noise_key(spark):
    """A key of about four rows each says nothing: only models that see a row's own label find something in it."""
    from tessera.operators.encode import ordered_statistics, target_encode

    rng = np.random.default_rng(9)
    rows = [(i, f"k{rng.integers(0, 400)}", int(rng.integers(0, 2))) for i in range(1600)]
    df = spark.createDataFrame(rows, "id long, k string, y int").repartition(4)
    df = df.withColumn("trained", F.col("id") < 1200)
    df = ordered_statistics(df, "y", ["k"], [1, 2], trained="trained")
    labelled = target_encode(df.withColumn("t", F.when(F.col("trained"), F.col("y"))), "t", ["k"], mode="full")
    df = labelled.withColumn("valid", ~F.col("trained")).cache()
    p = bo.Params(rounds=12, learning_rate=0.3, num_leaves=8, min_leaf_rows=5)
    binner = bo.fit_bins(df, ["k_ots1", "k_ots2", "k_te"], (), 32)
    greedy, first, second = bo.Boosting(df, binner, "y", "id", valid="valid").fit([
        bo.Spec(p, features=("k_te",)),
        bo.Spec(p, order=1, features=("k_ots1",)),
        bo.Spec(p, order=2, features=("k_ots2",)),
    ])
    noise = greedy.train_loss[0]
    assert greedy.train_loss[-1] < noise - 0.05  # the key's own labels leak into its encoding
    assert greedy.valid_loss[-1] > noise + 0.05
    for m in (first, second):
        assert m.train_loss[-1] > noise - 0.03  # an unbiased estimate: nothing is found
        assert m.valid_loss[-1] < greedy.valid_loss[-1]
    assert {t for m in (first, second) for tree in m.trees for t in tree.feature[tree.left >= 0].tolist()} <= {0, 1}


def test_a_row_moves_by_rows_before_it_only(spark):
    """Changing one label changes no training margin of rows before it in the order."""
    rng = np.random.default_rng(12)
    rows = [(i, float(rng.normal()), int(rng.integers(0, 2))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v double, y int")
    keys = {r["id"]: r["k"] for r in df.select("id", F.xxhash64(F.col("id").cast("string")).alias("k")).collect()}
    order = bo._blocks(np.array([keys[i] for i in range(300)]), np.ones(300, bool), (5, 300))
    last = int(np.argmax(order))
    binner = bo.fit_bins(df, ["v"], (), 16)

    def fitted(frame):
        return bo.Boosting(frame, binner, "y", "id").fit([bo.Spec(bo.Params(rounds=1, num_leaves=4, min_leaf_rows=20), order=5)])[0]

    tree = fitted(df).trees[0]
    own = tree.leaves(binner.binned([__import__("pyarrow").array([r[1] for r in rows])]))
    p = bo.sigmoid(np.full(300, fitted(df).base))
    y = np.array([r[2] for r in rows])
    for leaf in np.unique(own):
        for block in range(order.max() + 1):
            before = (own == leaf) & (order < block)
            want = -0.1 * (p - y)[before].sum() / (p * (1 - p))[before].sum() if before.any() else 0.0
            assert tree.by_block[leaf, block] == pytest.approx(want, abs=1e-5)
    assert order[last] == order.max() and (order >= 0).all()


def test_routes_lead_to_the_trees_leaves():
    rng = np.random.default_rng(3)
    trees = []
    for leaves in (1, 5, 16, 40, 64, 70):  # several in one word, one in a word, one too large for it
        left, right, feature, ends = [-1], [-1], [0], [0]
        while len(ends) < leaves:
            node = ends.pop(rng.integers(len(ends)))
            left[node], right[node], feature[node] = len(left), len(left) + 1, int(rng.integers(4))
            ends += [left[node], right[node]]
            left, right, feature = left + [-1, -1], right + [-1, -1], feature + [0, 0]
        n = len(left)
        parts = [np.array(feature), rng.random((n, 9)) < 0.5, np.array(left), np.array(right), rng.normal(size=n), np.zeros(n), np.zeros(n, int), np.zeros(n)]
        trees.append(bo.Tree(*parts))
    bins = rng.integers(0, 9, (500, 4)).astype(np.uint8)
    routes = bo.Routes(trees)
    for tree, found in zip(trees, routes.leaves(bo.codes_of(bins)), strict=True):
        assert found.tolist() == tree.leaves(bins).tolist()
    assert routes.scores(bo.codes_of(bins)).tolist() == sum((t.scores(bins) for t in trees), np.zeros(500)).tolist()


def test_a_pass_reads_blocks_of_rows(planted, monkeypatch):
    """The table of a fit has a row per block of cases, whatever their number."""
    seen = []
    save = bo.Boosting._with_margins
    monkeypatch.setattr(bo.Boosting, "_with_margins", lambda *a, **k: seen.append(save(*a, **k)) or seen[-1])
    planted[3].fit([bo.Spec(bo.Params(rounds=0))])
    assert "blocks" in seen[0].columns


def test_histogram_sums_are_exact():
    rng = np.random.default_rng(5)
    n = bo.BLOCK_ROWS
    place, codes = rng.integers(0, 2, n), rng.integers(0, 3, (2, n))
    y, p = np.zeros(n), np.full(n, 0.5)  # the greatest hessians
    got = bo._histogram(place, codes, y, p, 2, 3)
    for node in range(2):
        for f in range(2):
            for b in range(3):
                rows = int(((place == node) & (codes[f] == b)).sum())
                assert got[node, f, b].tolist() == [rows * 2**23, rows * 2**22, rows]
    whole = bo._histogram(np.zeros(n, int), np.zeros((1, n), int), y, p, 1, 1)
    assert whole.ravel().tolist() == [n * 2**23, n * 2**22, n]


def test_blocks_and_files_stay_small_with_many_models(planted, monkeypatch, tmp_path):
    """A block's margins take at most ``BLOCK_BYTES`` and a row group a few blocks, whatever the models' number."""
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(bo, "BLOCK_BYTES", 1 << 14)
    monkeypatch.setattr(bo, "_WIDE_ROWS", {**bo._WIDE_ROWS, "parquet.block.size": str(1 << 15)})
    folders, save = [], bo.Scratch.save

    def saved(self, df, name="table", *a, **k):
        out = save(self, df, name, *a, **k)
        if name == "margins":
            folders.append([(g.num_rows, f.schema_arrow.names) for p in glob.glob(out.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0] + "/*.parquet")
                            for f in [pq.ParquetFile(p)] for g in map(f.metadata.row_group, range(f.metadata.num_row_groups))])
            sizes.append(max(r[0] for r in out.selectExpr("length(margins)").collect()))
        return out

    sizes: list[int] = []
    monkeypatch.setattr(bo.Scratch, "save", saved)
    got = planted[3].fit([bo.Spec(bo.Params(rounds=1), fold_out=i % 3) for i in range(8)])
    assert len(got) == 8 and sizes[0] <= 1 << 14
    assert max(n for n, _ in folders[0]) <= 3 and sum(n for n, _ in folders[0]) >= 2000 * 8 * 8 >> 14


def test_stopped_models_leave_the_table(planted, monkeypatch):
    """Margins of models that have stopped are not written on; the others stay as they are alone."""
    held, save = [], bo.Boosting._with_margins
    monkeypatch.setattr(bo.Boosting, "_with_margins", lambda self, table, views, *a, **k: held.append(len(views)) or save(self, table, views, *a, **k))
    long, short = bo.Spec(bo.Params(rounds=10, num_leaves=4), fold_out=0), bo.Spec(bo.Params(rounds=2, num_leaves=4), fold_out=1)
    together = planted[3].fit([short, long, short])
    assert held == [3, 1, 1]
    (alone,) = planted[3].fit([long])
    assert bo.to_json(together[1]) == bo.to_json(alone) and [m.rounds for m in together] == [2, 10, 2]
