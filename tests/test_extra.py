import numpy as np
import pytest

from tessera.operators import extra as ex


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), None if i % 10 == 0 else float(c), int((a > 0) ^ (b > 0.2)), i % 3)
            for i, (a, b, c) in enumerate(rng.normal(size=(900, 3)))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int, fold int").repartition(3).cache()


ALL = ["a", "b", "c"]


def shape(forest):
    return [(t.feature, t.threshold, t.left, t.right, t.rows, t.positives) for t in forest]


def test_seeds_differ_and_repeat_under_repartition(planted):
    one = ex.fit_extra_trees(planted, ALL, "y", 5, 4, seed=1)[None]
    again = ex.fit_extra_trees(planted.repartition(8, "b"), ALL, "y", 5, 4, seed=1)[None]
    other = ex.fit_extra_trees(planted, ALL, "y", 5, 4, seed=2)[None]
    assert shape(one) == shape(again) and shape(one) != shape(other)
    assert len({str(s) for s in shape(one)}) == 5


def test_thresholds_lie_within_their_node(planted):
    forest = ex.fit_extra_trees(planted, ALL, "y", 3, 4, min_leaf_rows=3)[None]
    x = planted.toPandas()
    m = x[ALL].to_numpy(dtype=float)
    for t in forest:
        reached = {0: np.arange(len(m))}
        for node in range(len(t.left)):
            rows = reached[node]
            assert t.rows[node] == len(rows) and t.positives[node] == x.y.to_numpy()[rows].sum()
            if t.left[node] < 0:
                continue
            v = m[rows, t.feature[node]]
            assert np.nanmin(v) <= t.threshold[node] < np.nanmax(v)
            go = v <= t.threshold[node]
            assert min(go.sum(), (~go).sum()) >= 3
            reached[t.left[node]], reached[t.right[node]] = rows[go], rows[~go]


def test_learns_out_of_fold(planted):
    forests = ex.fit_extra_trees(planted, ALL, "y", 30, 8, fold="fold", folds=range(3), feature_share=1.0)
    got = ex.forest_scores(planted, ALL, forests, "fold").toPandas()
    assert ((got.p >= 0.5) == got.y).mean() > 0.85
    assert got.p.between(0, 1).all() and len(got) == 900


def test_pure_and_constant_tables_stay_leaves(spark):
    pure = spark.createDataFrame([(i, float(i), 1) for i in range(20)], "id long, a double, y int")
    assert ex.fit_extra_trees(pure, ["a"], "y", 2, 3)[None][0].left == [-1]
    flat = spark.createDataFrame([(i, 1.0, i % 2) for i in range(20)], "id long, a double, y int")
    tree = ex.fit_extra_trees(flat, ["a"], "y", 2, 3)[None][0]
    assert tree.left == [-1] and tree.probabilities(np.ones((2, 1))).tolist() == [0.5, 0.5]


def test_a_task_gives_each_sum_once():
    import pyarrow as pa

    tree = ex.RandomTree(0, [0, 0, 0], [0.5, 0.0, 0.0], [1, -1, -1], [2, -1, -1], [6, 0, 0], [3, 0, 0])
    rows = [([1, 0, 1], [0, 1, 2], [0.0, 0.25, 1.0]), ([0, 1], [1, 1], [0.5, np.nan])]
    batches = [pa.RecordBatch.from_arrays([pa.array(y), pa.array(f, pa.int32()), pa.array(x)], ["y", "fold", "x0"]) for y, f, x in rows]
    ranges = ex._accumulated(iter(batches), [(tree, {1: [(7, 0)], 2: [(8, 0)]})], lambda x, y, e: [(s, float(x[:, f].min()), int(y.sum())) for s, f in e], {"low": "min", "pos": "sum"})
    (got,) = [b.to_pylist() for b in ranges]
    assert [r["slot"] for r in got] == [7, 8] and got[0] == {"slot": 7, "low": 0.25, "pos": 0} and got[1]["pos"] == 2


def random_tree(rng, leaves, n_features, fold_out):
    t = ex.RandomTree(fold_out)
    ends = [0]
    while len(ends) < leaves:
        node = ends.pop(rng.integers(len(ends)))
        t.feature[node], t.threshold[node] = int(rng.integers(n_features)), float(rng.integers(0, 9))
        for side in (t.left, t.right):
            side[node] = len(t.left)
            for values, v in ((t.feature, 0), (t.threshold, 0.0), (t.left, -1), (t.right, -1), (t.rows, int(rng.integers(1, 50))), (t.positives, 1)):
                values.append(v)
            ends.append(side[node])
    return t


def test_groups_of_trees_give_what_single_trees_give():
    """Bit masks find the same leaves, ranges and counts as walking each tree, missing values and large trees included."""
    import pyarrow as pa

    rng = np.random.default_rng(11)
    x = rng.integers(0, 10, (700, 7)).astype(float)
    x[rng.random(x.shape) < 0.1] = np.nan
    y, folds = rng.integers(0, 2, 700), rng.integers(0, 3, 700)
    columns = [pa.array(y), pa.array(folds, pa.int32()), *(pa.array(c) for c in x.T)]
    batches = [pa.RecordBatch.from_arrays([c.slice(i, 100) for c in columns], [str(j) for j in range(9)]) for i in range(0, 700, 100)]
    trees = [random_tree(rng, leaves, 7, fold) for leaves in (1, 2, 9, 64, 70) for fold in (0, 2)]
    assert [len(g[1].trees) for g in ex._groups([(t, {}) for t in trees])[0]] == [4, 4] and len(ex._groups([(t, {}) for t in trees])[1]) == 2
    for t in trees[:8]:
        (got,) = ex._Group([t]).probabilities(np.ascontiguousarray(x.T))
        assert got.tolist() == t.probabilities(x).tolist()
    slot, asked, tried = 0, [], []
    for t in trees:
        ranges, counts = {}, {}
        for node in (i for i, c in enumerate(t.left) if c < 0):
            for f in rng.permutation(7)[:6].tolist():
                ranges.setdefault(node, []).append((slot, f))
                counts.setdefault(node, []).append((slot, f, float(rng.integers(0, 9))))
                slot += 1
        asked.append((t, ranges))
        tried.append((t, counts))

    class Passes(ex._Levels):
        def __init__(self):
            pass

        def _pass(self, trees, work, per_batch, aggregates, per_group, thresholds):
            pairs = [{r["slot"]: tuple(r.values())[1:] for b in ex._accumulated(iter(batches), work, per_batch, aggregates, g, thresholds)
                      for r in b.to_pylist()} for g in (None, per_group)]
            return pairs

    walked, masked = Passes().ranges(trees, asked)
    assert walked == masked and len(walked) > 100
    walked, masked = Passes().counts(trees, tried)
    found = [{s: v for s, v in x.items() if v[0]} for x in (walked, masked)]  # rows on the left
    assert found[0] == found[1] and len(found[0]) > 100
