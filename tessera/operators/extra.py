"""Extremely randomised trees: one random threshold per feature and node, grown level by level.

All trees (of all folds) grow together over one written table.  A level takes two passes:

1. the least and greatest value of each feature a node may use, as partial aggregates; the
   node's threshold of a feature is a seeded draw between the two;
2. rows and positives on the left of each of these thresholds; the node takes the feature
   whose threshold lowers the Gini impurity most.

A pass assigns rows to nodes by replaying the trees so far, so nothing is kept per row.  Trees of
at most 64 leaves are replayed by bit masks, some of them at a time (:class:`_Group`): a value is
placed among their thresholds once, and each feature's place leaves some leaves open.  A task
gives one row per (tree, node, feature).
Draws depend on the seed, tree, node and feature, and sums are whole numbers, so a seed gives
the same trees in every partitioning.  The driver receives one row per (node, feature).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .boost import _SEQUENCE

MOST_SUMS = 20_000_000  # (tree, node, feature) rows of one pass
BLOCK_ROWS = 1 << 16  # rows that a tree takes together
GROUP_TREES = 64  # trees whose thresholds are sorted together: their tables grow with the square of their number


@dataclass
class RandomTree:
    """Nodes as lists; node 0 is the root, a leaf has no children (-1).  Values up to the threshold go left."""

    fold_out: int | None
    feature: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    rows: list[int] = field(default_factory=lambda: [0])
    positives: list[int] = field(default_factory=lambda: [0])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row (features as columns; a missing value goes right)."""
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        node, at = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while (inner := left[node] >= 0).any():
            go = x[at, feature[node]] <= threshold[node]
            node = np.where(inner, np.where(go, left[node], right[node]), node)
        return node

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        share = np.array(self.positives) / np.maximum(np.array(self.rows), 1)
        return share[self.leaves(x)]


def _laid_out(tree: RandomTree) -> tuple[list[int], list[int]]:
    """A tree's leaves, and for each node the leaves under it as bits."""
    ends = [i for i, child in enumerate(tree.left) if child < 0]
    under = [0] * len(tree.left)
    for place, node in enumerate(ends):
        under[node] = 1 << place
    for node in range(len(under) - 1, -1, -1):  # children are numbered after their parent
        if tree.left[node] >= 0:
            under[node] = under[tree.left[node]] | under[tree.right[node]]
    return ends, under


class _Group:
    """Trees of at most 64 leaves, laid out for many rows.

    A value's place is the number of the group's thresholds below it (a missing value's is the
    last); a tree has for each of its features the leaves that a place leaves open, as bits.
    Thresholds ``tried`` at a tree's leaves have the bits of the leaves where a place goes left.
    """

    def __init__(self, trees: Sequence[RandomTree], tried: Sequence[dict] | None = None):
        self.trees, self.tried = list(trees), list(tried or [{} for _ in trees])
        cuts: dict[int, set[float]] = {}
        for t, nodes in zip(self.trees, self.tried):
            for node, child in enumerate(t.left):
                if child >= 0:
                    cuts.setdefault(t.feature[node], set()).add(t.threshold[node])
            for entries in nodes.values():
                for _, f, threshold in entries:
                    cuts.setdefault(f, set()).add(threshold)
        self.cuts = {f: np.array(sorted(c)) for f, c in cuts.items()}
        number = {f: {c: i + 1 for i, c in enumerate(cut.tolist())} for f, cut in self.cuts.items()}
        self.words, self.goes_left, self.products = [], [], []
        for t, nodes in zip(self.trees, self.tried):
            ends, under = _laid_out(t)
            whole, words, goes_left = (1 << len(ends)) - 1, {}, {}
            for node, child in enumerate(t.left):
                if child >= 0:
                    f = t.feature[node]
                    cut = number[f][t.threshold[node]]
                    word = words.setdefault(f, np.full(len(self.cuts[f]) + 1, whole, dtype=np.uint64))
                    word[:cut] &= np.uint64(whole ^ under[t.right[node]])
                    word[cut:] &= np.uint64(whole ^ under[child])
            for node, entries in nodes.items():
                for _, f, threshold in entries:
                    word = goes_left.setdefault(f, np.zeros(len(self.cuts[f]) + 1, dtype=np.uint64))
                    word[: number[f][threshold]] |= np.uint64(under[node])
            self.words.append(words)
            self.goes_left.append(goes_left)
            products = ((np.uint64(1) << np.arange(len(ends), dtype=np.uint64)) * _SEQUENCE) >> np.uint64(58)
            self.products.append(dict(zip(ends, products.tolist())))

    def places(self, columns: np.ndarray) -> dict[int, np.ndarray]:
        """The places of some rows (``columns``: features x rows) by feature."""
        return {f: np.searchsorted(cut, columns[f]) for f, cut in self.cuts.items()}

    def open_leaf(self, i: int, places: dict[int, np.ndarray], n: int) -> np.ndarray:
        """The bit of each row's leaf in tree ``i``."""
        found = None
        for f, word in self.words[i].items():
            found = word[places[f]] if found is None else np.bitwise_and(found, word[places[f]], out=found)
        return np.ones(n, dtype=np.uint64) if found is None else found

    def probabilities(self, columns: np.ndarray):
        """Each tree's probabilities of the rows."""
        places, n = self.places(columns), columns.shape[1]
        for i, t in enumerate(self.trees):
            share = np.zeros(64)
            for node, product in self.products[i].items():
                share[product] = t.positives[node] / max(t.rows[node], 1)
            yield share[_products(self.open_leaf(i, places, n))]


def _products(bit: np.ndarray) -> np.ndarray:
    """A number below 64 for each single bit."""
    return ((bit * _SEQUENCE) >> np.uint64(58)).view(np.int64)


def _groups(work: Sequence[tuple], tried: bool = False) -> tuple[list[tuple], list[tuple]]:
    """(fold left out, group, requests by tree) of trees with at most 64 leaves; the other trees' work."""
    groups, rest, parts = [], [], {}
    for tree, nodes in work:
        if (len(tree.left) + 1) // 2 > 64:
            rest.append((tree, nodes))
        else:
            parts.setdefault(tree.fold_out, []).append((tree, nodes))
    for fold_out, members in parts.items():
        for i in range(0, len(members), GROUP_TREES):
            trees, nodes = zip(*members[i : i + GROUP_TREES])
            groups.append((fold_out, _Group(trees, nodes if tried else None), nodes))
    return groups, rest


def _ranges(group: _Group, requests: Sequence[dict], columns: np.ndarray, y: np.ndarray):
    """Least and greatest values of the requested nodes and features."""
    places, n = group.places(columns), columns.shape[1]
    if not n:
        return
    missing = np.isnan(columns)
    lows, highs = (np.where(missing, np.inf, columns), np.where(missing, -np.inf, columns)) if missing.any() else (columns, columns)
    for i, nodes in enumerate(requests):
        if len(group.trees[i].left) == 1:
            place, order, present, starts = {0: 0}, slice(None), np.zeros(1, int), np.zeros(1, int)
        else:
            product = _products(group.open_leaf(i, places, n))
            sizes = np.bincount(product, minlength=64)
            present = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[present]
            order = np.argsort(product.astype(np.uint8), kind="stable")  # short numbers are sorted in linear time
            place = group.products[i]
        at = np.full(64, -1)
        at[present] = np.arange(len(present))
        wanted: dict[int, list] = {}
        for node, entries in nodes.items():
            if at[place[node]] >= 0:
                for slot, f in entries:
                    wanted.setdefault(f, []).append((slot, at[place[node]]))
        for f, slots in wanted.items():
            low, high = np.minimum.reduceat(lows[f][order], starts), np.maximum.reduceat(highs[f][order], starts)
            for slot, j in slots:
                if low[j] <= high[j]:
                    yield slot, float(low[j]), float(high[j])


def _counts(group: _Group, requests: Sequence[dict], columns: np.ndarray, y: np.ndarray):
    """Rows and positives on the left of each tried threshold."""
    places, n = group.places(columns), columns.shape[1]
    for i, nodes in enumerate(requests):
        leaf = group.open_leaf(i, places, n)
        product = _products(leaf)
        goes_left = list(group.goes_left[i].items())
        found = {}
        for begin in range(0, len(goes_left), 5):  # a bit of each row's key tells whether it goes left by a feature
            some = goes_left[begin : begin + 5]
            key = product << len(some)
            for j, (f, word) in enumerate(some):
                key |= ((leaf & word[places[f]]) != 0).astype(np.int64) << j
            shape = (64, *(2,) * len(some))
            totals = [np.bincount(key, weights, 64 << len(some)).reshape(shape) for weights in (None, y)]
            for j, (f, _) in enumerate(some):
                others = tuple(axis for axis in range(1, len(shape)) if axis != len(some) - j)
                found[f] = [t.sum(axis=others)[:, 1] for t in totals]
        for node, entries in nodes.items():
            product_of = group.products[i][node]
            for slot, f, _ in entries:
                if found[f][0][product_of]:
                    yield slot, int(found[f][0][product_of]), int(found[f][1][product_of])


def _matrix(columns: Sequence[pa.Array]) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns], axis=1)


_JOIN = {"min": min, "max": max, "sum": lambda a, b: a + b}


def _blocks(batches):
    """Labels, folds and features of some ``BLOCK_ROWS`` rows at a time."""
    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.columns[2:])))
        size += batch.num_rows
        if size >= BLOCK_ROWS:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _accumulated(batches, work, per_batch, aggregates: dict[str, str], per_group=None, tried: bool = False):
    """``per_batch`` of each tree's nodes and their rows, a row per slot for the whole task.

    ``per_group`` gives the same of a group of trees; larger trees are taken one by one.
    """
    joins = [_JOIN[f] for f in aggregates.values()]
    found: dict[int, list] = {}
    groups, work = _groups(work, tried) if per_group else ([], work)
    for y, folds, x in _blocks(batches):
        last, rows = None, None  # the groups of a fold come in turn
        for fold_out, group, requests in groups:
            if rows is None or last != fold_out:
                kept = slice(None) if fold_out is None else folds != fold_out
                last, rows = fold_out, (np.ascontiguousarray(x[kept].T), y[kept].astype(np.float64))
            for slot, *values in per_group(group, requests, *rows):
                old = found.get(slot)
                found[slot] = values if old is None else [join(a, b) for join, a, b in zip(joins, old, values)]
        seen: dict[int | None, tuple] = {}
        for tree, nodes in work:
            if tree.fold_out not in seen:
                rows = slice(None) if tree.fold_out is None else folds != tree.fold_out
                seen[tree.fold_out] = x[rows], y[rows]
            own, labels = seen[tree.fold_out]
            leaf = tree.leaves(own)
            # rows by leaf; short numbers are sorted in linear time
            order = np.argsort(leaf.astype(np.uint16) if len(tree.left) < 1 << 16 else leaf, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(leaf, minlength=len(tree.left)))])
            for node, entries in nodes.items():
                here = order[ends[node] : ends[node + 1]]
                if not len(here):
                    continue
                for slot, *values in per_batch(own[here], labels[here], entries):
                    old = found.get(slot)
                    found[slot] = values if old is None else [join(a, b) for join, a, b in zip(joins, old, values)]
    kinds = [pa.int64() if f == "sum" else pa.float64() for f in aggregates.values()]
    columns = list(zip(*found.values())) if found else [[] for _ in kinds]
    arrays = [pa.array(list(found), pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))]
    yield pa.RecordBatch.from_arrays(arrays, ["slot", *aggregates])


class _Levels:
    """The passes over the table."""

    def __init__(self, table: DataFrame, n_features: int):
        self.table, self.n_features, self.spark = table, n_features, table.sparkSession

    def _pass(self, trees: list[RandomTree], work: dict, per_batch, aggregates: dict[str, str], per_group, tried: bool) -> dict[int, tuple]:
        """``per_batch`` of each tree and its rows, aggregated by slot."""
        shared = self.spark.sparkContext.broadcast([(trees[t], nodes) for t, nodes in work.items()])
        schema = ", ".join(["slot long", *(f"{n} {'long' if f == 'sum' else 'double'}" for n, f in aggregates.items())])
        parts = self.table.mapInArrow(lambda batches: _accumulated(batches, shared.value, per_batch, aggregates, per_group, tried), schema)
        grouped = parts.groupBy("slot").agg(*[getattr(F, f)(n).alias(n) for n, f in aggregates.items()]).toArrow()
        shared.destroy()
        return {row[0]: row[1:] for row in zip(*(c.to_pylist() for c in grouped.columns))}

    def ranges(self, trees, work):
        def per_batch(x, y, entries):
            out = []
            for slot, feature in entries:
                v = x[:, feature]
                v = v[~np.isnan(v)]
                if len(v):
                    out.append((slot, float(v.min()), float(v.max())))
            return out

        return self._pass(trees, work, per_batch, {"low": "min", "high": "max"}, _ranges, False)

    def counts(self, trees, work):
        def per_batch(x, y, entries):
            out = []
            for slot, feature, threshold in entries:
                go = x[:, feature] <= threshold
                out.append((slot, int(go.sum()), int(y[go].sum())))
            return out

        return self._pass(trees, work, per_batch, {"n": "sum", "pos": "sum"}, _counts, True)


def _gini(n, pos):
    """Impurity times rows."""
    return 2.0 * pos * (n - pos) / n if n else 0.0


def fit_extra_trees(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100, max_depth: int = 6, min_split_rows: int = 2,
                    min_leaf_rows: int = 1, feature_share: float | None = None, seed: int = 42, fold: str | None = None,
                    folds: Sequence[int | None] = (None,)) -> dict[int | None, list[RandomTree]]:
    """Forests of random-threshold trees on all labelled rows (no bootstrap), one for each fold left out.

    ``feature_share`` of the features (default: their number's square root) may split a node.
    """
    ship_package(df.sparkSession)
    scratch = Scratch(df.sparkSession)
    columns = [F.col(label).cast("long").alias("y"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold")]
    columns += [F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    table = scratch.save(df.where(F.col(label).isNotNull()).select(*columns), "rows")
    levels, n = _Levels(table, len(features)), len(features)
    k = max(1, round(n * feature_share) if feature_share else round(np.sqrt(n)))
    sizes = {r["fold"]: (r["n"], r["pos"]) for r in table.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).collect()}
    trees = [RandomTree(out) for out in folds for _ in range(n_trees)]
    for t in trees:
        seen = [s for f, s in sizes.items() if t.fold_out is None or f != t.fold_out]
        t.rows[0], t.positives[0] = sum(s[0] for s in seen), sum(s[1] for s in seen)
    names = [f"{i % n_trees}" for i in range(len(trees))]  # trees of all folds draw alike
    open_nodes = {i: [(0, 1)] for i in range(len(trees))}  # node, and its place in a complete tree
    for _ in range(max_depth):
        work, slots = {}, []
        for i, nodes in open_nodes.items():
            for node, place in nodes:
                t = trees[i]
                if t.rows[node] < max(min_split_rows, 2 * min_leaf_rows) or t.positives[node] in (0, t.rows[node]):
                    continue
                rng = np.random.default_rng([seed, int(names[i]), place])
                usable, draws = rng.permutation(n), rng.random(n)
                for f in usable[:k].tolist():
                    work.setdefault(i, {}).setdefault(node, []).append((len(slots), f))
                    slots.append((i, node, place, f, float(draws[f])))
        if not slots:
            break
        if len(slots) > MOST_SUMS:
            raise ValueError(f"{len(slots)} sums in one pass: fewer trees or levels are needed (limit {MOST_SUMS})")
        ranges = levels.ranges(trees, work)
        drawn = {s: low + slots[s][4] * (high - low) for s, (low, high) in ranges.items() if low < high}
        tried = {
            i: {node: [(s, f, drawn[s]) for s, f in entries if s in drawn] for node, entries in nodes.items()} for i, nodes in work.items()
        }
        counts = levels.counts(trees, tried)
        best: dict[tuple[int, int], tuple] = {}
        for s in sorted(drawn):
            i, node, place, f, _ = slots[s]
            t, (n_left, pos_left) = trees[i], counts.get(s, (0, 0))
            n_right, pos_right = t.rows[node] - n_left, t.positives[node] - pos_left
            if min(n_left, n_right) < min_leaf_rows:
                continue
            gain = _gini(t.rows[node], t.positives[node]) - _gini(n_left, pos_left) - _gini(n_right, pos_right)
            if (i, node) not in best or gain > best[i, node][0]:
                best[i, node] = (gain, place, f, drawn[s], n_left, pos_left)
        open_nodes = {}
        for (i, node), (_, place, f, threshold, n_left, pos_left) in best.items():
            t = trees[i]
            t.feature[node], t.threshold[node] = f, threshold
            for side, (rows, pos) in enumerate(((n_left, pos_left), (t.rows[node] - n_left, t.positives[node] - pos_left))):
                child = len(t.left)
                (t.right if side else t.left)[node] = child
                for values, v in ((t.feature, 0), (t.threshold, 0.0), (t.left, -1), (t.right, -1), (t.rows, rows), (t.positives, pos)):
                    values.append(v)
                # a tree deeper than 60 levels numbers its places by hash
                open_nodes.setdefault(i, []).append((child, (2 * place + side) % (2**61 - 1)))
    scratch.drop(table)
    return {out: trees[i * n_trees : (i + 1) * n_trees] for i, out in enumerate(folds)}


def forest_scores(df: DataFrame, features: Sequence[str], forests: dict[int | None, list[RandomTree]], fold: str | None = None,
                  out: str = "p") -> DataFrame:
    """``df`` with the mean probability of the forest that did not see the row's fold (of all, for a row of no such fold)."""
    ship_package(df.sparkSession)
    small = {f: all((len(t.left) + 1) // 2 <= 64 for t in trees) for f, trees in forests.items()}
    laid_out = {
        f: [_Group(trees[i : i + GROUP_TREES]) for i in range(0, len(trees), GROUP_TREES)] if small[f] else trees for f, trees in forests.items()
    }
    shared = df.sparkSession.sparkContext.broadcast(laid_out)

    def score(folds: pa.Array, *columns: pa.Array) -> pa.Array:
        x, own = _matrix(columns), folds.to_numpy(zero_copy_only=False)
        by_feature, p = np.ascontiguousarray(x.T), {}
        for f, parts in shared.value.items():
            each = (q for g in parts for q in g.probabilities(by_feature)) if small[f] else (t.probabilities(x) for t in parts)
            total, n_trees = np.zeros(len(x)), 0
            for q in each:
                total += q
                n_trees += 1
            p[f] = total / n_trees
        mean = np.mean(list(p.values()), axis=0)
        for f, values in p.items():
            if f is not None:
                mean = np.where(own == f, values, mean)
        return pa.array(mean)

    own = F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)
    return df.withColumn(out, F.arrow_udf(score, "double")(own, *[F.col(f).cast("double") for f in features]))
