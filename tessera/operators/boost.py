"""Gradient-boosted trees from Spark aggregations: leaf-wise growth, penalties, missing values,
staged validation losses with patience.

Shape of a fit:

* features are cut into at most ``max_bins`` bins (exact quantiles of distinct values; the
  categories of a nominal feature are bins of their own) and written once, one byte per
  value; missing values have a bin of their own in every feature;
* a pass over that table sums gradients, hessians and row counts by (model, leaf, feature,
  bin): in numpy within each task, then in a Spark aggregation.  Sums are whole numbers (of
  2 ** -24), so they do not depend on the partitioning, and neither do the trees;
* what reaches the driver is those sums -- leaves x features x bins, whatever the number of
  rows, with a limit (``MOST_SUMS``); it picks splits from a best-first queue;
* only the smaller child of a split is summed, its sibling is the parent minus it.  All leaves
  waiting in the queue have their children summed in one pass, so a tree takes as many
  passes as it has levels, not leaves;
* for each split both sides are tried for the missing values, the better one is stored;
* several models (folds, trials, seeds) grow in lockstep: one pass serves all of them;
* losses of training and validation rows come with the next round's first pass.  After
  ``patience`` rounds without a better validation loss a model stops; ``Ensemble.best``
  is the model cut back to its best round;
* ordered models (``Spec.order``): a training row's gradient comes from trees whose leaf values
  were taken from rows before it in a hash order, never from itself.  Rows form blocks of
  doubling size in that order, a tree's leaf sums are taken by block in one more pass, and a
  row moves by the values of all blocks before its own;
* margins are written with the table every ``MARGIN_ROUNDS`` rounds, so tasks replay only the
  trees since then, and a lost executor re-reads files.  A row of that table is a block of
  many cases, as arrays of ``BLOCK_BYTES`` at most.  Margins of models that have stopped are
  left out once they are half of them;
* a tree is replayed by bit masks: each feature's bin leaves some leaves open, the one open for
  all features is the row's (:class:`Routes`).  Margins are only taken of rows that are summed.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .metrics import grid_bucket
from .ordered import running_sums

SCALE = float(1 << 24)  # sums are whole numbers of 1 / SCALE
MARGIN_ROUNDS = 8
TASK_MARGINS = 500_000  # rows x models that are worth a task
BLOCK_ROWS = 1 << 14  # cases of a block; sums of hessians and row counts of one share a double (see ``_histogram``)
BLOCK_BYTES = 4 << 20  # a block's margins: it has the fewer cases, the more models there are
#: A row of blocks takes megabytes: row groups end at 8 MB, asked after each row (Parquet asks every 100 rows only), so that
#: neither a writer nor a reader's batch holds a task's whole file.  Not compressed: a share of the files is then as large in
#: memory as on disk.
_WIDE_ROWS = {
    "compression": "none",
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
    "parquet.enable.dictionary": "false",
}
MOST_SUMS = 20_000_000  # (model, leaf, feature, bin) sums in one pass
MOST_BINS = 254
BINS = "_bins"


# ---------------------------------------------------------------- bins


@dataclass
class Binner:
    """Bins of each feature: upper ends of a numeric one (all but the last), categories of a nominal one."""

    features: list[str]
    ends: dict[str, list[float]]
    categories: dict[str, list[str]]

    @property
    def sizes(self) -> np.ndarray:
        """Bins of each feature, without the one for missing values (which is the next)."""
        return np.array([len(self.categories[f]) if f in self.categories else len(self.ends[f]) + 1 for f in self.features])

    @property
    def nominal(self) -> np.ndarray:
        return np.array([f in self.categories for f in self.features])

    def binned(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """Bins of some rows (rows x features) from the features' columns."""
        out = np.empty((len(columns[0]), len(self.features)), dtype=np.uint8)
        for i, (name, column) in enumerate(zip(self.features, columns)):
            if name in self.categories:
                kinds = self.categories[name]
                found = pc.index_in(column, value_set=pa.array(kinds, column.type), skip_nulls=True)
                out[:, i] = found.fill_null(len(kinds)).to_numpy(zero_copy_only=False)  # an unknown category counts as missing
            else:
                x = column.to_numpy(zero_copy_only=False).astype(np.float64)
                bins = np.searchsorted(np.array(self.ends[name]), x, side="left")
                out[:, i] = np.where(np.isnan(x), len(self.ends[name]) + 1, bins)
        return out

    def transform(self, df: DataFrame, out: str = BINS) -> DataFrame:
        """``df`` with the rows' bins as one binary column, a byte per feature."""
        ship_package(df.sparkSession)
        spec = self

        def to_bins(*columns: pa.Array) -> pa.Array:
            bins = spec.binned(columns)
            ends = pa.array(np.arange(len(bins) + 1, dtype=np.int32) * bins.shape[1], pa.int32())
            return pa.Array.from_buffers(pa.binary(), len(bins), [None, ends.buffers()[1], pa.py_buffer(bins.tobytes())])

        kinds = [F.col(f).cast("string") if f in self.categories else F.col(f).cast("double") for f in self.features]
        return df.withColumn(out, F.arrow_udf(to_bins, "binary")(*kinds))


def fit_bins(df: DataFrame, features: Sequence[str], nominal: Sequence[str] = (), max_bins: int = 64) -> Binner:
    """Exact quantile bins of ``df``'s numeric features; a bin per category of the nominal ones.

    A numeric feature of at most ``max_bins`` values has a bin per value.  Beyond
    ``max_bins`` categories, the rarest share the last bin with values never seen (the
    missing one).  The driver receives at most ``max_bins`` rows per feature.
    """
    if not 2 <= max_bins <= MOST_BINS:
        raise ValueError(f"max_bins must be from 2 to {MOST_BINS}")
    scratch = Scratch(df.sparkSession)
    numeric = [f for f in features if f not in nominal]
    ends: dict[str, list[float]] = {f: [] for f in numeric}
    categories: dict[str, list[str]] = {f: [] for f in nominal}
    if numeric:
        pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in numeric])
        values = df.select(F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
        counted = scratch.save(values.groupBy("feature", "value").agg(F.count("*").alias("n")), "values")
        totals = counted.groupBy("feature").agg(F.sum("n").alias("total"), F.count("*").alias("distinct_values"))
        ranked = running_sums(counted, ["value"], ["n"], by=["feature"]).join(F.broadcast(totals), "feature")  # a row per feature
        share = F.floor((F.col("cum_n") - 1) * max_bins / F.col("total"))
        few = F.col("distinct_values") <= max_bins
        cut = ranked.groupBy("feature", F.when(few, F.col("value")).otherwise(share).alias("bin")).agg(F.max("value").alias("value"))
        for r in cut.orderBy("feature", "value").collect():
            ends[r["feature"]].append(r["value"])
        ends = {f: e[:-1] for f, e in ends.items()}
        scratch.drop(counted)
    for f in nominal:
        top = df.where(F.col(f).isNotNull()).groupBy(F.col(f).cast("string").alias("c")).count()
        categories[f] = sorted(r["c"] for r in top.orderBy(F.col("count").desc(), "c").limit(max_bins).collect())
    return Binner(list(features), ends, categories)


# ---------------------------------------------------------------- trees


@dataclass
class Tree:
    """Nodes as arrays; node 0 is the root, a leaf has no children (-1)."""

    feature: np.ndarray
    goes_left: np.ndarray  # nodes x bins, the missing values' bin included
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    count: np.ndarray
    hessian: np.ndarray
    by_block: np.ndarray | None = None  # nodes x blocks: an ordered model's values for its training rows

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = self.left[node] >= 0
            if not inner.any():
                return node
            go = self.goes_left[node, bins[rows, self.feature[node]]]
            node = np.where(inner, np.where(go, self.left[node], self.right[node]), node)

    def scores(self, bins: np.ndarray, blocks: np.ndarray | None = None) -> np.ndarray:
        """Each row's value; ``blocks`` are those of rows that trained an ordered model (-1: another row)."""
        leaves = self.leaves(bins)
        if self.by_block is None or blocks is None:
            return self.value[leaves]
        return np.where(blocks >= 0, self.by_block[leaves, blocks], self.value[leaves])


@dataclass
class Ensemble:
    """A fitted model: start score, trees, and the losses after 0, 1, 2, ... trees."""

    base: float
    trees: list[Tree] = field(default_factory=list)
    train_loss: list[float] = field(default_factory=list)
    valid_loss: list[float] = field(default_factory=list)
    fold_out: int | None = None

    @property
    def rounds(self) -> int:
        return len(self.trees)

    @property
    def best_round(self) -> int:
        """The number of trees of least validation loss (the fewest of equals); all without validation rows."""
        return int(np.argmin(self.valid_loss)) if self.valid_loss else self.rounds

    def truncated(self, rounds: int) -> Ensemble:
        return replace(
            self, trees=self.trees[:rounds], train_loss=self.train_loss[: rounds + 1], valid_loss=self.valid_loss[: rounds + 1]
        )

    @property
    def best(self) -> Ensemble:
        return self.truncated(self.best_round)

    def margins(self, bins: np.ndarray, routes: Routes | None = None) -> np.ndarray:
        return self.base + (routes or Routes(self.trees)).scores(codes_of(bins))

    def staged(self, bins: np.ndarray, routes: Routes | None = None) -> np.ndarray:
        """Margins after 0, 1, ..., all trees (rows x rounds + 1)."""
        steps = [np.zeros(len(bins)), *(routes or Routes(self.trees)).steps(codes_of(bins))]
        return self.base + np.cumsum(np.stack(steps, axis=1), axis=1)


_SEQUENCE = np.uint64(0x03F79D71B4CB0A89)  # de Bruijn: its products with powers of two differ in their upper six bits


class Routes:
    """Trees laid out for many rows: the leaves that each bin of each feature leaves open, as bits.

    As many trees as have 64 leaves together share a word; a tree of more leaves is walked node by node.
    """

    def __init__(self, trees: Sequence[Tree]):
        self.packs: list[tuple] = []  # (words: features x bins, [(tree, shift, leaves, the node of each product)])
        width = 1 + max((int(t.feature.max()) for t in trees), default=0)
        taken = 64
        for tree in trees:
            ends = np.flatnonzero(tree.left < 0)
            if len(ends) > 64:
                self.packs.append((None, [(tree, 0, 0, None)]))
                taken = 64
                continue
            if taken + len(ends) > 64:
                self.packs.append((np.full((width, tree.goes_left.shape[1]), 2**64 - 1, dtype=np.uint64), []))
                taken = 0
            words, members = self.packs[-1]
            under = [0] * len(tree.left)
            for place, node in enumerate(ends.tolist()):
                under[node] = 1 << (taken + place)
            for node in range(len(under) - 1, -1, -1):  # children are numbered after their parent
                if tree.left[node] >= 0:
                    left, right = under[tree.left[node]], under[tree.right[node]]
                    under[node] = left | right
                    words[tree.feature[node]] &= np.where(tree.goes_left[node], np.uint64(~right & (2**64 - 1)), np.uint64(~left & (2**64 - 1)))
            nodes = np.zeros(64, dtype=np.int64)
            nodes[((np.uint64(1) << np.arange(len(ends), dtype=np.uint64)) * _SEQUENCE) >> np.uint64(58)] = ends
            members.append((tree, taken, len(ends), nodes))
            taken += len(ends)

    def _found(self, codes: np.ndarray):
        """(tree, the node of each product, the product of each row); without products the rows' leaves."""
        for words, members in self.packs:
            if words is None:
                yield members[0][0], None, members[0][0].leaves(codes.T)
                continue
            open_leaves = words[0][codes[0]]
            for f in range(1, len(words)):
                open_leaves &= words[f][codes[f]]
            for tree, shift, n, nodes in members:
                one = (open_leaves >> np.uint64(shift)) & np.uint64(2**n - 1)
                yield tree, nodes, ((one * _SEQUENCE) >> np.uint64(58)).view(np.int64)

    def leaves(self, codes: np.ndarray):
        """Each tree's leaves of the rows (``codes``: features x rows)."""
        for _, nodes, at in self._found(codes):
            yield at if nodes is None else nodes[at]

    def steps(self, codes: np.ndarray, blocks: np.ndarray | None = None):
        """Each tree's values of the rows; ``blocks`` as in :meth:`Tree.scores`."""
        for tree, nodes, at in self._found(codes):
            if tree.by_block is None or blocks is None:
                yield tree.value[at] if nodes is None else tree.value[nodes][at]
            else:
                leaves = at if nodes is None else nodes[at]
                yield np.where(blocks >= 0, tree.by_block[leaves, blocks], tree.value[leaves])

    def scores(self, codes: np.ndarray, blocks: np.ndarray | None = None) -> np.ndarray:
        return sum(self.steps(codes, blocks), np.zeros(codes.shape[1]))


def codes_of(bins: np.ndarray) -> np.ndarray:
    """Bins as features x rows, ready to index by."""
    return np.ascontiguousarray(bins.T, dtype=np.intp)


def flat_bytes(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column without nulls, in place."""
    if not len(column):
        return np.zeros(0, dtype=np.uint8)
    _, ends, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(ends, dtype=kind)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, dtype=np.uint8)


def bins_of(column: pa.Array, n_features: int) -> np.ndarray:
    """A binary column of bins as a matrix (rows x features)."""
    return flat_bytes(column).reshape(-1, n_features)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


# ---------------------------------------------------------------- parameters


@dataclass(frozen=True)
class Params:
    rounds: int = 500
    learning_rate: float = 0.1
    num_leaves: int = 31
    max_depth: int | None = None
    min_leaf_rows: int = 20
    l1: float = 0.0
    l2: float = 0.0
    row_fraction: float = 1.0
    feature_fraction: float = 1.0
    min_gain: float = 0.0
    patience: int | None = None
    seed: int = 42


@dataclass(frozen=True)
class Spec:
    """One model of a lockstep fit: its parameters and the fold that it must not see."""

    params: Params = Params()
    fold_out: int | None = None
    start: Ensemble | None = None  # resume from this model
    order: int | None = None  # ordered boosting in the row order of this seed
    features: tuple[str, ...] | None = None  # the model's own features (default: all)


def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _quality(g, h, p: Params):
    return shrunk(g, p.l1) ** 2 / (h + p.l2 + 1e-12)


@dataclass
class Split:
    gain: float
    feature: int
    goes_left: np.ndarray
    left: np.ndarray  # sums (g, h, n) of the left side
    right: np.ndarray


def best_split(sums: np.ndarray, sizes: np.ndarray, nominal: np.ndarray, p: Params, used: np.ndarray) -> Split | None:
    """The best split of a leaf from its sums (features x bins x (g, h, n)), None if there is none.

    A numeric feature is cut between bins, a nominal one between categories in the order of
    g / h.  Missing values are tried on both sides, and alone against all others.  Ties: the
    first feature, the first cut, missing values on the right.
    """
    n_features, n_bins, _ = sums.shape
    total = sums[0].sum(axis=0)
    place = np.arange(n_bins)
    regular = place < sizes[:, None]
    real = np.where(regular[..., None], sums, 0)
    missing = sums[np.arange(n_features), sizes]
    ratio = np.where(nominal[:, None], real[..., 0] / (real[..., 1] + SCALE), place)
    empty = nominal[:, None] & (real[..., 2] == 0)  # categories without rows stand last, and stay right
    order = np.argsort(np.where(regular & ~empty, ratio, np.inf), axis=1, kind="stable")
    cum = np.cumsum(np.take_along_axis(real, order[..., None], axis=1), axis=1)
    sides = np.stack([cum, cum + missing[:, None]], axis=0)  # missing right, missing left
    g, h, n = (sides[..., i] / (SCALE if i < 2 else 1) for i in range(3))
    tg, th, tn = total[0] / SCALE, total[1] / SCALE, total[2]
    gain = _quality(g, h, p) + _quality(tg - g, th - h, p) - _quality(tg, th, p)
    fits = (n >= max(p.min_leaf_rows, 1)) & (tn - n >= max(p.min_leaf_rows, 1)) & regular & used[:, None]
    gain = np.where(fits, gain, -np.inf).transpose(1, 2, 0)
    at = int(np.argmax(gain))
    f, cut, side = np.unravel_index(at, gain.shape)
    if not gain[f, cut, side] > p.min_gain + 1e-9:
        return None
    goes = np.zeros(n_bins, dtype=bool)
    goes[order[f, : cut + 1]] = True
    if nominal[f]:
        goes &= ~empty[f]
    left = sides[side, f, cut]
    # without missing rows here, later ones follow the larger side
    goes[sizes[f]] = bool(side) if missing[f, 2] else bool(left[2] * 2 > tn)
    return Split(float(gain[f, cut, side]), int(f), goes, left, total - left)


# ---------------------------------------------------------------- growing


class _Growing:
    """One tree being grown best-first; leaves wait in a queue with the split they would take."""

    def __init__(self, p: Params, sizes: np.ndarray, nominal: np.ndarray, n_bins: int, used: np.ndarray):
        self.p, self.sizes, self.nominal, self.n_bins, self.used = p, sizes, nominal, n_bins, used
        self.depth, self.left, self.right = [0], [-1], [-1]
        self.sums: list[np.ndarray | None] = [None]  # of a leaf: features x bins x (g, h, n)
        self.total: list[np.ndarray | None] = [None]
        self.split: list[Split | None] = [None]
        self.chosen: list[bool] = [False]
        self.queue: list[tuple[float, int]] = []
        self.leaves = 1

    def deepest(self, node: int) -> bool:
        return self.p.max_depth is not None and self.depth[node] >= self.p.max_depth

    def offer(self, node: int, sums: np.ndarray | None) -> None:
        """A node's sums are known: it joins the queue if it can be split (without sums it cannot)."""
        if sums is None:
            return
        self.sums[node], self.total[node] = sums, sums[0].sum(axis=0)
        if self.deepest(node):
            return
        self.split[node] = best_split(sums, self.sizes, self.nominal, self.p, self.used)
        if self.split[node] is not None:
            heapq.heappush(self.queue, (-self.split[node].gain, node))

    def choose(self) -> None:
        """Take leaves off the queue as long as their children's sums are known."""
        while self.queue and self.leaves < self.p.num_leaves:
            node = self.queue[0][1]
            if self.left[node] < 0:
                return
            heapq.heappop(self.queue)
            self.chosen[node] = True
            self.leaves += 1
            for child in (self.left[node], self.right[node]):
                self.offer(child, self.sums[child])
            self.sums[node] = None

    @property
    def done(self) -> bool:
        return not self.queue or self.leaves >= self.p.num_leaves

    def expand(self) -> list[int]:
        """Give children to the best waiting leaves, no more than could still be taken; the ones to sum.

        Children that no split could follow (of the last split, or at the greatest depth) need no sums.
        """
        wanted, last = [], self.p.num_leaves - self.leaves == 1
        for _, node in heapq.nsmallest(self.p.num_leaves - self.leaves, self.queue):
            if self.left[node] >= 0:
                continue
            s = self.split[node]
            for total in (s.left, s.right):
                self.depth.append(self.depth[node] + 1)
                self.left.append(-1)
                self.right.append(-1)
                self.sums.append(None)
                self.total.append(total)
                self.split.append(None)
                self.chosen.append(False)
            self.left[node], self.right[node] = len(self.left) - 2, len(self.left) - 1
            if not last and not self.deepest(self.left[node]):
                wanted.append(self.left[node] if s.left[2] <= s.right[2] else self.right[node])
        return wanted

    def advance(self) -> list[int]:
        """Grow as far as the sums at hand allow; the nodes to sum next, none when the tree is done."""
        while True:
            self.choose()
            if self.done:
                return []
            if wanted := self.expand():
                return wanted

    def summed(self, node: int, sums: np.ndarray) -> None:
        """Sums of a smaller child: its sibling's are the parent's minus these."""
        parent = max(self.left.index(node) if node in self.left else -1, self.right.index(node) if node in self.right else -1)
        other = self.right[parent] if self.left[parent] == node else self.left[parent]
        self.sums[node], self.sums[other] = sums, self.sums[parent] - sums

    def tree(self, every_split: bool = False) -> Tree:
        """The nodes chosen so far (``every_split``: also the splits that only wait)."""
        keep = [i for i in range(len(self.left)) if self.left[i] >= 0 and (every_split or self.chosen[i])]
        number, order = {0: 0}, [0]
        for i in order:
            if i in keep:
                for child in (self.left[i], self.right[i]):
                    number[child] = len(order)
                    order.append(child)
        self.numbers = number
        inner = [i in keep for i in order]
        child = lambda side: np.array([number[side[i]] if k else -1 for i, k in zip(order, inner)])
        total = np.array([self.total[i] for i in order], dtype=np.float64).reshape(-1, 3)
        g, h = total[:, 0] / SCALE, total[:, 1] / SCALE
        value = -self.p.learning_rate * shrunk(g, self.p.l1) / (h + self.p.l2 + 1e-12)
        none = np.zeros(self.n_bins, dtype=bool)
        return Tree(
            np.array([self.split[i].feature if k else 0 for i, k in zip(order, inner)]),
            np.array([self.split[i].goes_left if k else none for i, k in zip(order, inner)]),
            child(self.left), child(self.right), np.where(inner, 0.0, value),
            np.array([self.split[i].gain if k else 0.0 for i, k in zip(order, inner)]),
            total[:, 2].astype(np.int64), h,
        )


def _drawn(keys: np.ndarray, seed: int, turn: int, fraction: float) -> np.ndarray:
    """Rows of a sample by hash, the same in every partitioning."""
    if fraction >= 1.0:
        return np.ones(len(keys), dtype=bool)
    h = keys.view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xC2B2AE3D27D4EB4F) & (2**64 - 1))
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(33))) < np.uint64(int(fraction * (2**64 - 1)))


class Boosting:
    """Lockstep fits over one written table of bins, labels, folds and margins."""

    def __init__(self, df: DataFrame, binner: Binner, label: str, id_col: str, fold: str | None = None, valid: str | None = None):
        spark = df.sparkSession
        ship_package(spark)
        self.spark, self.binner, self.scratch = spark, binner, Scratch(spark)
        rows = binner.transform(df.where(F.col(label).isNotNull())).select(
            F.col(label).cast("double").alias("y"),
            F.xxhash64(F.col(id_col).cast("string")).alias("key"),
            (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
            (F.col(valid) if valid else F.lit(False)).alias("valid"),
            F.col(BINS).alias("bins"),
        )
        self.rows = self.scratch.save(rows, "bins")
        self._counts: list | None = None

    def fit(self, specs: Sequence[Spec]) -> list[Ensemble]:
        """The models of ``specs``, in order; all folds and trials share their passes."""
        sizes, nominal = self.binner.sizes, self.binner.nominal
        n_features, n_bins = len(sizes), int(sizes.max()) + 1
        models = [self._start(s) for s in specs]
        orders = [None if s.order is None else (s.order, self._rows_of(s)) for s in specs]
        views = [(s.fold_out, o) for s, o in zip(specs, orders)]
        table = self._with_margins(self.rows, views, [(m.base, m.trees) for m in models], first=True)
        recent: list[list[Tree]] = [[] for _ in specs]  # the trees that the written margins lack
        held = list(range(len(specs)))  # models whose margins are written
        active, written, turn = [True] * len(specs), 0, 0
        while any(active):
            # one pass for the losses of the trees so far and the sums of every root
            growing = {
                i: _Growing(s.params, sizes, nominal, n_bins, self._features(s, models[i].rounds))
                for i, s in enumerate(specs)
                if active[i]
            }
            roots = {i: (_stump(n_bins), [0]) for i in growing}
            sums, losses = self._summed(table, held, specs, views, models, recent, roots, n_features, n_bins, with_losses=True)
            for i in list(growing):
                self._note(models[i], losses[i])
                growing[i].offer(0, sums[i][0])
                p = specs[i].params
                # a root that no split improves stays so, unless another sample is drawn
                stuck = not growing[i].queue and p.row_fraction >= 1 and p.feature_fraction >= 1
                if stuck or self._stops(models[i], p):
                    active[i] = False
                    del growing[i]
            while True:
                requests = {}
                for i, g in growing.items():
                    if wanted := g.advance():
                        requests[i] = (g.tree(every_split=True), [g.numbers[w] for w in wanted], wanted)
                if not requests:
                    break
                sums, _ = self._summed(table, held, specs, views, models, recent, requests, n_features, n_bins)
                for i, (_, _, wanted) in requests.items():
                    for node, s in zip(wanted, sums[i]):
                        growing[i].summed(node, s)
            grown = {i: g.tree() for i, g in growing.items()}
            self._set_blocks(table, held, specs, views, models, recent, {i: t for i, t in grown.items() if orders[i]})
            for i, tree in grown.items():
                models[i].trees.append(tree)
                recent[i].append(tree)
            turn += 1
            going, moves = [i for i in held if active[i]], turn - written >= MARGIN_ROUNDS
            # models that have stopped need no margins: without them a pass reads less
            if going and (moves or 2 * len(going) <= len(held)):
                steps = [(0.0, recent[i] if moves else []) for i in going]
                newer = self._with_margins(table, [views[i] for i in going], steps, [held.index(i) for i in going], len(held))
                self.scratch.drop(table)
                table, held = newer, going
                if moves:
                    recent, written = [[] for _ in specs], turn
        self.scratch.drop(table)
        return models

    def _start(self, spec: Spec) -> Ensemble:
        if spec.start is not None:
            whole = spec.start
            return replace(whole, trees=list(whole.trees), train_loss=whole.train_loss[: whole.rounds],
                           valid_loss=whole.valid_loss[: whole.rounds], fold_out=spec.fold_out)
        n, pos = self._rows_of(spec), self._rows_of(spec, "pos")
        rate = min(max(pos / n, 1e-6), 1 - 1e-6) if n else 0.5
        return Ensemble(float(np.log(rate / (1 - rate))), fold_out=spec.fold_out)

    def _rows_of(self, spec: Spec, what: str = "n"):
        """Training rows of a model (``what='pos'``: their labels' sum)."""
        return sum(r[what] for r in self._grouped() if r["fold"] != spec.fold_out and not r["valid"])

    def _grouped(self) -> list:
        if self._counts is None:
            grouped = self.rows.groupBy("fold", "valid").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
            self._counts = grouped.collect()  # two rows per fold
        return self._counts

    def _set_blocks(self, table, held, specs, views, models, recent, trees: dict[int, Tree]) -> None:
        """Values of ordered models' new trees for the rows of each block: from the blocks before it."""
        if not trees:
            return
        requests = {i: (t, list(range(len(t.left)))) for i, t in trees.items()}
        sums, _ = self._summed(table, held, specs, views, models, recent, requests, 1, BLOCKS, by_block=True)
        for i, t in trees.items():
            p = specs[i].params
            before = np.cumsum(sums[i][:, 0], axis=1) - sums[i][:, 0]  # nodes x blocks x (g, h, n)
            value = -p.learning_rate * shrunk(before[..., 0] / SCALE, p.l1) / (before[..., 1] / SCALE + p.l2 + 1e-12)
            t.by_block = np.where(before[..., 2] > 0, value, 0.0)

    def _features(self, spec: Spec, turn: int) -> np.ndarray:
        """Features that a tree may split by: a seeded share of the model's own."""
        own = np.array([spec.features is None or f in spec.features for f in self.binner.features])
        kept = max(1, int(np.ceil(own.sum() * spec.params.feature_fraction)))
        drawn = np.random.default_rng([spec.params.seed, turn]).permutation(np.flatnonzero(own))[:kept]
        out = np.zeros(len(own), dtype=bool)
        out[drawn] = True
        return out

    def _note(self, model: Ensemble, losses: np.ndarray) -> None:
        (train, n_train), (valid, n_valid) = losses
        model.train_loss.append(float(train / SCALE / n_train) if n_train else float("nan"))
        if n_valid:
            model.valid_loss.append(float(valid / SCALE / n_valid))

    def _stops(self, model: Ensemble, p: Params) -> bool:
        if model.rounds >= p.rounds:
            return True
        return p.patience is not None and bool(model.valid_loss) and model.rounds - model.best_round >= p.patience

    def _with_margins(self, table: DataFrame, views: list[tuple], steps: list[tuple], places: Sequence[int] = (), n_held: int = 0,
                      first: bool = False) -> DataFrame:
        """The table with every model's margins, moved on by base and trees, written in blocks of rows.

        ``places`` of the ``n_held`` margins that ``table`` has are kept (``first``: it has none yet).
        """
        shared = self.spark.sparkContext.broadcast([(*v, base, Routes(trees)) for v, (base, trees) in zip(views, steps)])
        n_features, n_models, most = len(self.binner.features), len(steps), _block_rows(len(steps))

        def move(batches):
            for block in _packed(batches, n_features, shared.value, most) if first else _unpacked(batches, n_features, n_held, places):
                for m, (_, _, base, routes) in enumerate(shared.value):
                    block.margins[m] += base + routes.scores(block.codes, block.blocks_of(m))
                yield block.record()

        if first:  # small tables in few tasks: a pass takes as long as starting them
            rows = sum(r["n"] for r in self._grouped())
            table = table.coalesce(max(1, -(-rows * n_models // TASK_MARGINS)))
        saved = self.scratch.save(table.mapInArrow(move, _BLOCK), "margins", **_WIDE_ROWS)
        shared.destroy()
        return saved

    def _summed(self, table: DataFrame, held, specs, views, models, recent, requests: Mapping, n_features: int, n_bins: int, by_block: bool = False,
                with_losses: bool = False):
        """Sums of the requested nodes of each model, and (``with_losses``) its losses, in one pass.

        ``by_block``: by the rows' block instead of their features' bins.
        """
        work, at = [], 0
        width = len(self.binner.features)
        for i, request in requests.items():
            p = specs[i].params
            place = np.full(len(request[0].left), -1)
            place[request[1]] = np.arange(len(request[1]))
            work.append((held.index(i), views[i][0], Routes(recent[i]), Routes([request[0]]), place, len(request[1]), at, p.seed, models[i].rounds,
                         p.row_fraction))
            at += len(request[1]) * n_features * n_bins
        if at > MOST_SUMS:
            raise ValueError(f"{at} sums in one pass: fewer models, leaves, features or bins are needed (limit {MOST_SUMS})")
        shared = self.spark.sparkContext.broadcast(work)
        n_models, slots = len(held), at

        def collect(batches):
            sums = np.zeros((slots, 3), dtype=np.int64)
            losses = np.zeros((n_models, 2, 2), dtype=np.int64)
            for block in _unpacked(batches, width, n_models):
                for m, fold_out, routes, tree, place, n_nodes, begin, seed, turn, fraction in shared.value:
                    trained, held = block.seen(fold_out)
                    blocks = block.blocks_of(m)
                    margin = None
                    if with_losses:
                        margin = block.margins[m] + routes.scores(block.codes, blocks)
                        for kind, rows in enumerate((trained, held)):
                            x, y = margin[rows], block.y[rows]
                            loss = np.rint((np.logaddexp(0, x) - y * x) * SCALE).astype(np.int64)
                            losses[m, kind] += (loss.sum(), len(loss))
                    at = place[next(tree.leaves(block.codes))]
                    rows = np.flatnonzero(trained & (at >= 0) & block.drawn(seed, turn, fraction))
                    codes = block.codes[:, rows]
                    if margin is None:
                        margin = block.margins[m][rows] + routes.scores(codes, None if blocks is None else blocks[rows])
                    else:
                        margin = margin[rows]
                    size = n_nodes * n_features * n_bins
                    found = sums[begin : begin + size].reshape(n_nodes, n_features, n_bins, 3)
                    found += _histogram(at[rows], blocks[None, rows] if by_block else codes, block.y[rows], sigmoid(margin), n_nodes, n_bins)
            used = np.flatnonzero(sums[:, 2])
            lost = losses.reshape(-1, 2)
            found = np.flatnonzero(lost[:, 1])
            columns = [np.concatenate([used, -1 - found]), *(np.concatenate([sums[used, j], x]) for j, x in enumerate((lost[found, 0], 0 * found, lost[found, 1])))]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["slot", "g", "h", "n"])

        parts = table.mapInArrow(collect, "slot long, g long, h long, n long")
        found = parts.groupBy("slot").agg(F.sum("g"), F.sum("h"), F.sum("n")).toArrow()
        shared.destroy()
        slot = found.column(0).to_numpy()
        values = np.stack([found.column(j).to_numpy() for j in (1, 2, 3)], axis=1).reshape(-1, 3)
        sums = np.zeros((slots, 3), dtype=np.int64)
        sums[slot[slot >= 0]] = values[slot >= 0]
        losses = np.zeros((n_models * 2, 2), dtype=np.int64)
        losses[-1 - slot[slot < 0]] = values[slot < 0][:, [0, 2]]
        out = {}
        for i, (_, _, _, _, _, n_nodes, begin, *_) in zip(requests, work):
            out[i] = sums[begin : begin + n_nodes * n_features * n_bins].reshape(n_nodes, n_features, n_bins, 3)
        return out, dict(zip(held, losses.reshape(n_models, 2, 2)))


_BLOCK = "y binary, key binary, fold binary, valid binary, bins binary, margins binary, blocks binary"


class _Block:
    """Some rows as arrays: bins as features x rows, margins (and blocks of ordered models) as models x rows."""

    def __init__(self, y, key, fold, valid, bins, margins, blocks):
        self.y, self.key, self.fold, self.valid, self.bins, self.margins, self.blocks = y, key, fold, valid, bins, margins, blocks
        self.codes = bins.astype(np.intp)
        self._kept: dict = {}

    def record(self) -> pa.RecordBatch:
        parts = [self.y, self.key, self.fold, self.valid, self.bins, self.margins, self.blocks]
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names)

    def blocks_of(self, m: int) -> np.ndarray | None:
        """The block of each row in an ordered model; None for other models."""
        return self.blocks[m].astype(np.int64) if len(self.blocks) and self.blocks[m, 0] != _UNORDERED else None

    def seen(self, fold_out: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Training and validation rows of a model."""
        if ("seen", fold_out) not in self._kept:
            seen = _seen(self.fold, fold_out)
            self._kept["seen", fold_out] = seen & ~self.valid, seen & self.valid
        return self._kept["seen", fold_out]

    def drawn(self, seed: int, turn: int, fraction: float) -> np.ndarray:
        if (seed, turn, fraction) not in self._kept:
            self._kept[seed, turn, fraction] = _drawn(self.key, seed, turn, fraction)
        return self._kept[seed, turn, fraction]


def _block_rows(n_models: int) -> int:
    """Cases of a block for so many models."""
    return max(256, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, n_models))))


def _packed(batches, n_features: int, views, most: int):
    """Blocks of ``most`` rows, from batches of the written rows."""
    held, size = [], 0

    def block(parts):
        y, key, fold, valid, bins = (np.concatenate(x) for x in zip(*parts))
        ordered = [
            np.full(len(y), _UNORDERED) if order is None else _blocks(key, _seen(fold, fold_out) & ~valid, order) for fold_out, order, *_ in views
        ]
        blocks = np.array(ordered if any(v[1] for v in views) else [], dtype=np.int8)
        return _Block(y, key, fold, valid, np.ascontiguousarray(bins.T), np.zeros((len(views), len(y))), blocks)

    for batch in batches:
        for start in range(0, batch.num_rows, most):
            part = batch.slice(start, most)
            if size + part.num_rows > most:
                yield block(held)
                held, size = [], 0
            columns = [part.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            held.append((*columns[:3], columns[3].astype(bool), bins_of(part.column(4), n_features)))
            size += part.num_rows
    if held:
        yield block(held)


def _unpacked(batches, n_features: int, n_models: int, places: Sequence[int] = ()):
    """The blocks of the written table (``places``: only these of its models)."""
    kinds = [np.float64, np.int64, np.int32, bool, np.uint8, np.float64, np.int8]
    for batch in batches:
        for i in range(batch.num_rows):
            y, key, fold, valid, bins, margins, blocks = (np.frombuffer(c[i].as_buffer(), dtype=t) for c, t in zip(batch.columns, kinds))
            margins, blocks = margins.reshape(n_models, -1), blocks.reshape(-1, len(y))
            kept = list(places) or slice(None)
            yield _Block(y, key, fold, valid, bins.reshape(n_features, -1), margins[kept].copy(), blocks[kept] if len(blocks) else blocks)


def _histogram(place: np.ndarray, codes: np.ndarray, y: np.ndarray, p: np.ndarray, n_nodes: int, n_bins: int) -> np.ndarray:
    """Sums (g, h, n) of at most ``BLOCK_ROWS`` rows by node, feature and bin.

    Each h is at most a quarter of ``SCALE``, so the h of a block sum to less than 2 ** 37:
    above that, the same double counts the rows.
    """
    g, h = np.rint((p - y) * SCALE), np.rint(p * (1 - p) * SCALE) + 2.0**37
    out = np.empty((n_nodes, len(codes), n_bins, 3), dtype=np.int64)
    start = place * n_bins
    for f, code in enumerate(codes):
        slot = start + code
        out[:, f, :, 0] = np.bincount(slot, g, n_nodes * n_bins).reshape(n_nodes, n_bins)
        both = np.bincount(slot, h, n_nodes * n_bins).astype(np.int64).reshape(n_nodes, n_bins)
        out[:, f, :, 1], out[:, f, :, 2] = both & (2**37 - 1), both >> 37
    return out


def _stump(n_bins: int) -> Tree:
    """A tree that is one leaf of value 0."""
    one, zero = np.full(1, -1), np.zeros(1)
    return Tree(np.zeros(1, int), np.zeros((1, n_bins), bool), one, one, zero, zero, np.zeros(1, int), zero)


def _seen(folds: np.ndarray, fold_out: int | None) -> np.ndarray:
    return np.ones(len(folds), dtype=bool) if fold_out is None else folds != fold_out


#: Blocks of an ordered model: the first holds about 2 ** FIRST_BLOCK rows, each later one as many as all before it.
BLOCKS, FIRST_BLOCK = 48, 4
_UNORDERED = -2  # in place of the blocks of a model without order


def row_order(keys: np.ndarray, seed: int) -> np.ndarray:
    """Each row's place, from 0 to 1, in the hash order of a seed."""
    h = keys.view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(33))).astype(np.float64) / 2.0**64


def _blocks(keys: np.ndarray, trained: np.ndarray, order: tuple[int, int] | None) -> np.ndarray | None:
    """The block of each row that trains an ordered model of so many rows; -1 for other rows."""
    if order is None:
        return None
    seed, n = order
    place = np.log2(np.maximum(row_order(keys, seed) * n, 1.0))
    return np.where(trained, np.clip(np.floor(place) - FIRST_BLOCK + 1, 0, BLOCKS - 1).astype(np.int64), -1)


# ---------------------------------------------------------------- using models


def _routed(models: Sequence[Ensemble]) -> list[tuple[Ensemble, Routes]]:
    return [(m, Routes(m.trees)) for m in models]


def scored(df: DataFrame, binner: Binner, models: Sequence[Ensemble], out: str = "p") -> DataFrame:
    """``df`` with the mean probability of ``models``."""
    shared = df.sparkSession.sparkContext.broadcast(_routed(models))
    n = len(binner.features)

    def score(bins: pa.Array) -> pa.Array:
        x = bins_of(bins, n)
        return pa.array(np.mean([sigmoid(m.margins(x, r)) for m, r in shared.value], axis=0))

    return binner.transform(df).withColumn(out, F.arrow_udf(score, "double")(BINS)).drop(BINS)


def scored_out_of_fold(df: DataFrame, binner: Binner, models: Sequence[Ensemble], fold: str, out: str = "p") -> DataFrame:
    """Each row's probability by the model that did not see its fold; the mean of all for rows of no such fold."""
    shared = df.sparkSession.sparkContext.broadcast(_routed(models))
    n = len(binner.features)

    def score(bins: pa.Array, folds: pa.Array) -> pa.Array:
        x, own = bins_of(bins, n), folds.to_numpy(zero_copy_only=False)
        p = np.stack([sigmoid(m.margins(x, r)) for m, r in shared.value])
        out = p.mean(axis=0)
        for i, (m, _) in enumerate(shared.value):
            out[own == m.fold_out] = p[i][own == m.fold_out]
        return pa.array(out)

    folds = F.coalesce(F.col(fold).cast("int"), F.lit(-1))
    return binner.transform(df).withColumn(out, F.arrow_udf(score, "double")(BINS, folds)).drop(BINS)


def staged_losses(df: DataFrame, binner: Binner, models: Sequence[Ensemble], label: str) -> DataFrame:
    """(model, round, loss, n): the mean log loss of labelled rows after every number of trees, from one scan."""
    shared = df.sparkSession.sparkContext.broadcast(_routed(models))
    n = len(binner.features)

    def losses(batches):
        total = [np.zeros(m.rounds + 1, dtype=np.int64) for m, _ in shared.value]
        rows = 0
        for batch in batches:
            y, x = batch.column(0).to_numpy()[:, None], bins_of(batch.column(1), n)
            rows += len(x)
            for t, (m, routes) in zip(total, shared.value):
                margin = m.staged(x, routes)
                t += np.rint((np.logaddexp(0, margin) - y * margin) * SCALE).astype(np.int64).sum(axis=0)
        which = np.repeat(np.arange(len(total)), [len(t) for t in total])
        at = np.concatenate([np.arange(len(t)) for t in total])
        columns = [pa.array(which), pa.array(at), pa.array(np.concatenate(total)), pa.array(np.full(len(at), rows))]
        yield pa.RecordBatch.from_arrays(columns, ["model", "round", "loss", "n"])

    labelled = df.where(F.col(label).isNotNull()).withColumn("_y", F.col(label).cast("double"))
    parts = binner.transform(labelled).select("_y", BINS).mapInArrow(losses, "model long, round long, loss long, n long")
    loss = F.sum("loss") / F.lit(SCALE) / F.sum("n")
    return parts.groupBy(F.col("model").cast("int"), F.col("round").cast("int")).agg(loss.alias("loss"), F.sum("n").alias("n"))


def staged_histogram(df: DataFrame, binner: Binner, trials: Sequence[Sequence[Ensemble]], label: str, fold: str,
                     grid: tuple[int, int] = (30, 70), every: int = 1) -> DataFrame:
    """Counts by (trial, round, score bucket) of out-of-fold scores after every ``every`` rounds, from one scan.

    ``trials``: the fold models of each trial.  A row counts with the model that did not see
    its fold; a model that stopped before a round stays at its last.  Bucket b holds scores
    from b / 100 to below (b + 1) / 100 (the first all below, the last all from its start).
    """
    shared = df.sparkSession.sparkContext.broadcast([_routed(ms) for ms in trials])
    n, (lo, hi) = len(binner.features), grid
    width = hi - lo + 2
    cuts = np.arange(lo, hi + 1) / 100

    def count(batches):
        longest = [max(m.rounds for m, _ in ms) for ms in shared.value]
        at = [np.arange(0, r + every, every).clip(max=r) for r in longest]
        sums = [np.zeros((len(a), width, 2), dtype=np.int64) for a in at]
        for batch in batches:
            y, folds, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), bins_of(batch.column(2), n)
            for t, ms in enumerate(shared.value):
                for m, routes in ms:
                    own = folds == m.fold_out
                    if not own.any():
                        continue
                    p = sigmoid(m.staged(x[own], routes))[:, at[t].clip(max=m.rounds)]
                    bucket = np.searchsorted(cuts, p, side="right")
                    slot = (bucket + width * np.arange(len(at[t]))).ravel()
                    for j, weight in enumerate((np.ones(own.sum()), y[own])):
                        found = np.bincount(slot, np.repeat(weight, len(at[t])), width * len(at[t]))
                        sums[t][..., j] += found.reshape(-1, width).astype(np.int64)
        for t, s in enumerate(sums):
            r, b = np.nonzero(s[..., 0])
            columns = [np.full(len(r), t), at[t][r], b + lo - 1, s[r, b, 0], s[r, b, 1]]
            names = ["trial", "round", "bucket", "n", "pos"]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    labelled = df.where(F.col(label).isNotNull()).withColumn("_y", F.col(label).cast("double")).withColumn("_f", F.col(fold).cast("int"))
    parts = binner.transform(labelled).select("_y", "_f", BINS)
    parts = parts.mapInArrow(count, "trial long, round long, bucket long, n long, pos long")
    ints = [F.col(c).cast("int") for c in ("trial", "round", "bucket")]
    return parts.groupBy(*ints).agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))


def score_histogram(df: DataFrame, label: str, score: str, by: Sequence[str], grid: tuple[int, int] = (30, 70)) -> DataFrame:
    """The same counts for a given table of scores, one row per row and stage."""
    bucket = grid_bucket(score, *grid).alias("bucket")
    return df.groupBy(*by, bucket).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))


def accuracy_surface(histogram: DataFrame, grid: tuple[int, int] = (30, 70)) -> DataFrame:
    """(trial, round, threshold, accuracy) for every threshold of the grid, from the bucket counts alone.

    A score predicts 1 from the threshold on.
    """
    lo, hi = grid
    g = histogram.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("threshold"))  # hi - lo + 1 rows
    right = F.when(F.col("bucket") >= F.col("threshold"), F.col("pos")).otherwise(F.col("n") - F.col("pos"))
    share = F.sum(right).cast("double") / F.sum("n")
    return histogram.crossJoin(F.broadcast(g)).groupBy("trial", "round", "threshold").agg(share.alias("accuracy"))


def best_of_surface(surface: DataFrame) -> DataFrame:
    """Each trial's best (round, threshold): highest accuracy, then fewest rounds, then smallest threshold."""
    order = F.struct(-F.col("accuracy"), F.col("round"), F.col("threshold"))
    best = F.min_by(F.struct("round", "threshold", "accuracy"), order).alias("best")
    return surface.groupBy("trial").agg(best).select("trial", "best.*")


# ---------------------------------------------------------------- tree tables

NODES = (
    "model int, fold_out int, round int, node int, parent int, depth int, feature string, missing_left boolean, "
    "upto double, categories array<string>, gain double, n bigint, hessian double, value double, goes_left string"
)


def tree_table(spark: SparkSession, models: Sequence[Ensemble], binner: Binner) -> DataFrame:
    """One row per node of every tree.

    A split on a numeric feature sends values up to ``upto`` left, one on a nominal feature its
    ``categories``; ``missing_left`` is the side of missing values.  Leaves have a ``value``.
    The models' size bounds the table.
    """
    rows = []
    for i, model in enumerate(models):
        for r, t in enumerate(model.trees):
            parent, depth = np.full(len(t.left), -1), np.zeros(len(t.left), int)
            for node in range(len(t.left)):
                if t.left[node] < 0:
                    rows.append((i, model.fold_out, r, node, int(parent[node]), int(depth[node]), None, None, None, None, 0.0,
                                 int(t.count[node]), float(t.hessian[node]), float(t.value[node]), None))
                    continue
                for child in (t.left[node], t.right[node]):
                    parent[child], depth[child] = node, depth[node] + 1
                f, goes = binner.features[t.feature[node]], t.goes_left[node]
                kinds, ends = binner.categories.get(f), binner.ends.get(f)
                size = len(kinds) if kinds is not None else len(ends) + 1
                upto, names = None, None
                if kinds is None:
                    regular = int(goes[:size].sum())
                    upto = ends[regular - 1] if regular <= len(ends) else float("inf")
                else:
                    names = [c for c, g in zip(kinds, goes) if g]
                mask = "".join("1" if g else "0" for g in goes)
                rows.append((i, model.fold_out, r, node, int(parent[node]), int(depth[node]), f, bool(goes[size]), upto, names,
                             float(t.gain[node]), int(t.count[node]), float(t.hessian[node]), None, mask))
    return spark.createDataFrame(rows, NODES)


def gain_importance(nodes: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Raw gain and number of splits of each feature, as aggregates over a table of nodes."""
    inner = nodes.where(F.col("feature").isNotNull())
    return inner.groupBy(*by, "feature").agg(F.sum("gain").alias("gain"), F.count("*").alias("splits"))


def to_json(model: Ensemble) -> str:
    """The model as text, to be kept beside a :class:`Binner`; ``from_json`` reads it back."""
    trees = [{k: None if v is None else np.asarray(v).tolist() for k, v in vars(t).items()} for t in model.trees]
    losses = {"train_loss": model.train_loss, "valid_loss": model.valid_loss}
    return json.dumps({"base": model.base, "fold_out": model.fold_out, "trees": trees, **losses})


def from_json(text: str) -> Ensemble:
    spec = json.loads(text)
    spec["trees"] = [Tree(**{k: None if v is None else np.array(v) for k, v in t.items()}) for t in spec["trees"]]
    return Ensemble(**spec)
