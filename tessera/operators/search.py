"""Adaptive parameter search: Parzen estimators over good and bad trials, in batches, with a ledger.

A trial's parameters are drawn one by one from a mixture around the good trials' values, and
the draw is kept whose density among the good trials is highest against that among the
others.  Trials of a batch are proposed together: those still running count as trials with
the worst value seen, so a batch spreads out.  Proposals depend on the finished trials and
the seed alone.

The ledger is a folder of JSON rows, one append per finished batch.  A new application that
opens it goes on behind the last finished batch and repeats no trial.

Only parameters and one value per trial pass the driver; what a trial costs is in its
objective, which is given a whole batch (:func:`boosting_objective` fits all its trials and
folds in lockstep).
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import fields, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boost import Boosting, Params, Spec, accuracy_surface, best_of_surface, staged_histogram

#: Trials drawn at random before estimators are used; share of trials that are good; draws per parameter.
STARTUP, GOOD_SHARE, DRAWS = 10, 0.25, 24


class Range:
    """A numeric parameter: ``('int'|'float'|'logfloat', low, high[, step])``."""

    def __init__(self, kind: str, low, high, step=None):
        if kind not in ("int", "float", "logfloat") or not low <= high or (kind == "logfloat" and (low <= 0 or step)):
            raise ValueError(f"no such range: {(kind, low, high, step)}")
        self.kind, self.low, self.high = kind, low, high
        self.step = step or (1 if kind == "int" else None)
        # each grid value stands for the interval half a step around it
        last = low if not self.step else low + self.step * math.floor((high - low) / self.step + 1e-9)
        half = self.step / 2 if self.step else 0.0
        self.a, self.b = (math.log(low), math.log(high)) if kind == "logfloat" else (low - half, (last if self.step else high) + half)
        self.last = last

    def value(self, x: float):
        if self.kind == "logfloat":
            return min(max(math.exp(x), self.low), self.high)
        if not self.step:
            return x
        steps = min(max(round((x - self.low) / self.step), 0), round((self.last - self.low) / self.step))
        out = self.low + steps * self.step
        return int(out) if self.kind == "int" else out

    def place(self, value) -> float:
        return math.log(value) if self.kind == "logfloat" else float(value)

    def random(self, rng: np.random.Generator):
        return self.value(rng.uniform(self.a, self.b))

    def propose(self, rng: np.random.Generator, good: list, bad: list):
        estimators = [self._estimator([self.place(v) for v in side]) for side in (good, bad)]
        centres, widths = estimators[0]
        which = rng.integers(0, len(centres), DRAWS)
        draws = rng.normal(centres[which], widths[which])
        draws = np.where((draws < self.a) | (draws > self.b), rng.uniform(self.a, self.b, DRAWS), draws)
        good_density, bad_density = (self._log_density(draws, *e) for e in estimators)
        return self.value(float(draws[np.argmax(good_density - bad_density)]))

    def _estimator(self, places: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """Centres and widths of the mixture: the trials' values, and one wide part over the whole range."""
        span = max(self.b - self.a, 1e-12)
        centres = np.sort(np.array([*places, (self.a + self.b) / 2]))
        gaps = np.diff(np.concatenate([[self.a], centres, [self.b]]))
        widths = np.maximum(gaps[:-1], gaps[1:]).clip(span / min(100, 1 + len(centres)), span)
        widths[np.searchsorted(centres, (self.a + self.b) / 2)] = span
        return centres, widths

    def _log_density(self, x: np.ndarray, centres: np.ndarray, widths: np.ndarray) -> np.ndarray:
        cdf = np.vectorize(lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2))))
        inside = cdf((self.b - centres) / widths) - cdf((self.a - centres) / widths)
        parts = np.exp(-0.5 * ((x[:, None] - centres) / widths) ** 2) / widths / np.maximum(inside, 1e-12)
        return np.log(parts.mean(axis=1) + 1e-300)


class Choice:
    """One of some values."""

    def __init__(self, values: Sequence):
        self.values = list(values)

    def random(self, rng: np.random.Generator):
        return self.values[int(rng.integers(0, len(self.values)))]

    def propose(self, rng: np.random.Generator, good: list, bad: list):
        share = [np.array([1 + side.count(v) for v in self.values], dtype=float) for side in (good, bad)]
        share = [s / s.sum() for s in share]
        draws = rng.choice(len(self.values), DRAWS, p=share[0])
        return self.values[int(draws[np.argmax(share[0][draws] / share[1][draws])])]


def _space(space: Mapping[str, tuple]) -> dict[str, Range | Choice]:
    return {name: Choice(spec[1]) if spec[0] == "choice" else Range(*spec) for name, spec in space.items()}


def suggest(space: Mapping[str, tuple], finished: Sequence[tuple[dict, float]], pending: Sequence[dict], number: int, seed: int = 42) -> dict:
    """Parameters of trial ``number``, given finished trials (parameters, value: higher is better) and running ones."""
    rng = np.random.default_rng([seed, number])
    parts = _space(space)
    if len(finished) < STARTUP:
        return {name: part.random(rng) for name, part in parts.items()}
    worst = min(v for _, v in finished)
    trials = sorted([*finished, *((p, worst) for p in pending)], key=lambda t: -t[1])
    n_good = min(max(1, math.ceil(GOOD_SHARE * len(finished))), 25)
    good, bad = [t[0] for t in trials[:n_good]], [t[0] for t in trials[n_good:]]
    return {name: part.propose(rng, [p[name] for p in good], [p[name] for p in bad]) for name, part in parts.items()}


LEDGER = "trial int, params string, value double, result string"


def _finished(spark: SparkSession, ledger: str) -> list[tuple[int, dict, float, dict]]:
    """The ledger's trials: one short row each."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return []
    rows = spark.read.schema(LEDGER).json(ledger).where(F.col("trial").isNotNull()).orderBy("trial").collect()
    return [(r["trial"], json.loads(r["params"]), r["value"], json.loads(r["result"])) for r in rows]


def adaptive_search(spark: SparkSession, space: Mapping[str, tuple], objective: Callable[[list[dict]], list[dict]], n_trials: int = 30,
                    batch: int = 5, seed: int = 42, ledger: str | None = None) -> DataFrame:
    """Search for the parameters of highest ``value``; one row per trial, the best one marked.

    ``objective`` takes a batch of parameters and returns a result for each, with its
    ``value`` and whatever else is to be kept.  With ``ledger``, trials that it holds are
    taken from it, and finished batches are added.
    """
    trials = _finished(spark, ledger) if ledger else []
    while len(trials) < n_trials:
        size = min(batch, n_trials - len(trials))
        known = [(p, v) for _, p, v, _ in trials]
        proposed: list[dict] = []
        for i in range(size):
            proposed.append(suggest(space, known, proposed, len(trials) + i, seed))
        results = objective(proposed)
        done = [(len(trials) + i, p, float(r["value"]), r) for i, (p, r) in enumerate(zip(proposed, results))]
        if ledger:
            rows = [(i, json.dumps(p, sort_keys=True), v, json.dumps(r, sort_keys=True)) for i, p, v, r in done]
            spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").json(ledger)
        trials += done
    best = max(trials, key=lambda t: (t[2], -t[0]))[0] if trials else None
    rows = [(i, json.dumps(p, sort_keys=True), v, json.dumps(r, sort_keys=True), i == best) for i, p, v, r in trials]
    return spark.createDataFrame(rows, f"{LEDGER}, is_best boolean")


def boosting_objective(boosting: Boosting, df: DataFrame, label: str, fold: str, folds: Sequence[int], base: Params = Params(),
                       grid: tuple[int, int] = (30, 70), every: int = 1) -> Callable[[list[dict]], list[dict]]:
    """Objective over fields of :class:`Params`: out-of-fold accuracy at the best round and threshold.

    All trials and folds of a batch are fitted in lockstep; all their stopping rounds and
    thresholds are compared from one histogram of staged scores.
    """
    known = {f.name for f in fields(Params)}

    def run(batch: list[dict]) -> list[dict]:
        unknown = {k for p in batch for k in p} - known
        if unknown:
            raise ValueError(f"no such parameters: {sorted(unknown)}")
        specs = [Spec(replace(base, **p), fold_out=i) for p in batch for i in folds]
        models = boosting.fit(specs)
        k = len(folds)
        per_trial = [models[i * k : (i + 1) * k] for i in range(len(batch))]
        histogram = staged_histogram(df, boosting.binner, per_trial, label, fold, grid, every)
        best = best_of_surface(accuracy_surface(histogram, grid)).collect()  # one row per trial
        found = {r["trial"]: r for r in best}
        return [
            {"value": found[i]["accuracy"], "round": found[i]["round"], "threshold": found[i]["threshold"] / 100,
             "rounds": [m.rounds for m in ms]}
            for i, ms in enumerate(per_trial)
        ]

    return run
