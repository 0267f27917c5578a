import json
import math

import pytest

from tessera.operators import search as se

SPACE = {"a": ("float", 0, 1), "lr": ("logfloat", 0.001, 1.0), "d": ("int", 2, 12, 2), "c": ("choice", ["x", "y", "z"])}


def surface(p):
    return -(4 * (p["a"] - 0.3) ** 2 + (math.log10(p["lr"]) + 1.5) ** 2 + ((p["d"] - 6) / 5) ** 2 + (0 if p["c"] == "y" else 0.4))


def run(adaptive, seed, n=30, batch=5):
    done = []
    while len(done) < n:
        running = []
        for i in range(batch):
            running.append(se.suggest(SPACE, done if adaptive else [], running, len(done) + i, seed))
        done += [(p, surface(p)) for p in running]
    return max(v for _, v in done)


def test_beats_random_search_over_ten_seeds():
    pairs = [(run(True, s), run(False, s)) for s in range(10)]
    assert sum(a >= b for a, b in pairs) >= 7
    assert sum(a for a, _ in pairs) > sum(b for _, b in pairs)


def test_values_stay_in_their_space():
    done = []
    for i in range(40):
        p = se.suggest(SPACE, done, [], i, 3)
        assert 0 <= p["a"] <= 1 and 0.001 <= p["lr"] <= 1 and p["d"] in (2, 4, 6, 8, 10, 12) and p["c"] in "xyz"
        done.append((p, surface(p)))
    steps = [se.suggest({"s": ("float", 0.1, 0.95, 0.2)}, [], [], i)["s"] for i in range(60)]
    assert {round(s, 9) for s in steps} == {0.1, 0.3, 0.5, 0.7, 0.9}


def test_bad_ranges_are_errors():
    for spec in (("float", 2, 1), ("logfloat", 0, 1), ("even", 0, 1)):
        with pytest.raises(ValueError):
            se.suggest({"a": spec}, [], [], 0)


def test_pending_trials_spread_a_batch_out():
    done = [(se.suggest(SPACE, [], [], i, 1), 0.0) for i in range(12)]
    done = [(p, surface(p)) for p, _ in done]
    batch = []
    for i in range(8):
        batch.append(se.suggest(SPACE, done, batch, 12 + i, 1))
    assert len({json.dumps(p, sort_keys=True) for p in batch}) == 8


def test_a_ledger_resumes_without_repeating(spark, tmp_path):
    ledger, calls = str(tmp_path / "trials"), []

    def objective(batch, fail_at=None):
        if fail_at is not None and len(calls) >= fail_at:
            raise RuntimeError("lost")
        calls.extend(batch)
        return [{"value": surface(p), "round": 1} for p in batch]

    with pytest.raises(RuntimeError):
        se.adaptive_search(spark, SPACE, lambda b: objective(b, 8), 20, 4, 7, ledger)
    assert len(calls) == 8
    resumed = se.adaptive_search(spark, SPACE, objective, 20, 4, 7, ledger).collect()
    whole = se.adaptive_search(spark, SPACE, lambda b: [{"value": surface(p), "round": 1} for p in b], 20, 4, 7).collect()
    assert len(calls) == 20 and [r["params"] for r in resumed] == [r["params"] for r in whole]
    assert [r["trial"] for r in resumed] == list(range(20))
    best = [r for r in resumed if r["is_best"]]
    assert len(best) == 1 and best[0]["value"] == max(r["value"] for r in resumed)
    # a third application only reads
    se.adaptive_search(spark, SPACE, objective, 20, 4, 7, ledger)
    assert len(calls) == 20


def test_boosting_objective(spark):
    import numpy as np

    from tessera.operators import boost as bo

    rng = np.random.default_rng(2)
    rows = [(i, float(v), float(w), int(v + 0.3 * w > 0), i % 2) for i, (v, w) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "id long, v double, w double, y int, fold int")
    binner = bo.fit_bins(df, ["v", "w"], (), 16)
    fit = bo.Boosting(df, binner, "y", "id", "fold")
    objective = se.boosting_objective(fit, df, "y", "fold", [0, 1], bo.Params(rounds=6, min_leaf_rows=5))
    got = objective([{"num_leaves": 2}, {"num_leaves": 8, "learning_rate": 0.5}])
    assert got[1]["value"] > 0.9 and got[1]["value"] > got[0]["value"]
    assert all(0 <= r["round"] <= 6 and 0.3 <= r["threshold"] <= 0.7 for r in got)
    with pytest.raises(ValueError):
        objective([{"leaves": 2}])
