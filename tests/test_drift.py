import numpy as np
from pyspark.sql import functions as F

from tessera.operators import drift as dr


def _contingency(spark, col, train_counts, test_counts):
    rows = []
    for split, counts in (("train", train_counts), ("test", test_counts)):
        for value, n in counts.items():
            rows += [(split, value)] * n
    return spark.createDataFrame(rows, f"split string, {col} string")


def test_chi2_yates_golden(spark):
    df = _contingency(spark, "sex", {"female": 314, "male": 577}, {"female": 152, "male": 266})
    r = dr.drift_chi2(df, ["sex"], with_pvalue=True).collect()[0]
    assert abs(r["chi2"] - 0.1112) < 1e-4 and r["dof"] == 1
    assert abs(r["p_value"] - 0.7388) < 1e-4
    plain = dr.drift_chi2(df, ["sex"], yates=False).collect()[0]
    assert abs(plain["chi2"] - 0.1563) < 1e-4


def test_chi2_2x3_golden(spark):
    df = _contingency(spark, "emb", {"C": 168, "Q": 77, "S": 646}, {"C": 102, "Q": 46, "S": 270})
    r = dr.drift_chi2(df, ["emb"], with_pvalue=True).collect()[0]
    assert abs(r["chi2"] - 8.4780) < 1e-4 and r["dof"] == 2
    assert abs(r["p_value"] - 0.0144) < 1e-4


def test_ks_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    a = np.round(rng.normal(0, 1, 300), 1)
    b = np.round(rng.normal(0.2, 1, 200), 1)
    rows = [("train", float(x)) for x in a] + [("test", float(x)) for x in b]
    df = spark.createDataFrame(rows, "split string, x double")
    got = dr.drift_ks(df, ["x"]).collect()[0]["ks_stat"]
    grid = np.union1d(a, b)
    exp = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert abs(got - exp) < 1e-12


def test_category_shares_fill_one_sided(spark):
    df = _contingency(spark, "deck", {"A": 1, "T": 1}, {"A": 2})
    got = {r["value"]: (r["train_pct"], r["test_pct"], r["diff"]) for r in dr.drift_category(df, ["deck"]).collect()}
    assert got["T"] == (50.0, 0.0, -50.0)


def test_key_overlap(spark):
    rows = [("train", "s1"), ("train", "s1"), ("train", "s2"), ("test", "s1"), ("test", "s3")]
    df = spark.createDataFrame(rows, "split string, surname string")
    r = dr.key_overlap_audit(df, ["surname"]).collect()[0]
    assert (r["common"], r["train_rows_covered"], r["test_rows_covered"]) == (1, 2, 1)
    assert r["overlap_pct"] == 50.0


def test_chi2_tail_at_any_size():
    assert abs(dr.chi2_sf(1.0, 1) - 0.31731050786291415) < 1e-12
    assert abs(dr.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-12
    for dof in (1399, 1400, 1500, 1501, 2000, 2001, 200_000):  # near the median, by Wilson and Hilferty
        median = dof * (1 - 2 / (9 * dof)) ** 3
        assert abs(dr.chi2_sf(median, dof) - 0.5) < 1e-3
        assert dr.chi2_sf(dof * 2.0, dof) < 1e-6 < 1 - 1e-6 < dr.chi2_sf(dof * 0.5, dof)
    assert dr.chi2_sf(0.0, 5) == 1.0


def test_ks_tail_for_small_and_large_arguments():
    assert dr.ks_sf(1e-6, 200_000_000, 200_000_000) > 0.999999
    n = 10**12  # the correction vanishes: Kolmogorov's own table
    at = lambda lam: dr.ks_sf(lam / (n / 2) ** 0.5, n, n)
    assert abs(at(1.3580986) - 0.05) < 1e-5 and abs(at(0.8275735) - 0.5) < 1e-5 and abs(at(0.01) - 1) < 1e-12
    assert abs(at(1.1799999) - at(1.1800001)) < 1e-6


def test_leak_risk_both_ways(spark):
    audit = spark.createDataFrame([("a", 20.0), ("b", 40.0), ("c", 80.0), ("d", None)], "key string, test_coverage_pct double")
    got = {r["factor"]: (r["risk"], r["overall_risk"]) for r in dr.leak_risk(audit, {"a": (0.1, 0.15)}, cv_score=0.92).collect()}
    assert got == {k: (v, "LOW") for k, v in {"a": "LOW", "b": "MEDIUM", "c": "LOW", "d": "UNKNOWN", "cv_score": "MEDIUM"}.items()}
    assert {r["overall_risk"] for r in dr.leak_risk(audit).collect()} == {"HIGH"}
    assert {r["risk"] for r in dr.leak_risk(audit.limit(0), cv_score=0.99).collect()} == {"HIGH"}


def test_one_sided_columns_give_null_not_an_error(spark):
    df = spark.createDataFrame([("train", 1.0, "k"), ("train", 2.0, None), ("test", None, None)], "split string, x double, k string")
    assert dr.drift_ks(df, ["x"]).collect()[0]["ks_stat"] is None
    assert dr.key_overlap_audit(df, ["k"]).collect()[0]["test_coverage_pct"] is None


def test_exact_ks_is_the_share_of_lattice_paths():
    from itertools import combinations

    from tessera.operators.drift import ks_exact_sf

    for n, m in ((1, 1), (3, 4), (5, 5), (4, 7)):
        reached = []
        for right in combinations(range(n + m), n):
            i = j = most = 0
            for step in range(n + m):
                i, j = (i + 1, j) if step in right else (i, j + 1)
                most = max(most, abs(i * m - j * n))
            reached.append(most)
        for least in range(n * m + 1):
            share = sum(x >= least for x in reached) / len(reached)
            assert abs(ks_exact_sf(least / (n * m), n, m) - share) < 1e-12


def test_exact_ks_known_values():
    """Complete separation has two of C(n + m, n) orders; published critical values for n = m."""
    from math import comb

    from tessera.operators.drift import ks_exact_sf

    for n, m in ((5, 5), (8, 12), (20, 20)):
        assert abs(ks_exact_sf(1.0, n, m) * comb(n + m, n) - 2) < 1e-9
    assert ks_exact_sf(6 / 10, 10, 10) > 0.05 > ks_exact_sf(7 / 10, 10, 10)
    assert ks_exact_sf(8 / 20, 20, 20) > 0.05 > ks_exact_sf(9 / 20, 20, 20)
    assert ks_exact_sf(0.0, 4, 4) == 1.0


def test_exact_and_asymptotic_ks_agree_on_large_samples():
    from tessera.operators.drift import ks_exact_sf, ks_sf

    assert abs(ks_exact_sf(0.05, 1500, 1800) - ks_sf(0.05, 1500, 1800)) < 0.002
