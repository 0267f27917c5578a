import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.operators.ordered import dense_codes, exact_quantiles, running_sums


def test_running_sums_matches_pandas_with_hot_key(spark):
    rng = np.random.default_rng(0)
    n = 3000
    # one key holds about a third of all rows
    key = np.where(rng.random(n) < 0.34, "hot", rng.choice(list("abcdefg"), n))
    pdf = pd.DataFrame({"k": key, "o": np.arange(n), "v": rng.integers(0, 5, n)})
    df = spark.createDataFrame(pdf)
    out = running_sums(df, ["o"], ["v"], by=["k"], num_partitions=7).toPandas()
    out = out.sort_values(["k", "o"])
    exp = pdf.sort_values(["k", "o"]).groupby("k")["v"].cumsum()
    assert (out["cum_v"].to_numpy() == exp.to_numpy()).all()


def test_running_sums_global(spark):
    df = spark.range(0, 1000).withColumn("one", F.lit(1))
    out = running_sums(df, ["id"], ["one"], num_partitions=5).toPandas().sort_values("id")
    assert (out["cum_one"].to_numpy() == np.arange(1, 1001)).all()


def test_exact_quantiles_match_numpy_linear(spark):
    vals = [1.0, 2.0, 2.0, 2.0, 3.0, 10.0, None, 7.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "x", probs).collect()}
    arr = np.array([v for v in vals if v is not None])
    for p in probs:
        assert abs(got[p] - np.quantile(arr, p)) < 1e-12


def test_dense_codes_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "s string")
    codes = {r["s"]: r["code"] for r in dense_codes(df, "s").collect()}
    assert codes == {"a": 0, "b": 1, "c": 2}


def test_running_sums_leave_other_columns_as_they_are(spark):
    from tessera.operators.ordered import running_sums

    big = 9007199254740993
    rows = [(i, None if i % 3 else big + i, 1, None if i % 5 else "k") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, payload long, one int, k string")
    got = {r["id"]: r for r in running_sums(df, ["id"], ["one"], by=["k"], num_partitions=4).collect()}
    assert all(got[i]["payload"] == p for i, p, _, _ in rows)
    assert got[55]["cum_one"] == 12 and got[59]["cum_one"] == 48


def test_constant_column_bins(spark):
    from tessera.operators.binning import equal_width_bins

    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert sorted((r["bin"] for r in equal_width_bins(df, "x", 4).collect()), key=str) == [1, 1, None]
