from pyspark.sql import functions as F

from tessera.operators import groups as gr

from conftest import rows


def _frame(spark):
    data = [(1, "a", 1.0), (2, "a", None), (3, "b", 3.0), (4, None, 5.0), (5, "c", None), (6, "a", 7.0)]
    return spark.createDataFrame(data, "id int, k string, v double")


def test_null_key_gets_null_size_and_size_vs_count(spark):
    df = _frame(spark)
    got = rows(gr.group_size(gr.group_size(df, "k", "size"), "k", "cnt", count_col="v"), "id", "size", "cnt")
    assert got == [(1, 3, 2), (2, 3, 2), (3, 1, 1), (4, None, None), (5, 1, 0), (6, 3, 2)]


def test_group_median_keeps_all_null_group(spark):
    got = rows(gr.group_median(_frame(spark), "k", "v", "m"))
    assert got == [("a", 4.0), ("b", 3.0), ("c", None)]


def test_mode_smallest_on_ties(spark):
    df = spark.createDataFrame([("S",), ("C",), ("C",), ("S",), ("Q",), (None,), (None,), (None,)], "e string")
    assert gr.mode_table(df, "e", (), "m").collect()[0]["m"] == "C"


def test_dense_rank_nulls(spark):
    df = spark.createDataFrame([(1, "x", 30.0), (2, "x", 10.0), (3, "x", 30.0), (4, "x", None), (5, "y", 2.0)],
                               "id int, k string, v double")
    got = rows(gr.dense_rank_in_group(df, "k", "v", "r"), "id", "r")
    assert got == [(1, 2), (2, 1), (3, 2), (4, None), (5, 1)]


def test_value_share_excludes_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "e string")
    got = rows(gr.value_share(df, "e"))
    assert got == [("a", 2 / 3), ("b", 1 / 3)]


def test_sentinel_group_size(spark):
    df = spark.createDataFrame([(1, "Unknown"), (2, "Unknown"), (3, "C1"), (4, "C1")], "id int, c string")
    got = rows(gr.group_size(df, "c", "n", sentinel="Unknown"), "id", "n")
    assert got == [(1, 1), (2, 1), (3, 2), (4, 2)]


def test_average_rank_ties(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 3.0), ("d", 1.0)], "f string, v double")
    got = rows(gr.average_rank_desc(df, "v", "r"), "f", "r")
    assert got == [("a", 1.0), ("b", 2.5), ("c", 2.5), ("d", 4.0)]


def test_describe_exact(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    r = gr.describe_exact(df, ["x"]).collect()[0]
    assert (r["count"], r["mean"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]) == (4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)


def test_collapse_rare(spark):
    df = spark.createDataFrame([(i, "A" if i < 5 else "B") for i in range(7)], "id int, p string")
    got = {r["p"] for r in gr.collapse_rare(df, "p", 5).collect()}
    assert got == {"A", "RARE"}


def test_group_median_with_hot_group_matches_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(9)
    n = 6000
    key = np.where(rng.random(n) < 0.34, "hot", rng.choice(list("abcdef"), n))
    val = np.where(rng.random(n) < 0.1, np.nan, np.round(rng.normal(50, 20, n), 1))
    pdf = pd.DataFrame({"k": key, "v": val})
    df = spark.createDataFrame([(k, None if np.isnan(v) else float(v)) for k, v in zip(key, val)], "k string, v double")
    got = {r["k"]: r["m"] for r in gr.group_median(df, "k", "v", "m").collect()}
    exp = pdf.groupby("k")["v"].median().to_dict()
    assert set(got) == set(exp)
    assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)
