from pyspark.sql import functions as F

from tessera.functions import features as fx

from conftest import rows

EDGES = [0, 12, 18, 35, 60, 100]
LABELS = ["Child", "Teen", "Adult", "Middle", "Senior"]


def test_cut_right_closed_and_out_of_range(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.0, 0.5, 12.0, 12.01, 100.0, 100.5, None, -1.0])],
                               "id int, x double")
    got = [r[1] for r in rows(df.select("id", fx.cut("x", EDGES, LABELS).alias("b")))]
    assert got == [None, "Child", "Child", "Teen", "Senior", None, None, None]
    low = [r[1] for r in rows(df.select("id", fx.cut("x", EDGES, LABELS, include_lowest=True).alias("b")))]
    assert low[0] == "Child"


def test_band_and_binarize(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.29), (3, 0.9)], "id int, p double")
    got = rows(df.select("id", fx.band("p", [0.3, 0.5], ["low", "mid", "high"]).alias("b"),
                         fx.binarize("p", 0.5, True).alias("ge"), fx.binarize("p", 0.5, False).alias("gt")))
    assert got == [(1, "high", 1, 0), (2, "low", 0, 0), (3, "high", 1, 1)]


def test_flag_null_is_zero_and_ratio_by_zero(spark):
    df = spark.createDataFrame([(1, None, 0), (2, 10.0, 4)], "id int, x double, n int")
    got = rows(df.select("id", fx.threshold_flag("x", 12, "<=").alias("f"), fx.ratio("x", "n").alias("r")))
    assert got == [(1, 0, None), (2, 1, 2.5)]


def test_blend_weight_one_equals_first(spark):
    df = spark.createDataFrame([(1, 0.2, 0.9), (2, 0.7, 0.1)], "id int, a double, b double")
    got = rows(df.select("id", fx.blend({"a": 1.0, "b": 0.0}).alias("p"), F.col("a")))
    assert all(p == a for _, p, a in got)
