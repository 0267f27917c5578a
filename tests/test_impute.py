from pyspark.sql import functions as F

from tessera.operators import impute as im

from conftest import rows


def _frame(spark):
    # title t1: class 1 values all missing (group exists, median NULL); class 2 has values
    data = [
        (1, "t1", 1, None), (2, "t1", 1, None),
        (3, "t1", 2, 10.0), (4, "t1", 2, 20.0),
        (5, "t2", 1, 100.0), (6, "t2", 1, None),
        (7, "t3", 9, None),
    ]
    return spark.createDataFrame(data, "id int, title string, cls int, age double")


def test_key_exists_cascade_goes_to_global_not_next_level(spark):
    df = _frame(spark)
    out = im.impute_cascade(df, "age", [["title", "cls"], ["title"]], out="f")
    got = dict(rows(out, "id", "f"))
    glob = 20.0  # median of 10, 20, 100
    assert got[1] == glob and got[2] == glob  # (t1,1) exists with NULL median -> global (Q5)
    assert got[6] == 100.0
    assert got[7] == glob  # (t3,9) exists, all NULL -> global


def test_sequential_cascade_uses_filled_values(spark):
    df = _frame(spark)
    out = im.impute_sequential(df, "age", [["title", "cls"], ["title"]], "f")
    got = dict(rows(out, "id", "f"))
    assert got[1] == 15.0 and got[2] == 15.0  # level-2 median over t1 values 10, 20 (Q4)
    assert got[6] == 100.0
    assert got[7] is None  # no level has a value


def test_train_only_statistics(spark):
    df = _frame(spark).withColumn("split", F.when(F.col("id") <= 4, "train").otherwise("test"))
    out = im.impute_group_median(df, "age", "title", fit_on=df.where(F.col("split") == "train"), out="f")
    got = dict(rows(out, "id", "f"))
    assert got[6] is None and got[1] == 15.0


def test_mode_fill(spark):
    df = spark.createDataFrame([(1, "S"), (2, "C"), (3, "S"), (4, None)], "id int, e string")
    assert dict(rows(im.impute_mode(df, "e"), "id", "e"))[4] == "S"
