import numpy as np
from pyspark.sql import functions as F

from tessera.operators import folds as fo


def test_stratified_fold_balance_and_coverage(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(503) < 0.38).astype(int)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "id long, y int")
    out = fo.stratified_fold(df, "y", "id", 5, 42).toPandas()
    assert len(out) == 503 and out["id"].is_unique
    counts = out.groupby(["y", "fold"]).size().unstack()
    assert (counts.max(axis=1) - counts.min(axis=1) <= 1).all()


def test_hash_fold_deterministic(spark):
    df = spark.range(100)
    a = fo.hash_fold(df, "id", 5, 1).toPandas().sort_values("id")["fold"].tolist()
    b = fo.hash_fold(df, "id", 5, 1).toPandas().sort_values("id")["fold"].tolist()
    assert a == b and set(a) <= set(range(5))


def test_stratified_fold_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(2000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = fo.stratified_fold(df.mapInArrow(counted, "id long, y int"), "y", "id", 3, 42)
    sizes = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    assert sorted(sizes.values()) == [222, 222, 223, 444, 444, 445] and seen.value == 2000
