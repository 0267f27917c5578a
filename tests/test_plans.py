"""Plan-shape guards for the scale properties the operators are built for."""

from pyspark.sql import functions as F

import pytest

from tessera.operators import drift as dr
from tessera.operators import encode as en
from tessera.operators import folds as fo
from tessera.operators import groups as gr
from tessera.operators import impute as im
from tessera.operators import metrics as me
from tessera.operators import ordered as od


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _frame(spark):
    return spark.range(0, 5000).select(
        F.col("id"), (F.col("id") % 7).alias("k"), (F.col("id") % 2).cast("int").alias("y"),
        ((F.col("id") * 37 % 101) / 101.0).alias("p"),
    )


def test_group_size_combines_map_side(spark):
    plan = _plan(gr.group_size(_frame(spark), "k"))
    assert "partial_count" in plan  # pre-aggregated before the exchange
    assert "Window" not in plan


def test_stratified_fold_has_no_single_partition_step(spark):
    plan = _plan(fo.stratified_fold(_frame(spark), "y", "id", 5))
    assert "SinglePartition" not in plan
    assert "Window" not in plan


def test_threshold_sweep_is_a_histogram(spark):
    plan = _plan(me.threshold_sweep(_frame(spark), "y", "p", 30, 70))
    assert "partial_count" in plan and "_b" in plan  # rows -> bucket counts, then a tiny grid join
    assert "SortMergeJoin" not in plan


def test_mode_is_a_reduce_not_a_collect(spark):
    plan = _plan(gr.mode_table(_frame(spark), "k", (), "m"))
    assert "partial_min" in plan


@pytest.fixture
def unbroadcast(spark):
    """No join becomes a broadcast by itself, as when fitted tables are large."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield spark
    for n in names:
        spark.conf.unset(n)


def test_quantile_rows_are_never_brought_together_by_group(unbroadcast):
    plan = _plan(od.exact_quantiles(_frame(unbroadcast), "p", [0.25, 0.5], ["y"]))
    # the cumulated values are hashed with their range partition beside the group
    assert "hashpartitioning(y" in plan and "_part" in plan
    wide = [line for line in plan.splitlines() if "hashpartitioning(" in line and "_part" not in line]
    assert all("p#" not in line.split("Exchange")[1].split("hashpartitioning")[0] for line in wide)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert any("_part" in line for line in joins)


def test_rows_without_a_key_are_dealt_out_in_joins(unbroadcast):
    f = _frame(unbroadcast).withColumn("k", F.when(F.col("id") % 3 > 0, F.col("k")))
    for df in (
        gr.with_group_stats(f, "k", {"m": F.avg("p")}),
        gr.group_size(f, "k", sentinel=2),
        im.impute_group_median(f, "p", "k"),
        en.target_encode(f, "y", ["k"], mode="full"),
    ):
        joins = [line for line in _plan(df).splitlines() if "SortMergeJoin" in line and "LeftOuter" in line]
        assert joins and all("_tsr_salt" in line for line in joins[:1])
    salted = gr.join_back(f, f.groupBy("k").count().where("k is not null"), "k")
    tasks = salted.where("k is null").groupBy(F.spark_partition_id()).count().count()
    assert salted.count() == 5000 and tasks > 1


def test_column_totals_are_broadcast_in_drift(unbroadcast):
    f = _frame(unbroadcast).withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    for df in (dr.drift_ks(f, ["p", "k"]), dr.drift_chi2(f, ["k", "y"])):
        assert "SortMergeJoin" not in _plan(df)


def test_target_encoding_scans_its_source_three_times_at_most(spark, tmp_path):
    path = str(tmp_path / "t")
    _frame(spark).withColumn("fold", (F.col("id") % 5).cast("int")).write.parquet(path)
    df = en.target_encode(spark.read.parquet(path), "y", ["k", "p", "id"], mode="kfold")
    assert _plan(df).count(f"{path}]") <= 3


def test_top_fraction_and_average_rank(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 5.0), (3, 5.0), (4, None), (5, 1.0)], "id int, v double")
    assert sorted(r["id"] for r in gr.top_fraction(df, "v", 0.6, "id").collect()) == [1, 2, 3]
    rank = {r["id"]: r["rank"] for r in gr.average_rank_desc(df, "v").collect()}
    assert rank == {1: 3.0, 2: 1.5, 3: 1.5, 4: None, 5: 4.0}
    assert "Window" not in _plan(gr.top_fraction(df, "v", 0.6, "id"))
