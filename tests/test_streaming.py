"""Fitted tables apply to a streaming DataFrame as a stream-static join."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import groups as gr


def test_fitted_group_stats_apply_to_a_stream(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    orders.write.mode("overwrite").parquet(src)
    stats = gr.fit_group_stats(orders, "o_custkey", {"cust_orders": F.count(F.lit(1))})
    stream = spark.readStream.schema(orders.schema).parquet(src)
    applied = gr.apply_stats(stream, stats, "o_custkey", {"cust_orders": 0})
    q = (
        applied.select("o_orderkey", "cust_orders")
        .writeStream.format("memory")
        .queryName("tessera_stream_apply")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    got = spark.sql("SELECT * FROM tessera_stream_apply")
    batch = gr.apply_stats(orders, stats, "o_custkey").select("o_orderkey", "cust_orders")
    assert got.count() == orders.count()
    assert got.exceptAll(batch).count() == 0
