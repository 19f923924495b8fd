"""The replay query hands the store edges that are computed once."""

import datetime as dt

from pyspark.sql import functions as F

from assetlens.plans import queries
from assetlens.sinks import EdgeStore


def test_store_replay_hands_over_edges_that_are_kept(spark, tmp_dir, monkeypatch):
    spark.createDataFrame([(k, f"n{k}", g) for k, g in enumerate(["BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE"] * 3)],
                          "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_dir}/customer.parquet")
    spark.range(120).select(F.col("id").alias("event_id"), (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval((F.col("id") % 29).cast("int"))).alias("ts"),
                            (F.col("id") % 12).alias("user_id"), F.lit("view").alias("event_type")).write.parquet(f"{tmp_dir}/events.parquet")
    kept, write = [], EdgeStore.write_batch
    monkeypatch.setattr(EdgeStore, "write_batch", lambda self, edges, *a, **k: (kept.append(edges.storageLevel.useMemory), write(self, edges, *a, **k))[1])
    rows = queries.store_replay(spark, tmp_dir).count()
    assert kept == [True] * 5 and rows > 0
