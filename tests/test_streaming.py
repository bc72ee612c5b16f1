"""Collection watcher: first poll reports existing collections, the next only new ones."""

from pyspark.sql import functions as F

from newsflow.streaming.watch import new_in_last_batch, registry, update_log, watch_collections


def test_watcher_two_polls(spark, scratch):
    landing, state = f"{scratch}/landing", f"{scratch}/state"
    schema = "k long, v string"
    a = spark.createDataFrame([(i, "x") for i in range(10)], schema)
    a.withColumn("collection", F.lit("c1")).write.partitionBy("collection").mode("append").parquet(landing)
    a.limit(3).withColumn("collection", F.lit("c2")).write.partitionBy("collection").mode("append").parquet(landing)
    # an empty collection: a file with no rows
    a.limit(0).withColumn("collection", F.lit("empty")).write.partitionBy("collection").mode("append") \
        .parquet(landing)
    watch_collections(spark, landing, a.schema, state).awaitTermination()
    assert {r.collection for r in new_in_last_batch(spark, state).collect()} == {"c1", "c2"}

    a.limit(4).withColumn("collection", F.lit("c3")).write.partitionBy("collection").mode("append").parquet(landing)
    watch_collections(spark, landing, a.schema, state).awaitTermination()
    assert {r.collection for r in new_in_last_batch(spark, state).collect()} == {"c3"}
    reg = {r.collection: r.n_rows for r in registry(spark, state).collect()}
    assert reg == {"c1": 10, "c2": 3, "c3": 4}
    log = update_log(spark, state).orderBy("id").collect()
    assert [r.updated_collection for r in log] == ["c1", "c2", "c3"]
    # the two of the first batch arrived at one time, the third later
    assert log[0].logged_at == log[1].logged_at < log[2].logged_at
    assert [r.first_batch for r in log] == [0, 0, 1] and all(r.time for r in log)


def test_watcher_continuous_trigger(spark, scratch):
    landing, state = f"{scratch}/landing", f"{scratch}/state"
    a = spark.createDataFrame([(i, "x") for i in range(6)], "k long, v string")
    a.withColumn("collection", F.lit("d1")).write.partitionBy("collection").parquet(landing)
    q = watch_collections(spark, landing, a.schema, state, available_now=False,
                          processing_time="1 second")
    try:
        q.processAllAvailable()
        a.limit(2).withColumn("collection", F.lit("d2")).write.partitionBy("collection") \
            .mode("append").parquet(landing)
        q.processAllAvailable()
    finally:
        q.stop()
    assert {r.collection: r.n_rows for r in registry(spark, state).collect()} == {"d1": 6, "d2": 2}
    assert {r.collection for r in new_in_last_batch(spark, state).collect()} == {"d2"}
