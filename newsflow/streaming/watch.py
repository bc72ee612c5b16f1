"""Watch a landing folder for new collections with Structured Streaming.

Layout: ``<landing>/collection=<name>/part-*.{parquet,json}``. The file source
discovers the ``collection`` partition column from the path, tracks which
files it has read in its checkpoint, and each micro-batch records the
per-collection row counts of the newly arrived files under
``<state>/arrivals/batch_id=<n>`` (overwritten on retry, so a replayed batch
never double counts). A collection whose files hold no rows never appears,
which is the "non-empty only" rule (U3) for free; that its batch ran is
recorded beside the arrivals (``<state>/batches``).

``compact`` folds the arrivals into a snapshot of the registry, so that a read
costs the collections and the polls since then, not all polls ever made.

Run with ``trigger(availableNow=True)`` for a batch-style poll: each call
picks up exactly the files that arrived since the previous call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsflow.operators import updates as U
from newsflow.sources.tables import delete_folders, read_or_none


def _with_collection(schema: T.StructType) -> T.StructType:
    if "collection" in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField("collection", T.StringType())])


def watch_collections(spark: SparkSession, landing: str, schema: T.StructType, state: str,
                      fmt: str = "parquet", available_now: bool = True,
                      processing_time: str = "10 seconds") -> StreamingQuery:
    """Start the watcher; returns the running query (``awaitTermination`` for one poll)."""
    stream = (spark.readStream.format(fmt).schema(_with_collection(schema))
              .option("basePath", landing).load(landing))

    def record(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("collection").agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.current_timestamp().alias("arrived"))
        (counts.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{state}/arrivals/batch_id={batch_id}"))
        (spark.createDataFrame([(batch_id,)], "last long")
         .coalesce(1).write.mode("overwrite").parquet(f"{state}/batches/batch_id={batch_id}"))

    w = (stream.writeStream.foreachBatch(record)
         .option("checkpointLocation", f"{state}/checkpoint"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


ARRIVALS = "collection string, n_rows long, arrived timestamp, batch_id long"
REGISTRY = "collection string, first_batch long, first_seen timestamp, n_rows long"


def snapshot_batch(spark: SparkSession, state: str) -> int:
    """The last batch that the newest snapshot holds; -1 without one."""
    done = read_or_none(spark, f"{state}/snapshots", "last long")
    return -1 if done is None else done.agg(F.max("last")).first()[0]


def arrivals(spark: SparkSession, state: str, after: int = -1) -> DataFrame:
    """(collection, n_rows, arrived, batch_id) of the recorded micro-batches after ``after``;
    folders of earlier ones are not listed in the scan."""
    rows = read_or_none(spark, f"{state}/arrivals", ARRIVALS)
    rows = spark.createDataFrame([], ARRIVALS) if rows is None else rows
    return rows.where(F.col("batch_id") > after)


def registry(spark: SparkSession, state: str) -> DataFrame:
    """(collection, first_batch, first_seen, n_rows): one row per collection seen so far."""
    last = snapshot_batch(spark, state)
    new = arrivals(spark, state, last).select(
        "collection", F.col("batch_id").alias("first_batch"), F.col("arrived").alias("first_seen"), "n_rows")
    if last >= 0:
        new = new.unionByName(spark.read.schema(REGISTRY).parquet(f"{state}/registry/upto={last}"))
    return new.groupBy("collection").agg(
        F.min("first_batch").alias("first_batch"), F.min("first_seen").alias("first_seen"),
        F.sum("n_rows").cast("bigint").alias("n_rows"))


def compact(spark: SparkSession, state: str) -> None:
    """Fold all recorded batches into a snapshot of the registry and delete their files.

    Run it between polls. The snapshot counts once its row in ``snapshots`` is
    written, and only what it holds is deleted after that, so a run that stops
    anywhere leaves a state that reads the same."""
    upto = last_batch(spark, state)
    before = snapshot_batch(spark, state)
    if upto is not None and upto > before:
        registry(spark, state).coalesce(1).write.mode("overwrite").parquet(f"{state}/registry/upto={upto}")
        (spark.createDataFrame([(upto,)], "last long")
         .coalesce(1).write.mode("append").parquet(f"{state}/snapshots"))
        before = upto
    delete_folders(spark, f"{state}/arrivals", lambda name: 0 <= _number(name, "batch_id=") <= before)
    delete_folders(spark, f"{state}/batches", lambda name: 0 <= _number(name, "batch_id=") < before)
    delete_folders(spark, f"{state}/registry", lambda name: 0 <= _number(name, "upto=") < before)


def _number(name: str, prefix: str) -> int:
    digits = name.removeprefix(prefix)
    return int(digits) if digits != name and digits.isdigit() else -1


def last_batch(spark: SparkSession, state: str) -> int | None:
    """The last micro-batch that ran, with or without rows."""
    ran = read_or_none(spark, f"{state}/batches", "last long, batch_id long")
    return None if ran is None else ran.agg(F.max("last")).first()[0]


def new_in_last_batch(spark: SparkSession, state: str) -> DataFrame:
    """Collections first seen in the most recent micro-batch (U1 on the registry)."""
    return registry(spark, state).where(F.col("first_batch") == F.lit(last_batch(spark, state)))


def update_log(spark: SparkSession, state: str) -> DataFrame:
    """(id, time, updated_collection, logged_at, first_batch) in arrival order,
    collections of one batch by name."""
    reg = registry(spark, state)
    log = U.log_update(None, reg)
    return log.join(reg.select(F.col("collection").alias("updated_collection"), "first_batch"), "updated_collection")
