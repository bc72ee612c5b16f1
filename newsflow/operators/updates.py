"""Dataset-update detection (U1-U5, S3) as DataFrame operators.

A *collection* is a named batch of rows (a folder, a table partition). The
registry keeps (collection, first_seen); the update log keeps (id, time,
updated_collection). Every operator is a join or an aggregation on those
small tables or on per-collection row counts; none lists data on the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: the update log's time format (12-hour clock, AM/PM, ISO date).
LOG_TIME_FORMAT = "hh:mm a, yyyy-MM-dd"


def collection_counts(data: DataFrame, collection: Column, ts: Column) -> DataFrame:
    """(collection, first_seen, last_seen, n_rows) from the rows themselves (partial aggregation)."""
    return data.groupBy(collection.alias("collection")).agg(
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count(F.lit(1)).alias("n_rows"))


def new_collections(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Names in the current listing that the registry does not know."""
    return listing.join(known.select("collection"), "collection", "left_anti")


def nonempty_only(listing: DataFrame, counts: DataFrame) -> DataFrame:
    """Keep listed collections that hold at least one row."""
    return listing.join(counts.where(F.col("n_rows") > 0).select("collection"),
                        "collection", "left_semi")


def drop_vanished(log: DataFrame, listing: DataFrame) -> DataFrame:
    """U4: delete log rows whose collection is no longer listed."""
    return log.join(listing.select(F.col("collection").alias("updated_collection")),
                    "updated_collection", "left_semi")


def number_collections(registry: DataFrame, start: Column | int = 0) -> DataFrame:
    """History counter: ids in (first_seen, collection) order after ``start``.

    The registry holds one row per collection name, so the ordering window
    runs over names, not data rows.
    """
    s = start if isinstance(start, Column) else F.lit(start)
    w = Window.orderBy("first_seen", "collection")
    return registry.withColumn("id", (s + F.row_number().over(w)).cast("bigint"))


def log_update(log: DataFrame | None, new: DataFrame, start: int = 0) -> DataFrame:
    """Append (id, time, updated_collection, logged_at) rows for newly seen
    collections; ``time`` is the log's text form, ``logged_at`` the timestamp.
    Without a log, ids follow ``start``."""
    if log is not None:
        start = log.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    rows = number_collections(new, start).select(
        "id", F.date_format("first_seen", LOG_TIME_FORMAT).alias("time"),
        F.col("collection").alias("updated_collection"), F.col("first_seen").alias("logged_at"))
    return rows if log is None else log.unionByName(rows)


def append_log(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """U2 on a stored log: the collections of ``new`` that it does not list are
    appended, with ids after its last; returns the log read back. Appending the
    same collections again changes nothing."""
    try:
        log = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = None
    if log is not None:
        new = new_collections(new, log.select(F.col("updated_collection").alias("collection")))
    start = log.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] if log is not None else 0
    log_update(None, new, start).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def latest_collection(log: DataFrame) -> DataFrame:
    """S3: the most recently logged collection (largest id), one row."""
    return log.agg(F.max_by("updated_collection", "id").alias("updated_collection"),
                   F.max("id").alias("id"))


def expected_partitions(data: DataFrame, group: str, ts: str) -> DataFrame:
    """(collection, day): one expected daily partition per group and calendar day
    between the table's first and last day (days with no rows included)."""
    lo = data.agg(F.min(F.to_date(ts))).scalar()
    hi = data.agg(F.max(F.to_date(ts))).scalar()
    groups = data.select(group).distinct()
    return (groups.select(group, F.explode(F.sequence(lo, hi)).alias("day"))
            .select(partition_name(F.col(group), F.col("day")).alias("collection"), "day"))


def partition_name(group: Column, day: Column) -> Column:
    return F.concat(group, F.lit("_"), F.date_format(day, "yyyyMMdd"))
