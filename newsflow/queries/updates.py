"""Registered update-detection queries (U1-U5, S3) over ``events``.

Each (event_type, day) is a collection named ``<type>_<yyyyMMdd>``; its
first event is when it appeared. The previous registry snapshot is taken one
week before the newest event and the retention window is two weeks, both
measured from the data itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.operators import updates as U
from newsflow.session import materialize, staging_path
from newsflow.sources.tables import read_table

PREV_DAYS = 7
RETENTION_DAYS = 14
LARGE_VALUE = 200


def _events(spark, sf):
    return read_table(spark, sf, "events").select("event_type", "ts")


def _counts(ev):
    name = U.partition_name(F.col("event_type"), F.to_date("ts"))
    return U.collection_counts(ev, name, F.col("ts"))


def _listing(counts, cutoff):
    return counts.where(F.col("first_seen") <= cutoff).select("collection", "first_seen")


def _snapshots(spark, sf):
    ev = _events(spark, sf)
    counts = materialize(_counts(ev))  # one row per collection; read by several branches
    t_now = counts.agg(F.max("last_seen")).scalar()  # newest event, from the small table
    t_prev = t_now - F.expr(f"INTERVAL {PREV_DAYS} DAYS")
    return ev, counts, t_now, t_prev


def _log(spark, sf):
    _, counts, t_now, t_prev = _snapshots(spark, sf)
    prev = _listing(counts, t_prev)
    path = staging_path(spark, "update-log")
    U.append_log(spark, path, prev)
    return U.append_log(spark, path, _listing(counts, t_now)), counts, t_now


def _str(c):
    return F.col(c).cast("string").alias(c)


def q_new_collections(spark, sf):
    _, counts, t_now, t_prev = _snapshots(spark, sf)
    new = U.new_collections(_listing(counts, t_now), _listing(counts, t_prev))
    return new.select("collection", _str("first_seen"))


def q_nonempty(spark, sf):
    """Of the daily collections of large events that are expected, those that hold one."""
    ev = read_table(spark, sf, "events").select("event_type", "ts", "value")
    expected = U.expected_partitions(ev, "event_type", "ts")
    return U.nonempty_only(expected, _counts(ev.where(F.col("value") >= LARGE_VALUE))).select("collection", _str("day"))


def q_update_log(spark, sf):
    return _log(spark, sf)[0].withColumn("logged_at", F.col("logged_at").cast("string"))


def q_drop_vanished(spark, sf):
    log, counts, t_now = _log(spark, sf)
    kept = counts.where(F.col("first_seen") > t_now - F.expr(f"INTERVAL {RETENTION_DAYS} DAYS"))
    return U.drop_vanished(log, kept).drop("logged_at")


def q_latest_collection(spark, sf):
    return U.latest_collection(_log(spark, sf)[0])


def q_update_history(spark, sf):
    counts = _counts(_events(spark, sf))
    return U.number_collections(counts).select("id", "collection", _str("first_seen"), "n_rows")


def q_source_registry(spark, sf):
    """U5 with each ``documents.source`` as a collection, in arrival (doc_id) order."""
    docs = read_table(spark, sf, "documents").select("source", "doc_id")
    counts = U.collection_counts(docs, F.col("source"), F.col("doc_id"))
    return U.number_collections(counts).select("id", "collection", "first_seen", "n_rows")


QUERIES = {
    "new_collections": q_new_collections,
    "nonempty": q_nonempty,
    "update_log": q_update_log,
    "drop_vanished": q_drop_vanished,
    "latest_collection": q_latest_collection,
    "update_history": q_update_history,
    "source_registry": q_source_registry,
}

_C = ("c AS (SELECT event_type || '_' || strftime(CAST(ts AS DATE), '%Y%m%d') AS collection, "
      "min(ts) AS first_seen, count(*) AS n_rows FROM events GROUP BY 1), "
      "m AS (SELECT max(ts) AS t FROM events)")
_LOG = (f"{_C}, lg AS (SELECT CAST(row_number() OVER (ORDER BY first_seen, collection) AS BIGINT) AS id, "
        f"strftime(first_seen, '%I:%M %p, %Y-%m-%d') AS time, collection AS updated_collection, "
        f"CAST(first_seen AS VARCHAR) AS logged_at "
        f"FROM c WHERE first_seen <= (SELECT t FROM m))")

SQL = {
    "new_collections": f"WITH {_C} SELECT collection, CAST(first_seen AS VARCHAR) AS first_seen FROM c "
                       f"WHERE first_seen <= (SELECT t FROM m) AND collection NOT IN "
                       f"(SELECT collection FROM c WHERE first_seen <= "
                       f"(SELECT t FROM m) - INTERVAL {PREV_DAYS} DAY)",
    "nonempty": f"WITH {_C}, days AS (SELECT CAST(d AS DATE) AS day FROM generate_series("
                f"(SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events), "
                f"INTERVAL 1 DAY) g(d)), "
                f"ex AS (SELECT t.event_type || '_' || strftime(days.day, '%Y%m%d') AS collection, days.day "
                f"FROM (SELECT DISTINCT event_type FROM events) t CROSS JOIN days) "
                f"SELECT collection, CAST(day AS VARCHAR) AS day FROM ex "
                f"WHERE collection IN (SELECT event_type || '_' || strftime(CAST(ts AS DATE), '%Y%m%d') "
                f"FROM events WHERE value >= {LARGE_VALUE})",
    "update_log": f"WITH {_LOG} SELECT id, time, updated_collection, logged_at FROM lg",
    "drop_vanished": f"WITH {_LOG} SELECT id, time, updated_collection FROM lg WHERE updated_collection IN "
                     f"(SELECT collection FROM c WHERE first_seen > "
                     f"(SELECT t FROM m) - INTERVAL {RETENTION_DAYS} DAY)",
    "latest_collection": f"WITH {_LOG} SELECT arg_max(updated_collection, id) AS updated_collection, "
                         f"max(id) AS id FROM lg",
    "source_registry": "SELECT CAST(row_number() OVER (ORDER BY min(doc_id), source) AS BIGINT) AS id, "
                       "source AS collection, min(doc_id) AS first_seen, count(*) AS n_rows "
                       "FROM documents GROUP BY source",
    "update_history": f"WITH {_C} SELECT CAST(row_number() OVER (ORDER BY first_seen, collection) AS BIGINT) "
                      f"AS id, collection, CAST(first_seen AS VARCHAR) AS first_seen, n_rows FROM c",
}
