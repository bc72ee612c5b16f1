"""Registered streaming queries.

Each stages a given table into a landing folder under the shared checkpoint
dir (the way upstream writers would deliver it), runs the streaming job with
``availableNow`` and returns what the job wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.operators import updates as U
from newsflow.plans.model import TrainConfig
from newsflow.plans.retrain import retrain_if_updated
from newsflow.queries.model import _ITEMS, QUERY_TOL, known_class, trained
from newsflow.session import staging_path
from newsflow.sources.tables import read_table
from newsflow.streaming.score import score_stream, scored
from newsflow.streaming.watch import compact, registry, watch_collections


def q_watch_collections(spark, sf):
    """Every (event_type, day) collection found by the watcher, with its rows."""
    landing, state = staging_path(spark, "landing"), staging_path(spark, "watch")
    ev = read_table(spark, sf, "events")
    (ev.withColumn("collection", U.partition_name(F.col("event_type"), F.to_date("ts")))
     .write.partitionBy("collection").parquet(landing))
    watch_collections(spark, landing, ev.schema, state).awaitTermination()
    compact(spark, state)
    return registry(spark, state).select("collection", "n_rows")


def q_stream_score(spark, sf):
    """Benchmark items scored as a file stream."""
    src, out, ck = (staging_path(spark, n) for n in ("stream-in", "stream-out", "stream-ck"))
    bench = read_table(spark, sf, "benchmark")
    bench.write.parquet(src)
    model = trained(spark, sf)[0].with_input("item_id")
    score_stream(spark, model, src, bench.schema, out, ck).awaitTermination()
    return scored(spark, out).select("item_id", "Content", known_class(F.col("Predicted Category"), model))


def q_retrain(spark, sf):
    """Documents land per source; the newest collection is retrained on. Its name
    and the number of held-out rows that were scored."""
    landing, state, mdir = (staging_path(spark, n) for n in ("docs-landing", "docs-watch", "model"))
    docs = read_table(spark, sf, "documents")
    docs.withColumn("collection", F.col("source")).write.partitionBy("collection").parquet(landing)
    out = retrain_if_updated(spark, landing, docs.schema, state, mdir,
                             TrainConfig(tol=QUERY_TOL))
    return out["accuracy"].select("collection", "n")


QUERIES = {
    "watch_collections": q_watch_collections,
    "stream_score": q_stream_score,
    "retrain": q_retrain,
}

SQL = {
    "stream_score": _ITEMS,
    "watch_collections": "SELECT event_type || '_' || strftime(CAST(ts AS DATE), '%Y%m%d') AS collection, "
                         "count(*) AS n_rows FROM events GROUP BY 1",
    "retrain": "SELECT source AS collection, count(*) AS n FROM documents "
               "WHERE source = (SELECT max(source) FROM documents) AND text IS NOT NULL AND lang IS NOT NULL "
               "AND substr(md5(concat('42:', CAST(doc_id AS VARCHAR))), 1, 8) < '33333333' GROUP BY source",
}
