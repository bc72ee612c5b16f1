"""S1 malformed lines, JSON landing folders, and C6's second poll finding nothing."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from newsflow.plans.model import TrainConfig
from newsflow.plans.retrain import retrain_if_updated
from newsflow.sources import news as N
from newsflow.sources.tables import read_table
from newsflow.streaming.watch import registry, watch_collections


def test_read_news_keeps_bad_lines_aside(spark, scratch):
    os.makedirs(f"{scratch}/news")
    good = {"link": "l", "headline": "h", "category": "SPORTS", "short_description": "d",
            "authors": "a", "date": "2022-09-23"}
    with open(f"{scratch}/news/part.json", "w") as f:
        f.write(json.dumps(good) + "\n")
        f.write("{not json\n")
    rows = N.read_news(spark, f"{scratch}/news").collect()
    ok = [r for r in rows if r["_corrupt_record"] is None]
    bad = [r for r in rows if r["_corrupt_record"] is not None]
    assert len(ok) == 1 and str(ok[0]["date"]) == "2022-09-23" and ok[0]["category"] == "SPORTS"
    assert len(bad) == 1 and bad[0]["_corrupt_record"] == "{not json"


def test_watcher_reads_json_collections(spark, scratch):
    landing, state = f"{scratch}/landing", f"{scratch}/state"
    df = spark.createDataFrame([(i, "t") for i in range(5)], "k long, v string")
    df.withColumn("collection", F.lit("news_a")).write.partitionBy("collection").json(landing)
    watch_collections(spark, landing, df.schema, state, fmt="json").awaitTermination()
    assert {r.collection: r.n_rows for r in registry(spark, state).collect()} == {"news_a": 5}


def test_retrain_only_when_something_new(spark, scratch):
    landing, state = f"{scratch}/landing", f"{scratch}/state"
    docs = read_table(spark, SF0001, "documents")
    docs.withColumn("collection", F.col("source")).where(F.col("source").isin("src0", "src1")) \
        .write.partitionBy("collection").parquet(landing)
    cfg = TrainConfig(max_iter=20)
    first = retrain_if_updated(spark, landing, docs.schema, state, f"{scratch}/m1", cfg)
    assert first is not None and first["accuracy"].first()["collection"] == "src1"
    assert retrain_if_updated(spark, landing, docs.schema, state, f"{scratch}/m2", cfg) is None
    # more files of a known collection are no new collection
    docs.limit(5).write.parquet(f"{landing}/collection=src1/more")
    assert retrain_if_updated(spark, landing, docs.schema, state, f"{scratch}/m2", cfg) is None


def test_failed_training_is_tried_again(spark, scratch, monkeypatch):
    from newsflow.plans import retrain as R
    landing, state = f"{scratch}/landing", f"{scratch}/state"
    docs = read_table(spark, SF0001, "documents")
    docs.withColumn("collection", F.lit("c1")).write.partitionBy("collection").parquet(landing)
    real = R.train

    def broken(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(R, "train", broken)
    with pytest.raises(RuntimeError):
        retrain_if_updated(spark, landing, docs.schema, state, f"{scratch}/m", TrainConfig(max_iter=5))
    monkeypatch.setattr(R, "train", real)
    assert retrain_if_updated(spark, landing, docs.schema, state, f"{scratch}/m", TrainConfig(max_iter=5))


def test_read_news_csv_and_parquet(spark, scratch):
    row = ("l1", "h", "TECH", 'says "hi", then.\nmore', "a", "2022-01-02")
    cols = "link string, headline string, category string, short_description string, " \
           "authors string, date string"
    df = spark.createDataFrame([row], cols).withColumn("date", F.to_date("date"))
    df.write.option("header", True).option("escape", '"').csv(f"{scratch}/csv")
    df.write.parquet(f"{scratch}/pq")
    for fmt, path in (("csv", f"{scratch}/csv"), ("parquet", f"{scratch}/pq")):
        r = N.read_news(spark, path, fmt=fmt).first()
        assert (r["category"], r["short_description"], str(r["date"])) == \
            ("TECH", 'says "hi", then.\nmore', "2022-01-02"), fmt
