"""Lexicon CSV round trip, JSON-lines dump, and the batch update-log operators."""

import datetime as dt

from pyspark.sql import functions as F

from newsflow.operators import updates as U
from newsflow.sources import news as N


def test_read_lexicon_quoted_lists(spark, scratch):
    path = f"{scratch}/lex.csv"
    with open(path, "w") as f:
        f.write('category,unique_words\n')
        f.write('sports,"sports,athlete,ball"\n')
        f.write('finance,"finance,accounting, accrual, balance sheet, cash flow statement"\n')
    lex = {r.category: r.words for r in N.read_lexicon(spark, path).collect()}
    assert lex["sports"] == ["sports", "athlete", "ball"]
    assert lex["finance"] == ["finance", "accounting", "accrual", "balance sheet", "cash flow statement"]
    rows = N.explode_lexicon(N.read_lexicon(spark, path))
    assert rows.count() == 8


def test_write_then_read_lexicon(spark, scratch):
    words = spark.createDataFrame([("a", "x y"), ("a", "w"), ("b", "z")], "category string, word string")
    N.write_lexicon(words, f"{scratch}/out")
    got = {r.category: r.words for r in N.read_lexicon(spark, f"{scratch}/out").collect()}
    assert got == {"a": ["w", "x y"], "b": ["z"]}


def test_export_collection_ids_are_strings(spark, scratch):
    df = spark.createDataFrame([(7, "t")], "doc_id long, text string")
    N.export_collection(df, f"{scratch}/dump", id_col="doc_id")
    back = spark.read.json(f"{scratch}/dump").first()
    assert back["_id"] == "7" and back["doc_id"] == 7


def test_registry_log_operators(spark):
    t = dt.datetime(2024, 1, 5, 13, 7)
    known = spark.createDataFrame([("c1", t)], "collection string, first_seen timestamp")
    listing = spark.createDataFrame([("c1", t), ("c2", t + dt.timedelta(hours=1)), ("c3", t)],
                                    "collection string, first_seen timestamp")
    new = U.new_collections(listing, known)
    assert {r.collection for r in new.collect()} == {"c2", "c3"}
    counts = spark.createDataFrame([("c2", 5), ("c3", 0)], "collection string, n_rows long")
    assert [r.collection for r in U.nonempty_only(new, counts).collect()] == ["c2"]
    log = U.log_update(None, known)
    log = U.log_update(log, new)
    rows = sorted(log.collect())
    assert [(r.id, r.updated_collection) for r in rows] == [(1, "c1"), (2, "c3"), (3, "c2")]
    assert rows[0].time == "01:07 PM, 2024-01-05"
    latest = U.latest_collection(log).first()
    assert (latest.updated_collection, latest.id) == ("c2", 3)
    kept = U.drop_vanished(log, listing.where(F.col("collection") != "c3"))
    assert sorted(r.updated_collection for r in kept.collect()) == ["c1", "c2"]


def test_append_log_keeps_ids_and_is_idempotent(spark, scratch):
    path = f"{scratch}/log"

    def seen(*names):
        return spark.createDataFrame([(n, f"2024-01-0{i + 1} 10:00:00") for i, n in enumerate(names)],
                                     "collection string, t string").select(
            "collection", F.to_timestamp("t").alias("first_seen"))

    U.append_log(spark, path, seen("b", "a"))
    U.append_log(spark, path, seen("b", "a", "c"))
    log = U.append_log(spark, path, seen("b", "a", "c"))
    assert [(r.id, r.updated_collection) for r in log.orderBy("id").collect()] == [(1, "b"), (2, "a"), (3, "c")]


def test_spread_only_when_asked(spark):
    from newsflow.sources.tables import SPREAD_KEY, spread
    rows = spark.range(0, 100, 1, 3)
    assert spread(rows).rdd.getNumPartitions() == 3
    assert "Exchange" in spread(rows, 5)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(SPREAD_KEY, "2")
    try:
        # also fewer than the scan has: the setting, not the size, decides
        assert "Exchange" in spread(rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(SPREAD_KEY)
