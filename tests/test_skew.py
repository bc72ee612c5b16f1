"""A key holding a large share of the rows: results stay whole and exact."""

from pyspark.sql import functions as F

from newsflow.operators.clean import clean_text, token_counts_by_group
from newsflow.operators.metrics import confusion_matrix
from newsflow.operators.scoring import top_k_per_group


def test_hot_group_token_stats_and_topk(spark):
    n = 3000
    rows = [(i, "hot" if i % 3 else f"g{i % 11}", f"w{chr(97 + i % 13)} common x{chr(97 + i % 7)}")
            for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, g string, text string").repartition(16)
    stats = {r.g: r for r in token_counts_by_group(clean_text(df, processed_col=None), "g").collect()}
    assert stats["hot"].n_docs == 2000
    assert sum(r.n_docs for r in stats.values()) == n

    counts = df.groupBy("g", F.col("doc_id") % 50).agg(F.count(F.lit(1)).alias("c")) \
        .withColumnRenamed("(doc_id % 50)", "item")
    top = top_k_per_group(counts, "g", [F.desc("c"), F.asc("item")], 5, "item", buckets=8)
    got = {(r.g, r.item) for r in top.collect()}
    want = set()
    for g, grp in __import__("itertools").groupby(
            sorted(counts.collect(), key=lambda r: (r.g, -r.c, r.item)), key=lambda r: r.g):
        want |= {(g, r.item) for r in list(grp)[:5]}
    assert got == want


def test_confusion_matrix_skewed_labels(spark):
    rows = [("a", "a")] * 900 + [("a", "b")] * 50 + [("b", "b")] * 30 + [("c", "c")] * 20
    cm = {(r.label, r.prediction): r.n for r in confusion_matrix(
        spark.createDataFrame(rows, "label string, prediction string").repartition(8)).collect()}
    assert cm[("a", "a")] == 900 and cm[("c", "a")] == 0 and sum(cm.values()) == 1000


def test_hot_term_is_split_in_the_final_plan(spark):
    """Half of all rows hold one term: the executed join reads its partition in pieces."""
    from newsflow.operators.features import tfidf
    forced = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
              "spark.sql.adaptive.coalescePartitions.enabled": "false",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in forced}
    for k, v in forced.items():
        spark.conf.set(k, v)
    try:
        terms = spark.range(0, 200_000, 1, 8).selectExpr(
            "id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('t', id % 5000) END AS term")
        idf = terms.groupBy("term").count().selectExpr("term", "1.0D AS idf")
        got = tfidf(terms, idf, "doc_id")
        assert len(got.collect()) == 200_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
