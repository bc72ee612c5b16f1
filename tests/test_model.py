"""Model: optimality of the fitted classifier, save/load, batch = stream."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from newsflow.operators.features import is_test
from newsflow.plans.model import (TextModel, TrainConfig, bounded, classifier, evaluate, feature_frame,
                                  fit_features, prepared, train)
from newsflow.sources.tables import documents, read_table


@pytest.fixture(scope="module")
def fitted(spark):
    return train(documents(spark, SF0001), TrainConfig(max_iter=300))


def test_stationarity_of_c1_objective(spark):
    """At the fitted point the gradient of sum(log-loss) + 0.5*||W||^2 is ~0."""
    cfg = TrainConfig(max_iter=1000, tol=1e-10)
    prep, _ = prepared(documents(spark, SF0001), cfg)
    trn = prep.where(~F.col("is_test"))
    stages = fit_features(trn, cfg)
    feats = feature_frame(trn, stages).persist()
    n = feats.count()
    lr = classifier(cfg, n).fit(feats)
    W = lr.coefficientMatrix.toArray()
    b = lr.interceptVector.toArray()
    rows = feats.collect()
    X = np.stack([r.features.toArray() for r in rows])
    y = np.array([int(r._label_idx) for r in rows])
    Y = np.eye(W.shape[0])[y]
    Z = X @ W.T + b
    P = np.exp(Z - Z.max(axis=1, keepdims=True))
    P /= P.sum(axis=1, keepdims=True)
    gW = (P - Y).T @ X + W
    gb = (P - Y).sum(axis=0)
    scale = np.abs(((np.full_like(P, 1.0 / W.shape[0]) - Y).T @ X)).max()  # gradient at W = 0
    assert np.abs(gW).max() < 1e-2 * scale
    assert np.abs(gb).max() < 5e-2 * scale


def test_save_load_roundtrip(spark, fitted, scratch):
    model, preds = fitted
    model.save(f"{scratch}/m")
    loaded = TextModel.load(spark, f"{scratch}/m")
    docs = documents(spark, SF0001)
    a = {r.doc_id: r["Predicted Category"] for r in model.score_rows(docs).collect()}
    b = {r.doc_id: r["Predicted Category"] for r in loaded.score_rows(docs).collect()}
    assert a == b and len(a) == docs.count()
    assert preds.count() > 0


def test_scoring_partition_invariant(spark, fitted):
    model, _ = fitted
    docs = documents(spark, SF0001)
    a = sorted(model.score_rows(docs).collect())
    b = sorted(model.score_rows(docs.repartition(3)).collect())
    assert a == b


def test_stream_equals_batch(spark, fitted, scratch):
    from newsflow.streaming.score import score_stream, scored
    model, _ = fitted
    bench = read_table(spark, SF0001, "benchmark")
    bench.repartition(3).write.parquet(f"{scratch}/in")
    m = model.with_input("item_id")
    score_stream(spark, m, f"{scratch}/in", bench.schema, f"{scratch}/out", f"{scratch}/ck",
                 max_files_per_trigger=1).awaitTermination()
    s = sorted(scored(spark, f"{scratch}/out").select("item_id", "Content", "Predicted Category").collect())
    b = sorted(m.score_rows(bench).collect())
    assert s == b and len(s) == bench.count()


def test_predict_text_single(spark, fitted):
    from newsflow.plans.model import predict_text
    model, _ = fitted
    out = predict_text(spark, model, "sachin score 100.he played well .he get a trophy")
    assert out["Content"] == "sachin score 100.he played well.he get a trophy"
    assert out["Predicted_category"] in set(model.pipeline.stages[-1].getLabels())


def test_score_distinct_matches_row_scores(spark, fitted):
    model, _ = fitted
    docs = documents(spark, SF0001)
    once = {r.Content: r["Predicted Category"] for r in model.score_distinct(docs).collect()}
    rows = model.score_rows(docs).collect()
    assert len(once) == len({r.Content for r in rows})
    assert all(once[r.Content] == r["Predicted Category"] for r in rows)


def test_fit_rows_are_bounded_by_labelled_rows(spark):
    docs = documents(spark, SF0001)
    assert bounded(docs, TrainConfig()).count() == docs.count()
    some = bounded(docs, TrainConfig(max_fit_rows=50))
    assert 20 <= some.count() <= 90
    assert {r.doc_id for r in some.collect()} == {
        r.doc_id for r in bounded(docs.repartition(3), TrainConfig(max_fit_rows=50)).collect()}


def test_bound_on_fit_rows_leaves_the_test_split_whole(spark):
    docs = documents(spark, SF0001)
    docs = docs.union(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    whole = docs.where(is_test("doc_id") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    cfg = TrainConfig(max_fit_rows=60, max_iter=5)
    model, preds = train(docs, cfg)
    assert sorted(r.doc_id for r in preds.collect()) == sorted(r.doc_id for r in whole.collect())
    assert evaluate(preds)["accuracy"].first()["n"] == whole.count()
    trn, _ = prepared(docs, cfg)
    assert 20 <= trn.count() <= 110 and trn.where("is_test").isEmpty()


def test_fit_ends_before_the_iteration_limit(spark):
    model, _ = train(documents(spark, SF0001), TrainConfig(tol=1e-4))
    assert model.pipeline.stages[3].summary.totalIterations < 1000


def test_null_and_empty_text_score_to_a_class(spark, fitted):
    model, _ = fitted
    df = spark.createDataFrame([(1, None), (2, ""), (3, "...")], "doc_id long, text string")
    out = {r.doc_id: r["Predicted Category"] for r in model.score_rows(df).collect()}
    labels = set(model.pipeline.stages[-1].getLabels())
    assert set(out) == {1, 2, 3} and all(v in labels for v in out.values())
    assert out[1] == out[2] == out[3]          # all three are the zero vector


def test_rows_with_repeated_and_null_keys_are_all_scored(spark, fitted):
    model, _ = fitted
    docs = documents(spark, SF0001).limit(20)
    one = docs.withColumn("doc_id", F.when(F.col("lang") == "en", F.lit(1).cast("long")))
    assert model.score_rows(one).count() == docs.count()


def test_the_last_saved_version_is_loaded_without_an_older_lexicon(spark, fitted, scratch):
    model, _ = fitted
    model.save(f"{scratch}/m")
    loaded = TextModel.load(spark, f"{scratch}/m")
    assert loaded.lexicon is not None and loaded.key == "doc_id" and loaded.text_col == "text"
    loaded.save(f"{scratch}/m")  # onto the folder it was read from
    assert TextModel.load(spark, f"{scratch}/m").lexicon.count() == model.lexicon.count()
    TextModel(model.pipeline, None, ["a", "b"], "body").save(f"{scratch}/m")
    plain = TextModel.load(spark, f"{scratch}/m")
    assert plain.lexicon is None and plain.key == ["a", "b"] and plain.text_col == "body"
