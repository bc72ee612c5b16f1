"""Lemma lookup, scoring plans, streams, folds, indexes, splits and slices."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF0001
from newsflow.operators import features as FT
from newsflow.operators import lemma as L
from newsflow.operators.metrics import accuracy, confusion_matrix
from newsflow.operators.scoring import vector_scores
from newsflow.plans.model import (TextModel, TrainConfig, classifier, feature_frame, fit_features, predict_rows, prepared,
                                  train, usable)
from newsflow.plans.tuning import cross_validate, fold_of, fold_scalings
from newsflow.sources import news as N
from newsflow.sources.tables import documents, read_table
from newsflow.streaming import watch as W
from newsflow.streaming.score import read_texts


@pytest.fixture(scope="module")
def fitted(spark):
    return train(documents(spark, SF0001), TrainConfig(max_iter=30))[0]


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_equals_the_lemma_table(spark):
    rnd = random.Random(5)
    stems = ["bo", "bos", "box", "gla", "woman", "fly", "wolf", "church", "dish", "quiz", "a", "s", "men", "ses"]
    ends = ["", "s", "ss", "ses", "ves", "xes", "zes", "ches", "shes", "men", "ies", "sss", "sesses", "ssssssss"]
    words = sorted({rnd.choice(stems) + rnd.choice(ends) + rnd.choice(ends) for _ in range(300)} | {"s" * 300, "x" + "s" * 300})
    lexicon = spark.createDataFrame([(w,) for w in rnd.sample(words, 40) + stems[:6]], "form string").distinct()
    toks = spark.createDataFrame([(w,) for w in words], "token string")
    table = {r.token: r.lemma for r in L.lemma_table(toks, lexicon).collect()}
    known = {r.form for r in lexicon.collect()}
    assert {w: L.lemma_of(w, known, max(map(len, known))) for w in words} == table
    rows = spark.createDataFrame([(1, words), (2, []), (3, None), (4, [words[9]] * 2)], "k int, tokens array<string>")
    got = {r.k: r.tokens for r in L.look_up_lemmas(rows, L.lemma_lookup(lexicon)).collect()}
    assert got == {1: sorted({table[w] for w in words}), 2: [], 3: [], 4: [table[words[9]]]}
    joined = {r.k: r.tokens for r in L.lemmatize_tokens(rows, L.changed_lemmas(toks, lexicon)).collect()}
    assert got == joined


def test_a_lexicon_over_the_bound_goes_by_joins(spark, fitted, monkeypatch, scratch):
    from newsflow.streaming.score import score_stream, scored
    monkeypatch.setattr(L, "LOOKUP_FORMS", 3)
    big = TextModel(fitted.pipeline, fitted.lexicon, "item_id")
    assert big.lookup() is None and not big.streams and fitted.streams
    bench = read_table(spark, SF0001, "benchmark")
    small = sorted(fitted.with_input("item_id").score_rows(bench).collect())
    assert sorted(big.score_rows(bench).collect()) == small
    bench.write.parquet(f"{scratch}/in")
    score_stream(spark, big, f"{scratch}/in", bench.schema, f"{scratch}/out", f"{scratch}/ck").awaitTermination()
    assert sorted(scored(spark, f"{scratch}/out").select(*bench.columns[:1], "Content", "Predicted Category").collect()) == small


def test_scoring_is_one_projection(spark, fitted, scratch):
    bench = read_table(spark, SF0001, "benchmark")
    fitted.lookup()
    plan = _plan(predict_rows(fitted, bench, "item_id"))
    assert not any(x in plan for x in ("Exchange", "Join", "Aggregate", "Sort")) and plan.count("Scan") == 1
    bench.write.parquet(f"{scratch}/in")
    stream = fitted.with_input("item_id").score_rows(read_texts(spark, f"{scratch}/in", bench.schema))
    assert stream.isStreaming
    logical = stream._jdf.queryExecution().analyzed().toString()
    assert not any(x in logical for x in ("Join", "Aggregate", "Repartition"))


def test_loaded_model_scores_alike(spark, fitted, scratch):
    fitted.save(f"{scratch}/m")
    bench = read_table(spark, SF0001, "benchmark")
    a = TextModel.load(spark, f"{scratch}/m", key="item_id").score_rows(bench)
    assert sorted(a.collect()) == sorted(fitted.with_input("item_id").score_rows(bench).collect())


def test_vocabulary_index_does_not_depend_on_partitions(spark):
    rows = [(f"t{i}", 1 + i % 7) for i in range(500)]
    want = {t: i for i, (t, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    for n in (1, 50):
        got = FT.vocabulary_index(spark.createDataFrame(rows, "term string, df long").repartition(n))
        assert {r.term: r.idx for r in got.collect()} == want
    assert FT.vocabulary_index(spark.createDataFrame([], "term string, df long")).collect() == []


def test_exact_split_with_ties_and_nulls(spark):
    rows = [(i, "x") for i in range(40)] + [(7, "x")] * 50 + [(7, "y"), (None, "z"), (None, None)]
    df = spark.createDataFrame(rows, "k long, t string")
    for n in (1, 7):
        for share, size in ((0.2, 19), (0.0, 0), (1.0, 93), (0.5, 47)):
            trn, tst = FT.exact_split(df.repartition(n), "k", test_fraction=share)
            got = tst.collect()
            assert len(got) == size
            assert sorted(map(repr, [tuple(r) for r in got + trn.collect()])) == sorted(map(repr, rows))
    a = sorted(map(repr, FT.exact_split(df, "k")[1].collect()))
    assert a == sorted(map(repr, FT.exact_split(df.repartition(9), "k")[1].collect()))


def test_training_on_an_exact_split(spark):
    docs = documents(spark, SF0001)
    _, preds = train(docs, TrainConfig(max_iter=5, exact_split=True))
    assert preds.count() == -(-docs.count() // 5)


def test_folds_equal_a_refit_on_each(spark):
    cfg, folds = TrainConfig(max_iter=40, lemmas=False), 2
    trn, _ = prepared(documents(spark, SF0001), cfg)
    trn = trn.withColumn("fold", fold_of("doc_id", folds)).persist()
    stages = fit_features(trn, cfg)
    feats = feature_frame(trn, stages, ["tf", "fold"]).select("tf", "_label_idx", "fold")
    got = cross_validate(feats, cfg, (1.0,), folds)[0]
    scores = []
    vocabulary = stages[0].vocabulary
    for f, weights in enumerate(fold_scalings(feats, folds)):
        fit, judge = trn.where(f"fold <> {f}"), trn.where(f"fold = {f}")
        cv, scale, norm, indexer = fit_features(fit, cfg)
        own = dict(zip(cv.vocabulary, scale.getScalingVec().toArray()))
        assert np.allclose([own.get(t, 0.0) for t in vocabulary], weights.toArray())
        lr = classifier(cfg, fit.count()).fit(feature_frame(fit, (cv, scale, norm, indexer)))
        out = PipelineModel([cv, scale, norm, lr]).transform(judge)
        labels = {v: i for i, v in enumerate(indexer.labels)}
        rows = out.select("lang", "prediction").collect()
        scores.append(np.mean([labels.get(r.lang) == r.prediction for r in rows]))
    trn.unpersist()
    assert abs(got - np.mean(scores)) < 0.02


def test_lexicon_slices(spark, scratch):
    words = [("a", f"w{i:04d}") for i in range(900)] + [("b", "x"), ("b", 'q"uote'), ("b", None), (None, "n"), ("a", "w0001")]
    df = spark.createDataFrame(words, "category string, word string").repartition(6)
    rows = N.lexicon_slices(df, 100).collect()
    assert max(len(r.unique_words.split(",")) for r in rows) == 100
    a = sorted((r for r in rows if r.category == "a"), key=lambda r: r.slice)
    assert [w for r in a for w in r.unique_words.split(",")] == sorted(w for c, w in words if c == "a")
    assert [r.slice for r in a] == list(range(10))
    N.write_lexicon(df, f"{scratch}/lex", 100)
    got = N.explode_lexicon(N.read_lexicon(spark, f"{scratch}/lex")).collect()
    assert sorted((r.category or "", r.word) for r in got) == sorted((c or "", w) for c, w in words if w)


def test_vector_scores_hold_one_row_a_term(spark):
    x = spark.createDataFrame([(1, "a", 2.0), (1, "b", 1.0), (2, "b", 3.0), (3, "z", 1.0)], "k int, term string, weight double")
    w = spark.createDataFrame([("a", [1.0, -1.0]), ("b", [0.5, 2.0])], "term string, w array<double>")
    got = vector_scores(x, w, "k", 2)
    assert {r.k: r.scores for r in got.collect()} == {1: [2.5, 0.0], 2: [1.5, 6.0]}
    assert "Generate" not in _plan(got)
    unit = {r.k: r.scores for r in vector_scores(x, w, "k", 2, unit=True).collect()}
    assert np.allclose(unit[2], [0.5, 2.0]) and np.allclose(unit[1], np.array([2.5, 0.0]) / 5 ** 0.5)


def test_metrics_agree_on_missing_rows(spark):
    df = spark.createDataFrame([("a", "a"), (None, "a"), ("a", None), ("b", "a")], "label string, prediction string")
    assert tuple(accuracy(df).first()) == (3, pytest.approx(1 / 3))
    cm = {(r.label, r.prediction): r.n for r in confusion_matrix(df).collect()}
    assert cm == {("a", "a"): 1, ("a", "b"): 0, ("a", None): 1, ("b", "a"): 1, ("b", "b"): 0, ("b", None): 0}


def test_dropped_input_is_counted(spark):
    df = spark.createDataFrame([("t", "l", None), (None, "l", None), ("t", None, None), (None, None, "{bad")],
                               "text string, lang string, _corrupt_record string")
    assert tuple(usable(df, TrainConfig()).first()) == (4, 1, 1, 1, 1)


def test_watcher_with_an_empty_last_batch_and_compaction(spark, scratch):
    landing, state = f"{scratch}/landing", f"{scratch}/state"
    a = spark.createDataFrame([(i, "x") for i in range(10)], "k long, v string")

    def land(rows, name):
        rows.withColumn("collection", F.lit(name)).write.partitionBy("collection").mode("append").parquet(landing)
        rows.write.mode("append").parquet(f"{landing}/collection={name}")
        W.watch_collections(spark, landing, a.schema, state).awaitTermination()

    def seen():
        return {(r.collection, r.first_batch, r.n_rows) for r in W.registry(spark, state).collect()}

    land(a, "c1")
    assert [r.collection for r in W.new_in_last_batch(spark, state).collect()] == ["c1"]
    land(a.limit(0), "c2")
    assert W.new_in_last_batch(spark, state).collect() == [] and W.last_batch(spark, state) == 1
    before = seen()
    W.compact(spark, state)
    assert seen() == before == {("c1", 0, 20)} and W.arrivals(spark, state).isEmpty()
    assert W.new_in_last_batch(spark, state).collect() == []
    W.compact(spark, state)
    land(a.limit(4), "c3")
    land(a.limit(1), "c1")
    assert seen() == {("c1", 0, 22), ("c3", 2, 8)}
    W.compact(spark, state)
    assert seen() == {("c1", 0, 22), ("c3", 2, 8)} and W.snapshot_batch(spark, state) == 3
    assert [r.updated_collection for r in W.update_log(spark, state).orderBy("id").collect()] == ["c1", "c3"]
