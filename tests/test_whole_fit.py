"""Fits on all rows: memory of the solver, packed pairs, scoring, the grid, staged files."""

import random
import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from newsflow.plans import model as M
from newsflow.plans import sharded, tuning
from newsflow.plans.model import TrainConfig
from newsflow.session import stage

WORDS = ["cat", "cats", "dog", "dogs", "glass", "glasses", "boat", "tree", "trees", "stone", "river", "rivers", "men", "man", "a", "s"]


def _docs(spark, n=120, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        label = rnd.choice(["p", "q", "r"])
        first = {"p": 0, "q": 5, "r": 10}[label]
        words = [rnd.choice(WORDS[first:first + 7]) for _ in range(rnd.randint(2, 9))] + [rnd.choice(WORDS)]
        rows.append((i if i % 9 else None, " ".join(words) if i % 31 else None, label if i % 37 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_the_driver_holds_few_numbers_a_row():
    rng = np.random.default_rng(4)
    n, k = 60_000, 4
    y = rng.integers(0, k, n)
    weight = 10.0 ** rng.uniform(-2, 3, (n, 1))   # a diagonal inner product of many scales
    tracemalloc.start()
    fit = sharded.descent(y, k, 1 / n, 25, 1e-12)
    asked = next(fit)
    try:
        while True:
            asked = fit.send(asked * weight)
    except StopIteration as end:
        losses = end.value[-1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(losses) > 10 and losses == sorted(losses, reverse=True)
    assert peak < 25 * n * k * 8


def test_rows_in_blocks_and_a_given_start_find_the_same_optimum(monkeypatch):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(90, 12)), rng.integers(-1, 3, 90)

    def solved(reg, store=None, tol=1e-13):
        fit = sharded.descent(y, 3, reg, 300, tol, store=store)
        asked = next(fit)
        try:
            while True:
                asked = fit.send(x @ (x.T @ asked))
        except StopIteration as end:
            return end.value

    whole, losses = solved(0.01)
    w = x.T @ whole.read(sharded.POINT, sharded.NUMBERS, 0, 90)
    real = y >= 0
    z = x @ w + whole.free[sharded.POINT]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    assert np.abs(x[real].T @ (p[real] - np.eye(3)[y[real]]) / real.sum() + 0.01 * w).max() < 1e-5
    monkeypatch.setattr(sharded, "STORE_ROWS", 7)
    blocks, again = solved(0.01)
    assert abs(losses[-1] - again[-1]) < 1e-9
    warm, later = solved(0.01, store=solved(0.1, tol=1e-6)[0])
    assert abs(losses[-1] - later[-1]) < 1e-9
    assert np.allclose(warm.read(sharded.POINT, sharded.MARGINS, 0, 90), whole.read(sharded.POINT, sharded.MARGINS, 0, 90), atol=1e-3)


def test_packed_pairs_are_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(sharded, "PACK_ENTRIES", 40)
    monkeypatch.setattr(sharded, "BLOCK_BITS", 3)
    rnd = random.Random(1)
    rows = [(i + (5 << 33), [rnd.choice(WORDS) for _ in range(rnd.randint(0, 12))]) for i in range(60)]
    rows += [(70, WORDS * 9), (71, []), (72, None), ((7 << 33) + 9, ["x"])]
    got = sharded.pack(spark.createDataFrame(rows, "row long, tokens array<string>").repartition(2)).collect()
    pairs = [((r.block << 3) + int(p), r.term) for r in got for p in np.frombuffer(r.rows, "<u2")]
    assert sorted(pairs) == sorted((i, t) for i, tokens in rows for t in set(tokens or []))
    assert sharded.pack(spark.createDataFrame([(1, [])], "row long, tokens array<string>")).isEmpty()


def test_scores_are_those_of_a_plain_sum(spark):
    lexicon = spark.createDataFrame([("cat",), ("dog",), ("man",)], "form string")
    weights = {"cat": (0, 1.5, [1.0, -1.0]), "dog": (1, 2.0, [-3.0, 3.0]), "man": (2, 1.0, [0.1, 0.2])}
    terms = spark.createDataFrame([(t, 1, *v) for t, v in weights.items()], "term string, df long, idx long, idf double, w array<double>")
    classes = spark.createDataFrame([("one", 0, 0.5), ("two", 1, 0.4)], "label string, label_idx long, intercept double")
    model = sharded.ShardedModel(terms, classes, lexicon)
    texts = ["cats cat zebra", "cat", "dogs men", "dog cats cats", "zebra", "", None, "man men cat"] * 2
    # the terms of each text: several forms of a lemma count once
    bags = [["cat"], ["cat"], ["dog", "man"], ["dog", "cat"], [], [], [], ["man", "cat"]] * 2
    want = []
    for bag in bags:
        norm = sum(weights[t][1] ** 2 for t in bag) ** 0.5 or 1.0
        z = [b + sum(weights[t][1] * weights[t][2][j] for t in bag) / norm for j, b in enumerate((0.5, 0.4))]
        want.append(["one", "two"][int(np.argmax(z))])
    df = spark.createDataFrame([(i // 2, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n int")
    got = model.score(df)
    assert got.columns == ["doc_id", "text", "n", "content", "prediction_label"]
    assert [r.prediction_label for r in got.orderBy("n").collect()] == want
    bare = model.score(df, content=False)
    assert bare.columns == ["doc_id", "n", "prediction_label"]
    assert [r.prediction_label for r in bare.orderBy("n").collect()] == want


def test_grid_search_equals_spark_ml_folds_without_fitting_them(spark, monkeypatch):
    docs, cfg, folds, grid = _docs(spark), TrainConfig(tol=1e-9, max_iter=100), 2, (0.1, 10.0)
    trn, _ = M.prepared(docs, cfg)
    stages = M.fit_features(trn, cfg)
    feats = M.feature_frame(trn.withColumn("fold", tuning.fold_of("doc_id", folds)), stages, ["tf", "fold"])
    want = tuning.cross_validate(feats.select("tf", "_label_idx", "fold"), cfg, grid, folds)
    n = trn.count()
    monkeypatch.setattr("pyspark.ml.classification.LogisticRegression.fit", None)
    monkeypatch.setattr("pyspark.ml.feature.CountVectorizer.fit", None)
    res, best = tuning.grid_search(docs, cfg, grid, folds)
    rows = res.orderBy("multiplier").collect()
    assert np.allclose([(r.multiplier, r.reg_param) for r in rows], [(m, m / n) for m in grid], rtol=1e-12)
    assert np.allclose([r.cv_accuracy for r in rows], want, atol=0.04)
    assert best.labels() == ["p", "q", "r"] and best.terms.count() == len(stages[0].vocabulary)


def test_staged_tables_leave_no_shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        it, n = blocks.getAllBlocks().iterator(), 0
        while it.hasNext():
            n += it.next().name().startswith("shuffle_")
        return n

    before = shuffles()
    got = stage(spark.range(1000).repartition(5, F.col("id")), "test")
    end = time.time() + 20
    while shuffles() > before and time.time() < end:
        time.sleep(0.5)
    assert shuffles() <= before and got.count() == 1000
