"""The solver with coefficients dealt out by term ranges, against the optimum and Spark ML."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF0001
from newsflow.plans import sharded
from newsflow.plans.model import TrainConfig, train
from newsflow.sources.tables import documents


def _problem(spark, n=150, terms=60, classes=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, terms)) * (rng.random((n, terms)) < 0.15)
    x[7] = 0   # a row without an entry
    x[:, 5] = 0   # a term that no row holds
    y = (x @ rng.normal(size=(terms, classes)) + rng.normal(size=(n, classes))).argmax(1)
    ids = [i + ((1 << 33) if i % 3 else 0) for i in range(n)]   # rows of two partitions
    long = spark.createDataFrame([(ids[i], int(j), float(x[i, j])) for i, j in zip(*x.nonzero())],
                                 "row long, idx long, value double")
    labels = spark.createDataFrame([(ids[i], int(c)) for i, c in enumerate(y)], "row long, label_idx long")
    return x, y, long, labels


def _objective(x, y, w, b, reg):
    z = x @ w.T + b
    z -= z.max(axis=1, keepdims=True)
    logp = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    p = np.exp(logp) - np.eye(w.shape[0])[y]
    return -logp[np.arange(len(y)), y].mean() + reg / 2 * (w ** 2).sum(), p.T @ x / len(y) + reg * w, p.mean(axis=0)


def test_solution_is_the_optimum(spark, monkeypatch):
    # many blocks and ranges
    monkeypatch.setattr(sharded, "BLOCK_BITS", 5)
    monkeypatch.setattr(sharded, "RANGE_BITS", 4)
    x, y, long, labels = _problem(spark)
    reg = 1 / len(y)
    got = sharded.solve(long.repartition(3), labels, 3, x.shape[1], reg, tol=1e-8, max_iter=30)
    w = np.zeros((3, x.shape[1]))
    rows = got.coefficients.collect()
    assert sorted(r["idx"] for r in rows) == list(range(x.shape[1]))
    for r in rows:
        w[:, r["idx"]] = r["w"]
    loss, gw, gb = _objective(x, y, w, np.array(got.intercepts), reg)
    assert abs(loss - got.losses[-1]) < 1e-9 and got.losses == sorted(got.losses, reverse=True)
    assert max(np.abs(gw).max(), np.abs(gb).max()) < 5e-4
    assert not w[:, 5].any()
    feats = spark.createDataFrame([(float(c), Vectors.dense(v)) for v, c in zip(x, y)], ["label", "features"])
    ml = LogisticRegression(regParam=reg, standardization=False, tol=1e-10, maxIter=500, family="multinomial").fit(feats)
    assert loss < _objective(x, y, ml.coefficientMatrix.toArray(), ml.interceptVector.toArray(), reg)[0] + 1e-5


def test_rows_solver_finds_the_optimum(spark, monkeypatch):
    # many parts, and many blocks of sums
    monkeypatch.setattr(sharded, "PART_ENTRIES", 50)
    monkeypatch.setattr(sharded, "SUM_ROWS", 32)
    x, y, long, labels = _problem(spark)
    reg = 1 / len(y)
    got = sharded.solve_rows(long.repartition(3), labels, 3, reg, tol=1e-10, max_iter=200)
    w = np.zeros((3, x.shape[1]))
    rows = got.coefficients.collect()
    assert sorted(r["idx"] for r in rows) == sorted(np.flatnonzero(x.any(axis=0)))
    for r in rows:
        w[:, r["idx"]] = r["w"]
    loss, gw, gb = _objective(x, y, w, np.array(got.intercepts), reg)
    assert abs(loss - got.losses[-1]) < 1e-9 and got.losses == sorted(got.losses, reverse=True)
    assert max(np.abs(gw).max(), np.abs(gb).max()) < 1e-4


def test_terms_solver_equals_the_rows_solver(spark, monkeypatch):
    # pairs that come twice count once, and no vocabulary is joined to them
    monkeypatch.setattr(sharded, "PART_ENTRIES", 50)
    x, y, long, labels = _problem(spark)
    reg, n = 1 / len(y), len(y)
    pairs = long.select("row", F.format_string("t%02d", "idx").alias("term"))
    df = {f"t{j:02d}": int(c) for j, c in enumerate((x > 0).sum(axis=0)) if c >= 20}
    assert 0 < len(df) < (x > 0).any(axis=0).sum()
    got = sharded.solve_terms(pairs.union(pairs.where("row % 2 = 0")).repartition(4), labels, 3, n, reg, tol=1e-9, max_iter=60, min_df=20)
    rows = {r["term"]: r for r in got.coefficients.collect()}
    assert {t: r["df"] for t, r in rows.items()} == df
    idf = spark.createDataFrame([(int(t[1:]), float(np.log((1 + n) / (1 + c)) + 1)) for t, c in df.items()], "idx long, idf double")
    entries = long.join(idf, "idx").select("row", "idx", F.col("idf").alias("value"))
    want = sharded.solve_rows(entries, labels, 3, reg, tol=1e-9, max_iter=60, unit=True)
    assert abs(got.losses[-1] - want.losses[-1]) < 1e-8
    for r in want.coefficients.collect():
        assert np.allclose(rows[f"t{r['idx']:02d}"]["w"], r["w"], atol=1e-4)


def test_scoring_queries_do_not_score_the_test_split(spark, monkeypatch):
    from newsflow.queries import model as Q
    monkeypatch.setattr(Q, "_MODELS", {})
    monkeypatch.setattr(sharded, "held_out", None)
    assert Q.q_score_batch(spark, SF0001).where("NOT known_class").isEmpty()


def test_queries_fit_no_model_on_the_driver(spark, monkeypatch, scratch):
    from newsflow.queries import model as Q
    monkeypatch.setattr("pyspark.ml.feature.CountVectorizer.fit", None)
    model = Q.trained(spark, SF0001)[0].with_input(["item_id"])
    model.save(f"{scratch}/m")
    model.with_input("other").save(f"{scratch}/m")   # a second version
    assert sharded.ShardedModel.load(spark, f"{scratch}/m").key == "other"
    assert Q.q_train_lr(spark, SF0001).where("NOT known_class").isEmpty()
    assert Q.q_model_roundtrip(spark, SF0001).first()["n_changed"] == 0


def test_two_loops_equal_the_plain_recursion():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(12, 12))
    h = a @ a.T + np.eye(12)
    s = rng.normal(size=(4, 12))
    y, g = s @ h, rng.normal(size=12)
    basis = np.vstack([s, y, g])
    d = np.array(sharded.two_loops(basis @ basis.T, 4)) @ basis
    q, alpha = g.copy(), []
    for si, yi in zip(s[::-1], y[::-1]):
        alpha.append(si @ q / (si @ yi))
        q = q - alpha[-1] * yi
    q = q * (s[-1] @ y[-1]) / (y[-1] @ y[-1])
    for si, yi, al in zip(s, y, alpha[::-1]):
        q = q + si * (al - yi @ q / (si @ yi))
    assert np.allclose(d, -q)


@pytest.fixture(scope="module")
def fitted(spark):
    return sharded.train_sharded(documents(spark, SF0001), TrainConfig(tol=1e-4, max_fit_rows=None))


def test_all_rows_are_fitted_and_all_held_out_rows_scored(spark, fitted, scratch):
    model, preds = fitted
    docs = documents(spark, SF0001)
    # far over a bound of 10 fit rows, on the same driver: the tables hold what the driver does not
    ml, ml_preds = train(docs, TrainConfig(tol=1e-4, max_fit_rows=None))
    a = {r.doc_id: r.prediction for r in preds.collect()}
    b = {r.doc_id: r.prediction for r in ml_preds.collect()}
    assert a.keys() == b.keys()
    assert sum(a[k] == b[k] for k in a) >= 0.9 * len(a)
    assert model.terms.count() == len(ml.pipeline.stages[0].vocabulary)
    model.save(f"{scratch}/m")
    again = sharded.ShardedModel.load(spark, f"{scratch}/m")
    rows = docs.select("doc_id", "text").limit(30).union(
        spark.createDataFrame([(None, None), (1, ""), (1, "zzzqqq")], "doc_id long, text string"))
    one = sorted(model.score(rows).select("doc_id", "content", "prediction_label").collect(), key=repr)
    two = sorted(again.score(rows).select("doc_id", "content", "prediction_label").collect(), key=repr)
    assert one == two and len(one) == 33
    best = max(again.classes.collect(), key=lambda r: r["intercept"])["label"]
    assert {r.prediction_label for r in one if r.content in (None, "", "zzzqqq")} == {best}
