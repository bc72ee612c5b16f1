"""TF-IDF against the textbook formula; split stability; metric identities."""

import math

from newsflow.operators import features as FT
from newsflow.operators import metrics as M


def test_tfidf_formula(spark):
    docs = {1: ["apple", "banana"], 2: ["apple", "cherry", "date"], 3: ["banana", "x"], 4: []}
    df = spark.createDataFrame(list(docs.items()), "doc_id int, tokens array<string>")
    idf = FT.idf_from_docs(df, "doc_id")
    got = {(r.doc_id, r.term): r.weight for r in FT.tfidf(FT.doc_terms(df, "doc_id"), idf, "doc_id").collect()}
    n = len(docs)
    dfreq = {}
    for toks in docs.values():
        for t in set(t for t in toks if len(t) >= 2):
            dfreq[t] = dfreq.get(t, 0) + 1
    want = {}
    for d, toks in docs.items():
        terms = [t for t in set(toks) if len(t) >= 2]
        w = {t: math.log((1 + n) / (1 + dfreq[t])) + 1 for t in terms}
        norm = math.sqrt(sum(v * v for v in w.values()))
        want.update({(d, t): v / norm for t, v in w.items()})
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_hash_split_stable_and_sized(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = df.where(FT.is_test("k")).select("k")
    b = df.repartition(13).where(FT.is_test("k")).select("k")
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())
    assert abs(a.count() / 20000 - 0.2) < 0.02


def test_metric_identities(spark):
    rows = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] * 1
    df = spark.createDataFrame(rows, "label string, prediction string")
    cm = M.confusion_matrix(df).collect()
    assert len(cm) == 9 and sum(r.n for r in cm) == len(rows)
    acc = M.accuracy(df).first().accuracy
    rep = {r.class_name: r for r in M.classification_report(df).collect()}
    assert abs(rep["weighted avg"].recall - acc) < 1e-6
    assert abs(rep["accuracy"].f1 - acc) < 1e-6
    assert rep["c"].precision == 0.0 and rep["c"].recall == 0.0 and rep["c"].f1 == 0.0
    assert abs(rep["a"].precision - 5 / 6) < 1e-6 and abs(rep["a"].recall - 5 / 7) < 1e-6
