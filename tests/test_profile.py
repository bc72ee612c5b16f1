"""Profiling checks on small frames with known answers."""

import random

import numpy as np

from newsflow.operators import profile as P


def test_null_dup_shape(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, 3.0), (3, "b", 4.0)],
                               "k int, s string, v double")
    nulls = {r.column_name: r.n_null for r in P.null_counts(df).collect()}
    assert nulls == {"k": 0, "s": 1, "v": 2}
    assert P.dup_count(df).first().n_duplicates == 1          # null-safe row equality
    assert P.dup_count(P.drop_dups(df)).first().n_duplicates == 0
    assert P.drop_nulls(df).count() == 1
    sh = P.shape(df).first()
    assert (sh.n_rows, sh.n_cols) == (4, 3)
    info = {r.column_name: (r.dtype, r.non_null) for r in P.column_info(df).collect()}
    assert info == {"k": ("int", 4), "s": ("string", 3), "v": ("double", 2)}
    kinds = {r.column_name: r.kind for r in P.column_kinds(df).collect()}
    assert kinds == {"k": "numeric", "s": "categorical", "v": "numeric"}
    nu = {r.column_name: r.n_unique for r in P.nunique(df).collect()}
    assert nu == {"k": 3, "s": 2, "v": 2}


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(3)
    vals = [float(rnd.choice([1, 2, 2, 3, 7, 7, 7])) for _ in range(500)] + \
           [rnd.uniform(-5, 50) for _ in range(777)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.prob: r.quantile for r in P.exact_quantiles(df, "x", probs, n_ranges=5).collect()}
    for p in probs:
        assert abs(got[p] - float(np.quantile(vals, p))) < 1e-9


def test_describe_text_top_ties_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    r = P.describe_text(df, ["s"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)
