"""Long-form linear scoring (C3) and per-group top-k.

A linear model applied as a sparse dot product: features (key, term, x) are
joined to one row a term, which holds an array of a weight a class, and summed
into one number a class and key. A key with no known term keeps the default
class. The number of classes is that of the label table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.session import materialize


def class_centroids(weights: DataFrame, label: str, classes: list, counts: list[int]) -> DataFrame:
    """(term, w): the mean weight of a term in each of ``classes``, over ``counts`` keys a class.

    ``weights``: (key, label, term, weight); a term's row holds a number a class."""
    return weights.groupBy("term").agg(F.array(*[
        F.coalesce(F.sum(F.when(F.col(label) == c, F.col("weight"))), F.lit(0.0)) / F.lit(float(n))
        for c, n in zip(classes, counts)]).alias("w"))


def vector_scores(features: DataFrame, per_term: DataFrame, key: str, k: int, weight: str = "weight",
                  unit: bool = False) -> DataFrame:
    """(key, scores): for each of ``k`` classes the sum over shared terms of ``weight`` * w.

    ``per_term``: (term, w array). One row a document and term goes to the sums,
    which are combined before the shuffle. With ``unit`` the document's weights
    count as if scaled to length 1. ``per_term`` is staged, so that the join can
    split a hot term's rows."""
    x = F.col(weight)
    sums = [F.sum(x * F.get("w", F.lit(i))).alias(f"_s{i}") for i in range(k)]
    got = features.join(materialize(per_term), "term").groupBy(key).agg(*sums, F.sqrt(F.sum(x * x)).alias("_n"))
    by = F.col("_n") if unit else F.lit(1.0)
    return got.select(key, F.array(*[F.col(f"_s{i}") / by for i in range(k)]).alias("scores"))


def best_class(scores: DataFrame, keys: DataFrame, key: str, classes: list, intercepts: list[float] | None = None,
               default: Column | None = None) -> DataFrame:
    """(key, prediction) for every row of ``keys``: the class of the largest score, the
    first of ``classes`` on ties. Keys without a score get ``default``, or the
    class that the intercepts alone give."""
    free = intercepts or [0.0] * len(classes)
    named = F.array(*[F.lit(c) for c in classes])
    total = F.array(*[F.get("scores", F.lit(i)) + F.lit(float(b)) for i, b in enumerate(free)])
    best = scores.select(key, F.element_at(named, F.array_position(total, F.array_max(total)).cast("int"))
                         .alias("prediction"))
    if default is None:
        default = F.lit(classes[free.index(max(free))])
    return keys.select(key).join(best, key, "left").select(key, F.coalesce("prediction", default).alias("prediction"))


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int,
                    salt_col: str, buckets: int = 64) -> DataFrame:
    """Top ``k`` rows per group by ``order``, safe for a group with a third of all rows.

    Stage 1 ranks inside (group, hash(salt_col) % buckets) sub-groups and keeps
    k each; stage 2 ranks the at most buckets * k survivors per group.
    """
    sub = F.pmod(F.xxhash64(salt_col), F.lit(buckets))
    w1 = Window.partitionBy(group, "_b").orderBy(*order)
    stage1 = (df.withColumn("_b", sub).withColumn("_r", F.row_number().over(w1))
              .where(F.col("_r") <= k).drop("_b", "_r"))
    w2 = Window.partitionBy(group).orderBy(*order)
    return stage1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)
