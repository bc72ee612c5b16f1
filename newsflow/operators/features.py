"""Split, vocabulary, smoothed IDF, L2-normalised TF-IDF, label index (M1-M6).

Long form: one row per (document, term). After de-duplication a term occurs
at most once per document, so term frequency is 1 and the TF-IDF weight of a
term is ``idf / sqrt(sum of idf^2 over the document's terms)``.

Joins against the vocabulary are plain equi-joins: AQE turns them into a
broadcast join when the vocabulary measured at run time is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps a
sort-merge join whose hot-term partitions it splits (skew join).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions import text as T
from newsflow.operators.lemma import ROW_ID, with_row_ids
from newsflow.session import materialize


def split_threshold(fraction: float) -> str:
    """Hex prefix bound so that md5-prefix < bound holds for ``fraction`` of keys."""
    return format(min(int(fraction * 2 ** 32), 2 ** 32 - 1), "08x")


def is_test(key: str | Column, seed: int = 42, test_fraction: float = 0.2) -> Column:
    """M1: deterministic hash split, stable under re-partitioning and re-runs."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"))), 1, 8)
    # a null key belongs to the training side
    return F.coalesce(h < F.lit(split_threshold(test_fraction)), F.lit(False))


def train_test_split(df: DataFrame, key: str, seed: int = 42, test_fraction: float = 0.2):
    """M1: (train, test) frames."""
    flag = is_test(key, seed, test_fraction)
    return df.where(~flag), df.where(flag)


def exact_split(df: DataFrame, key: str, seed: int = 42, test_fraction: float = 0.2):
    """M1 with an exact size: (train, test) frames, ``ceil(test_fraction * rows)`` rows in the test.

    Rows are in the order of the hash of their key; the hash of a whole row and
    then a row's place tell rows of one key apart, so that also among copies
    exactly as many are taken as are needed. Null keys come last. One narrow
    sort by ranges finds the last row of the test side, and a comparison with
    it is the split.
    """
    rows = with_row_ids(df)
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    order = {"_h": F.coalesce(h, F.lit("g")), "_c": F.xxhash64(*df.columns), "_i": F.col(ROW_ID)}   # g: after all digits
    size = math.ceil(round(test_fraction * rows.count(), 9))
    place = rows.select(*[c.alias(n) for n, c in order.items()])
    last = numbered(place, "_h", "_c", "_i").where(F.col("idx") == size - 1).first() if size else None
    flag = F.lit(False)
    if last:
        flag = (F.struct(*[c.alias(n) for n, c in order.items()])
                <= F.struct(*[F.lit(last[n]).cast(t).alias(n) for n, t in place.dtypes]))
    return rows.where(~flag).drop(ROW_ID), rows.where(flag).drop(ROW_ID)


def numbered(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``idx``, the place of each row (from 0) in the given order.

    Rows are dealt by ranges of the order and counted within their range; the
    ranges' sizes, one row a task, give the number before each. Ties are in any order.
    """
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_at")).alias("idx"))


def doc_terms(df: DataFrame, key: str, tokens: str = "tokens", keep: tuple = ()) -> DataFrame:
    """(key, term): distinct tokens of two or more characters, long form; ``keep`` columns go along."""
    return df.select(key, *keep, F.explode(F.array_distinct(T.terms(tokens))).alias("term"))


def vocabulary(terms_long: DataFrame, key: str, min_df: int = 1) -> DataFrame:
    """M2: (term, df) = number of documents containing the term.

    ``terms_long`` holds each (key, term) once, so a row count is the document
    frequency (partial counts are combined map-side; hot terms stay cheap).
    """
    v = terms_long.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return v.where(F.col("df") >= min_df) if min_df > 1 else v


def vocabulary_index(vocab: DataFrame) -> DataFrame:
    """M2: ``vocab`` (term, df) with ``idx``, from 0 by falling df and then by term, as a table:
    the same numbers however it is partitioned, and no vocabulary on the driver."""
    return numbered(vocab, F.desc("df"), F.asc("term"))


def idf_table(vocab: DataFrame, n_docs: Column | int) -> DataFrame:
    """M3: smoothed idf = ln((1 + n) / (1 + df)) + 1."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return vocab.withColumn("idf", F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0)


def idf_from_docs(train: DataFrame, key: str, tokens: str = "tokens", min_df: int = 1) -> DataFrame:
    """M2 + M3 from a cleaned frame; n counts every training document."""
    n = train.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    return idf_table(vocabulary(doc_terms(train, key, tokens), key, min_df), n)


def tfidf(terms_long: DataFrame, idf: DataFrame, key: str, keep: tuple = ()) -> DataFrame:
    """M4 + M5: (key, term, weight), L2-normalised per document; unknown terms dropped.

    The vocabulary is staged, so both sides of the join have an exchange of
    their own and a hot term's rows can be split. ``keep`` columns of either side go along."""
    idf = materialize(idf)
    j = terms_long.join(idf.select("term", "idf", *[c for c in keep if c in idf.columns]), "term")
    norm = F.sqrt(F.sum(F.col("idf") * F.col("idf")).over(Window.partitionBy(key)))
    return j.select(key, *keep, "term", (F.col("idf") / norm).alias("weight"))


def label_index(df: DataFrame, label: str) -> DataFrame:
    """M6: classes in alphabetical order -> 0..K-1 (the model's class order).

    The distinct label set is tiny (one row per class), so the ordering window
    runs on a few rows after a partial-aggregated distinct.
    """
    d = df.select(label).where(F.col(label).isNotNull()).distinct()
    return d.select(label, (F.row_number().over(Window.orderBy(label)) - 1)
                    .cast("bigint").alias("label_idx"))
