"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations.

A source's rate is its target over its size, both in words. Every document is
taken whole as often as the rate's whole part says; for the rest, documents
are ranked by Pareto's order, the random odds of a document over the odds of
its inclusion, and taken from the least rank on until the words the source
still lacks are filled. A document that no longer fits is passed over and
smaller ones behind it are tried, in a few rounds, so that a source comes near
its target even where one document is a large share of it.

Ranks are never sorted as a whole: words are summed by source and slice of the
rank, and only documents of the slice where the target falls are ordered, so a
source with a third of all documents is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import stage

#: Weights of the sources in the order of their code points, in turn.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this on average, no document more often.
MOST = 3
#: Slices of the rank; the slice with the target is cut once more.
SLICES = 1 << 12
ROUNDS = 3


def sizes(text: Column) -> Column:
    """Number of words of a text: runs without blank, tab, line and page ends."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(by_source: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, bear ``weights`` in turn and share the
    sum of all sizes by them; a target stops at ``most`` times its source's
    size, and what it leaves is shared again until none is above. With sources
    in the order of the level at which they stop, that level is found in one
    pass. The table has one row a source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    s = by_source.withColumn("w", w).withColumn("cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, behind = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(Window.partitionBy())
                               - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(behind))
    # caps fill in this order; the first source whose cap is not reached sets the level
    s = s.withColumn("open", F.col("level") <= F.col("cap") / F.col("w"))
    s = s.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), "level")))
                     .over(Window.partitionBy())["level"])
    return s.select("source", "source_size", F.coalesce(
        F.least(F.col("cap"), F.col("level") * F.col("w")), F.col("cap")).alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from a key and a seed, the same in every run and engine."""
    hexes = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
                              .cast("binary")), 1, 13)
    return (F.conv(hexes, 16, 10).cast("double") + 0.5) / float(1 << 52)


def _edge(pool: DataFrame, by: list[str], slice_: Column, start: Column) -> DataFrame:
    """For each source the slice in which the running words pass its lack:
    (*by, edge, begin), edge null where all slices fit."""
    words = (pool.withColumn("slice", slice_).groupBy(*by, "slice")
             .agg(F.sum("size").alias("n"), F.first("lack").alias("lack"), F.first(start).alias("start")))
    upto = F.col("start") + F.sum("n").over(Window.partitionBy(*by).orderBy("slice"))
    over = F.when(F.col("upto") > F.col("lack"), F.struct("slice", (F.col("upto") - F.col("n")).alias("begin")))
    found = words.withColumn("upto", upto).groupBy(*by).agg(F.min(over).alias("e"))
    return stage(found.select(*by, F.col("e.slice").alias("edge"), F.col("e.begin").alias("begin")), "edge")


def _fill(rows: DataFrame) -> DataFrame:
    """One round: rows (k, p, doc_id, h, size, lack, open, extra) with ``extra`` set on
    those that are taken in the order of p while their words stay within the lack."""
    slice1 = F.floor(F.col("p") * SLICES)
    slice2 = F.floor((F.col("p") * SLICES - slice1) * SLICES)
    fits = F.col("open") & (F.col("size") <= F.col("lack"))
    one = _edge(rows.where(fits), ["k"], slice1, F.lit(0).cast("long")).toDF("k", "edge1", "begin1")
    rows = rows.join(one, "k", "left")
    two = _edge(rows.where(fits & (slice1 == F.col("edge1"))), ["k"], slice2, F.col("begin1"))
    rows = rows.join(two.toDF("k", "edge2", "begin2"), "k", "left")
    sure = fits & (F.col("edge1").isNull() | (slice1 < F.col("edge1"))
                   | ((slice1 == F.col("edge1")) & (F.col("edge2").isNull() | (slice2 < F.col("edge2")))))
    last = F.coalesce(fits & (slice1 == F.col("edge1")) & (slice2 == F.col("edge2")), F.lit(False))
    # the last slice holds one document in 16 million
    upto = F.col("begin2") + F.sum("size").over(Window.partitionBy("k").orderBy("p", "doc_id", "h")
                                                .rowsBetween(Window.unboundedPreceding, 0))
    names = ["doc_id", "h", "k", "size", "source_size", "target", "whole", "p"]
    keep = [*names, "open", "extra", "lack"]
    easy = rows.where(~last).withColumn("extra", F.col("extra") | F.coalesce(sure, F.lit(False)))
    hard = rows.where(last).withColumn("extra", upto <= F.col("lack"))
    done = stage(easy.select(*keep).union(hard.select(*keep)), "round")
    got = stage(done.where("open AND extra").groupBy("k").agg(F.sum("size").alias("got")), "got")
    left = (F.col("lack") - F.coalesce(F.col("got"), F.lit(0))).alias("lack")
    return done.join(got, "k", "left").select(*names, (F.col("open") & ~F.col("extra")).alias("open"), "extra", left)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, most: int = MOST, seed: int = 8, weight: str | None = None) -> DataFrame:
    """(doc_id, h, size, source_size, target, taken, copies), one row per row of ``docs``.

    ``weight`` names a column of positive numbers that a document's expected
    copies within its source are in proportion to; without it (and where it is
    null) they are equal. ``h`` is a hash of the text, which with the key names
    a row. A null or blank text has size 0 and nothing taken, a null source is
    a source of its own, null keys are ranked by ``h``, and repeated rows are
    interchangeable. Ranks come from a hash of seed and key, so reruns agree.
    """
    h = F.xxhash64(F.col(text))
    base = stage(docs.select(
        F.col(key).alias("doc_id"), h.alias("h"), sizes(F.col(text)).alias("size"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("v"), F.col(source).cast("string")), F.lit("n")).alias("k"),
        F.coalesce(F.col(weight).cast("double") if weight else F.lit(1.0), F.lit(1.0)).alias("w")), "sizes")
    by_source = base.groupBy("k", "source").agg(F.sum("size").alias("source_size"),
                                                F.sum(F.col("size") * F.col("w")).alias("weighed"))
    by_source = stage(by_source, "sources")
    goal = stage(targets(by_source.select("source", "source_size"), weights, most).withColumn(
        "k", F.coalesce(F.concat(F.lit("v"), "source"), F.lit("n"))).drop("source", "source_size"), "targets")
    goal = by_source.select("k", "source_size", "weighed").join(goal, "k")
    copies = F.when(F.col("weighed") > 0, F.least(F.lit(float(most)), F.col("target") * F.col("w") / F.col("weighed")))
    rows = base.join(goal, "k").withColumn("e", F.coalesce(copies, F.lit(0.0)))
    rows = rows.withColumn("whole", F.floor("e")).withColumn("odds", F.col("e") - F.col("whole"))
    u = uniform(F.coalesce(F.col("doc_id"), F.col("h")), seed)
    q = u / (1 - u) / (F.col("odds") / (1 - F.col("odds")))
    rows = (rows.withColumn("open", (F.col("odds") > 0) & (F.col("size") > 0))
            .withColumn("p", F.when(F.col("open"), q / (1 + q)))
            .select("doc_id", "h", "k", "size", "source_size", "target", "whole", "p", "open"))
    rows = stage(rows, "ranked")
    sure = stage(rows.groupBy("k").agg(F.first("target").alias("t"),
                                       F.sum(F.col("whole") * F.col("size")).alias("n")), "sure")
    sure = sure.select("k", F.floor(F.round(F.col("t") - F.col("n"), 6)).alias("lack"))
    rows = rows.join(sure, "k").withColumn("extra", F.lit(False))
    for _ in range(ROUNDS):
        rows = _fill(rows)
    n = F.col("whole") + F.col("extra").cast("int")
    return rows.select("doc_id", "h", "size", "source_size", F.round("target", 6).alias("target"),
                       (n * F.col("size")).alias("taken"), n.alias("copies"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns unchanged."""
    picked = mix(docs, key, text, **how).groupBy("doc_id", "h").agg(
        F.count("*").alias("c"), F.sum("copies").alias("n")).where("n > 0")
    picked = picked.select(F.col("doc_id").alias("_k"), F.col("h").alias("_h"), "c", "n")
    names = docs.columns
    own = docs.select(F.struct(*names).alias("_row"), F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_own"))
    got = own.join(picked, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_own") == F.col("_h")))
    # of c equal rows the first n mod c are taken once more than the others
    one = got.where("c = 1").withColumn("_r", F.lit(0))
    more = got.where("c > 1").withColumn("_r", F.row_number().over(
        Window.partitionBy("_k", "_h").orderBy("_own")) - 1)
    both = one.unionByName(more)
    times = F.floor(F.col("n") / F.col("c")) + (F.col("_r") < F.col("n") % F.col("c")).cast("int")
    return (both.withColumn("_t", times.cast("int")).where("_t > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_t")))).select("_row.*"))
