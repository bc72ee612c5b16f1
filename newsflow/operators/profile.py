"""Data profiling (P1-P12): long-form check tables over any DataFrame.

Each check is one aggregation job (or a small union of them); results are
long tables ``(column, ...)`` so they stay narrow however wide the input is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, FractionalType, NumericType, StringType

from newsflow.session import materialize


def _lit_col(name: str):
    return F.lit(name).alias("column_name")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, one aggregation pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "n_null")


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a missing value (in ``subset`` or any column)."""
    return df.dropna(how="any", subset=subset)


def dup_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row (null-safe, like pandas).

    Grouping on all columns pre-aggregates map-side, so a value repeated in a
    third of the table costs one partial row per task before the shuffle.
    """
    g = df.groupBy(*df.columns).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def drop_dups(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep one row per distinct row (or per ``subset`` key)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def column_info(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) from the schema plus one count pass."""
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column_name", "non_null")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    mapping = F.create_map(*[x for k, v in types.items() for x in (F.lit(k), F.lit(v))])
    return long.select("column_name", mapping[F.col("column_name")].alias("dtype"), "non_null")


def nunique(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (``approx`` uses HyperLogLog++).

    Exact counts compare SHA-256 digests of strings, so no text is shuffled.
    """
    if approx:
        wide = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in df.columns])
        return wide.unpivot([], df.columns, "column_name", "n_unique")

    def short(f):
        if isinstance(f.dataType, (StringType, BinaryType)):
            return F.sha2(F.col(f.name).cast("binary"), 256)
        # 0.0 and -0.0 are one value
        return (F.col(f.name) + F.lit(0.0) if isinstance(f.dataType, FractionalType) else F.col(f.name)).cast("string")

    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), short(f).alias("value")) for f in df.schema.fields]))
        .alias("c")).select("c.*")
    counts = cells.where("value IS NOT NULL").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    return names.join(counts, "column_name", "left").select(
        "column_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_unique"))


def column_kinds(df: DataFrame) -> DataFrame:
    """P10: numeric vs categorical columns, from the schema alone."""
    kinds = [(f.name, "numeric" if isinstance(f.dataType, NumericType) else "categorical") for f in df.schema.fields]
    return df.sparkSession.createDataFrame(kinds, "column_name string, kind string")


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts, and the columns by name."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
                  F.lit(", ".join(df.columns)).alias("columns"))


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value as string) for every non-null cell of ``cols``, one scan."""
    return (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("cv")).select("cv.*"))


def distinct_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct values of each column, long form (value as string), one scan."""
    return _long_values(df, columns or df.columns).distinct()


# --- P8 summary statistics ----------------------------------------------------
def exact_quantiles_multi(df: DataFrame, columns: list[str], probs: list[float],
                          n_ranges: int | None = None) -> DataFrame:
    """Exact linearly-interpolated quantiles of several columns in one pass.

    1. (column, value) counts (partial aggregation: heavy repeats collapse);
    2. range-partition by (column, value) and total each range (tiny table);
    3. running count inside each range plus the range's offset within its
       column gives every distinct value its rank interval;
    4. the values at ranks floor(h) and ceil(h), h = (n-1)p, are picked by an
       equi-join on the column plus a rank-interval filter, and interpolated.
    No step sorts all values in one task. Returns (column_name, prob, quantile).
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
        for c in columns])).alias("cv")).select("cv.*").where(F.col("v").isNotNull())
    vals = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c"))
    # materialise once: range bounds come from a sample, so every later use
    # must see the same range ids (checkpoint also cuts the lineage)
    # without an explicit count AQE may merge adjacent ranges, keeping their order
    by_range = (vals.repartitionByRange(n_ranges, "column_name", "v") if n_ranges
                else vals.repartitionByRange("column_name", "v"))
    ranged = materialize(by_range.withColumn("rid", F.spark_partition_id()))
    totals = ranged.groupBy("column_name", "rid").agg(F.sum("c").alias("rc"))
    wc = Window.partitionBy("column_name")
    offsets = totals.select(
        "column_name", "rid",
        F.sum("rc").over(wc.orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)).alias("off"),
        F.sum("rc").over(wc).alias("n"))
    w = Window.partitionBy("column_name", "rid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cum = (ranged.withColumn("hi", F.sum("c").over(w))
           .join(F.broadcast(offsets), ["column_name", "rid"])  # one row per range
           .select("column_name", "v",
                   (F.coalesce("off", F.lit(0)) + F.col("hi") - F.col("c")).alias("lo_rank"),
                   (F.coalesce("off", F.lit(0)) + F.col("hi")).alias("hi_rank")))
    tg = (offsets.groupBy("column_name").agg(F.max("n").alias("n"))
          .select("column_name", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"),
                  "n")
          .select("column_name", "prob", ((F.col("n") - 1) * F.col("prob")).alias("h"))
          .select("column_name", "prob", "h", F.floor("h").alias("k1"), F.ceil("h").alias("k2")))

    # the values at 0-based ranks k1 and k2 (the same or neighbours), in one pass over the
    # running counts; the targets are columns x probabilities rows
    def at(k):
        return F.max(F.when((F.col("lo_rank") <= F.col(k)) & (F.col(k) < F.col("hi_rank")), F.col("v"))).alias(f"v_{k}")

    found = (cum.join(F.broadcast(tg), "column_name")
             .where((F.col("lo_rank") <= F.col("k2")) & (F.col("k1") < F.col("hi_rank")))
             .groupBy("column_name", "prob", "h").agg(at("k1"), at("k2")))
    return found.select("column_name", "prob",
                        (F.col("v_k1") + (F.col("h") - F.floor("h")) * (F.col("v_k2") - F.col("v_k1")))
                        .alias("quantile"))


def exact_quantiles(df: DataFrame, column: str, probs: list[float],
                    n_ranges: int | None = None) -> DataFrame:
    """(prob, quantile) of one column; see ``exact_quantiles_multi``."""
    return exact_quantiles_multi(df, [column], probs, n_ranges).select("prob", "quantile")


def describe_numeric(df: DataFrame, columns: list[str] | None = None,
                     digits: int = 6) -> DataFrame:
    """P8 (numeric): count, mean, std (sample), min, 25%, 50%, 75%, max.

    Long form (column, stat, value): all moments in one aggregation pass, all
    quantiles in one ``exact_quantiles_multi`` pass.
    """
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    stats = ("count", "mean", "std", "min", "max")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}|count"), F.avg(x).alias(f"{c}|mean"),
                 F.stddev_samp(x).alias(f"{c}|std"), F.min(x).alias(f"{c}|min"),
                 F.max(x).alias(f"{c}|max")]
    wide = df.agg(*aggs)
    moments = (wide.unpivot([], [f"`{c}|{s}`" for c in cols for s in stats], "key", "value")
               .select(F.split("key", r"\|").getItem(0).alias("column_name"),
                       F.split("key", r"\|").getItem(1).alias("stat"), "value"))
    q = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75])
    quant = q.select("column_name",
                     F.concat((F.col("prob") * 100).cast("int").cast("string"), F.lit("%")).alias("stat"),
                     F.col("quantile").alias("value"))
    return moments.unionByName(quant).withColumn("value", F.round("value", digits))


def describe_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """P8 (object columns): count, unique, top (most frequent, ties -> smallest), freq.

    One scan: (column, value) counts, then one small aggregation per column.
    """
    cols = columns or [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]
    vc = (_long_values(df, cols).where(F.col("value").isNotNull())
          .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    return vc.groupBy("column_name").agg(
        F.sum("n").cast("bigint").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))
