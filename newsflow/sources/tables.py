"""Readers for the input tables (parquet, one folder or file per table)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(base, name))


#: Partitions that text tables are dealt into before cleaning; unset, the scan's own splits stay.
SPREAD_KEY = "spark.newsflow.spread"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows into ``partitions``, or as many as the session's ``spark.newsflow.spread``.

    Text cleaning costs CPU per row, and a table stored as one row group scans
    in a single task. Only the caller or the session asks for this shuffle;
    with neither, which is right for naturally split tables, the scan is left
    as it is, at every size.
    """
    partitions = partitions or int(df.sparkSession.conf.get(SPREAD_KEY, "0"))
    return df.repartition(partitions) if partitions else df


def documents(spark: SparkSession, base: str) -> DataFrame:
    """The text table, spread for per-row cleaning work if the session asks for it."""
    return spread(read_table(spark, base, "documents"))


def read_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A stored table, or None if it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def delete_folders(spark: SparkSession, path: str, chosen: Callable[[str], bool]) -> None:
    """Delete the folders below ``path`` whose names are ``chosen``, in any store Spark writes to."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(top):
        for found in fs.listStatus(top):
            if found.isDirectory() and chosen(found.getPath().getName()):
                fs.delete(found.getPath(), True)
