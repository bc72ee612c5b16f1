"""Small pieces that several operators of this package share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from newsflow.sources.tables import read_table
from newsflow.session import stage, staging_path, unstage

__all__ = ["arrow_map", "crc32_of", "digest16", "letters_lower", "read_table",
           "sampled", "stage", "staging_path", "unstage", "utf8"]

#: Bytes A-Z to a-z, all others unchanged.
letters_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null gives no bytes."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def digest16(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def crc32_of(col: Column) -> Column:
    """crc32 of a value written as text."""
    return F.crc32(col.cast("string").cast("binary"))


def arrow_map(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str,
              flush: int = 2048) -> DataFrame:
    """``mapInArrow`` for code that takes and yields tuples.

    ``rows`` gets an iterator over all rows of a task, in order, and may keep
    state between them; results leave in batches of ``flush`` rows.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(fields)

    def run(batches):
        def each():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        kept = []
        for row in rows(each()):
            kept.append(row)
            if len(kept) >= flush:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*kept), arrow)],
                                      schema=arrow)
                kept = []
        if kept:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*kept), arrow)],
                                  schema=arrow)

    return df.mapInArrow(run, fields)


def sampled(rows: DataFrame, n: int) -> list[Row]:
    """At most ``n`` distinct rows of ``rows``, whose column ``r`` is a hash of the key.

    One row of each ``r`` comes first, from the least on, and then the others by a
    hash of the row: copies count once, and a key with many texts takes a
    place of another only when each has one.
    """
    names = [c for c in rows.columns if c != "r"]
    rows = stage(rows.distinct().withColumn("h", F.xxhash64("r", *names)), "sample")
    one = rows.groupBy("r").agg(F.min(F.struct("h", *names)).alias("x"))
    got = one.orderBy("r").limit(n).select("r", "x.*").collect()
    if len(got) < min(n, rows.count()):
        seen = {(x["r"], x["h"]) for x in got}
        others = rows.orderBy("h", "r").limit(n).select("r", "h", *names).collect()
        got += [x for x in others if (x["r"], x["h"]) not in seen][:n - len(got)]
    unstage(rows)
    return got


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")
