"""T13 ``clean_text``: the whole cleaning pipeline as one narrow projection.

No shuffle: every step is a per-row column expression. Null text becomes an
empty token list (a null list would make the vectorizer fail).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import text as T



def empty_tokens():
    return F.array().cast("array<string>")


def clean_text(df: DataFrame, text_col: str = "text", content_col: str = "content",
               tokens_col: str = "tokens", processed_col: str | None = "processed_text",
               drop_null: bool = False) -> DataFrame:
    """Add ``content`` (T3), ``tokens`` (T9 + T11) and ``processed_text``.

    ``drop_null=True`` drops rows whose text is null (training, P2); otherwise
    a null text yields empty tokens (scoring).
    """
    if drop_null:
        df = df.where(F.col(text_col).isNotNull())
    cols = T.clean_columns(text_col, content_col, tokens_col)
    out = df.withColumns({
        content_col: cols[content_col],
        tokens_col: F.coalesce(cols[tokens_col], empty_tokens()),
    })
    if processed_col:
        out = out.withColumn(processed_col, T.join_tokens(tokens_col))
    return out


def token_counts_by_group(df: DataFrame, group_col: str, tokens_col: str = "tokens") -> DataFrame:
    """Per group: documents, summed per-document token counts (of ``tokens_col``,
    distinct within each document after T11) and distinct tokens, in one scan.

    One row per (doc, token) via ``posexplode_outer``; the document-level
    counts ride on the first token of each document. Aggregation is two-level
    (partial on (group, token), then on group), so a group holding a third of
    all rows is still spread over many tasks before the final tiny merge.
    """
    ex = df.select(group_col, F.size(tokens_col).alias("_n"),
                   F.posexplode_outer(tokens_col).alias("_pos", "token"))
    first = F.col("_pos").isNull() | (F.col("_pos") == 0)
    per_token = ex.groupBy(group_col, "token").agg(
        F.sum(F.when(first, 1).otherwise(0)).alias("_docs"),
        F.sum(F.when(first, F.col("_n")).otherwise(0)).alias("_toks"))
    return per_token.groupBy(group_col).agg(
        F.sum("_docs").cast("bigint").alias("n_docs"),
        F.sum("_toks").cast("bigint").alias("n_tokens"),
        F.count("token").alias("n_distinct_tokens"))
