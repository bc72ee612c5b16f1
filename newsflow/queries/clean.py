"""Registered cleaning queries (T1-T13, J1-J3, J6, S10) over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.functions import text as T
from newsflow.operators.clean import clean_text, token_counts_by_group
from newsflow.queries import duck as D
from newsflow.sources.tables import documents


def _docs(spark, sf):
    return documents(spark, sf)


def q_sentence_trim(spark, sf):
    return _docs(spark, sf).select("doc_id", T.sentence_trim("text").alias("content"))


def q_punct_strip(spark, sf):
    c = T.lower(T.sentence_trim("text"))
    return _docs(spark, sf).select("doc_id", T.punct_strip(c).alias("stripped"))


def q_digit_strip(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", T.normalize(T.sentence_trim("text")).alias("normalized"))


def q_tokenize(spark, sf):
    toks = T.tokenize(T.normalize(T.sentence_trim("text")))
    return (_docs(spark, sf).select("doc_id", toks.alias("t"))
            .select("doc_id", F.size("t").cast("bigint").alias("n_tokens"),
                    F.array_join("t", " ").alias("tokens")))


def q_stopword_filter(spark, sf):
    return (_docs(spark, sf).select("doc_id", T.clean_tokens("text").alias("t"))
            .select("doc_id", F.size("t").cast("bigint").alias("n_kept"),
                    F.array_join("t", " ").alias("kept")))


def q_token_distinct(spark, sf):
    return (_docs(spark, sf).select("doc_id", T.distinct_tokens(T.clean_tokens("text")).alias("t"))
            .select("doc_id", F.size("t").cast("bigint").alias("n_distinct"),
                    T.join_tokens("t").alias("distinct_tokens")))


def q_clean_text(spark, sf):
    return (clean_text(_docs(spark, sf))
            .select("doc_id", "lang", "content", "processed_text"))


def q_token_stats_by_lang(spark, sf):
    """Flagship: documents, kept tokens and distinct tokens per language."""
    return token_counts_by_group(clean_text(_docs(spark, sf), processed_col=None), "lang")


def q_drop_columns(spark, sf):
    """Keep key, label and text; replace the text by its cleaned form."""
    df = _docs(spark, sf).drop("source", "n_chars")
    return clean_text(df, processed_col="text_clean").select("doc_id", "lang", "text_clean")


def q_distinct_labels(spark, sf):
    """J6."""
    return _docs(spark, sf).select("lang").distinct()


def q_preview(spark, sf):
    """First rows by key (the limit is the feature)."""
    return (_docs(spark, sf).orderBy("doc_id").limit(5)
            .select("doc_id", "lang", "source", "n_chars"))


QUERIES = {
    "sentence_trim": q_sentence_trim,
    "punct_strip": q_punct_strip,
    "digit_strip": q_digit_strip,
    "tokenize": q_tokenize,
    "stopword_filter": q_stopword_filter,
    "token_distinct": q_token_distinct,
    "clean_text": q_clean_text,
    "token_stats_by_lang": q_token_stats_by_lang,
    "drop_columns": q_drop_columns,
    "distinct_labels": q_distinct_labels,
    "preview": q_preview,
}

_TOK = D.tokenize(D.normalize(D.content("text")))
_KEPT = D.clean_tokens("text")

SQL = {
    "sentence_trim": f"SELECT doc_id, {D.content('text')} AS content FROM documents",
    "punct_strip": f"SELECT doc_id, {D.punct_strip('lower(' + D.content('text') + ')')} AS stripped "
                   f"FROM documents",
    "digit_strip": f"SELECT doc_id, {D.normalize(D.content('text'))} AS normalized FROM documents",
    "tokenize": f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens "
                f"FROM (SELECT doc_id, {_TOK} AS t FROM documents)",
    "stopword_filter": f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_kept, array_to_string(t, ' ') AS kept "
                       f"FROM (SELECT doc_id, {_KEPT} AS t FROM documents)",
    "token_distinct": f"SELECT doc_id, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct, "
                      f"{D.sorted_join('t')} AS distinct_tokens "
                      f"FROM (SELECT doc_id, {_KEPT} AS t FROM documents)",
    "clean_text": f"SELECT doc_id, lang, {D.content('text')} AS content, "
                  f"{D.sorted_join(_KEPT)} AS processed_text FROM documents",
    "token_stats_by_lang": f"""
        WITH d AS (SELECT doc_id, lang, list_distinct({_KEPT}) AS t FROM documents)
        SELECT s.lang, s.n_docs, s.n_tokens, coalesce(u.n_distinct_tokens, 0) AS n_distinct_tokens
        FROM (SELECT lang, count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_tokens
              FROM d GROUP BY lang) s
        LEFT JOIN (SELECT lang, count(DISTINCT tok) AS n_distinct_tokens
                   FROM (SELECT lang, unnest(t) AS tok FROM d) GROUP BY lang) u
        ON s.lang = u.lang""",
    "drop_columns": f"SELECT doc_id, lang, {D.sorted_join(_KEPT)} AS text_clean FROM documents",
    "distinct_labels": "SELECT DISTINCT lang FROM documents",
    "preview": "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5",
}
