"""Registered profiling queries.

The news-table stand-in is ``documents`` left-joined to ``labels``: the join
leaves real missing values in ``quality`` / ``toxic`` for unlabeled documents.
"""

from __future__ import annotations

from newsflow.operators import profile as P
from newsflow.sources.tables import read_table

V_COLS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
V_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
           "n_chars": "bigint", "quality": "int", "toxic": "int"}
NUM_EVENTS = ("event_id", "user_id", "value")
TEXT_COLS = ("lang", "source", "text")


def labeled(spark, sf):
    docs = read_table(spark, sf, "documents")
    labels = read_table(spark, sf, "labels")
    return docs.join(labels, "doc_id", "left").select(*V_COLS)   # unused columns are pruned before the join


def q_null_counts(spark, sf):
    return P.null_counts(labeled(spark, sf))


def q_drop_nulls(spark, sf):
    return P.drop_nulls(labeled(spark, sf)).select("doc_id", "lang", "quality", "toxic")


def _repeated(spark, sf):
    """All documents, and the German ones a second time: whole rows that repeat."""
    docs = read_table(spark, sf, "documents").select(*V_COLS[:5])
    return docs.unionByName(docs.where("lang = 'de'"))


def q_dup_count(spark, sf):
    return P.dup_count(_repeated(spark, sf))


def q_drop_dups(spark, sf):
    return P.drop_dups(_repeated(spark, sf))


def q_dup_recheck(spark, sf):
    return P.dup_count(P.drop_dups(_repeated(spark, sf)))


def q_column_info(spark, sf):
    return P.column_info(labeled(spark, sf))


def q_nunique(spark, sf):
    return P.nunique(labeled(spark, sf))


def q_describe(spark, sf):
    return P.describe_numeric(read_table(spark, sf, "events"), list(NUM_EVENTS))


def q_describe_text(spark, sf):
    return P.describe_text(read_table(spark, sf, "documents"), list(TEXT_COLS))


def q_distinct_values(spark, sf):
    return P.distinct_values(read_table(spark, sf, "documents").select(*V_COLS[:5]))


def q_column_kinds(spark, sf):
    return P.column_kinds(labeled(spark, sf))


def q_shape(spark, sf):
    return P.shape(labeled(spark, sf))


def q_null_labels(spark, sf):
    return P.null_counts(labeled(spark, sf).select("quality")).select(
        "column_name", "n_null")


QUERIES = {
    "null_counts": q_null_counts,
    "drop_nulls": q_drop_nulls,
    "dup_count": q_dup_count,
    "drop_dups": q_drop_dups,
    "dup_recheck": q_dup_recheck,
    "column_info": q_column_info,
    "nunique": q_nunique,
    "describe": q_describe,
    "describe_text": q_describe_text,
    "distinct_values": q_distinct_values,
    "column_kinds": q_column_kinds,
    "shape": q_shape,
    "null_labels": q_null_labels,
}

_V = ("(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
      "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")


_W = ("(SELECT doc_id, text, lang, source, n_chars FROM documents UNION ALL "
      "SELECT doc_id, text, lang, source, n_chars FROM documents WHERE lang = 'de')")


def _union(parts):
    return " UNION ALL ".join(parts)


def _describe_sql():
    parts = []
    for c in NUM_EVENTS:
        x = f"CAST({c} AS DOUBLE)"
        stats = [("count", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"avg({x})"),
                 ("std", f"stddev_samp({x})"), ("min", f"min({x})"), ("max", f"max({x})"),
                 ("25%", f"quantile_cont({x}, 0.25)"), ("50%", f"quantile_cont({x}, 0.5)"),
                 ("75%", f"quantile_cont({x}, 0.75)")]
        parts += [f"SELECT '{c}' AS column_name, '{k}' AS stat, round({e}, 6) AS value FROM events"
                  for k, e in stats]
    return _union(parts)


def _describe_text_sql():
    parts = []
    for c in TEXT_COLS:
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique, "
            f"first(v ORDER BY n DESC, v ASC) AS top, max(n) AS freq "
            f"FROM (SELECT {c} AS v, count(*) AS n FROM documents WHERE {c} IS NOT NULL GROUP BY {c})")
    return _union(parts)


SQL = {
    "null_counts": _union(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM {_V}"
                          for c in V_COLS),
    "drop_nulls": f"SELECT doc_id, lang, quality, toxic FROM {_V} WHERE "
                  + " AND ".join(f"{c} IS NOT NULL" for c in V_COLS),
    "dup_count": "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates "
                 f"FROM (SELECT count(*) AS n FROM {_W} GROUP BY doc_id, text, lang, source, n_chars)",
    "drop_dups": f"SELECT DISTINCT * FROM {_W}",
    "dup_recheck": "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates "
                   f"FROM (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM {_W}) "
                   "GROUP BY doc_id, text, lang, source, n_chars)",
    "column_info": _union(f"SELECT '{c}' AS column_name, '{V_TYPES[c]}' AS dtype, "
                          f"count({c}) AS non_null FROM {_V}" for c in V_COLS),
    "nunique": _union(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM {_V}"
                      for c in V_COLS),
    "describe": _describe_sql(),
    "describe_text": _describe_text_sql(),
    "distinct_values": _union(f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value "
                              f"FROM documents" for c in V_COLS[:5]),
    "column_kinds": _union(
        f"SELECT '{c}' AS column_name, "
        f"'{'categorical' if V_TYPES[c] == 'string' else 'numeric'}' AS kind"
        for c in V_COLS),
    "shape": f"SELECT count(*) AS n_rows, CAST({len(V_COLS)} AS BIGINT) AS n_cols, "
             f"'{', '.join(V_COLS)}' AS columns FROM {_V}",
    "null_labels": f"SELECT 'quality' AS column_name, count(*) - count(quality) AS n_null FROM {_V}",
}
