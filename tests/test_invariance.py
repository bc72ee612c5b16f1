"""Row order and partitioning change no output."""

from pyspark.sql import functions as F

from conftest import SF0001
from newsflow.operators import features as FT
from newsflow.operators import metrics as M
from newsflow.operators import profile as P
from newsflow.operators import updates as U
from newsflow.operators.clean import clean_text
from newsflow.sources.tables import read_table


def _rows(df):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def _pair(df):
    return df, df.orderBy(F.desc(df.columns[0])).repartition(5)


def test_operators_are_partition_invariant(spark):
    docs, docs2 = _pair(read_table(spark, SF0001, "documents"))
    ev, ev2 = _pair(read_table(spark, SF0001, "events"))

    def feats(d):
        c = clean_text(d.select("doc_id", "lang", "text"), processed_col=None)
        tr = c.where(~FT.is_test("doc_id"))
        return FT.tfidf(FT.doc_terms(tr, "doc_id"), FT.idf_from_docs(tr, "doc_id"), "doc_id")

    def pairs(d):
        return d.select(F.col("lang").alias("label"),
                        F.when(FT.is_test("doc_id", seed=7), F.lit("en")).otherwise(F.col("lang"))
                        .alias("prediction"))

    checks = {
        "clean_text": lambda d, e: clean_text(d).select("doc_id", "content", "processed_text"),
        "null_counts": lambda d, e: P.null_counts(d),
        "dup_count": lambda d, e: P.dup_count(d.select("lang", "text")),
        "nunique": lambda d, e: P.nunique(d),
        "describe": lambda d, e: P.describe_numeric(e, ["event_id", "user_id", "value"]),
        "describe_text": lambda d, e: P.describe_text(d, ["lang", "source", "text"]),
        "distinct_values": lambda d, e: P.distinct_values(d, ["lang", "source"]),
        "tfidf": lambda d, e: feats(d),
        "label_index": lambda d, e: FT.label_index(d, "lang"),
        "report": lambda d, e: M.classification_report(pairs(d)),
        "history": lambda d, e: U.number_collections(
            U.collection_counts(e, F.col("event_type"), F.col("ts"))),
    }
    for name, f in checks.items():
        assert _rows(f(docs, ev)) == _rows(f(docs2, ev2)), name
