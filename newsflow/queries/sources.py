"""Registered source/sink queries (S1, S2, S4, S5) and lexicon training."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.operators import features as FT
from newsflow.plans.model import TrainConfig, usable
from newsflow.plans.sharded import train_sharded
from newsflow.queries import duck as D
from newsflow.queries.features import cleaned
from newsflow.queries.model import known_class
from newsflow.session import staging_path
from newsflow.sources import news as N
from newsflow.sources.tables import documents, read_table


def q_json_roundtrip(spark, sf):
    """S2 then S1: dump ``documents`` as a JSON-lines collection, read it back."""
    path = staging_path(spark, "collection")
    N.export_collection(read_table(spark, sf, "documents"), path, id_col="doc_id")
    schema = "_id string, doc_id long, text string, lang string, source string, n_chars long"
    return spark.read.schema(schema).json(path)


def _news(spark, sf):
    """Documents written as news rows in JSON lines, and read with the news schema."""
    path = staging_path(spark, "news")
    docs = read_table(spark, sf, "documents")
    docs.select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("link"),
                F.col("source").alias("headline"), F.col("lang").alias("category"),
                F.col("text").alias("short_description"), F.col("n_chars").cast("string").alias("authors"),
                F.date_add(F.lit("2020-01-01").cast("date"), F.pmod("doc_id", F.lit(1000)).cast("int")).alias("date")
                ).write.mode("overwrite").json(path)
    return N.read_news(spark, path)


def q_read_news(spark, sf):
    """S1 + J1/J2: documents laid out as news rows, read with the news schema,
    unused columns dropped."""
    return _news(spark, sf).drop(*N.UNUSED_NEWS_COLUMNS, "_corrupt_record").select(
        "category", "short_description")


def q_read_news_columns(spark, sf):
    """All six columns, the date as a date."""
    return _news(spark, sf).where("_corrupt_record IS NULL").drop("_corrupt_record")


def q_training_input(spark, sf):
    """Rows that training takes and drops, of documents joined to their ratings as labels;
    texts of every seventh key are missing."""
    docs = read_table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text"))
    rows = docs.join(read_table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return usable(rows, TrainConfig(label_col="quality"))


def lexicon_words(spark, sf):
    """(category, word): all words of each language."""
    terms = FT.doc_terms(cleaned(spark, sf), "doc_id", keep=["lang"])
    return terms.select(F.col("lang").alias("category"), F.col("term").alias("word")).distinct()


def _written_lexicon(spark, sf):
    path = staging_path(spark, "lexicon")
    N.write_lexicon(lexicon_words(spark, sf), path)
    return N.read_lexicon(spark, path), path


def q_lexicon_write(spark, sf):
    """The CSV as written, read back raw."""
    _, path = _written_lexicon(spark, sf)
    return spark.read.schema(N.LEXICON_SCHEMA).option("header", True).option("escape", '"').csv(path)


def q_lexicon_explode(spark, sf):
    """Read the CSV lexicon, split and trim the word lists."""
    lex, _ = _written_lexicon(spark, sf)
    return N.explode_lexicon(lex)


def q_lexicon_train(spark, sf):
    """Train on the lexicon rows (text = word list, label = category),
    then classify every document with that model."""
    lex, _ = _written_lexicon(spark, sf)
    rows = lex.select("category", F.array_join("words", ", ").alias("text"),
                      F.col("category").alias("label"))
    model, _ = train_sharded(rows, TrainConfig(key="category", label_col="label", test_fraction=0.0,
                                       tol=1e-4))
    rows = model.with_input("doc_id").score_rows(documents(spark, sf))
    return rows.select("doc_id", known_class(F.col("Predicted Category"), model))


QUERIES = {
    "json_roundtrip": q_json_roundtrip,
    "read_news": q_read_news,
    "read_news_columns": q_read_news_columns,
    "training_input": q_training_input,
    "lexicon_write": q_lexicon_write,
    "lexicon_explode": q_lexicon_explode,
    "lexicon_train": q_lexicon_train,
}

_KEPT = D.clean_tokens("text")
_TOP = (f"d AS (SELECT doc_id, lang, list_distinct({_KEPT}) AS t FROM documents), "
        f"dt AS (SELECT DISTINCT doc_id, lang, term FROM (SELECT doc_id, lang, unnest(t) AS term FROM d) "
        f"WHERE length(term) >= 2), "
        f"top AS (SELECT DISTINCT lang AS category, term AS word FROM dt), "
        f"sl AS (SELECT category, word, (row_number() OVER (PARTITION BY category ORDER BY word) - 1) // {N.SLICE_WORDS} "
        f"AS slice FROM top)")

SQL = {
    "json_roundtrip": "SELECT CAST(doc_id AS VARCHAR) AS _id, doc_id, text, lang, source, n_chars "
                      "FROM documents",
    "read_news": "SELECT lang AS category, text AS short_description FROM documents",
    "lexicon_write": f"WITH {_TOP} SELECT category, string_agg(word, ',' ORDER BY word) AS unique_words "
                     f"FROM sl GROUP BY category, slice",
    "lexicon_train": "SELECT doc_id, TRUE AS known_class FROM documents",
    "read_news_columns": "SELECT 'doc/' || doc_id AS link, source AS headline, lang AS category, "
                         "text AS short_description, CAST(n_chars AS VARCHAR) AS authors, "
                         "DATE '2020-01-01' + CAST(doc_id % 1000 AS INT) AS date FROM documents",
    "training_input": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_corrupt, "
                      "count(*) FILTER (text IS NULL OR doc_id % 7 = 0) AS n_no_text, "
                      "count(*) FILTER (text IS NOT NULL AND doc_id % 7 <> 0 AND quality IS NULL) AS n_no_label, "
                      "count(*) FILTER (text IS NOT NULL AND doc_id % 7 <> 0 AND quality IS NOT NULL) AS n_used "
                      "FROM documents LEFT JOIN labels USING (doc_id)",
    "lexicon_explode": f"WITH {_TOP} SELECT category, word FROM top",
}
