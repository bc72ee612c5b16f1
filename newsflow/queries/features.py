"""Registered lemma and feature queries (T10, T13, M1-M6) over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.functions import text as T
from newsflow.operators import features as FT
from newsflow.operators.clean import clean_text
from newsflow.operators.lemma import (NOUN_RULES, RULE_SUFFIX, changed_lemmas, lemma_table,
                                      lemmatize_tokens, with_row_ids)
from newsflow.queries import duck as D
from newsflow.sources.tables import documents, read_table, spread
from newsflow.session import materialize

KEY = "doc_id"


def cleaned(spark, sf):
    return clean_text(documents(spark, sf).select(KEY, "lang", "text"), processed_col=None)


def cleaned_once(spark, sf):
    """Cleaned tokens materialised once, for queries that read them in several
    branches (the regex work is the expensive part; tokens are smaller than text)."""
    return materialize(cleaned(spark, sf).select(KEY, "lang", "tokens"))


def corpus_lemmas(df):
    """Lemma map with the corpus vocabulary as lexicon (the default lexicon)."""
    toks = df.select(F.explode("tokens").alias("token")).distinct()
    return lemma_table(toks, toks)


def q_lemma_table(spark, sf):
    return corpus_lemmas(cleaned(spark, sf))


def q_lemmatize(spark, sf):
    df = with_row_ids(cleaned(spark, sf).select(KEY, "lang", "tokens"))
    toks = df.select(F.explode("tokens").alias("token")).distinct()
    lem = lemmatize_tokens(df, changed_lemmas(toks, toks), only=RULE_SUFFIX)
    return lem.select(KEY, "lang", T.join_tokens("tokens").alias("processed_text"))


def q_lemmatize_turns(spark, sf):
    """T10 on a table whose key repeats, against the words of another table."""
    turns = spread(read_table(spark, sf, "conversations")).select("conv_id", "role", "text")
    df = with_row_ids(clean_text(turns, processed_col=None).select("conv_id", "role", "tokens"))
    lexicon = cleaned(spark, sf).select(F.explode("tokens").alias("form")).distinct()
    toks = df.select(F.explode("tokens").alias("token")).distinct()
    lem = lemmatize_tokens(df, changed_lemmas(toks, lexicon), only=RULE_SUFFIX)
    return lem.select("conv_id", "role", T.join_tokens("tokens").alias("processed_text"))


def q_train_split(spark, sf):
    return documents(spark, sf).select(
        KEY, "lang", F.when(FT.is_test(KEY), "test").otherwise("train").alias("split"))


def _train(spark, sf):
    return cleaned(spark, sf).where(~FT.is_test(KEY))


def q_vocabulary(spark, sf):
    tr = _train(spark, sf)
    return FT.vocabulary(FT.doc_terms(tr, KEY), KEY)


def q_vocabulary_index(spark, sf):
    """M2: the numbers of the training vocabulary's terms, as a table."""
    tr = _train(spark, sf)
    return FT.vocabulary_index(FT.vocabulary(FT.doc_terms(tr, KEY), KEY)).select("term", "df", "idx")


def q_tfidf_unseen(spark, sf):
    """M5: weights of held-out documents; terms that training has not seen count nothing."""
    docs = cleaned_once(spark, sf)
    flag = FT.is_test(KEY)
    idf = FT.idf_from_docs(docs.where(~flag), KEY)
    return FT.tfidf(FT.doc_terms(docs.where(flag), KEY), idf, KEY).select(
        KEY, "term", F.round("weight", 6).alias("weight"))


def q_train_split_exact(spark, sf):
    """M1: exactly a fifth of the rows, rounded up, in the order of the keys' hashes."""
    docs = read_table(spark, sf, "documents").select(KEY, "lang")
    trn, tst = FT.exact_split(docs, KEY)
    return trn.withColumn("split", F.lit("train")).union(tst.withColumn("split", F.lit("test")))


def q_idf(spark, sf):
    return FT.idf_from_docs(_train(spark, sf), KEY).select(
        "term", "df", F.round("idf", 6).alias("idf"))


def q_tfidf_l2(spark, sf):
    tr = cleaned_once(spark, sf).where(~FT.is_test(KEY))
    idf = FT.idf_from_docs(tr, KEY)
    return FT.tfidf(FT.doc_terms(tr, KEY), idf, KEY).select(
        KEY, "term", F.round("weight", 6).alias("weight"))


def q_label_index(spark, sf):
    return FT.label_index(documents(spark, sf), "lang")


QUERIES = {
    "lemma_table": q_lemma_table,
    "lemmatize": q_lemmatize,
    "lemmatize_turns": q_lemmatize_turns,
    "train_split": q_train_split,
    "vocabulary": q_vocabulary,
    "idf": q_idf,
    "vocabulary_index": q_vocabulary_index,
    "tfidf_unseen": q_tfidf_unseen,
    "train_split_exact": q_train_split_exact,
    "tfidf_l2": q_tfidf_l2,
    "label_index": q_label_index,
}

# ---------------------------------------------------------------- oracle SQL
_KEPT = D.clean_tokens("text")
_SPLIT = "substr(md5(concat('42:', CAST(doc_id AS VARCHAR))), 1, 8) < '33333333'"
_DOCS = f"d AS (SELECT doc_id, lang, list_distinct({_KEPT}) AS t FROM documents)"


_RULES = ", ".join(f"({i}, {D.q(old)}, {D.q(new)})" for i, (old, new) in enumerate(NOUN_RULES, start=1))


def _lemma_ctes() -> str:
    rules = " UNION ALL ".join(
        f"SELECT token, left(token, length(token) - {len(old)}) || {D.q(new)} AS cand, {i} AS seq "
        f"FROM tok WHERE suffix(token, {D.q(old)})"
        for i, (old, new) in enumerate(NOUN_RULES, start=1))
    return (f"{_DOCS}, tok AS (SELECT DISTINCT unnest(t) AS token FROM d), "
            f"cand AS (SELECT token, token AS cand, 0 AS seq FROM tok UNION ALL {rules}), "
            f"best AS (SELECT c.token, first(c.cand ORDER BY length(c.cand), c.seq) AS lemma "
            f"FROM cand c JOIN tok l ON c.cand = l.token GROUP BY c.token)")


_TERMS = (f"{_DOCS}, tr AS (SELECT * FROM d WHERE NOT ({_SPLIT})), "
          f"n AS (SELECT count(*) AS n FROM tr), "
          f"dt AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest(t) AS term FROM tr) "
          f"WHERE length(term) >= 2), "
          f"v AS (SELECT term, count(*) AS df FROM dt GROUP BY term), "
          f"i AS (SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM v, n)")

SQL = {
    "lemma_table": f"WITH {_lemma_ctes()} SELECT token, lemma FROM best",
    "lemmatize": f"WITH {_lemma_ctes()}, "
                 f"ex AS (SELECT doc_id, unnest(t) AS token FROM d), "
                 f"lm AS (SELECT ex.doc_id, list(b.lemma) AS ls FROM ex JOIN best b "
                 f"ON ex.token = b.token GROUP BY ex.doc_id) "
                 f"SELECT d.doc_id, d.lang, "
                 f"coalesce(array_to_string(list_sort(list_distinct(lm.ls)), ' '), '') AS processed_text "
                 f"FROM d LEFT JOIN lm ON d.doc_id = lm.doc_id",
    "lemmatize_turns": f"WITH RECURSIVE {_DOCS}, lx AS (SELECT DISTINCT unnest(t) AS cand FROM d), "
                       f"r(seq, old, new) AS (VALUES {_RULES}), "
                       f"cv AS (SELECT row_number() OVER () AS rid, conv_id, role, list_distinct({_KEPT}) AS t "
                       f"FROM conversations), "
                       f"tok AS (SELECT DISTINCT unnest(t) AS token FROM cv), "
                       f"ch AS (SELECT token, token AS cand, 0 AS depth, '' AS path FROM tok UNION ALL "
                       f"SELECT token, left(cand, length(cand) - length(old)) || new, depth + 1, path || seq "
                       f"FROM ch JOIN r ON suffix(cand, old)), "
                       f"best AS (SELECT token, first(cand ORDER BY greatest(depth, 1), length(cand), path) AS lemma "
                       f"FROM ch JOIN lx USING (cand) GROUP BY token), "
                       f"lm AS (SELECT rid, list(coalesce(lemma, token)) AS ls "
                       f"FROM (SELECT rid, unnest(t) AS token FROM cv) LEFT JOIN best USING (token) GROUP BY rid) "
                       f"SELECT conv_id, role, "
                       f"coalesce(array_to_string(list_sort(list_distinct(ls)), ' '), '') AS processed_text "
                       f"FROM cv LEFT JOIN lm USING (rid)",
    "train_split": f"SELECT doc_id, lang, CASE WHEN {_SPLIT} THEN 'test' ELSE 'train' END AS split "
                   f"FROM documents",
    "vocabulary": f"WITH {_TERMS} SELECT term, df FROM v",
    "vocabulary_index": f"WITH {_TERMS} SELECT term, df, row_number() OVER (ORDER BY df DESC, term) - 1 AS idx FROM v",
    "tfidf_unseen": f"WITH {_TERMS}, te AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest(t) AS term FROM d "
                    f"WHERE {_SPLIT}) WHERE length(term) >= 2) SELECT te.doc_id, te.term, "
                    f"round(i.idf / sqrt(sum(i.idf * i.idf) OVER (PARTITION BY te.doc_id)), 6) AS weight "
                    f"FROM te JOIN i ON te.term = i.term",
    "train_split_exact": "SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id)) "
                         "<= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM documents",
    "idf": f"WITH {_TERMS} SELECT term, df, round(idf, 6) AS idf FROM i",
    "tfidf_l2": f"WITH {_TERMS} SELECT dt.doc_id, dt.term, "
                f"round(i.idf / sqrt(sum(i.idf * i.idf) OVER (PARTITION BY dt.doc_id)), 6) AS weight "
                f"FROM dt JOIN i ON dt.term = i.term",
    "label_index": "SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS BIGINT) AS label_idx "
                   "FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)",
}
