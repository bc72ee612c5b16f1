"""Lemma table against lemmas written down by hand."""

from newsflow.operators.lemma import lemma_table, lemmatize_tokens

LEXICON = ["cat", "box", "church", "wish", "man", "woman", "fly", "bus", "glass", "quiz", "wolf", "s", "mouse", "goose"]
EXCEPTIONS = [("mice", "mouse"), ("geese", "goose"), ("geese", "gander")]
# token -> lemma: the shortest form of the lexicon that the rules reach first, else the token
LEMMAS = {
    "cat": "cat", "cats": "cat", "catss": "cat", "boxes": "box", "churches": "church", "wishes": "wish",
    "men": "man", "women": "woman", "flies": "fly", "buses": "bus", "glasses": "glass", "glass": "glass",
    "wolves": "wolf", "sss": "s", "mice": "mouse", "geese": "goose", "dogs": "dogs", "gander": "gander",
}


def test_lemmas_by_hand(spark):
    tok = spark.createDataFrame([(w,) for w in LEMMAS], "token string")
    lex = spark.createDataFrame([(w,) for w in LEXICON], "form string")
    exc = spark.createDataFrame(EXCEPTIONS, "form string, lemma string")
    assert {r.token: r.lemma for r in lemma_table(tok, lex, exc).collect()} == LEMMAS


def test_lemmatize_tokens_regroups_distinct(spark):
    df = spark.createDataFrame([(1, "x", ["cats", "cat", "dogs"]), (2, "y", []), (3, "z", None)],
                               "doc_id int, other string, tokens array<string>")
    lem = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "token string, lemma string")
    out = {r.doc_id: r for r in lemmatize_tokens(df, lem).collect()}
    assert out[1].tokens == ["cat", "dog"] and out[1].other == "x"
    assert out[2].tokens == [] and out[2].other == "y"
    assert out[3].tokens == []


def test_lemmatize_only_suffix_tokens_same_result(spark):
    from newsflow.operators.lemma import RULE_SUFFIX
    df = spark.createDataFrame([(1, ["cats", "cat", "women", "dog", "glasses"]), (2, ["x"]), (3, [])],
                               "doc_id int, tokens array<string>")
    lex = spark.createDataFrame([(w,) for w in ["cat", "woman", "glass", "dog"]], "form string")
    toks = df.selectExpr("explode(tokens) AS token").distinct()
    lt = lemma_table(toks, lex)
    a = {r.doc_id: r.tokens for r in lemmatize_tokens(df, lt).collect()}
    b = {r.doc_id: r.tokens for r in lemmatize_tokens(df, lt, only=RULE_SUFFIX).collect()}
    assert a == b
    assert a[1] == ["cat", "dog", "glass", "woman"] and a[2] == ["x"] and a[3] == []


def test_repeated_and_null_keys_keep_every_row(spark):
    df = spark.createDataFrame([(1, "a", ["cats"]), (1, "b", ["dogs", "cats"]), (None, "c", ["cats"]), (None, "d", [])],
                               "doc_id int, text string, tokens array<string>")
    lem = spark.createDataFrame([("cats", "cat")], "token string, lemma string")
    out = {r.text: (r.doc_id, r.tokens) for r in lemmatize_tokens(df, lem).collect()}
    assert out == {"a": (1, ["cat"]), "b": (1, ["cat", "dogs"]), "c": (None, ["cat"]), "d": (None, [])}


def test_a_long_run_of_s_ends_at_the_lexicon(spark):
    import time
    lex = spark.createDataFrame([("as",), ("b",)], "form string")
    tok = spark.createDataFrame([("a" + "s" * 10_000,), ("b" + "s" * 10_000,), ("c" + "s" * 10_000,)], "token string")
    begin = time.time()
    got = {r.token[0]: r.lemma for r in lemma_table(tok, lex).collect()}
    assert got["a"] == "as" and got["b"] == "b" and got["c"] == "c" + "s" * 10_000
    assert time.time() - begin < 60


def test_lemma_rows_are_the_lemmas_of_lemmatize_tokens(spark):
    from newsflow.operators.lemma import ROW_ID, changed_lemmas, lemma_rows, with_row_ids
    rows = with_row_ids(spark.createDataFrame([(1, ["cats", "cat", "women", "glass", "omen"]), (1, ["dog", "dogs"]), (None, []), (2, None)],
                                              "k int, tokens array<string>"))
    toks = rows.selectExpr("explode(tokens) AS token").union(spark.createDataFrame([("woman",)], "token string"))
    changes = changed_lemmas(toks, toks)
    want = {(r.k, t) for r in lemmatize_tokens(rows, changes).collect() for t in r.tokens}
    keys = rows.select(ROW_ID, "k")
    got = [(r.k, r.lemma) for r in lemma_rows(rows, changes).join(keys, ROW_ID).collect()]
    assert set(got) == want and len(got) == 7 and got.count((1, "cat")) == 2
    assert sorted(r.lemma for r in lemma_rows(rows, None).collect()) == sorted(["cats", "cat", "women", "glass", "omen", "dog", "dogs"])
