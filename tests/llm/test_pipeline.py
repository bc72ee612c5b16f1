"""The pipeline, stage by stage and as a whole, against plain versions of every stage on hard rows;
and the scores of the trained classifiers against plain loops."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from newsflow.llm import langid, ordinal, triecount

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, wm_n_hit long, _row string, rid long, "
           "k string, h long, component_id long, size long")


def _rows(seed=4):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(900)}"
    out, labels = [], []
    for i in range(150):
        kind = i % 6
        text = " ".join(word() for _ in range(rnd.randrange(30, 80)))
        if kind == 0:
            text = "spam " * rnd.randrange(40, 60)
        elif kind == 1:
            text += " vile vile"
        out.append((i, text))
        labels.append((i, int(kind != 0), int(kind == 1)))
    good = [t for i, t in out if i % 6 > 1]
    passage = " ".join(f"bench{j}" for j in range(12))
    out += [(200 + j, t) for j, t in enumerate(good[:10])]                             # copies
    out += [(220 + j, t.replace("w1", "w2", 1)) for j, t in enumerate(good[10:20])]    # near copies
    out += [(240 + j, good[20 + j] + " " + passage.upper() + " " + good[21 + j]) for j in range(5)]
    out += [(260, None), (261, ""), (262, " \n"), (None, good[40]), (None, good[41]), (263, " ".join(word() for _ in range(9000))),
            (5, out[5][1]), (5, "another text of the key " + good[50]), (264, "x" * 60_000)]
    rows = [(i, t, None if j % 9 == 0 else "en", None if j % 11 == 0 else f"src{j % 4}", len(t or ""), 7, "r", 1, "k", 2, 3, 4)
            for j, (i, t) in enumerate(out)]
    return rows, labels + [(5, None, None), (None, 1, 0)], [(0, passage), (1, "too short"), (2, None), (0, passage)]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    rows, labels, items = _rows()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.fixture(scope="module")
def outputs(spark, table):
    """Every stage's output, written and read again."""
    docs, got = spark.read.parquet(f"{table}/documents.parquet"), {}
    got["input"] = docs
    for name, step in P.STAGES:
        docs = got[name] = P.stage(step(spark, docs, table), name)
    return got


def _texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def _words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]


def test_names_and_columns(outputs):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "token_ids"]
    for name in ("quality", "near_duplicates", "decontamination", "mixing"):
        assert outputs[name].schema.simpleString() == outputs["input"].schema.simpleString()
        # the other columns come through as they were
        assert outputs[name].where("wm_n_hit <> 7 OR _row <> 'r' OR rid <> 1 OR k <> 'k' OR h <> 2 OR size <> 4").isEmpty()


def _keeps(model, text):
    """The tail probability from the weights, one feature at a time."""
    if not (text or "").strip():
        return False
    score = 0.0
    for h in ordinal.features(text).tolist():
        score += model.weights.get(h, 0.0)
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, score - float(model.cuts[-1]))))) >= model.keep


def test_quality(spark, table, outputs):
    model = ordinal.train(outputs["input"], spark.read.parquet(f"{table}/labels.parquet"))
    want = [(i, t) for i, t in _texts(outputs["input"]) if _keeps(model, t)]
    assert _texts(outputs["quality"]) == want
    kept = {i for i, _ in want}
    assert sum(i in kept for i in range(150) if i % 6 > 1) > 90 and not any(i in kept for i in range(0, 150, 6))


def test_near_duplicates(outputs):
    rows = _texts(outputs["quality"])
    sets = [({tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()) for w in
            (_words(t) for _, t in rows)]
    root = list(range(len(rows)))

    def top(i):
        return i if root[i] == i else top(root[i])

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(top(i), []).append(r)
    got = _texts(outputs["near_duplicates"])
    assert len(got) == len(groups) < len(rows)
    left = list(got)
    for group in groups.values():   # one of each
        one = next(r for r in group if r in left)
        left.remove(one)
    assert not left


def test_decontamination(spark, table, outputs):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    windows = set()
    for r in spark.read.parquet(f"{table}/benchmark.parquet").collect():
        w = cut(r.text)
        n = min(10, len(w))
        windows |= {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if n else set()
    hit = lambda t: any(tuple(w[j:j + len(x)]) == x for w in [cut(t)] for x in windows for j in range(len(w)))
    rows = _texts(outputs["near_duplicates"])
    assert _texts(outputs["decontamination"]) == [r for r in rows if not hit(r[1])]
    assert any(hit(t) for _, t in rows)


def test_mixing(spark, table, outputs):
    before, after = {}, {}
    size = lambda t: len(_words(t))
    for r in outputs["decontamination"].collect():
        before.setdefault(r.source, []).append(r)
    for r in outputs["mixing"].collect():
        after.setdefault(r.source, []).append(r)
    # targets by filling up from the weights, sources over three times their size held there
    order = sorted(before, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total = {s: sum(size(r.text) for r in rs) for s, rs in before.items()}
    target, left = {}, set(order)
    while left:
        rest = sum(total.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * total[s]}
        target |= {s: 3 * total[s] for s in over} if over else share
        left = left - over if over else set()
    for s in order:
        taken = sum(size(r.text) for r in after.get(s, []))
        assert abs(taken - target[s]) <= max(size(r.text) for r in before[s]), s
    copies = {}
    for r in outputs["mixing"].collect():
        copies[r] = copies.get(r, 0) + 1
    own = {}
    for r in outputs["decontamination"].collect():
        own[r] = own.get(r, 0) + 1
    assert set(copies) <= set(own) and all(n <= 3 * own[r] for r, n in copies.items())
    again = P.mixing(spark, outputs["decontamination"], table)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, outputs["mixing"].collect()))


def test_token_ids_and_the_whole(spark, table, outputs):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in _texts(outputs["mixing"]):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    got = outputs["token_ids"]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got.collect())
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    whole = P.run(spark, table)
    total = F.sum("n_tokens")
    assert whole.count() == got.count() and whole.agg(total).first() == got.agg(total).first()
    assert sorted(map(repr, whole.select("doc_id", *names[2:]).collect())) == sorted(
        map(repr, got.select("doc_id", *names[2:]).collect()))


def test_empty_tables_come_through(spark, table, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{table}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_ordinal_fit_lowers_the_likelihood_of_plain_loops():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["good", "fine", "w"] if g == 2 else ["vile", "w"] if g == 1 else ["spam", "w"]) for _ in range(20))
             for g in (0, 1, 2) * 30]
    grades = [0, 1, 2] * 30
    model = ordinal.fit([ordinal.features(t) for t in texts], grades)
    scores = [sum(model.weights.get(h, 0.0) for h in ordinal.features(t).tolist()) for t in texts]
    for t, s in zip(texts, scores):
        assert abs(model.score(t) - s) < 1e-9
        tails = [1 / (1 + math.exp(-(s - c))) for c in model.cuts]
        expected, last = model.grades(s)
        assert abs(expected - sum(tails)) < 1e-9 and abs(last - tails[-1]) < 1e-9

    def loss(shift, cuts):
        total = 0.0
        for s, g in zip(scores, grades):
            tail = [1.0, *(1 / (1 + math.exp(-(s + shift - c))) for c in cuts), 0.0]
            total -= math.log(max(tail[g] - tail[g + 1], 1e-12))
        return total

    assert list(model.cuts) == sorted(model.cuts)
    assert loss(0, model.cuts) < 0.3 * len(texts) * math.log(3)
    assert loss(0, model.cuts) < min(loss(4, model.cuts), loss(-4, model.cuts))


def test_language_scores_against_a_loop():
    model = langid.fit(["der hund und die katze"] * 12 + ["the dog and the cat"] * 12, ["de"] * 12 + ["en"] * 12, epochs=30)
    table, bias = model.table, model.bias
    texts = ["die katze the dog", "", "und " * 5000, "ÜBER the 12 cat!", "z" * 40_000, "der"]
    for text, got in zip(texts, model.scorer()(texts)):
        total, n = np.zeros(2), 0
        for w in langid.tokens(text):
            grams, size = langid.subwords([w])
            assert size.tolist() == [len(grams)]
            for g in grams.tolist():
                total += table[g]
                n += 1
        assert np.allclose(got, total / max(1, n) + bias)
    # ties of the training set's copies do not matter, and languages part
    p = langid.softmax(model.scorer()(["der hund", "the dog"]))
    assert model.labels[p[0].argmax()] == "de" and model.labels[p[1].argmax()] == "en"


def test_language_rows_with_clashing_columns(spark):
    rows = [(i, "der hund und die katze " * 9 if i % 2 else "the dog and the cat " * 9, "de" if i % 2 else "en", True, "x", 0.5)
            for i in range(90)]
    rows += [(7, "the dog", "en", True, "x", 0.5), (None, None, None, None, None, None), (95, "x" * 80_000, None, None, None, None),
             (96, "12 34", None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out boolean, lang_pred string, score double")
    model = langid.train(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows) and sorted(map(repr, got)) == sorted(map(repr, langid.predict(docs.repartition(5), model).collect()))
    logits = model.scorer()
    for r, (i, text, *_) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.score)),
                                sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        if r.doc_id == 7:
            continue
        if not langid.has_letter(text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            p = langid.softmax(logits([text]) / model.temperature)[0]
            assert r.lang_pred == model.labels[p.argmax()] and abs(r.score - p.max()) < 1e-9


def test_trie_counts_of_hard_rows(spark):
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [None, "", " ", "the cat sat", "the cat sat", "ab" * 30_000, "the " * 4000]
    docs = spark.createDataFrame([(i % 5 if i != 3 else None, t, 1, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_tokens long, token string")
    got = triecount.token_counts(docs, path).collect()
    assert len(got) == len(texts)
    one = {repr(r): r for r in triecount.token_counts(docs.repartition(3), path).collect()}
    assert sorted(one) == sorted({repr(r) for r in got})


def test_long_words_and_texts_are_not_held():
    model = ordinal.Model(np.array([1]), np.array([0.5]), np.array([0.0]))
    for text in ("x" * 100_000 + " ab", "ab " * 10 + "y" * 100_000):
        assert model.score(text) == ordinal.Model(np.array([1]), np.array([0.5]), np.array([0.0])).score(text)
    assert max(map(len, model._kept)) <= ordinal.KEPT_WORD and b"ab" in model._kept
    rows = [(i, "x" * (1_000_000 if i % 7 else 3_000_000)) for i in range(20)] + [(20 + i, None) for i in range(1200)]
    parts = list(triecount.groups(iter(rows)))
    assert [r for p in parts for r in p] == rows
    assert all(len(p) == 1 or len(p) <= triecount.ROWS and sum(len(t or "") for _, t in p) <= triecount.CHARS for p in parts)


def test_the_language_fit_takes_bounded_texts(spark, monkeypatch):
    got = {}
    monkeypatch.setattr(langid, "fit", lambda texts, langs: got.update(texts=texts))
    words = [f"w{i}" for i in range(60_000)]
    docs = spark.createDataFrame([(i, " ".join(words), "en") for i in range(3)] + [(9, "short", "en")],
                                 "doc_id long, text string, lang string")
    langid.train(docs)
    assert got["texts"] and max(map(len, got["texts"])) <= langid.MAX_FIT_CHARS * 1.01
    long = max(got["texts"], key=len).split()
    assert long[0] == "w0" and any(w in long for w in words[-4000:])   # from all over the text
