"""Training-data operators against brute force on small tables with hard rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import bitplane, langid, licences, minhash, ordinal, pareto, subspace, triecount, urltrie, wumanber
from newsflow.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, row string, rid string, k string"


def _words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(60):
        t = _words(rnd, rnd.randint(1, 80))
        rows.append((i, t))
        if i % 3 == 0:
            w = t.split()
            w[len(w) // 2] = "changed"
            rows += [(100 + i, " ".join(w).upper()), (200 + i, t)]
    rows += [(300, None), (301, ""), (302, " \n\t "), (None, "only one"), (None, rows[0][1]), (5, rows[5][1]),
             (303, "x" * 50_000), (304, _words(rnd, 20_000)), (305, rows[0][1]), (305, "another text of the same key here")]
    return spark.createDataFrame([(i, t, None, f"s{j % 3}" if j % 7 else None, "r", "q", "k")
                                  for j, (i, t) in enumerate(rows)], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    ids = np.array([0, 1, 65_536, 49_407, 2 ** 32 - 1] * 7, "<u4")
    assert (bitplane.from_planes(bitplane.to_planes(ids, bits), len(ids), bits) == ids).all()
    data = bitplane.pack_shard(2, 3, 40, [7, None], [30, 5], ids.tobytes(), 8, bits) + bitplane.END_MARK.encode()
    shard = bitplane.Shard(data)
    assert [k for k, _, _ in shard.documents()] == [7, None]
    assert (shard.ids(6, 19) == ids[6:19]).all() and shard.before == 40
    with pytest.raises(ValueError):
        bitplane.Shard(data[:-3])


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_against_the_tokenizer(spark, docs, scratch, bits):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    extra = spark.createDataFrame([(900, "İstanbul ΣΑΣ it's,,, a.b <|endoftext|>. É́ \x1cx  y")],
                                  "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(extra)
    bitplane.encode_to_files(docs, scratch, path, bits=bits, block_ids=64, shard_ids=500)
    tok = Tokenizer.from_file(path)
    want, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
    got = bitplane.read_files(spark, scratch).orderBy("start").collect()
    assert sorted(map(repr, want)) == sorted(repr((r.key, r.n_tokens, r.ids_crc32)) for r in got)
    for r in got:  # starts follow on, in the order of the keys
        assert r.start == start
        start += r.n_tokens
    keys = [r.key for r in got if r.key is not None]
    assert keys == sorted(keys)


def _component(pairs, items):
    root = {i: i for i in items}
    while True:
        new = {i: min([root[i], *(root[j] for p in pairs for j in p if i in p)]) for i in items}
        if new == root:
            return root
        root = new


def test_near_duplicates_against_all_pairs(spark, docs):
    rows = list(enumerate(docs.select("doc_id", "text").collect()))
    sets = {}
    for i, r in rows:
        w = (r.text or "").lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    link = [(i, j) for i in sets for j in sets if i < j and sets[i] and
            100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = _component(link, list(sets))
    least = {}
    for i, r in rows:
        if r.doc_id is not None:
            least[root[i]] = min(least.get(root[i], r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, len(sets[i]), least.get(root[i]), r.doc_id == least.get(root[i])) for i, r in rows), key=repr)
    assert _rows(minhash.near_duplicates(docs, chunk=4)) == want
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.where(F.col("text").rlike(r"\S")).count() == len({
        root[i] for i, r in rows if (r.text or "").strip()})


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(50))


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    v = [(base[i % 12] + rng.normal(scale=0.03 * (i % 5), size=16)).tolist() for i in range(150)]
    rows = [(i, x, None if i % 40 == 9 else i % 2) for i, x in enumerate(v)]
    rows += [(150, None, 0), (151, [0.0] * 16, 0), (152, [float("nan")] * 16, 0), (153, [1.0, None], 0),
             (154, v[0], 0), (155, [3 * x for x in v[0]], 0), (156, [1.0, 2.0], 0), (157, [], 1)]
    ok = {i: np.array(x) / np.linalg.norm(x) for i, x, lab in rows
          if lab is not None and x and None not in x and np.isfinite(x).all() and any(x)}
    lab = {i: y for i, _, y in rows}
    link = [(i, j) for i in ok for j in ok if i < j and lab[i] == lab[j] and len(ok[i]) == len(ok[j])
            and ok[i] @ ok[j] >= 0.98]
    root = _component(link, [i for i, _, _ in rows])
    want = sorted(((i, sum(i in p for p in link), root[i], root[i] == i) for i, _, _ in rows), key=repr)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert _rows(subspace.near_vectors(df)) == want
    assert _rows(subspace.near_vectors(df, cell=4, chunk=3)) == want


def test_passages_against_a_scan(spark, docs):
    texts = [r.text for r in docs.select("text").collect() if r.text and len(r.text.split()) > 30]
    items = [(1, " ".join(texts[0].split()[3:18])), (2, "w1 w2"), (3, None), (None, " ".join(texts[1].split()[:12])),
             (4, "changed"), (5, texts[0]), (6, ""), (2, "w1 w2")]
    df = spark.createDataFrame(items, "item_id long, text string")
    windows = {(tuple(w[i:i + min(10, len(w))]), k) for k, t in items for w in [(t or "").split()]
               for i in range(len(w) - min(10, len(w)) + 1) if w}
    want = []
    for r in docs.collect():
        w, hit, names = (r.text or "").lower().split(), set(), set()
        for p, k in windows:
            for i in range(len(w) - len(p) + 1):
                if w[i] == p[0] and tuple(w[i:i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    names |= {str(k)} - {"None"}
        want.append((r.doc_id, len(w), len(hit), len(names), bool(hit)))
    for rows in (200_000, 7):
        got = wumanber.report(docs, df, block_rows=rows).drop("items_sha256")
        assert _rows(got) == sorted(want, key=repr)
    assert wumanber.decontaminate(docs, df).columns == docs.columns


def test_url_rules(spark):
    rules = spark.createDataFrame([("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
                                   ("x.com", "", "allow"), ("x.com", "", "block"), (None, "/", "block")],
                                  "host string, path string, action string")
    urls = ["http://a.example.org/es/1", "http://EXAMPLE.org/en/123?q", "http://example.org/en/2", "https://org", "https://org/",
            "http://badexample.org/es/", "http://y.x.com#f", None, "no scheme", "http://", "http://x.com/a/b"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    want = ["example.org/es/ block", "example.org/en/1 block", "org/ allow", "None allow", "org/ allow", "org/ allow",
            "x.com block", "None allow", "None allow", "None allow", "x.com block"]
    for n in (100, 2):
        got = urltrie.judge(df, rules, block_rules=n).orderBy("page_id").collect()
        assert [f"{r.rule} {r.verdict}" for r in got] == want
    assert (got[1].host, got[1].path) == ("example.org", "/en/123")


def test_trie_counts_against_all_segmentations():
    p = triecount.Pieces({"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁a": -2.9, "ba": -6.0, "▁ab": -6.1, "bab": -4.0}, -9.0)

    def best(w):
        if not w:
            return 0.0, 0
        cuts = [(p.scores[w[:i]], 1, i) for i in range(1, len(w) + 1) if w[:i] in p.scores]
        n = len(w[0].encode())
        cuts.append((n * p.byte, n, 1))
        found = [(s + b, -(k + c)) for s, k, i in cuts for b, c in [best(w[i:])]]
        top = max(round(s, 9) for s, _ in found)
        return top, -max(k for s, k in found if round(s, 9) == top)

    words = {"a", "ab", "aba", "abab", "babab", "é", "abéa", "bbbb", "aaba", ""}
    assert p.counts(words) == {w: best(triecount.BEGIN + w)[1] for w in words}


def test_mix_takes_near_targets(spark, docs):
    got = pareto.mix(docs).collect()
    assert len(got) == docs.count() and _rows(pareto.mix(docs.repartition(5))) == sorted(map(tuple, got), key=repr)
    assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in got)
    by = {}
    for r in got:
        size, goal, taken = by.get(r.source_size, (0, r.target, 0))
        by[r.source_size] = (max(size, r.size), goal, taken + r.taken)
    assert all(taken <= goal + 1e-6 for _, goal, taken in by.values())
    assert sum(r.copies for r in got) == pareto.mixed(docs).count()
    heavy = pareto.mix(docs.withColumn("w", F.when(F.col("doc_id") == 1, 100.0).otherwise(1.0)), weight="w")
    assert heavy.where("doc_id = 1").first().copies >= 1


def test_targets_share_what_stops(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1000), (None, 1000), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in pareto.targets(df).collect()}
    assert got["a"] == 30 and got["c"] == 0 and abs(sum(got.values()) - 2010) < 1e-6


def test_ordinal_grades_and_licences_and_language(spark):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        t = _words(rnd, 60)
        kind = i % 4
        rows.append((i, "spam " * 60 if kind == 0 else t + " vile vile" if kind == 1 else t, "de" if i % 2 else "en"))
        labels.append((i, int(kind != 0), int(kind == 1)))
    rows = [(i, t.replace("w", "ü") if x == "de" else t, x) for i, t, x in rows]
    hard = [(900, None, None), (901, "", "de"), (None, "12 34", None), (902, "Released under the MIT License.\nword", "en")]
    docs = spark.createDataFrame(rows + hard, "doc_id long, text string, lang string")
    model = ordinal.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in ordinal.judge(docs, model).collect()}
    right = sum(got[i].kept == (i % 4 > 1) for i in range(400))
    assert right >= 390 and not got[900].kept and not got[901].kept
    assert ordinal.keep(docs, None).count() == docs.count() - 2
    lang = {r.doc_id: r for r in langid.predict(docs, langid.train(docs)).collect()}
    held = [r for r in lang.values() if r.held_out and r.doc_id is not None and r.doc_id < 400]
    spoken = [r for r in held if r.doc_id % 4]
    assert spoken and all(r.lang_pred == ("de" if r.doc_id % 2 else "en") for r in spoken)
    assert lang[900].lang_pred == lang[None].lang_pred == "und"
    found = {r.doc_id: r for r in licences.scan(docs, licences.train(docs)).collect()}
    assert found[902].families == "mit" and found[1].families == "" and found[900].n_paragraphs == 0


def test_a_repeated_key_pushes_no_other_out_of_the_fit(spark, monkeypatch):
    rows = [(i, f"text of number {i} " + "ab " * i, "de" if i % 2 else "en") for i in range(40)]
    ids = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    least = ids.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0").orderBy(
        F.xxhash64(F.lit("fit"), "doc_id")).first()
    hot = [(least.doc_id, least.text, least.lang)] * 90 + [(least.doc_id, f"other text {j}", least.lang) for j in range(60)]
    docs = spark.createDataFrame(rows + hot, ids.schema).repartition(4)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = {}
    monkeypatch.setattr(ordinal, "fit", lambda sets, grades: got.update(sets=[s.tobytes() for s in sets], grades=grades))
    monkeypatch.setattr(langid, "fit", lambda texts, langs: got.update(texts=texts, langs=langs))
    for bound in (40, 60):
        ordinal.train(docs, labels, max_fit_rows=bound)
        assert len(got["sets"]) == len(set(got["sets"])) == bound
        assert {ordinal.features(t).tobytes() for i, t, _ in rows if i != least.doc_id} <= set(got["sets"]) and len(set(got["grades"])) == 2
        langid.train(docs, max_fit_rows=bound)
        assert len(got["texts"]) == len(set(got["texts"])) == bound
        assert {t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5 and i != least.doc_id} <= set(got["texts"]) and len(set(got["langs"])) == 2


def test_wrapped_notices_titles_and_other_licences(spark):
    cases = [("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public "
              "License as published by\nthe Free Software Foundation, either version 3", "gpl"),
             ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that", "bsd"),
             ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated", "mit"),
             ("The MIT License (MIT)", "mit"), ("Distributed under the MIT License.", "mit"), ("Apache License, Version 2.0", "apache"),
             ("SPDX-License-Identifier: Apache-2.0", "apache"), ("Licensed under CC BY 4.0", "cc-by"),
             ("SPDX-License-Identifier: MIT\n\nLicensed under the GNU Affero General Public License", "agpl,mit"),
             ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
             ("Licensed under CC BY-ND 4.0", "unknown"), ("Licensed under CC BY-NC-SA 4.0", "unknown"),
             ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "unknown"),
             ("SPDX-License-Identifier: Zlib", "unknown"), ("plain text\nof two lines on public permits", "")]
    rnd = random.Random(5)
    rows = [(i, _words(rnd, 50) + "\n\n" + t) for i, (t, _) in enumerate(cases)] + [(100 + i, _words(rnd, 70)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(docs, licences.train(docs)).collect()}
    assert [(t, got[i].families) for i, (t, _) in enumerate(cases)] == cases
    assert got[8].n_paragraphs == 3 and got[8].paragraphs == 2 and all(got[100 + i].families == "" for i in range(50))


def test_empty_tables(spark, empty, scratch):
    import public_tokenizers
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    bitplane.encode_to_files(empty, scratch, public_tokenizers.path("word_bpe_49k.json"))
    frames = [bitplane.read_files(spark, scratch), minhash.near_duplicates(empty), minhash.deduplicate(empty),
              wumanber.report(empty, items), pareto.mix(empty), pareto.mixed(empty),
              ordinal.judge(empty, ordinal.train(empty, labels)), langid.predict(empty, langid.train(empty)),
              triecount.token_counts(empty, public_tokenizers.path("piece_bpe_32k.model")),
              licences.scan(empty, licences.train(empty))]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_another_tokenizer_encodes_whole_texts():
    import json
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer
    spec = json.load(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8"))
    assert bitplane.splits_at_blanks(spec)
    spec["normalizer"]["normalizers"].pop()   # keeps upper case
    assert not bitplane.splits_at_blanks(spec)
    path = public_tokenizers.path("byte_bpe_50k.json")
    words, tok = bitplane._Words(path), Tokenizer.from_file(path)
    texts = ["Two  blanks, THEN\nmore", "", "x" * 200]
    ids, counts = words.ids(pa.array(texts))
    assert not words.by_pieces and ids.tolist() == [i for t in texts for i in tok.encode(t, add_special_tokens=False).ids]
    assert counts.sum() == len(ids)


def test_kept_pieces_are_bounded(monkeypatch):
    import pyarrow as pa
    import public_tokenizers
    monkeypatch.setattr(bitplane, "KEPT_WORDS", 50)
    monkeypatch.setattr(bitplane, "KEPT_IDS", 400)
    words = bitplane._Words(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(8)
    for _ in range(12):
        texts = [" ".join("".join(rnd.choices("abcDEé,.'!7", k=rnd.randrange(9))) for _ in range(30)), "q" * 100_000, "İ% ŉ. x_y"]
        ids, counts = words.ids(pa.array(texts))
        at = np.concatenate([[0], np.cumsum(counts)])
        for t, a, b in zip(texts, at, at[1:]):
            assert ids[a:b].tolist() == words.tokenizer.encode(t, add_special_tokens=False).ids
        assert max(map(len, words.number)) <= bitplane.KEPT_WORD and words.count < 400
