"""Licence notices in documents by a trained paragraph classifier, in DataFrame operations.

A paragraph ends at a blank line; its wrapped lines are joined, and it is cut at
the ends of its sentences and before licence tags. A sparse multinomial logistic
regression over all one- to three-word runs of such a part says which licence
family it names, or that it names a licence outside the families, or none. What
it says counts if its probability reaches a least one, calibrated on parts that
were not fitted, and if a comparison with the family's templates confirms it:
the part must hold most of one of them. A part that names some licence, but no
family for sure, is reported as ``unknown``.

Parts without any word that a licence notice needs are left out before they are
cut into words. One narrow shuffle brings a document's parts together again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import stage, unstage

NONE, UNKNOWN = "none", "unknown"
# Names by which texts call their licences, in words of letters.
NAMES = {
    "agpl": ["gnu affero general public license", "affero general public license", "gnu agpl", "agpl"],
    "apache": ["apache license", "apache software license", "apache"],
    "bsd": ["bsd license", "bsd clause license", "bsd clause", "bsd"],
    "cc-by": ["creative commons attribution license", "creative commons attribution international license",
              "creative commons attribution", "cc by"],
    "cc-by-nc": ["creative commons attribution noncommercial license", "creative commons attribution noncommercial",
                 "creative commons attribution noncommercial international license", "cc by nc"],
    "cc-by-sa": ["creative commons attribution sharealike license", "creative commons attribution sharealike",
                 "creative commons attribution sharealike international license", "cc by sa"],
    "cc0": ["cc zero", "creative commons zero", "creative commons cc zero license", "cc zero universal"],
    "gpl": ["gnu general public license", "gnu gpl", "gpl", "gplv"],
    "lgpl": ["gnu lesser general public license", "gnu lgpl", "lgpl", "lgplv"],
    "mit": ["mit license", "mit"],
    "mpl": ["mozilla public license", "mpl"],
}
OTHER_NAMES = [
    "eclipse public license", "unlicense", "boost software license", "artistic license", "zlib license", "isc license",
    "microsoft public license", "european union public license", "gnu free documentation license", "mit zero license",
    "academic free license", "open software license", "common development and distribution license", "python license",
    "creative commons attribution noderivatives license", "creative commons attribution noncommercial sharealike license",
    "creative commons attribution noncommercial noderivatives license", "cc by nd", "cc by nc sa", "cc by nc nd",
    "creative commons attribution noncommercial sharealike international license", "server side public license",
    "creative commons attribution noderivatives international license", "open database license", "mit zero",
    "creative commons attribution noncommercial noderivatives international license", "university open license",
    "creative commons attribution noncommercial sharealike", "creative commons attribution noderivatives",
    "creative commons attribution noncommercial noderivatives", "business source license", "public license of the city"]
#: Sentences of licence texts that name no licence, and say it all the same.
SENTENCES = {
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted"],
    "cc0": ["dedicated to the public domain", "released into the public domain"],
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software"],
    UNKNOWN: ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
}
#: What stands before and behind a name.
LEADS = ["licensed under", "licensed under the", "released under", "released under the", "distributed under",
         "distributed under the", "published under", "published under the", "covered by the", "available under the",
         "this work is licensed under", "this work is licensed under the", "this work is licensed under a",
         "subject to the terms of the", "under the terms of the", "spdx license identifier", "license", "the", "",
         "this program is free software you can redistribute it and or modify it under the terms of the"]
TAILS = ["", "version", "version or any later version", "only", "as published by the foundation"]
#: Leads that make a licence of any name.
WHOLE = LEADS[:16]
# Words of licences in sentences that name none.
NO_LICENCE = [
    "he was licensed under the state rules to drive a bus", "the doctor is licensed to practice in this state",
    "the plates and the driver license were lost", "a fishing license costs ten a year", "the bar lost its license",
    "permission is hereby denied", "permission to land was granted by the tower", "the apache helicopter landed",
    "the apache people live in the south", "she studied at mit and worked for the general public", "mit der bahn nach hause",
    "a license to print money", "under the terms of the contract the tenant pays", "under the terms of the treaty",
    "the creative commons room is open to the public", "the general public was not admitted", "public domain records are kept",
    "licensed under section four of the act", "they are licensed under the gaming act", "covered by the insurance",
    "published under the name of his brother", "released under the cover of night", "released under bail",
    "distributed under the tables", "available under the counter", "subject to the terms of the sale", "the version of the story",
    "license fees are due", "his pilot license was renewed", "no license is needed for the boat", "licensed premises only",
    "a software license agreement must be signed", "licensed under the trade rules", "licensed under the rules of the guild"]
#: Words of which every notice holds one: no template of any class is without, however its words are parted.
STEMS = (r"licen[cs]|(?<![a-z])spdx|public[^a-z]+domain|permission[^a-z]+(is|to)|redistribut|creative[^a-z]+commons"
         r"|(?<![a-z])cc[^a-z]*(by|zero|0)|(?<![a-z])mit([^a-z]+zero|-?0)|(?<![a-z])[al]?gplv?|(?<![a-z])(bsd|mpl)(?![a-z])"
         r"|general[^a-z]+public|(releas|distribut)ed[^a-z]+under"
         r"|(?<![a-z])(under|by)[^a-z]+(the[^a-z]+)?(mit|apache)(?![a-z])")
#: Documents whose paragraphs may serve as examples of no licence; a documented bound on the fit.
MAX_FIT_DOCS = 4000
#: Share of a template's runs that a part must hold.
LEAST_SHARE = 0.8
#: Share of parts that name no family and may pass the least probability.
FALSE_SHARE = 0.001
CLASSES = [NONE, UNKNOWN, *sorted(NAMES)]
PARTS = "array<struct<at:int,words:array<string>>>"


def runs(words: list[str]) -> list[str]:
    """Distinct runs of one to three words."""
    return sorted({" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)})


def template_runs(template: str) -> list[str]:
    """What a template is compared by: its runs of two and three words, or its only word."""
    words = template.split()
    return [r for r in runs(words) if " " in r] or words


def templates(name: str) -> list[list[str]]:
    """The templates of a class; of ``unknown`` also the general ones."""
    if name == UNKNOWN:
        own = OTHER_NAMES + SENTENCES[UNKNOWN] + [x for x in WHOLE if x.startswith(("licensed", "released", "distributed", "spdx"))]
    else:
        # a word that is more than a licence's name counts only behind a lead
        bare = [n for n in NAMES.get(name, ()) if n not in ("mit", "apache", "bsd", "mpl")]
        own = bare + SENTENCES.get(name, []) + [f"{x} {n}" for n in NAMES.get(name, ()) if n not in bare
                                                for x in ("under", "under the", "license identifier", "by the")]
    return [template_runs(t) for t in dict.fromkeys(own)]


def examples() -> list[tuple[str, str, bool]]:
    """(text, class, whether to fit it or to calibrate on it) of made-up notices and of sentences that are none."""
    out = []
    for f, names in [*NAMES.items(), (UNKNOWN, OTHER_NAMES)]:
        for i, n in enumerate(names):
            for j, lead in enumerate(LEADS):
                if lead in ("", "the") and n in ("mit", "apache", "bsd", "mpl"):
                    continue   # a word alone is no notice
                for k, tail in enumerate(TAILS):
                    # a fifth of the wordings is kept from the fit, and every third other licence as a whole,
                    # but for those whose names hold a family's
                    unseen = f == UNKNOWN and i % 3 == 2 and not n.startswith(("cc", "creative", "mit"))
                    out.append((f"{lead} {n} {tail}".strip(), f, not unseen and (i + j + k) % 5 != 4))
    out += [(t, f, True) for f, ts in SENTENCES.items() for t in ts]
    out += [(t, NONE, i % 4 != 3) for i, t in enumerate(NO_LICENCE)]
    out += [(" ".join(t.split()[:n]), NONE, True) for t in LEADS if "spdx" not in t for n in range(1, len(t.split()) + 1)]
    return out


def _words(part: Column) -> Column:
    low = F.lower(part)
    for pattern, to in ((r"\b(cc|mit)-?0\b", "$1 zero"), (r"\blicence", "license"), (r"non[- ]?commercial", "noncommercial"),
                        (r"share[- ]?alike", "sharealike"), (r"no[- ]?deriv(ative)?s?\b", "noderivatives")):
        low = F.regexp_replace(low, pattern, to)
    return F.filter(F.split(F.regexp_replace(low, "[^a-z]+", " "), " "), lambda w: w != "")


def _split(text: Column) -> Column:
    return F.split(text, r"\r?\n[^\S\n]*\n\s*")


def _parts(text: Column) -> Column:
    """(paragraph, words) of the parts that may hold a notice."""
    some = F.filter(F.transform(_split(text), lambda p, i: F.struct(i.alias("at"), p.alias("p"))),
                    lambda x: F.lower(x["p"]).rlike(STEMS))
    cut = F.flatten(F.transform(some, lambda x: F.transform(
        F.split(x["p"], r"(?<=[.!?])\s+(?=[^a-z\s])|\n(?=[^\n]*SPDX-)"), lambda s: F.struct(x["at"].alias("at"), s.alias("s")))))
    cut = F.filter(cut, lambda x: F.lower(x["s"]).rlike(STEMS))
    return F.transform(cut, lambda x: F.struct(x["at"].alias("at"), _words(x["s"]).alias("words")))


def _runs(words: Column) -> Column:
    """``runs`` as a column; ``words`` is evaluated once."""
    def of(w, n):
        last = F.size(w) - (n - 1)
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                            lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(
            F.array().cast("array<string>"))
    return F.transform(F.array(words), lambda w: F.array_distinct(F.concat(w, of(w, 2), of(w, 3))))[0]


@dataclass
class Model:
    """Vocabulary of runs, weights by class, and the least probability of a family that counts."""

    vocabulary: CountVectorizerModel
    weights: LogisticRegressionModel
    least: float = 0.5

    def probabilities(self, df: DataFrame) -> DataFrame:
        """``df`` (``runs``) with ``p``, one probability a class."""
        names = [c for c in df.columns]
        got = self.weights.transform(self.vocabulary.transform(df))
        return got.select(*names, vector_to_array("probability").alias("p"))

    def judged(self, df: DataFrame) -> DataFrame:
        """``df`` (``runs``) with ``family`` (null: no licence) and its ``probability``."""
        scored = self.probabilities(df)
        names = F.array(*[F.lit(c) for c in CLASSES])
        held = F.array(*[F.array(*[F.array(*[F.lit(r) for r in t]) for t in templates(c)]) if c != NONE
                         else F.array().cast("array<array<string>>") for c in CLASSES])

        def confirmed(k):
            return F.exists(held[k], lambda t: F.size(F.array_intersect(t, F.col("runs"))) >= LEAST_SHARE * F.size(t))

        of_families = F.slice("p", 3, len(CLASSES) - 2)
        scored = scored.withColumn("best", F.array_max(of_families)).withColumn(
            "k", F.array_position(of_families, F.col("best")).cast("int") + 1)
        licensed = F.col("p")[0] < 0.5
        family = F.when(licensed & (F.col("best") >= self.least) & confirmed(F.col("k")), names[F.col("k")]).when(
            licensed & (confirmed(F.lit(1)) | confirmed(F.col("k"))), F.lit(UNKNOWN))
        return scored.withColumn("family", family).withColumn(
            "probability", F.when(family == UNKNOWN, 1 - F.col("p")[0]).when(family.isNotNull(), F.col("best"))
        ).drop("p", "best", "k")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", max_fit_docs: int = MAX_FIT_DOCS,
          given: list[tuple[str, str, bool]] | None = None) -> Model:
    """Fit on made-up notices of every class (``examples``) and on sentences of at most about
    ``max_fit_docs`` documents, chosen by a hash of the key, as examples of none.

    A sentence of a document that a template of any class confirms is left out, for it may
    well be a notice. A fifth of all examples and sentences is kept from the fit: the least
    probability is that which all but ``FALSE_SHARE`` of those without a family stay under.
    """
    spark = docs.sparkSession
    rows = spark.createDataFrame([(runs(t.split()), float(CLASSES.index(c)), fit) for t, c, fit in given or examples()],
                                 "runs array<string>, label double, fit boolean")
    share = max_fit_docs / max(1, docs.count())
    some = docs.where(F.col(text).isNotNull() & (F.pmod(F.xxhash64(F.lit("fit"), F.col(key)), F.lit(1 << 30))
                                                 < int((1 << 30) * min(1.0, share))))
    sentences = some.select(F.explode(F.split(F.col(text), r"(?<=[.!?])\s+|\r?\n")).alias("s"))
    # of a document's plain sentences a tenth will do; all that hold a word of a notice are taken
    sentences = sentences.where(F.lower("s").rlike(STEMS) | (F.pmod(F.xxhash64("s"), F.lit(10)) == 0))
    corpus = sentences.select(_runs(_words(F.col("s"))).alias("runs"), F.xxhash64("s").alias("h")).where(F.size("runs") > 0)
    notices = F.array(*[F.array(*[F.lit(r) for r in t]) for c in CLASSES[1:] for t in templates(c)])
    named = F.exists(notices, lambda t: F.size(F.array_intersect(t, F.col("runs"))) >= LEAST_SHARE * F.size(t))
    corpus = corpus.where(~named).select("runs", F.lit(0.0).alias("label"), (F.pmod("h", F.lit(5)) != 4).alias("fit"))
    every = stage(rows.union(corpus), "examples")
    fit = every.where("fit")
    vocabulary = CountVectorizer(inputCol="runs", outputCol="features", binary=True, minDF=2, vocabSize=1 << 16).fit(fit)
    weights = LogisticRegression(family="multinomial", regParam=5e-5, elasticNetParam=0.9, maxIter=150, tol=1e-5,
                                 standardization=False).fit(vocabulary.transform(fit))
    model = Model(vocabulary, weights)
    spare = model.probabilities(every.where("NOT fit AND label < 2").select("runs"))
    edge = spare.agg(F.percentile(F.array_max(F.slice("p", 3, len(CLASSES) - 2)), 1 - FALSE_SHARE)).first()[0]
    model.least = max(0.5, edge or 0.0)
    unstage(every)
    return model


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, families, paragraphs, probability), one row per row of ``docs``.

    families are the confirmed families, ``unknown`` for a licence of another one,
    sorted and joined by commas (empty: none); a part of a paragraph names one.
    paragraphs counts their paragraphs, probability is the greatest of them
    (null: none). A null text has no paragraph, an empty one has one. Null and
    repeated keys keep one row each; other columns are not read; an empty table
    gives no row.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.greatest(F.coalesce(F.size(_split(F.col(text))), F.lit(0)), F.lit(0)).alias("n"),
                       F.coalesce(_parts(F.col(text)), F.lit([]).cast(PARTS)).alias("parts"))
    # a document without a part stays as one row without words
    parts = rows.select("doc_id", "row", "n", F.explode_outer("parts").alias("x")).select(
        "doc_id", "row", "n", F.col("x.at").alias("at"),
        F.coalesce(_runs(F.col("x.words")), F.array().cast("array<string>")).alias("runs"))
    judged = model.judged(parts)
    found = F.col("family").isNotNull()
    # one row a part: a document's families are at most the classes
    return judged.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n").cast("long").alias("n_paragraphs"),
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
        F.count_distinct(F.when(found, F.col("at"))).alias("paragraphs"),
        F.max("probability").alias("probability")).drop("row")
