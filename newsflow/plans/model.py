"""Train, evaluate, save, load and apply the text classifier.

Features: binary term counts (``CountVectorizer``) scaled by the smoothed idf
``ln((1+n)/(1+df)) + 1`` (Spark's ``IDF`` gives ``ln((1+n)/(1+df))``, so the
scaling vector is its idf plus one, applied by ``ElementwiseProduct``), then
L2-normalised. Classifier: multinomial logistic regression with the penalty
``0.5 * ||w||^2`` on the summed log-loss, i.e. Spark's mean-loss objective
with ``regParam = 1 / n_train`` and no standardization.

The saved artefact is one folder of versions: each has a ``PipelineModel``
(vectorizer, scaling, normaliser, classifier, index-to-label) and the lemma
lexicon as a parquet table; a small table names the versions. Cleaning itself is code (column expressions) and needs no state.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (CountVectorizer, ElementwiseProduct, IDF, IndexToString,
                                Normalizer, StringIndexer)
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions import text as T
from newsflow.operators import metrics as M
from newsflow.operators.clean import clean_text
from newsflow.operators.features import exact_split, is_test, train_test_split
from newsflow.operators.lemma import (RULE_SUFFIX, changed_lemmas, lemma_lookup, lemmatize_tokens, look_up_lemmas,
                                      with_row_ids)
from newsflow.session import materialize


PRED = "prediction_label"

#: The largest size the vectorizer can be given: no term is cut.
VOCABULARY_LIMIT = (1 << 31) - 1
#: One row for each saved version of a model.
VERSION = "name string, saved double, lemmas boolean, key array<string>, text_col string"


@dataclass
class TrainConfig:
    key: str = "doc_id"
    text_col: str = "text"
    label_col: str = "lang"
    seed: int = 42
    test_fraction: float = 0.2
    min_df: float = 1.0
    max_iter: int = 1000
    tol: float = 1e-6
    reg_param: float | None = None     # None -> 1 / n_train
    lemmas: bool = True
    # None: all training rows are fitted. A number bounds the labelled rows of the fit for a caller
    # that wants a smaller one: a hash of key and text takes them after the split and before cleaning
    # (all held-out rows are scored).
    max_fit_rows: int | None = None
    # M1: hold out exactly ceil(test_fraction * n) rows, not the keys of a share of all hashes.
    exact_split: bool = False


@dataclass
class TextModel:
    pipeline: PipelineModel
    lexicon: DataFrame | None          # (form) table for lemmas, None = no lemmas
    key: str | list = "doc_id"
    text_col: str = "text"
    _lookup: list = field(default_factory=list, repr=False, compare=False)

    # ---------------------------------------------------------- scoring
    def lookup(self):
        """The lexicon as a function of a token column, read once; None without a
        lexicon, or for one that is too large for the workers to hold."""
        if self.lexicon is not None and not self._lookup:
            self._lookup.append(lemma_lookup(self.lexicon))
        return self._lookup[0] if self._lookup else None

    @property
    def streams(self) -> bool:
        """Whether scoring is one projection, as a stream needs it."""
        return self.lexicon is None or self.lookup() is not None

    def features_input(self, df: DataFrame) -> DataFrame:
        """Clean (and lemmatize) ``df`` into (key, ..., content, tokens, terms).

        The raw text is dropped after cleaning. Lemmas are looked up in the
        model's lexicon, in the same projection. Only with a lexicon that no
        worker should hold is the cleaned frame staged and joined to it. One
        row out per row in, also where the key repeats or is null.
        """
        c = clean_text(df, self.text_col, processed_col=None).drop(self.text_col)
        lookup = self.lookup()
        if lookup is not None:
            c = look_up_lemmas(c, lookup)
        elif self.lexicon is not None:
            c = with_row_ids(c)
            toks = c.select(F.explode("tokens").alias("token")).distinct()
            c = lemmatize_tokens(c, changed_lemmas(toks, self.lexicon), only=RULE_SUFFIX)
        return c.withColumn("terms", T.terms("tokens"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Score a whole table; adds ``content``, ``tokens``, ``prediction_label``."""
        return self.pipeline.transform(self.features_input(df))

    def score_rows(self, df: DataFrame) -> DataFrame:
        """C1/C2 output: (key..., Content, Predicted Category)."""
        keys = [self.key] if isinstance(self.key, str) else list(self.key)
        return self.transform(df).select(
            *keys, F.col("content").alias("Content"), F.col(PRED).alias("Predicted Category"))

    def score_distinct(self, df: DataFrame) -> DataFrame:
        """C4: one prediction per distinct content (T3), scored once.

        The prediction is a function of the content alone, so rows are
        de-duplicated on it before the lemma join and the model run.
        """
        keyed = df.withColumn("_content", T.sentence_trim(self.text_col))
        return (self.score_rows(keyed.dropDuplicates(["_content"]).drop("_content"))
                .select("Content", "Predicted Category"))

    def with_input(self, key, text_col: str = "text") -> "TextModel":
        """The same fitted model reading another table's key and text columns."""
        return TextModel(self.pipeline, self.lexicon, key, text_col, self._lookup)

    # ---------------------------------------------------------- persistence
    def save(self, path: str) -> None:
        """A fresh folder for pipeline and lexicon, then a row in ``versions``
        that makes it the current one; a save that fails leaves the last one."""
        name, keys = uuid.uuid4().hex, [self.key] if isinstance(self.key, str) else list(self.key)
        self.pipeline.write().save(f"{path}/{name}/pipeline")
        if self.lexicon is not None:
            self.lexicon.write.parquet(f"{path}/{name}/lexicon")
        SparkSession.getActiveSession().createDataFrame(
            [(name, time.time(), self.lexicon is not None, keys, self.text_col)],
            VERSION).coalesce(1).write.mode("append").parquet(f"{path}/versions")

    @classmethod
    def load(cls, spark, path: str, key: str | list | None = None, text_col: str | None = None) -> "TextModel":
        """The version saved last; key and text column are the saved ones unless given."""
        v = spark.read.schema(VERSION).parquet(f"{path}/versions").orderBy(F.desc("saved")).first()
        lexicon = spark.read.parquet(f"{path}/{v.name}/lexicon") if v.lemmas else None
        saved = v.key[0] if len(v.key) == 1 else list(v.key)
        return cls(PipelineModel.load(f"{path}/{v.name}/pipeline"), lexicon, key or saved, text_col or v.text_col)


def prepare(df: DataFrame, cfg: TrainConfig) -> DataFrame:
    """P2 + T13 for training: drop missing text/labels, clean, split flag."""
    base = df.where(F.col(cfg.text_col).isNotNull() & F.col(cfg.label_col).isNotNull())
    c = clean_text(base.select(cfg.key, cfg.text_col, cfg.label_col), cfg.text_col,
                   processed_col=None)
    side = F.lit(False) if cfg.exact_split else is_test(cfg.key, cfg.seed, cfg.test_fraction)
    return c.select(cfg.key, cfg.label_col, "tokens", side.alias("is_test"))


def sides(df: DataFrame, cfg: TrainConfig):
    """M1: (train, test) rows of ``df``."""
    how = exact_split if cfg.exact_split else train_test_split
    return how(df, cfg.key, cfg.seed, cfg.test_fraction)


def usable(df: DataFrame, cfg: TrainConfig) -> DataFrame:
    """(n_rows, n_corrupt, n_no_text, n_no_label, n_used): what training drops, and why.

    A row counts for the first reason that holds; corrupt rows are those that
    the reader put aside in ``_corrupt_record``."""
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in df.columns else F.lit(False)
    no_text, no_label = F.col(cfg.text_col).isNull(), F.col(cfg.label_col).isNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(corrupt).alias("n_corrupt"),
                  F.count_if(~corrupt & no_text).alias("n_no_text"),
                  F.count_if(~corrupt & ~no_text & no_label).alias("n_no_label"),
                  F.count_if(~corrupt & ~no_text & ~no_label).alias("n_used"))


def bounded(df: DataFrame, cfg: TrainConfig) -> DataFrame:
    """At most about ``max_fit_rows`` labelled rows, by a hash of the key and text."""
    df = df.where(F.col(cfg.label_col).isNotNull() & F.col(cfg.text_col).isNotNull())
    if cfg.max_fit_rows is None:
        return df
    share = cfg.max_fit_rows / max(1, df.count())
    if share >= 1:
        return df
    rank = F.pmod(F.xxhash64(cfg.key, cfg.text_col), F.lit(1 << 30))
    return df.where(rank < int(share * (1 << 30)))


def cleaned_rows(df: DataFrame, cfg: TrainConfig):
    """Cleaned, split-flagged training rows (staged, numbered), the lexicon and the lemmas that differ.

    The split comes first: ``max_fit_rows`` bounds the training side only, and
    held-out rows are not read here.
    """
    trn, _ = sides(df, cfg)
    prep = with_row_ids(prepare(bounded(trn, cfg), cfg))  # regex cleaning runs once
    if not cfg.lemmas:
        return prep, None, None
    seen = materialize(prep.select(F.explode("tokens").alias("token")).distinct())
    lexicon = seen.select(F.col("token").alias("form"))
    return prep, lexicon, changed_lemmas(seen, lexicon)


def with_terms(prep: DataFrame, changes: DataFrame | None) -> DataFrame:
    """``cleaned_rows`` with their tokens' lemmas and with ``terms``, staged."""
    if changes is not None:
        prep = lemmatize_tokens(prep, changes, only=RULE_SUFFIX)
    return materialize(prep.withColumn("terms", T.terms("tokens")))


def prepared(df: DataFrame, cfg: TrainConfig):
    """Cleaned, lemmatized, split-flagged training rows (checkpointed) and the lexicon."""
    prep, lexicon, changes = cleaned_rows(df, cfg)
    return with_terms(prep, changes), lexicon


def held_out(df: DataFrame, cfg: TrainConfig) -> DataFrame:
    """(key, text, label) of every labelled row of the test split, however many there are."""
    _, tst = sides(df, cfg)
    return (tst.where(F.col(cfg.text_col).isNotNull() & F.col(cfg.label_col).isNotNull())
            .select(cfg.key, cfg.text_col, cfg.label_col))


def fit_features(trn: DataFrame, cfg: TrainConfig):
    """Vectorizer, idf+1 scaling, normaliser and label indexer fitted on ``trn``.

    Both fits run inside the JVM (the vocabulary never crosses into Python);
    the idf vector comes back in serialized form.
    """
    cv = CountVectorizer(inputCol="terms", outputCol="tf", binary=True,
                         minDF=cfg.min_df, vocabSize=VOCABULARY_LIMIT).fit(trn)
    if len(cv.vocabulary) >= VOCABULARY_LIMIT:
        raise ValueError("the vocabulary reached the vectorizer's limit; lower max_fit_rows")
    idf = IDF(inputCol="tf", outputCol="_idf").fit(cv.transform(trn))
    indexer = StringIndexer(inputCol=cfg.label_col, outputCol="_label_idx",
                            stringOrderType="alphabetAsc").fit(trn)
    weights = idf.idf.toArray() + 1.0
    scale = ElementwiseProduct(scalingVec=DenseVector(weights), inputCol="tf", outputCol="tfidf")
    norm = Normalizer(p=2.0, inputCol="tfidf", outputCol="features")
    return cv, scale, norm, indexer


def feature_frame(trn: DataFrame, stages, extra: list | None = None) -> DataFrame:
    cv, scale, norm, indexer = stages
    out = indexer.transform(norm.transform(scale.transform(cv.transform(trn))))
    return out.select("features", "_label_idx", *(extra or []))


#: Rows of a fit that are worth a task of their own in every iteration.
ROWS_A_TASK = 200


def spread_rows(feats: DataFrame, n: int) -> DataFrame:
    """``n`` rows that are fitted many times, dealt to all cores: what a join coalesced into a
    few partitions would keep the others idle in every iteration. A partition more costs a
    task and one dense gradient, so there are no more than cores, and few for few rows."""
    cores = feats.sparkSession.sparkContext.defaultParallelism
    return feats.repartition(max(1, min(cores, -(-n // ROWS_A_TASK))))


def classifier(cfg: TrainConfig, n_train: int) -> LogisticRegression:
    reg = cfg.reg_param if cfg.reg_param is not None else 1.0 / max(n_train, 1)
    return LogisticRegression(featuresCol="features", labelCol="_label_idx", family="auto",
                              maxIter=cfg.max_iter, tol=cfg.tol, regParam=reg,
                              elasticNetParam=0.0, standardization=False, fitIntercept=True)


def train(df: DataFrame, cfg: TrainConfig | None = None):
    """Clean -> split -> fit features on train -> fit classifier -> evaluate.

    Returns (TextModel, predictions on the whole test split). The cleaned, lemmatized
    training frame is checkpointed once (cuts lineage; every fit below re-reads it) and
    the training features are cached for the iterative optimizer.
    """
    cfg = cfg or TrainConfig()
    trn, lexicon = prepared(df, cfg)
    stages = fit_features(trn, cfg)
    n_train = trn.count()
    feats = spread_rows(feature_frame(trn, stages), n_train).persist()
    lr_model = classifier(cfg, n_train).fit(feats)
    feats.unpersist()
    cv, scale, norm, indexer = stages
    to_label = IndexToString(inputCol="prediction", outputCol=PRED, labels=indexer.labels)
    pipe = PipelineModel(stages=[cv, scale, norm, lr_model, to_label])
    model = TextModel(pipe, lexicon, cfg.key, cfg.text_col)
    preds = model.transform(held_out(df, cfg)).select(
        cfg.key, F.col(cfg.label_col).alias("label"), F.col(PRED).alias("prediction"))
    return model, preds


def evaluate(preds: DataFrame) -> dict[str, DataFrame]:
    """M8-M11 on (label, prediction); the test split is scored once."""
    preds = materialize(preds.select("label", "prediction"))
    return {"accuracy": M.accuracy(preds), "confusion_matrix": M.confusion_matrix(preds),
            "classification_report": M.classification_report(preds)}


def texts_frame(spark, texts: list[str], key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A small list of caller texts as a (key, text) DataFrame."""
    return spark.createDataFrame(list(enumerate(texts)), f"{key} long, {text_col} string")


def predict_rows(model: TextModel, df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """C1's output for every row: (key, Content, Predicted_category). One projection: no
    shuffle, no staged table, and nothing is read but the rows."""
    return model.with_input(key, text_col).score_rows(df).withColumnRenamed("Predicted Category", "Predicted_category")


def predict_text(spark, model: TextModel, text: str) -> dict:
    """One text -> {"Content": cleaned content, "Predicted_category": label}."""
    row = predict_rows(model, texts_frame(spark, [text])).first()
    return {"Content": row["Content"], "Predicted_category": row["Predicted_category"]}
