"""Text quality as an ordinal grade: cumulative-link regression on hashed text.

Graded ratings (0 worst) are modelled with one weight vector over hashed
features and ordered thresholds, P(grade >= k) = sigmoid(score - threshold k).
Features are the words a text holds, each once, and a few statistics of the
whole text in steps (share of distinct words, of words like the one before, of
capitals, digits and marks, word length), hashed alike. The hash space is 2^31
wide, and only features that tell grades apart in enough fitted texts get a
weight, so a long text does not gather weight by chance. The model gives the expected grade and
the tail probability of the best grade, by which texts are selected.
"""

from __future__ import annotations

import zlib
from itertools import pairwise
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, letters_lower, sampled, utf8

#: Rated texts that the model is fitted on, the least by a hash of the key; a documented bound.
MAX_FIT_ROWS = 12_000
#: A feature gets a weight if so many fitted texts hold it.
LEAST_TEXTS = 4
#: And if their grades differ so much from those of all texts (chi-square).
LEAST_CHI = 25.0
KEPT_WORDS = 500_000
#: Bytes of a word that is kept, at most.
KEPT_WORD = 64

_PART = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in letters_lower)
#: Classes of bytes: 1 capitals, 2 digits, 3 marks of sentences, 4 other marks, 5 line ends.
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[48:58], _CLASS[33:48] = 1, 2, 4
_CLASS[[58, 59, 60, 61, 62, 63, 64, *range(91, 97), *range(123, 127)]] = 4
_CLASS[[ord(c) for c in ".,'-?"]] = 3
_CLASS[10] = 5


#: Hashes of statistics lie above those of words.
STATISTIC = 1 << 31


def _hash(word: bytes) -> int:
    return zlib.crc32(word) >> 1 | (STATISTIC if word[:1] == b"\x01" else 0)


def statistics(raw: bytes, words: list[bytes]) -> list[bytes]:
    """The statistics of a text, each as a name with its step."""
    n, size = max(1, len(words)), max(1, len(raw))
    share = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=6) / size if raw else np.zeros(6)
    distinct = len(set(words)) / n
    same = sum(map(eq, words, words[1:])) / n
    length = min(12, int(np.log2(n)))
    out = [b"\x01distinct %d %d" % (length, int(distinct * 20)), b"\x01same %d" % min(20, int(same * 40)),
           b"\x01word %d" % min(20, int(sum(map(len, words)) / n)), b"\x01length %d" % length]
    for k in range(1, 6):
        out.append(b"\x01class%d %d" % (k, int(min(0.5, share[k]) * 60)))
    return out


def features(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of all features of a text."""
    raw = utf8(text)
    words = raw.translate(_PART).split()
    return np.unique(np.array([_hash(w) for w in {*words, *statistics(raw, words)}], np.int64))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    """Weights of hashed features, ordered thresholds, and the least tail probability to keep."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, cuts: np.ndarray, keep: float = 0.5):
        self.weights = dict(zip(ids.tolist(), weights.tolist()))
        self.cuts, self.keep = cuts, keep
        self._kept: dict[bytes, float] | None = None

    def __getstate__(self):
        return self.__dict__ | {"_kept": None}

    def score(self, text: str | None) -> float:
        """The weights of all the text's features; those of short words met before are kept."""
        raw = utf8(text)
        words = raw.translate(_PART).split()
        if self._kept is None or len(self._kept) > KEPT_WORDS:
            self._kept = {}
        kept, mine = self._kept, set(words)
        new = mine.difference(kept)
        kept.update((w, self.weights.get(_hash(w), 0.0)) for w in new)
        score = (sum(map(kept.__getitem__, mine))
                 + sum(self.weights.get(_hash(s), 0.0) for s in statistics(raw, words)))
        for w in new:
            if len(w) > KEPT_WORD:
                del kept[w]
        return score

    def grades(self, score: float) -> tuple[float, float]:
        """(expected grade, probability of the best grade)."""
        tails = sigmoid(score - self.cuts)
        return float(tails.sum()), float(tails[-1])


def _telling(sets: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Features whose texts differ in grade from all texts, by a chi-square of at
    least ``LEAST_CHI``; with few texts all features."""
    ids, at = np.unique(np.concatenate(sets), return_inverse=True)
    grade_of = np.repeat(y, [len(x) for x in sets])
    share = np.bincount(y) / len(y)
    n = np.bincount(at, minlength=len(ids))
    chi = sum((np.bincount(at[grade_of == g], minlength=len(ids)) - n * q) ** 2 / np.maximum(n * q, 1e-9)
              for g, q in enumerate(share))
    telling = ids[(chi >= LEAST_CHI) & (n >= LEAST_TEXTS)]
    return telling if len(telling) else ids


def fit(sets: list[np.ndarray], grades: list[int], steps: int = 200,
        rate: float = 0.1, seed: int = 9) -> Model | None:
    """Maximum likelihood by Adam on the whole sample; one text in five sets ``keep``.
    None with fewer than two grades.

    A word can only lower the score, so a long text does not make up for a bad
    passage with many ordinary words; statistics count either way.
    """
    y = np.array(grades)
    levels = np.unique(y)
    if len(levels) < 2:
        return None
    y = np.searchsorted(levels, y)
    held = np.arange(len(y)) % 5 == 0
    if len(y) < 50 or len(np.unique(y[~held])) < len(levels):
        held = np.zeros(len(y), bool)
    rows = np.flatnonzero(~held)
    ids = _telling([sets[i] for i in rows], y[rows])

    def matrix(which):
        flat = np.concatenate([np.empty(0, np.int64), *(sets[i] for i in which)])
        own = np.repeat(np.arange(len(which)), [len(sets[i]) for i in which])
        at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
        ok = ids[at] == flat
        return at[ok], own[ok]

    col, own = matrix(rows)
    t, k = y[rows], len(levels)
    weight = (len(rows) / k) / np.bincount(t, minlength=k)[t]
    w, words = np.zeros(len(ids)), ids < STATISTIC
    l2 = np.where(words, 1e-5, 3e-4)
    # thresholds as a first one and the logarithms of the steps to the next
    c = np.r_[-1.0, np.zeros(k - 2)]
    m = [np.zeros_like(w), np.zeros_like(c)]
    v = [np.zeros_like(w), np.zeros_like(c)]
    for step in range(1, steps + 1):
        cuts = np.cumsum(np.r_[c[0], np.exp(c[1:])])
        s = np.bincount(own, w[col], minlength=len(rows))
        tail = np.c_[np.ones(len(s)), sigmoid(s[:, None] - cuts), np.zeros(len(s))]
        here, nxt = tail[np.arange(len(s)), t], tail[np.arange(len(s)), t + 1]
        p = np.maximum(here - nxt, 1e-9)
        d1, d2 = here * (1 - here), nxt * (1 - nxt)
        ds = -weight * (d1 - d2) / p / len(s)
        dcut = np.zeros((len(s), k + 1))
        dcut[np.arange(len(s)), t] += weight * d1 / p / len(s)
        dcut[np.arange(len(s)), t + 1] -= weight * d2 / p / len(s)
        dcut = dcut.sum(axis=0)[1:k]
        gc = np.array([dcut[j:].sum() * (1 if j == 0 else np.exp(c[j])) for j in range(k - 1)])
        for j, (x, g) in enumerate(((w, np.bincount(col, ds[own], minlength=len(w)) + l2 * w), (c, gc))):
            m[j] = 0.9 * m[j] + 0.1 * g
            v[j] = 0.999 * v[j] + 0.001 * g * g
            x -= rate * (m[j] / (1 - 0.9 ** step)) / (np.sqrt(v[j] / (1 - 0.999 ** step)) + 1e-8)
        w[words] = np.minimum(w[words], 0)
    cuts = np.cumsum(np.r_[c[0], np.exp(c[1:])])
    model = Model(ids, w, cuts)
    which = np.flatnonzero(held) if held.any() else rows
    col, own = matrix(which)
    s = np.bincount(own, w[col], minlength=len(which)) - cuts[-1]
    best = y[which] == k - 1
    # the place between two scores that parts best-graded texts from the others with least error
    order = np.argsort(s)
    lost = np.r_[0, np.cumsum(best[order])] / max(1, best.sum())
    left = 1 - np.r_[0, np.cumsum(~best[order])] / max(1, (~best).sum())
    edges = np.r_[s[order][0] - 1, [(a + b) / 2 for a, b in pairwise(s[order])], s[order][-1] + 1]
    cost = 3 * lost + left
    least = np.flatnonzero(cost <= cost.min() + 1e-12)
    # of equally good places the middle one
    model.keep = float(sigmoid((edges[least[0]] + edges[least[-1]]) / 2))
    return model


def grade(quality: Column, toxic: Column) -> Column:
    """0 for bad text, 1 for toxic text of good quality, 2 for good text."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).otherwise(2)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          max_fit_rows: int = MAX_FIT_ROWS) -> Model | None:
    """Fit on at most ``max_fit_rows`` rated texts, chosen by a hash of the key.

    ``labels`` has the key, quality (0 or 1) and toxic (0 or 1). Of several
    ratings of a key the worst counts; a null quality is no rating, a null
    toxic means 0. Rows of a key with the same features count once, and each key
    has a text in the sample before one has two. None if fewer than two grades are present.
    """
    rated = (labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col(key).alias("k")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
             .select("k", grade(F.col("quality"), F.col("toxic")).alias("grade"),
                     F.xxhash64(F.lit("fit"), "k").alias("r")))
    share = max_fit_rows / max(1, rated.count())
    if share < 0.9:
        rated = rated.where(F.pmod("r", F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * share)))
    # at most max_fit_rows rows: bounded, so it may go to every task
    chosen = F.broadcast(rated.orderBy("r").limit(max_fit_rows))
    found = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL").join(chosen, "k")

    def hashed(rows):
        for t, g, r in rows:
            yield r, g, features(t).astype("<u4").tobytes()

    got = sampled(arrow_map(found.select("t", "grade", "r"), hashed, "r long, grade int, ids binary", flush=64),
                  max_fit_rows)
    return fit([np.frombuffer(x["ids"], "<u4").astype(np.int64) for x in got], [x["grade"] for x in got])


def _judged(text: str | None, model: Model | None) -> tuple:
    if not text or not text.strip():
        return 0.0, 0.0, False
    if model is None:
        return None, None, True
    expected, tail = model.grades(model.score(text))
    return expected, tail, tail >= model.keep


def judge(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept), one row per row of ``docs``.

    A null or blank text has grade and probability 0 and is not kept. Without
    a model (no ratings) other texts have null grades and are kept. Null and
    repeated keys keep one row each; other columns are not read.
    """
    kind = dict(docs.select(F.col(key).alias("k")).dtypes)["k"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(rows):
        for k, t in rows:
            yield k, *_judged(t, shared.value)

    return arrow_map(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), each,
                     f"doc_id {kind}, expected_grade double, tail_probability double, kept boolean")


def keep(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model keeps, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches):
        import pyarrow as pa
        for batch in batches:
            ok = [_judged(t, shared.value)[2] for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
