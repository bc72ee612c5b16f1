"""Language of a text: averaged hashed subword embeddings and a linear softmax.

A word's subwords are its runs of one to five UTF-8 bytes, marked at both ends, hashed into a table of embeddings; a text's vector is the
mean over all subwords of all its words, and a linear layer with softmax gives
the language. Embeddings and layer are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled texts; a temperature fitted on
labelled texts outside that sample calibrates the score, and texts under the
score that all but one in a hundred of those reach are marked as rejected.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, crc32_of, sampled, utf8
from newsflow.llm.shingles import mix

BUCKETS, DIM, SIZES = 1 << 16, 16, (1, 2, 3, 4, 5)
#: Labelled texts that the model is fitted on, the least by a hash of the key; a documented bound.
MAX_FIT_ROWS = 6000
KEPT_WORDS = 300_000
#: Bytes of a word whose sums are kept, at most.
KEPT_WORD = 64
#: Characters of a text that the fit takes: all, or as many in even pieces from all over it.
MAX_FIT_CHARS, FIT_PIECE = 8000, 500


#: Words that are cut into subwords at once; bounds the arrays of a large vocabulary.
PORTION = 20_000
#: The same for long words.
LONG_WORDS = 500


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of ``words``, and how many each word has."""
    got = [_portion(words[i:i + PORTION]) for i in range(0, max(1, len(words)), PORTION)]
    return np.concatenate([g for g, _ in got]), np.concatenate([n for _, n in got])


def _portion(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    if not len(buf):
        return np.empty(0, np.int32), np.zeros(len(words), np.int64)
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(buf))
    grams, owner = [], []
    which = np.repeat(np.arange(len(words)), lengths)
    h = np.zeros(len(buf), np.uint64)
    for n in range(1, SIZES[-1] + 1):
        h = h[:len(buf) - n + 1] * np.uint64(0x100000001B3) + buf[n - 1:] + np.uint64(n)
        ok = at[:len(h)] + n <= ends[:len(h)]
        grams.append((mix(h[ok]) % np.uint64(BUCKETS)).astype(np.int32))
        owner.append(which[:len(h)][ok])
    grams, owner = np.concatenate(grams), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return grams[order], np.bincount(owner, minlength=len(words))


def tokens(text: str | None) -> list[bytes]:
    """Words without digits and marks, in lower case."""
    return utf8((text or "").lower()).translate(_PART).split()


_PART = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Model:
    """Class scores of subwords: the product of embeddings and layer, and a bias."""

    def __init__(self, labels: list[str], table: np.ndarray, bias: np.ndarray,
                 temperature: float = 1.0, reject: float = 0.0):
        self.labels, self.table, self.bias = labels, table, bias
        self.temperature, self.reject = temperature, reject
        self._scorer = None

    def __getstate__(self):
        return self.__dict__ | {"_scorer": None}

    def scorer(self):
        """A function from texts to logits that keeps the sums of words it has met."""
        if self._scorer is None:
            self._scorer = self._new_scorer()
        return self._scorer

    def _new_scorer(self):
        kept: dict[bytes, int] = {}
        sums = np.zeros((1024, len(self.labels) + 1))

        def logits(texts: list[str | None]) -> np.ndarray:
            nonlocal sums
            out = np.empty((len(texts), len(self.labels)))
            for k, text in enumerate(texts):
                words = tokens(text)
                long = [w for w in words if len(w) > KEPT_WORD]
                if long:
                    words = [w for w in words if len(w) <= KEPT_WORD]
                if len(kept) > KEPT_WORDS:
                    kept.clear()
                new = list(set(words).difference(kept))
                if new:
                    at = len(kept)
                    if at + len(new) > len(sums):
                        sums = np.vstack([sums, np.zeros((at + len(new) + len(sums), sums.shape[1]))])
                    grams, n = subwords(new)
                    first = np.cumsum(n) - n
                    sums[at:at + len(new), :-1] = np.add.reduceat(self.table[grams], first)
                    sums[at:at + len(new), -1] = n
                    kept.update(zip(new, range(at, at + len(new))))
                total = sums[list(map(kept.__getitem__, words))].sum(axis=0) if words else np.zeros(sums.shape[1])
                for at in range(0, len(long), LONG_WORDS):
                    grams, n = subwords(long[at:at + LONG_WORDS])
                    total = total + np.append(self.table[grams].sum(axis=0), n.sum())
                out[k] = total[:-1] / max(1.0, total[-1]) + self.bias
            return out

        return logits


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = 10, epochs: int = 12, batch: int = 64,
        rate: float = 20.0, piece: int = 60) -> Model:
    """Train on pieces of ``piece`` words; one text in five is kept for calibration."""
    labels = sorted(set(langs))
    rng = np.random.default_rng(seed)
    y = np.array([labels.index(x) for x in langs])
    fitted = np.arange(len(texts)) % 5 != 0 if len(texts) >= 20 else np.ones(len(texts), bool)
    index: dict[bytes, int] = {}
    words = [np.array([index.setdefault(w, len(index)) for w in tokens(t)], np.int32) for t in texts]
    grams, size = subwords(list(index))
    first = np.cumsum(size) - size
    emb = rng.normal(0, 0.1, (DIM, BUCKETS))
    layer, bias = np.zeros((DIM, len(labels))), np.zeros(len(labels))
    rows = np.flatnonzero(fitted & np.array([len(w) > 0 for w in words], bool))
    weight = 1 / np.maximum(1, np.bincount(y[rows], minlength=len(labels)))
    chance = weight[y[rows]] / weight[y[rows]].sum() if len(rows) else None
    steps = epochs * max(1, len(rows) // batch) if len(rows) and len(labels) > 1 else 0
    for step in range(steps):
        pick = rng.choice(rows, batch, p=chance)
        pieces = []
        for i in pick:
            at = rng.integers(max(1, len(words[i]) - piece + 1))
            pieces.append(words[i][at:at + piece])
        # each distinct word of the batch once; ``held`` counts it in each piece
        ids, at = np.unique(np.concatenate(pieces), return_inverse=True)
        own = np.repeat(np.arange(batch), [len(x) for x in pieces])
        held = np.bincount(own * len(ids) + at, minlength=batch * len(ids)).reshape(batch, -1).astype(float)
        n = size[ids]
        flat = grams[np.repeat(first[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        word = np.repeat(np.arange(len(ids)), n)
        sums = np.stack([np.bincount(word, row[flat], len(ids)) for row in emb], axis=1)
        total = (held @ n)[:, None]
        mean = held @ sums / total
        p = softmax(mean @ layer + bias)
        p[np.arange(batch), y[pick]] -= 1
        p /= batch
        lr = rate * (1 - step / steps)
        back = held.T @ (p @ layer.T / total)
        layer -= lr * 0.05 * (mean.T @ p)
        bias -= lr * 0.05 * p.sum(axis=0)
        for row, b in zip(emb, back.T):
            row -= lr * np.bincount(flat, b[word], BUCKETS)
    model = Model(labels, emb.T @ layer, bias)
    held = np.flatnonzero(~fitted) if (~fitted).any() else np.arange(len(texts))
    if len(held) and len(labels) > 1:
        z = model.scorer()([texts[i] for i in held])
        heats = np.geomspace(0.002, 5, 80)
        loss = [-np.log(softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in heats]
        model.temperature = float(heats[int(np.argmin(loss))])
        top = softmax(z / model.temperature)
        right = top.argmax(axis=1) == y[held]
        if right.any():
            model.reject = float(np.quantile(top.max(axis=1)[right], 0.01))
    return model


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          max_fit_rows: int = MAX_FIT_ROWS, folds: int = 5) -> Model | None:
    """Fit on at most ``max_fit_rows`` labelled texts outside fold 0, chosen by a
    hash of the key; None without labelled texts. Equal rows of a key count once,
    and each key has a text in the sample before one has two. Of a text over
    ``MAX_FIT_CHARS`` the fit sees pieces from all over it, so that the driver
    holds at most ``max_fit_rows`` times as many characters."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (crc32_of(F.col(key)) % folds != 0))
    rank = F.xxhash64(F.lit("fit"), F.col(key))
    share = max_fit_rows / max(1, known.select(rank).distinct().count())
    if share < 0.9:  # a little over the bound, then cut to it
        known = known.where(F.pmod(rank, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * share)))
    t, pieces = F.col(text), MAX_FIT_CHARS // FIT_PIECE
    step = (F.length(t) / pieces).cast("int")
    spread = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)),
                                      lambda i: F.substring(t, i * step + 1, F.lit(FIT_PIECE))), " ")
    t = F.when(F.length(t) > MAX_FIT_CHARS, spread).otherwise(t)
    rows = sampled(known.select(rank.alias("r"), t.alias("t"), F.col(lang).alias("l")), max_fit_rows)
    return fit([r["t"] for r in rows], [r["l"] for r in rows]) if rows else None


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text",
            lang: str | None = None, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted), one row per row of ``docs``.

    lang_pred is a learned language, ``und`` for a text that is null or has no
    letter (score 0), or for every text without a model. score is the
    calibrated probability; accepted is false for ``und`` and for scores under
    the model's rejection threshold. held_out tells that the crc32 of the key
    as text is divisible by ``folds``; a null key is not held out. Only the text
    is an input of a prediction; other columns are not read.
    """
    kind = dict(docs.select(F.col(key).alias("k")).dtypes)["k"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(rows):
        model = shared.value  # one object for all tasks of a worker, with its kept words
        logits = model.scorer() if model else None
        for k, held, t in rows:
            if model is None or not has_letter(t):
                yield k, held, "und", 0.0, False
                continue
            p = softmax(logits([t]) / model.temperature)[0]
            best = int(p.argmax())
            yield k, held, model.labels[best], float(p[best]), bool(p[best] >= model.reject)

    held = F.coalesce(crc32_of(F.col(key)) % folds == 0, F.lit(False))
    return arrow_map(docs.select(F.col(key).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text")),
                     each, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")
