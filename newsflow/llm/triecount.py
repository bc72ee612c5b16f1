"""Token counts by unigram segmentation, computed once per shared prefix.

A pre-token (a word with a mark of its beginning) is cut into vocabulary pieces
so that the sum of their scores is largest. The distinct pre-tokens of a run of
documents are the paths of a trie; walked in sorted order, a word keeps the
forward scores of the prefix that it shares with the word before, and only its
own characters are scored. The count at each word's end is its terminal; a
document's count is the sum over its words.

The vocabulary is a public piece file. Its pieces stand in order of frequency,
and a piece's score is the logarithm of Zipf's share for its rank. A character
without a piece is spelled in byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map

BEGIN = "▁"
#: Rows and characters of texts whose words share one trie; a longer text goes alone.
ROWS, CHARS = 512, 1 << 21
#: Words whose counts a worker keeps, and their length at most.
KEPT_WORDS, KEPT_WORD = 500_000, 48


class Pieces:
    """Scores of pieces, the score of a byte, and all ends of pieces."""

    def __init__(self, scores: dict[str, float], byte: float):
        self.scores, self.byte = scores, byte
        self.ends = {p[i:] for p in scores for i in range(len(p))}

    @classmethod
    def from_file(cls, path: str) -> Pieces:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte = {}, 0.0
        for i in range(sp.vocab_size()):
            share = -log(i + 2.0)
            if sp.is_byte(i):
                byte = min(byte, share)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                scores[sp.id_to_piece(i)] = share
        # a spelled character is the last resort: below every piece
        return cls(scores, min(byte, -log(sp.vocab_size() + 2.0)))

    def extend(self, word: str, start: int, best: list[float], count: list[int]) -> None:
        """Forward scores and counts of the prefixes of ``word`` beyond ``start``;
        of equal scores the fewest pieces, then the shortest last piece."""
        scores, ends = self.scores, self.ends
        for e in range(start + 1, len(word) + 1):
            n = len(word[e - 1].encode("utf-8", "surrogatepass"))
            top, least = best[e - 1] + n * self.byte, count[e - 1] + n
            for s in range(e - 1, -1, -1):
                piece = word[s:e]
                if piece not in ends:
                    break
                score = scores.get(piece)
                if score is not None:
                    score += best[s]
                    if score > top or (score == top and count[s] + 1 < least):
                        top, least = score, count[s] + 1
            best.append(top)
            count.append(least)

    def counts(self, words: set[str]) -> dict[str, int]:
        """Pieces of each word: a walk of the trie of all words, prefix before continuation."""
        out, last, best, count = {}, "", [0.0], [0]
        for word in sorted(words):
            full = BEGIN + word
            shared, upto = 0, min(len(last), len(full))
            while shared < upto and last[shared] == full[shared]:
                shared += 1
            del best[shared + 1:], count[shared + 1:]
            self.extend(full, shared, best, count)
            out[word] = count[-1]
            last = full
        return out


def split(text: str | None) -> list[str]:
    """Runs without blank, tab, line and page ends."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()] if text else []


def groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Neighbouring (key, text) rows, bounded in number and in characters."""
    held, size = [], 0
    for k, t in rows:
        n = len(t or "")
        if held and (len(held) >= ROWS or size + n > CHARS):
            yield held
            held, size = [], 0
        held.append((k, t))
        size += n
    if held:
        yield held


def token_counts(docs: DataFrame, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens), one row per row of ``docs``.

    ``pieces`` is the path of a piece file as present on every executor. Null,
    empty and blank texts have no words and no tokens. Null and repeated keys
    keep one row each; other columns are not read. Nothing is shuffled, and a
    worker keeps a bounded number of short words.
    """
    kind = dict(docs.select(F.col(key).alias("k")).dtypes)["k"]

    def count(rows):
        vocabulary, kept = Pieces.from_file(pieces), {}
        for group in groups(rows):
            group = [(k, split(t)) for k, t in group]
            new = {w for _, words in group for w in set(words).difference(kept)}
            if len(kept) + len(new) > KEPT_WORDS:
                kept = {}
                new = {w for _, words in group for w in words}
            kept.update(vocabulary.counts(new))
            for k, words in group:
                yield k, len(words), sum(map(kept.__getitem__, words))
            for w in new:
                if len(w) > KEPT_WORD:
                    del kept[w]

    return arrow_map(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), count,
                     f"doc_id {kind}, n_words long, n_tokens long")
