"""Text cleaning as native Spark column expressions (steps T1-T12).

Every function here maps Column -> Column and compiles to built-in Spark SQL
expressions (regexp_replace, split, filter, array_distinct, ...), so cleaning
runs inside the JVM with no Python per row and no shuffle.

Character classes: Java's ``\\w``/``\\s``/``\\d`` are ASCII-only, while the
cleaning rules are defined on Unicode word / space / digit characters. The
classes below are the Unicode equivalents (letters, numbers and underscore are
word characters; the Unicode separators plus U+001C-U+001F and U+0085 are
spaces; decimal digits are digits).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.stopwords import STOP_WORDS

# --- regex building blocks -------------------------------------------------
SPACE_CLASS = r"\s\x1c-\x1f\x85\p{Z}"
# one punctuation / symbol character: neither a word character nor a space
PUNCT = r"[^\p{L}\p{N}_" + SPACE_CLASS + r"]"
SPACE_RUN = r"[" + SPACE_CLASS + r"]+"
DIGIT_RUN = r"\p{Nd}+"
# a token edge: start/end of string or a space character on that side
_LEFT = r"(?<![^" + SPACE_CLASS + r"])"
_RIGHT = r"(?![^" + SPACE_CLASS + r"])"

# The six whole-token contractions the word tokenizer splits
# once punctuation is gone (token -> two tokens).
CONTRACTIONS = (
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
)
_CONTRACTION_RE = _LEFT + "(" + "|".join(
    f"{a}(?={b}{_RIGHT})" for a, b in CONTRACTIONS) + ")"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- T1-T3 ------------------------------------------------------------------
def sentence_trim(c) -> Column:
    """No blanks (U+0020, no others) around a full stop or at either end.

    One regex pass for the stops and a trim for the ends.
    """
    return F.trim(F.regexp_replace(_col(c), r" *\. *", "."))


# --- T4-T7 ------------------------------------------------------------------
def lower(c) -> Column:
    """T4: Unicode lowercase."""
    return F.lower(_col(c))


def punct_to_space(c) -> Column:
    """T5: a punctuation character directly before an ASCII letter -> space."""
    return F.regexp_replace(_col(c), PUNCT + r"(?=[a-zA-Z])", " ")


def punct_drop(c) -> Column:
    """Remove every remaining punctuation character ('_' is a word char)."""
    return F.regexp_replace(_col(c), PUNCT, "")


def punct_strip(c) -> Column:
    """T5 + T6."""
    return punct_drop(punct_to_space(c))


def digit_strip(c) -> Column:
    """Remove runs of Unicode decimal digits."""
    return F.regexp_replace(_col(c), DIGIT_RUN, "")


# T6 and T7 both delete characters, so one pass deleting either class is equal
# to the two passes in sequence (digits are never punctuation).
_DROP = PUNCT + "|" + DIGIT_RUN


def normalize(c) -> Column:
    """T4-T7 on sentence-trimmed content (T6 and T7 fused into one pass)."""
    return F.regexp_replace(punct_to_space(lower(c)), _DROP, "")


# --- T8 ---------------------------------------------------------------------
def split_contractions(c) -> Column:
    """Insert a space inside the whole-token contractions (cannot -> can not)."""
    return F.regexp_replace(_col(c), _CONTRACTION_RE, "$1 ")


def tokenize(c) -> Column:
    """Whitespace tokenizer plus contraction splits; no empty tokens.

    Input is T7 output, which holds only word and space characters, so token
    boundaries are exactly the space runs.
    """
    return F.array_remove(F.split(split_contractions(c), SPACE_RUN), "")


# --- T9-T12 -----------------------------------------------------------------
def drop_stopwords(tokens) -> Column:
    """Drop English stop words (exact match, duplicates kept).

    The IN list inside the lambda is planned as a hash ``INSET``.
    """
    return F.filter(_col(tokens), lambda x: ~x.isin(*STOP_WORDS))


def distinct_tokens(tokens) -> Column:
    """De-duplicate, first-seen order (deterministic)."""
    return F.array_distinct(_col(tokens))


def join_tokens(tokens) -> Column:
    """Sorted distinct tokens joined by one space (stable output)."""
    return F.array_join(F.sort_array(_col(tokens)), " ")


def clean_tokens(c) -> Column:
    """Raw text -> list of kept tokens (with repeats)."""
    return drop_stopwords(tokenize(normalize(sentence_trim(c))))


def clean_columns(text_col: str = "text", content: str = "content",
                  tokens: str = "tokens") -> dict[str, Column]:
    """T1-T9 + T11 as named columns: ``content`` (T3) and ``tokens``.

    Lemmas (T10) need a lexicon join and are applied by
    ``newsflow.operators.lemma``.
    """
    content_col = sentence_trim(text_col)
    toks = drop_stopwords(tokenize(normalize(content_col)))
    return {content: content_col, tokens: distinct_tokens(toks)}


def terms(tokens) -> Column:
    """Feature terms: tokens of two or more characters (vectorizer rule)."""
    return F.filter(_col(tokens), lambda x: F.length(x) >= 2)
