"""SQL text for the DuckDB oracle: the same cleaning rules in RE2 / DuckDB SQL.

Only used to state the expected result of each registered query; the engine
itself never runs DuckDB. RE2 has no look-around, so T5 captures the letter
and writes it back, and contractions are split on the token list.
"""

from __future__ import annotations

from newsflow.functions.stopwords import STOP_WORDS
from newsflow.functions.text import CONTRACTIONS

D_SPACE_CLASS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
D_PUNCT = r"[^\p{L}\p{N}_" + D_SPACE_CLASS + r"]"
D_SPACE_RUN = "[" + D_SPACE_CLASS + "]+"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = ", ".join(q(w) for w in STOP_WORDS)


def content(c: str) -> str:
    return f"trim(regexp_replace({c}, ' *\\. *', '.', 'g'))"


def punct_strip(c: str) -> str:
    t5 = f"regexp_replace({c}, {q(D_PUNCT + '([a-zA-Z])')}, ' \\1', 'g')"
    return f"regexp_replace({t5}, {q(D_PUNCT)}, '', 'g')"


def digit_strip(c: str) -> str:
    return f"regexp_replace({c}, '\\p{{Nd}}+', '', 'g')"


def normalize(c: str) -> str:
    return digit_strip(punct_strip(f"lower({c})"))


def tokenize(c: str) -> str:
    raw = (f"list_filter(string_split(regexp_replace({c}, {q(D_SPACE_RUN)}, ' ', 'g'), ' '), "
           f"lambda x: x <> '')")
    cases = " ".join(f"WHEN {q(a + b)} THEN [{q(a)}, {q(b)}]" for a, b in CONTRACTIONS)
    return f"flatten(list_transform({raw}, lambda x: CASE x {cases} ELSE [x] END))"


def drop_stopwords(arr: str) -> str:
    return f"list_filter({arr}, lambda x: x NOT IN ({STOP_LIST}))"


def clean_tokens(text: str) -> str:
    """T1-T9 on a raw text column."""
    return drop_stopwords(tokenize(normalize(content(text))))


def sorted_join(arr: str) -> str:
    """Distinct tokens sorted by code point, joined by one space."""
    return f"array_to_string(list_sort(list_distinct({arr})), ' ')"
