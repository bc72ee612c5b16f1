"""Noun lemmatization against a lexicon table.

Rule (noun morphology): the word itself and the forms made by each suffix
rule below are candidates; those present in the lexicon count, and the
shortest wins (earlier candidate on ties). With no match the rules are applied
again to the candidates, round after round; with none at all the word stays.
Words in the exception table use only their listed lemmas (plus themselves).

The lexicon is data, not code: by default the training vocabulary, or any
(form) table the caller supplies. Lemmas are computed once per *distinct*
token; only tokens that change are joined back to their rows.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.session import materialize, unstage

# Noun suffix rules (old ending -> new ending) in rule order.
NOUN_RULES = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)


_CAND = "struct<cand:string,path:string,depth:int>"


def _rule_outputs(f):
    """Forms made by one rule application to ``f`` (struct cand, path)."""
    outs = [
        F.when(f["cand"].endswith(old),
               F.struct(F.concat(f["cand"].substr(F.lit(1), F.length(f["cand"]) - F.lit(len(old))),
                                 F.lit(new)).alias("cand"),
                        F.concat(f["path"], F.lit(str(i))).alias("path")))
        for i, (old, new) in enumerate(NOUN_RULES, start=1)
    ]
    return F.filter(F.array(*outs), lambda x: x.isNotNull())


def rule_chains(token, longest: int | None = None) -> Column:
    """Every form reachable from ``token`` by repeated rule application; with
    ``longest`` only those of at most so many characters, so that a long run of
    's' costs no list of long forms that no lexicon holds.

    Array of (cand, path, depth): depth = number of rules applied, path = the
    rule numbers applied in order (so paths of one depth sort in candidate
    order). Only tokens ending in 's' or 'men' have any rule form; the
    whole closure is one higher-order expression per token.
    """
    t = F.col(token) if isinstance(token, str) else token
    init = F.struct(
        F.array(F.struct(t.alias("cand"), F.lit("").alias("path"))).alias("front"),
        F.array().cast(f"array<{_CAND}>").alias("out"))

    def step(acc, d):
        nxt = F.flatten(F.transform(acc["front"], _rule_outputs))
        short = nxt if longest is None else F.filter(nxt, lambda x: F.length(x["cand"]) <= longest)
        return F.struct(
            nxt.alias("front"),
            F.concat(acc["out"], F.transform(short, lambda x: F.struct(
                x["cand"].alias("cand"), x["path"].alias("path"), d.alias("depth")))).alias("out"))

    # a chain continues only through rules that leave a trailing 's', and each
    # such step consumes an 's': depth <= (number of 's' in the token) + 1
    n_s = F.length(t) - F.length(F.regexp_replace(t, "s", ""))
    closure = F.aggregate(F.sequence(F.lit(1), n_s + 1), init, step)["out"]
    return F.when(t.rlike("(s|men)$"), closure).otherwise(F.array().cast(f"array<{_CAND}>"))


def lemma_table(tokens: DataFrame, lexicon: DataFrame,
                exceptions: DataFrame | None = None) -> DataFrame:
    """(token) -> (token, lemma) for every distinct token.

    Round 1 holds the token and its forms by one rule, round k those by k
    rules. The lemma is the lexicon hit of the earliest round, shortest first,
    earlier candidate on ties; a token with no hit keeps its form. Most tokens
    hit in round 1; only the others go through the whole chain of rules.
    ``exceptions`` (form, lemma): such tokens use only their listed lemmas.
    """
    lex = materialize(lexicon.select(F.col(lexicon.columns[0]).alias("cand")).distinct())
    toks = tokens.select(F.col(tokens.columns[0]).alias("token")).distinct()
    own = F.struct(F.col("token").alias("cand"), F.lit("").alias("path"))
    first, listed = F.concat(F.array(own), _rule_outputs(own)), F.lit(False)
    if exceptions is not None:
        exc = exceptions.select(F.col(exceptions.columns[0]).alias("token"),
                                F.col(exceptions.columns[1]).alias("_exc"))
        toks = toks.join(exc.groupBy("token").agg(F.collect_list("_exc").alias("_excs")), "token", "left")
        listed = F.col("_excs").isNotNull()
        first = F.when(listed, F.concat(F.array(own), F.transform("_excs", lambda e, i: F.struct(
            e.alias("cand"), F.format_string("%09d", i + 1).alias("path"))))).otherwise(first)
    order = F.struct(F.length("cand").alias("len"), F.col("path"))
    hits = toks.select("token", listed.alias("listed"), F.inline(first)).join(
        lex.withColumn("_hit", F.lit(True)), "cand", "left")
    best = materialize(hits.groupBy("token").agg(
        F.min_by("cand", F.when(F.col("_hit"), order)).alias("lemma"), F.first("listed").alias("listed")))
    open_ = best.where(F.col("lemma").isNull() & ~F.col("listed") & F.col("token").rlike(RULE_SUFFIX)).select("token")
    longest = lex.agg(F.max(F.length("cand"))).first()[0] or 0
    later = open_.select("token", F.inline(rule_chains("token", longest))).join(lex, "cand")
    later = later.groupBy("token").agg(
        F.min_by("cand", F.struct("depth", F.length("cand").alias("len"), "path")).alias("_later"))
    return best.join(later, "token", "left").select("token", F.coalesce("lemma", "_later", "token").alias("lemma"))


def changed_lemmas(tokens: DataFrame, lexicon: DataFrame,
                   exceptions: DataFrame | None = None) -> DataFrame:
    """(token, lemma) for the tokens whose lemma differs, materialised.

    Without exceptions only tokens with a rule suffix can change, so only
    those go through the rule closure (the lexicon stays complete).
    """
    t = tokens.select(F.col(tokens.columns[0]).alias("token"))
    if exceptions is None:
        t = t.where(F.col("token").rlike(RULE_SUFFIX))
    table = lemma_table(t, lexicon, exceptions)
    changes = lemma_changes(table)
    unstage(table)   # its own staged tables; nothing else reads them
    return changes


def lemma_changes(lemmas: DataFrame) -> DataFrame:
    """Only the tokens whose lemma differs: the map that ``lemmatize_tokens``
    needs (usually a small fraction of the vocabulary), materialised."""
    return materialize(lemmas.where(F.col("token") != F.col("lemma")))


# Without an exception table only tokens with a rule suffix can change.
RULE_SUFFIX = "(s|men)$"


#: Names a row while its tokens are away from it.
ROW_ID = "_row_id"


def with_row_ids(df: DataFrame) -> DataFrame:
    """``df`` staged with a number for each row, so that all its readers see the same one."""
    return materialize(df.withColumn(ROW_ID, F.monotonically_increasing_id()))


def lemmatize_tokens(df: DataFrame, lemmas: DataFrame, tokens: str = "tokens", only: str | None = None) -> DataFrame:
    """Replace every token by its lemma; result tokens distinct and sorted.

    One row out per row in, whatever its columns hold: rows are named by
    ``ROW_ID`` (see ``with_row_ids``; numbered here if they are not yet), so
    repeated or null keys do not matter. Only (row id, token) goes to the join
    with the (token, lemma) map, and only tokens that the map changes come
    back; the row's other columns never pass that shuffle. With ``only`` (a
    regex, e.g. ``RULE_SUFFIX``) just the tokens that can change are sent.
    """
    names = df.columns
    if ROW_ID not in names:
        df = with_row_ids(df)
    toks = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
    sent = F.array_distinct(F.filter(toks, lambda t: t.rlike(only)) if only else toks)
    changes = (df.select(ROW_ID, F.explode(sent).alias("token")).join(lemmas.select("token", "lemma"), "token")
               .groupBy(ROW_ID).agg(F.map_from_entries(F.collect_set(F.struct("token", "lemma"))).alias("_map")))
    new = F.transform(toks, lambda t: F.coalesce(F.col("_map")[t], t))
    merged = F.array_sort(F.array_distinct(F.when(F.col("_map").isNull(), toks).otherwise(new)))
    return (df.join(changes, ROW_ID, "left").withColumn(tokens, merged)
            .select(*[c for c in names if c != ROW_ID]))


def lemma_rows(df: DataFrame, lemmas: DataFrame | None, tokens: str = "tokens") -> DataFrame:
    """``lemmatize_tokens`` in long form: (row id, lemma), for work that takes the lemmas apart again.

    A lemma comes once for each of the row's tokens that have it. ``lemmas`` is a map made
    without exceptions (None: every token is its own lemma), so only tokens with a rule
    suffix go through the join; the others are read straight into the result.
    """
    long = df.select(ROW_ID, F.explode(tokens).alias("token"))
    if lemmas is None:
        return long.withColumnRenamed("token", "lemma")
    may_change = F.col("token").endswith("s") | F.col("token").endswith("men")
    joined = long.where(may_change).join(lemmas.select("token", "lemma"), "token", "left")
    return (long.where(~may_change).withColumnRenamed("token", "lemma")
            .union(joined.select(ROW_ID, F.coalesce("lemma", "token").alias("lemma"))))


#: A lexicon of at most so many forms and characters may be held by every worker.
LOOKUP_FORMS, LOOKUP_CHARS = 1_000_000, 16_000_000


def lemma_of(word: str, known, longest: int) -> str:
    """The lemma of one word, as in ``lemma_table``, with the set ``known`` as the lexicon,
    whose forms have at most ``longest`` characters."""
    form = word
    if len(word) > longest and word.endswith("ss"):
        # one rule fits and takes an s at a time: go to the first form that may be known
        run = len(word) - len(word.rstrip("s"))
        form = word[:len(word) - min(run - 1, len(word) - longest)]
    front, own = [form], [form]
    while front:
        front = [w[:-len(old)] + new for w in front for old, new in NOUN_RULES if w.endswith(old)]
        hits = [w for w in own + front if w in known]
        if hits:
            return min(hits, key=len)
        own = []
    return word


def lemma_lookup(lexicon: DataFrame) -> Callable[[Column], Column] | None:
    """A function that gives the lemmas of an array column of tokens, or None for a lexicon
    over ``LOOKUP_FORMS`` or ``LOOKUP_CHARS``, which takes the joins of ``lemma_table``.

    ``lexicon``: distinct forms in its first column. They are read once and
    broadcast; each Arrow batch looks every distinct token up once.
    """
    form = F.col(lexicon.columns[0])
    size = lexicon.agg(F.count(form).alias("n"), F.coalesce(F.sum(F.length(form)), F.lit(0)).alias("chars")).first()
    if size["n"] > LOOKUP_FORMS or size["chars"] > LOOKUP_CHARS:
        return None
    forms = frozenset(r[0] for r in lexicon.where(form.isNotNull()).collect())
    known = lexicon.sparkSession.sparkContext.broadcast((forms, max(map(len, forms), default=0)))

    @F.arrow_udf("array<string>")
    def lemmas(tokens: pa.Array) -> pa.Array:
        flat = tokens.flatten().dictionary_encode()
        table = pa.array([lemma_of(t, *known.value) for t in flat.dictionary.to_pylist()], pa.string())
        ends = pa.compute.cumulative_sum(pa.compute.list_value_length(tokens)) if len(tokens) else pa.array([], pa.int32())
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
        return pa.ListArray.from_arrays(offsets, table.take(flat.indices))

    return lemmas


def look_up_lemmas(df: DataFrame, lookup: Callable[[Column], Column], tokens: str = "tokens",
                   only: str | None = RULE_SUFFIX) -> DataFrame:
    """``lemmatize_tokens`` as a projection, for batch and streaming frames: distinct sorted
    lemmas in place of ``tokens``. Just the tokens that can change are looked up."""
    own = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
    sent = F.array_distinct(F.filter(own, lambda t: t.rlike(only)) if only else own)
    return (df.withColumn(tokens, own).withColumn("_sent", sent).withColumn("_lemmas", lookup(F.col("_sent")))
            .withColumn("_map", F.map_from_arrays("_sent", "_lemmas"))
            .withColumn(tokens, F.array_sort(F.array_distinct(F.transform(tokens, lambda t: F.coalesce(F.col("_map")[t], t)))))
            .drop("_sent", "_lemmas", "_map"))
