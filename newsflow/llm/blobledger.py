"""Secret scans with an incremental ledger of scanned blobs.

Every version of every text is addressed by its content (its SHA-256, a blob).
A ledger, a Parquet table in a shared folder, records which blob has been
scanned by which version of which rule, with the spans found. A scan takes only
pairs of blob and rule version that the ledger lacks, one text a blob however
many rows carry it, appends what it finds, also that there was nothing, and
joins the findings back to all rows by blob. A changed rule gets a new version,
which is scanned for anew; findings of its older versions no longer count.

Appending goes through Spark's commit protocol, so a scan that fails leaves the
ledger as it was. Two scans at once may both record a pair: findings are read
as sets, so that this changes nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, stage, unstage

SPAN = "struct<start:int,end:int,kind:string,rule:string>"
LEDGER = f"blob binary, rules array<string>, spans array<{SPAN}>"
#: Blobs whose digests (32 bytes and the names of their rules) may be broadcast; beyond it they are shuffled.
BROADCAST_BLOBS = 100_000


@dataclass(frozen=True)
class Rule:
    """A kind of secret: all leftmost non-overlapping matches of ``pattern`` whose
    group ``group`` has at least ``least`` characters. Change ``version`` with any of them."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the base kinds. Greedy runs of one class are cut by
# their least length in the pattern itself: a run's first match is the whole run.
BASE = (
    Rule("assign", 1, r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
                      r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
                      r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
#: Kinds with fixed marks of their own, beside the base ones.
MARKED = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("forge_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MARKED


def find(text: str, rules: tuple[Rule, ...]) -> list[tuple]:
    """(start, end, kind, rule) of every match, in code points, end exclusive."""
    found = []
    for rule in rules:
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), m.end(), rule.kind, rule.name))
    return found


def blob_of(text: Column) -> Column:
    """The address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(blob, rules, spans) recorded under ``path``; empty before the first scan."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rules): the rules whose present version has not scanned a blob yet, if any."""
    done = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("done"))
    wanted = F.array(*[F.lit(r.name) for r in rules])
    left = F.coalesce(F.array_except(wanted, "done"), wanted)
    return blobs.join(done, "blob", "left").select("blob", left.alias("rules")).where(F.size("rules") > 0)


def scan(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings in every whole text of ``docs``, through the ledger under ``path``.

    One row per row: the key, ``blob``, and ``spans``, an array of (start, end,
    kind, rule) by start and then in the order of ``rules``. A null text is an
    empty one and has no spans; repeated rows and keys, also null ones, give a
    row each; other columns are ignored; an empty table gives no row.
    """
    spark = docs.sparkSession
    texts = docs.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = stage(docs.select(F.col(key).alias("key"), blob_of(F.col(text)).alias("blob")), "paths")
    todo = stage(unseen(rows.select("blob").distinct(), read_ledger(spark, path), rules), "unseen")
    if todo.count() <= BROADCAST_BLOBS:
        work = texts.join(F.broadcast(todo), "blob").dropDuplicates(["blob"])
    else:
        work = texts.dropDuplicates(["blob"]).join(todo, "blob")
    by_name = {r.name: r for r in rules}

    def search(rows):
        for blob, names, t in rows:
            yield blob, names, find(t, tuple(by_name[n] for n in names))

    found = arrow_map(work.select("blob", "rules", "text"), _as_structs(search), LEDGER)
    found.write.mode("append").parquet(path)
    unstage(todo)

    wanted = [r.name for r in rules]
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    # one row a blob: as many findings as there were scans of it
    hits = (read_ledger(spark, path)
            .select("blob", F.filter("spans", lambda s: s["rule"].isin(wanted)).alias("spans"))
            .where(F.size("spans") > 0).groupBy("blob")
            .agg(F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans")))
    ordered = F.transform(F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("place"), s.alias("span")))),
        lambda x: x["span"])
    out = rows.join(hits.select("blob", ordered.alias("spans")), "blob", "left")
    return out.select(F.col("key").alias(key), "blob",
                      F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def _as_structs(search):
    """Spans as the mappings that Arrow makes structs of."""
    names = ("start", "end", "kind", "rule")

    def run(rows):
        for blob, rules, spans in search(rows):
            yield blob, rules, [dict(zip(names, s)) for s in spans]

    return run


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))
