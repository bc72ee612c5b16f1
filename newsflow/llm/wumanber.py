"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

Patterns are the benchmark items' windows of consecutive words. A block is a
pair of words. The shift table holds, for every block of a pattern, how far the
search may move when it meets that block, and a block of no pattern lets it
move past it, so most words of a clean document are never looked at. Where the
shift is zero, the bucket of that suffix block and of the block at the
window's start holds the patterns to compare word by word.

The patterns of one length form one table; items shorter than a window are one
pattern of their own length. Pattern sets beyond ``block_rows`` are searched in
blocks, one pass over the documents each, and broadcast one block at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.common import arrow_map, letters_lower, stage, utf8

#: All bytes but 0-9, a-z and those of non-ASCII characters part words.
_TABLE = bytes(c if chr(c).isdigit() or 97 <= c <= 122 or c >= 128 else 32
               for c in letters_lower)
#: (window, item) rows that are broadcast at once.
BLOCK_ROWS = 200_000

HITS = "array<struct<start:bigint,stop:bigint>>"


def words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_TABLE).split()


class Search:
    """Shift and bucket tables of patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple, list]):
        self.m, self.far = length, max(1, length - 1)
        self.shift: dict = {}
        self.buckets: dict = {}
        for p, items in patterns.items():
            for end in range(min(2, length) - 1, length):
                block = p[end - 1:end + 1] if length > 1 else p
                self.shift[block] = min(self.shift.get(block, self.far), length - 1 - end)
            suffix = p[-2:]
            self.buckets.setdefault((suffix, p[:2]), []).append((p, items))

    def find(self, w: list[bytes]):
        """(start, items) of every occurrence in the words ``w``."""
        m, n, far, shift, buckets = self.m, len(w), self.far, self.shift, self.buckets
        i = m - 1
        if m == 1:
            for i, x in enumerate(w):
                if (x,) in shift:
                    yield i, buckets[((x,), (x,))][0][1]
            return
        get = shift.get
        while i < n:
            block = (w[i - 1], w[i])
            step = get(block, far)
            if step:
                i += step
                continue
            start = i - m + 1
            bucket = buckets.get((block, (w[start], w[start + 1])))
            if bucket:
                window = tuple(w[start:i + 1])
                for p, items in bucket:
                    if p == window:
                        yield start, items
                        break
            i += 1


def merged(spans) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined, in order."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = 10) -> DataFrame:
    """(words, item): each distinct window of each item; null texts have none."""
    def cut(rows):
        for item, t in rows:
            w = words(t)
            k = min(window, len(w))
            for p in {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else ():
                yield b" ".join(p).decode("utf-8", "surrogatepass"), item

    return arrow_map(items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
                     .select("item", "text"),
                     lambda rows: cut(rows), "words string, item string").distinct()


def find_passages(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", window: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with four columns more, prefixed ``wm_``: n_words, spans (merged
    word ranges that lie inside an occurrence), found (sorted distinct items as
    strings) and n_hit.

    Null and empty texts have no words and no hit. Items without words are
    never found; items with a null key mark words but are not listed. Columns
    of ``docs`` with these names are replaced, all others are kept.
    """
    rows = stage(windows(items, item_key, item_text, window), "windows")
    blocks = max(1, -(-rows.count() // block_rows))
    docs = docs.drop("wm_n_words", "wm_spans", "wm_found", "wm_n_hit")
    found = docs
    for b in range(blocks):
        # one block of the windows, of about block_rows rows
        block = rows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).collect()
        found = _pass(found, text, block, first=b == 0)
        if b + 1 < blocks:
            found = stage(found, "hits")
    return found


def _pass(docs: DataFrame, text: str, block: list, first: bool) -> DataFrame:
    by_length: dict[int, dict] = {}
    for row in block:
        p = tuple(row["words"].encode("utf-8", "surrogatepass").split(b" "))
        by_length.setdefault(len(p), {}).setdefault(p, []).append(row["item"])
    tables = docs.sparkSession.sparkContext.broadcast([Search(n, p) for n, p in by_length.items()])
    extra = [T.StructField("wm_n_words", T.LongType()), T.StructField("wm_spans", T._parse_datatype_string(HITS)),
             T.StructField("wm_found", T.ArrayType(T.StringType())), T.StructField("wm_n_hit", T.LongType())]
    schema = T.StructType([f for f in docs.schema.fields if not f.name.startswith("wm_")] + extra)
    if first:
        docs = docs.withColumns({"wm_n_words": F.lit(None).cast("long"), "wm_spans": F.lit(None).cast(HITS),
                                 "wm_found": F.lit(None).cast("array<string>"), "wm_n_hit": F.lit(None).cast("long")})

    def search(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            cols: dict[str, list] = {f.name: [] for f in extra}
            before = zip(batch.column("wm_spans").to_pylist(), batch.column("wm_found").to_pylist())
            for t, (spans, names) in zip(batch.column(text).to_pylist(), before):
                w = words(t)
                hits = [(x["start"], x["stop"]) for x in spans or ()]
                seen = set(names or ())
                for table in tables.value:
                    for start, items in table.find(w):
                        hits.append((start, start + table.m))
                        seen.update(items)
                seen.discard(None)
                hits = merged(hits)
                cols["wm_n_words"].append(len(w))
                cols["wm_spans"].append([{"start": a, "stop": b} for a, b in hits])
                cols["wm_found"].append(sorted(seen, key=lambda x: x.encode("utf-8", "surrogatepass")))
                cols["wm_n_hit"].append(sum(b - a for a, b in hits))
            kept = [batch.column(f.name) for f in schema.fields if not f.name.startswith("wm_")]
            yield pa.record_batch([*kept, *(pa.array(v, arrow.field(k).type) for k, v in cols.items())],
                                  schema=arrow)

    return docs.select(*[f.name for f in schema.fields]).mapInArrow(search, schema)


def decontaminate(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, columns unchanged, also
    those whose names the search uses itself. Null and empty texts stay; each of
    repeated rows is judged alike."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    of = docs.columns.index(how.pop("text", "text"))
    found = find_passages(docs.toDF(*names), items, text=names[of], **how)
    return found.where("wm_n_hit = 0").select(*names).toDF(*docs.columns)


def report(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_passages(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), items,
                          text="text", **how)
    return found.select(
        "doc_id", F.col("wm_n_words").alias("n_words"), F.col("wm_n_hit").alias("n_hit"),
        F.size("wm_found").cast("long").alias("n_items"),
        F.sha2(F.array_join("wm_found", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("wm_n_hit") > 0).alias("contaminated"))

