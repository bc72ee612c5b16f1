"""Ranked lexical search by branch and bound in trees of documents.

Documents are restricted to the terms that some item asks for, and each becomes
the path of its terms from the most frequent one on (an FP-tree): documents with
the same first terms share nodes. Every node knows, over all documents below it,
the largest frequency of each term and the least length norm ``m``; a document's
score grows with the one and falls with the other, so that the score at both
bounds everything below. An item is searched depth first, best child first, and
leaves a subtree out only when its bound is under the item's k-th best score.

A tree holds a bounded block of documents. Spark deals the blocks to tasks, each
gives its best k per item, and the best of these are the result: a document of
the best k of all is among the best k of its block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, letters_lower, stage, unstage, utf8
from newsflow.operators.scoring import top_k_per_group

#: Terms of the items that are searched in one pass over the texts.
PASS_TERMS = 200_000
#: Terms of the items whose documents share one tree: the width of a node's maxima.
TREE_TERMS = 8192
#: Documents, and terms in them, of one tree.
TREE_DOCS = 1 << 15
TREE_POSTINGS = 1 << 22
#: A subtree of at most so many documents is not split further.
LEAF_DOCS = 128

#: Bytes of terms to lower-case, all others to a blank.
_TERM_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in letters_lower)


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order."""
    return utf8(text).translate(_TERM_BYTES).split()


def impact(tf, m):
    """What a term of weight 1 adds to a score; ints or integer arrays."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """The tree of a block of documents.

    ``m`` is a document's norm; ``doc``, ``rank`` and ``tf`` give the document,
    the rank of the term (0: the most frequent) and its frequency for each of
    the block's postings. Nodes are stored parents first; documents are
    renumbered in the order of their paths, so that a node's are a range.
    """

    def __init__(self, m: np.ndarray, doc: np.ndarray, rank: np.ndarray, tf: np.ndarray, width: int):
        by = np.lexsort((rank, doc))
        doc, rank, tf = doc[by], rank[by], tf[by]
        n = len(m)
        at = np.searchsorted(doc, np.arange(n + 1))
        raw = rank.astype(">u4").tobytes()
        paths = [raw[4 * a:4 * b] for a, b in zip(at, at[1:])]
        self.order = np.array(sorted(range(n), key=paths.__getitem__), np.int64)
        length = np.diff(at)[self.order]
        self.at = np.concatenate([[0], np.cumsum(length)])
        take = np.repeat(at[self.order] - self.at[:-1], length) + np.arange(len(doc))
        self.doc = np.repeat(np.arange(n), length)
        self.rank, self.tf, self.m = rank[take], tf[take].astype(np.int64), m[self.order]
        self._grow(n, length)
        self._bounds(width)

    def _grow(self, n: int, length: np.ndarray) -> None:
        """Nodes as ranges of documents with their children."""
        self.low, self.high, self.children, todo = [0], [n], [[]], [(0, 0)]

        def add(parent: int, low: int, high: int, depth: int) -> None:
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            self.children[parent].append(len(self.low) - 1)
            if high - low > LEAF_DOCS and depth >= 0:
                todo.append((len(self.low) - 1, depth))

        while todo:
            node, depth = todo.pop()
            most = max((self.high[node] - self.low[node]) * 7 // 8, LEAF_DOCS)
            left: list[tuple] = []
            right: list[tuple] = []
            big = (self.low[node], self.high[node], depth)
            while big:
                parts = self._parts(*big, length)
                x = max(range(len(parts)), key=lambda i: parts[i][1] - parts[i][0])
                if parts[x][2] >= 0 and parts[x][1] - parts[x][0] > most:
                    # nearly all documents: taken apart in its parent's place
                    left += parts[:x]
                    right += reversed(parts[x + 1:])
                    big = parts[x]
                else:
                    left += parts
                    big = None
            packed = None   # neighbours that are small share a leaf
            for low, high, depth in left + right[::-1]:
                if packed and high - packed[0] <= LEAF_DOCS:
                    packed = (packed[0], high)
                    continue
                if packed:
                    add(node, *packed, -1)
                packed = (low, high) if high - low <= LEAF_DOCS else None
                if not packed:
                    add(node, low, high, depth)
            if packed:
                add(node, *packed, -1)
            if len(self.children[node]) == 1:   # equal paths: nothing was split
                self.children[node] = []

    def _parts(self, low: int, high: int, depth: int, length: np.ndarray) -> list[tuple]:
        """(low, high, depth) of the documents that go apart at the first depth, from
        ``depth`` on, where any do; depth -1 for one range of equal paths."""
        at, size = self.at[low:high], length[low:high]
        while True:
            inside = size > depth
            if not inside.any():
                return [(low, high, -1)]
            term = np.full(high - low, -1, np.int64)
            term[inside] = self.rank[at[inside] + depth]
            depth += 1
            cuts = np.flatnonzero(term[1:] != term[:-1]) + 1 + low
            if len(cuts):
                ends = [low, *cuts.tolist(), high]
                return [(a, b, depth) for a, b in zip(ends, ends[1:])]

    def _bounds(self, width: int) -> None:
        nodes = len(self.low)
        self.most = np.zeros((nodes, width), np.int32)
        self.least = np.zeros(nodes, np.int64)
        for x in range(nodes - 1, -1, -1):
            if self.children[x]:
                self.most[x] = self.most[self.children[x]].max(axis=0)
                self.least[x] = self.least[self.children[x]].min()
            else:
                a, b = self.at[self.low[x]], self.at[self.high[x]]
                np.maximum.at(self.most[x], self.rank[a:b], self.tf[a:b].astype(np.int32))
                self.least[x] = self.m[self.low[x]:self.high[x]].min()

    def best(self, ranks: np.ndarray, weights: np.ndarray, keys: np.ndarray, k: int) -> tuple:
        """(keys, scores) of the k best documents with a score above 0, equal scores by key.

        ``keys`` are the documents' in the order given to the tree. ``visited``
        afterwards is the number of documents that were scored.
        """
        keys = keys[self.order]
        bound = (weights * impact(self.most[:, ranks].astype(np.int64), self.least[:, None])).sum(axis=1)
        weight = np.zeros(self.most.shape[1], np.int64)
        weight[ranks] = weights
        got_key, got = np.empty(0, np.int64), np.empty(0, np.int64)
        todo, self.visited = [0], 0
        while todo:
            x = todo.pop()
            # a document at the bound may still win by its key
            if bound[x] <= 0 or len(got) == k and bound[x] < got[-1]:
                continue
            if self.children[x]:
                todo += sorted(self.children[x], key=bound.__getitem__)
                continue
            low, high = self.low[x], self.high[x]
            self.visited += high - low
            a, b = self.at[low], self.at[high]
            w = weight[self.rank[a:b]]
            hit = np.flatnonzero(w)
            doc = self.doc[a:b][hit]
            score = np.zeros(high - low, np.int64)
            np.add.at(score, doc - low, w[hit] * impact(self.tf[a:b][hit], self.m[doc]))
            new = np.flatnonzero(score > (got[-1] - 1 if len(got) == k else 0))
            if len(new):
                got, got_key = np.concatenate([got, score[new]]), np.concatenate([got_key, keys[low + new]])
                first = np.lexsort((got_key, -got))[:k]
                got, got_key = got[first], got_key[first]
        return got_key, got


def vectors(docs: DataFrame, vocabulary: list[bytes], key: str, text: str) -> DataFrame:
    """(key, n, ids, tfs): the number of terms of each document that has any, and
    those of ``vocabulary`` by number with their frequencies."""
    numbers = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def count(rows):
        number = numbers.value.get
        for k, t in rows:
            found = terms(t)
            if found:
                tf = Counter(map(number, found))
                tf.pop(None, None)
                yield k, len(found), list(tf), list(tf.values())

    return arrow_map(docs.select(F.col(key).cast("long"), F.col(text)), count,
                     "key long, n long, ids array<int>, tfs array<int>")


def _blocks(batches, tree_docs: int) -> Iterator[tuple]:
    """(keys, n, doc, id, tf) arrays of bounded blocks of the rows of ``vectors``; null keys are the largest."""
    held: list[tuple] = []
    docs = postings = 0

    def block():
        keys, n, size, ids, tfs = (np.concatenate(c) for c in zip(*held))
        return keys, n, np.repeat(np.arange(len(n)), size), ids, tfs

    for batch in batches:
        keys = batch.column(0).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        n, ids, tfs = batch.column(1).to_numpy(), batch.column(2), batch.column(3)
        off, ids, tfs = ids.offsets.to_numpy(), ids.values.to_numpy(), tfs.values.to_numpy()
        low = 0
        while low < len(n):
            high = int(np.searchsorted(off, off[low] + TREE_POSTINGS - postings, "right")) - 1
            high = min(max(high, low + 1), low + tree_docs - docs, len(n))
            a, b = off[low], off[high]
            held.append((keys[low:high], n[low:high], np.diff(off[low:high + 1]), ids[a:b], tfs[a:b]))
            docs, postings, low = docs + high - low, postings + int(b - a), high
            if docs >= tree_docs or postings >= TREE_POSTINGS:
                yield block()
                held, docs, postings = [], 0, 0
    if held:
        yield block()


def _groups(items: list[tuple], order: np.ndarray) -> list[tuple]:
    """Items in groups of at most ``TREE_TERMS`` terms: for each the rank of a term in the
    group's trees (-1: not in it), their number, and the items with their terms' ranks."""
    groups, held, seen = [], [], set()
    for no, ids in items:
        if held and len(seen.union(ids)) > TREE_TERMS:
            groups.append((held, seen))
            held, seen = [], set()
        held.append((no, ids))
        seen.update(ids)
    if held:
        groups.append((held, seen))
    out = []
    for held, seen in groups:
        rank = np.full(len(order), -1, np.int32)
        chosen = sorted(seen, key=order.__getitem__)
        rank[chosen] = np.arange(len(chosen))
        out.append((rank, len(chosen), [(no, rank[ids], np.array(ids)) for no, ids in held]))
    return out


def _search(found: DataFrame, items: list[tuple], df: np.ndarray, n_docs: int, n_terms: int, k: int,
            tree_docs: int) -> DataFrame:
    """(no, key, score, part): the best ``k`` documents of each block for each item."""
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], np.int64)
    order = np.empty(len(df), np.int64)
    order[np.argsort(-df, kind="stable")] = np.arange(len(df))
    shared = found.sparkSession.sparkContext.broadcast((_groups(items, order), weight))
    none = np.iinfo(np.int64).max

    def run(batches):
        groups, weight = shared.value
        part = TaskContext.get().partitionId()
        for keys, n, doc, ids, tfs in _blocks(batches, tree_docs):
            m = 10 + (90 * n * n_docs) // n_terms
            rows: list[tuple] = []
            for rank, width, wanted in groups:
                r = rank[ids]
                inside = r >= 0
                # documents without a term of the group have no place in its tree
                have, at = np.unique(doc[inside], return_inverse=True)
                if not len(have):
                    continue
                tree = Tree(m[have], at, r[inside], tfs[inside], width)
                for no, ranks, terms_ in wanted:
                    for key, score in zip(*tree.best(ranks, weight[terms_], keys[have], k)):
                        rows.append((no, None if key == none else int(key), int(score), part))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int32()))], ["no", "key", "score", "part"])

    return (found.select("key", "n", "ids", "tfs").where(F.size("ids") > 0)
            .mapInArrow(run, "no int, key long, score long, part int"))


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", k: int = 10, pass_terms: int = PASS_TERMS,
           tree_docs: int = TREE_DOCS) -> DataFrame:
    """item, rank, document and score of the ``k`` best documents of every item.

    Whole texts count; null and empty ones have no terms, and are no document
    of the statistics. Rows of one item key (null is one too) are one item with
    all their terms; each row of ``docs`` is a document, repeated ones too.
    Equal scores rank by ascending key, nulls last (keys are longs). An item
    without terms, or with none that a document holds, gives no row; neither
    does an empty table. Other columns are ignored. Items are searched in
    passes of about ``pass_terms`` terms over the documents; the broadcast and
    the driver hold the terms of one pass. A tree holds ``tree_docs`` documents at most.
    """
    spark = docs.sparkSession

    def cut(rows):
        for item, t in rows:
            for term in set(terms(t)):
                yield item, term

    asked = arrow_map(items.select(F.col(item_key), F.col(item_text)), cut,
                      f"item {items.schema[item_key].dataType.simpleString()}, term binary")
    asked = stage(asked.distinct(), "items")
    passes = max(1, -(-asked.count() // pass_terms))
    got = None
    for p in range(passes):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == p).groupBy("item").agg(
            F.sort_array(F.collect_list("term")).alias("terms")).collect()
        best = _pass(docs, block, key, text, k, tree_docs)
        if best is not None:
            names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(block)],
                                          f"no int, item {asked.schema['item'].dataType.simpleString()}")
            best = best.join(F.broadcast(names), "no").select("item", "rank", "key", "score")
            got = best if got is None else got.union(best)
    unstage(asked)
    if got is None:
        got = spark.createDataFrame([], f"item {asked.schema['item'].dataType.simpleString()}, "
                                        "rank int, key long, score long")
    return got.toDF(item_key, "rank", key, "score")


def _pass(docs: DataFrame, block: list, key: str, text: str, k: int, tree_docs: int) -> DataFrame | None:
    vocabulary = sorted({bytes(t) for row in block for t in row["terms"]})
    number = {t: i for i, t in enumerate(vocabulary)}
    items = [(no, [number[bytes(t)] for t in row["terms"]]) for no, row in enumerate(block)]
    if not items:
        return None
    found = stage(vectors(docs, vocabulary, key, text), "vectors")
    total = found.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for row in found.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        df[row["id"]] = row["count"]
    best = stage(_search(found, items, df, total["docs"], total["terms"], k, tree_docs), "best")
    unstage(found)
    order = [F.desc("score"), F.asc_nulls_last("key")]
    return top_k_per_group(best, "no", order, k, "part").select("no", "rank", "key", "score")
