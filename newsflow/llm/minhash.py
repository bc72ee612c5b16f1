"""Near-duplicate texts by circulant MinHash, banding and exact verification.

A text's set is its distinct five-word shingles. Two permutations of a fixed
universe give the whole signature: the first scatters the shingles, the second
is read from that place on, each further coordinate one circular shift later,
so a shingle's values for all coordinates are one slice of a table. Texts that
agree on a band of the signature become candidates; candidates are compared by
their full sets, and links join components.

No stage emits all pairs of a group: equal texts are one class from the first
shuffle on; a band's texts are tied to one of them, never to each other; and a
cluster of candidates is dealt into chunks whose pairs are compared inside
tasks of bounded size that return a spanning forest of the links.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, digest16, stage, unstage
from newsflow.llm.components import components
from newsflow.llm.shingles import mix, shingle_set, words

UNIVERSE = 1 << 20
#: 40 bands of 5 coordinates: a pair of similarity 0.75 is missed with odds of 2 in 100,000.
BANDS, ROWS = 40, 5
#: Texts, and shingles, of a chunk of a cluster.
CHUNK, CHUNK_SHINGLES = 64, 1 << 19


@lru_cache(maxsize=1)
def _permutations(seed: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    first = rng.permutation(UNIVERSE).astype(np.uint32)
    second = rng.permutation(UNIVERSE).astype(np.uint32)
    circle = np.concatenate([second, second[:k - 1]])
    return first, np.lib.stride_tricks.sliding_window_view(circle, k)


def signature(shingles: np.ndarray, k: int = BANDS * ROWS, seed: int = 1) -> np.ndarray:
    """Circulant MinHash: coordinate i is the least second[(first[x] + i) mod universe]."""
    first, slices = _permutations(seed, k)
    at = first[(shingles % np.uint64(UNIVERSE)).astype(np.int64)]
    out = np.full(k, UNIVERSE, np.uint32)
    for i in range(0, len(at), 256):
        np.minimum(out, slices[at[i:i + 256]].min(axis=0), out=out)
    return out


def bands(sig: np.ndarray, n: int = BANDS) -> np.ndarray:
    """One 64-bit hash a band, different between bands."""
    rows = sig.reshape(n, -1).astype(np.uint64)
    h = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(rows.shape[1]):
        h = mix(h + rows[:, j])
    return h.view(np.int64)


def _link(sets: list[np.ndarray], side: np.ndarray, cross: bool, threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``sets``, by exact sizes of their
    intersections; with ``cross`` only pairs of one set of each side count."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, ids, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[ids] > 1  # shingles of one set alone are in no intersection
    owner, ids = owner[shared], ids[shared]
    _, ids = np.unique(ids, return_inverse=True)
    common = np.zeros((n, n), np.float32)
    width = 4096
    order = np.argsort(ids, kind="stable")
    owner, ids = owner[order], ids[order]
    for lo in range(0, int(ids[-1]) + 1 if len(ids) else 0, width):
        i, j = np.searchsorted(ids, [lo, lo + width])
        m = np.zeros((n, width), np.float32)
        m[owner[i:j], ids[i:j] - lo] = 1
        common += m @ m.T
    common = common.astype(np.int64)
    ok = 100 * common >= threshold * (sizes[:, None] + sizes[None, :] - common)
    if cross:
        ok &= side[:, None] != side[None, :]
    root, forest = np.arange(n), []
    for i, j in zip(*np.nonzero(np.triu(ok, 1))):
        a, b = root[i], root[j]
        if a != b:
            root[root == max(a, b)] = min(a, b)
            forest.append((int(i), int(j)))
    return forest


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 75,
                    shingle_words: int = 5, chunk: int = CHUNK, seed: int = 1, row_id: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``;
    on request also rid, a hash of key and text, and the classes of the text and its component.

    Two texts are linked when 100 times their common shingles is at least
    ``threshold`` times all their shingles; component_id is the smallest key
    reachable by links, kept marks the rows that bear it. Texts without words
    (null, empty, blank) have no shingle and no link. Repeated rows keep one
    result each. A null key never becomes a component_id while its component
    has another; alone it gives a null component_id and is kept. Other columns
    of ``docs`` are not read.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                         F.xxhash64(F.col(key).cast("long"), text).alias("rid"))

    def sign(rows):
        for doc_id, t, rid in rows:
            w = words(t)
            s = shingle_set(w, shingle_words)
            if len(s):
                yield doc_id, rid, digest16(b" ".join(w)), len(s), bands(signature(s, seed=seed)).tolist()
            else:
                yield doc_id, rid, None, 0, None

    signed = stage(arrow_map(source.select("doc_id", "text", "rid"), sign,
                             "doc_id long, rid long, cls binary, n long, bands array<long>"), "signed")
    classes = stage(signed.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("least"), F.min("rid").alias("rid"), F.max("n").alias("n"),
        F.first("bands").alias("bands")), "classes")
    banded = classes.select("cls", F.explode("bands").alias("band"))
    hubs = stage(banded.groupBy("band").agg(F.min("cls").alias("hub"), F.count("*").alias("c"))
                 .where("c > 1").select("band", "hub"), "hubs")
    clusters = stage(components(banded.join(hubs, "band").where("cls <> hub")
                                .select(F.col("cls").alias("u"), F.col("hub").alias("v"))), "clusters")
    members = classes.join(clusters.toDF("cls", "cluster"), "cls").select("cls", "cluster", "rid", "n")
    sizes = stage(members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / chunk), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int").alias("chunks")),
        "sizes")
    members = stage(members.join(sizes, "cluster"), "members")

    def sets(rows):
        for t, cls, cluster, chunks in rows:
            w = words(t)
            if digest16(b" ".join(w)) == cls:  # a row id may belong to two texts
                yield cls, cluster, chunks, shingle_set(w, shingle_words).tobytes()

    full = arrow_map(source.select("rid", "text").join(members.drop("n"), "rid")
                     .select("text", "cls", "cluster", "chunks"), sets,
                     "cls binary, cluster binary, chunks int, shingles binary", flush=256)
    # a chunk meets each chunk of its cluster once; the pair names the task
    paired = (full.withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("chunks").cast("long")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select("cluster", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
                      "mine", "cls", "shingles")
              .repartition("cluster", "a", "b").sortWithinPartitions("cluster", "a", "b"))

    def verify(rows):
        for (_, a, b), group in groupby(rows, key=lambda r: r[:3]):
            got = {cls: (mine, raw) for _, _, _, mine, cls, raw in group}  # repeated rows once
            if len(got) < 2:
                continue
            names = list(got)
            side = np.array([mine == b and a != b for mine, _ in got.values()])
            arrays = [np.frombuffer(raw, np.uint64) for _, raw in got.values()]
            for i, j in _link(arrays, side, a != b, threshold):
                yield names[i], names[j]

    linked = components(arrow_map(paired, verify, "u binary, v binary"))
    linked = stage(linked.toDF("cls", "root"), "linked")
    least = classes.select("cls", "least")
    # staged, so that the join below may split a root of very many texts
    roots = stage(linked.join(least, "cls").groupBy("root").agg(F.min("least").alias("component")), "roots")
    labels = stage(least.join(linked.join(roots, "root"), "cls", "left")
                   .select("cls", F.coalesce("component", "least").alias("component"),
                           F.coalesce("root", "cls").alias("root")), "labels")
    unstage(hubs, clusters, sizes, members, linked, roots)
    got = signed.select("doc_id", "cls", "n", "rid").join(labels, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return got.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), *(["rid", "cls", "root"] if row_id else []))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of ``docs`` of each component, columns unchanged: the one with the
    smallest key, of several the one with the smallest hash of its text. Texts
    without words stay, repeated rows of them once."""
    found = near_duplicates(docs, key, text, row_id=True, **how).where("kept")
    # texts without words stand for themselves; two components may have one smallest key
    own = F.coalesce(F.hex("root"), F.col("rid").cast("string"))
    stay = found.groupBy(own, F.col("cls").isNull()).agg(F.min("rid").alias("rid"), F.first("doc_id").alias("of"))
    stay = stage(stay.select("rid", "of").distinct(), "stay")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).cast("long").alias("k"),
                       F.xxhash64(F.col(key).cast("long"), F.col(text)).alias("own"))
    mine = (F.col("own") == F.col("rid")) & F.col("k").eqNullSafe(F.col("of"))
    return rows.join(stay, mine, "left_semi").dropDuplicates(["own", "k"]).select("row.*")
