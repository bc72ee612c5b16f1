"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors at cosine c are at squared distance 2 - 2c. Vectors are rotated
and cut into blocks of few dimensions; if two are within the distance, then in
at least one block they are within that block's share of it. Each block is
joined by range: a grid over its first dimensions, with cells twice as wide as
the block's reach, where a vector visits the cells its reach touches. The
candidates' union is verified exactly in double precision, and a pair counts in
the first block that finds it, so nothing is counted twice.

Equal vectors are one class from the first shuffle on. A cell is dealt into
chunks whose pairs are compared inside tasks of bounded size; these return sums
of links and a spanning forest, not pairs.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, digest16, stage, unstage
from newsflow.llm.components import components

BLOCKS = 8
#: Grid dimensions are added until cells hold about so many vectors of a label.
CELL = 4000
#: Vectors of a chunk of a cell.
CHUNK = 1024


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = 3) -> np.ndarray:
    """A random rotation, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vector) -> np.ndarray | None:
    """The vector at length 1, or None if it is null, empty, zero or not finite."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    v = np.array(vector, np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top  # no overflow or underflow of the squares
    return v / np.sqrt(v @ v)


def _edges(dim: int, blocks: int) -> list[tuple[int, int]]:
    """Begin and end of each block of dimensions."""
    at = np.linspace(0, dim, min(blocks, dim) + 1).astype(int)
    return list(zip(at[:-1].tolist(), at[1:].tolist()))


def homes(r: np.ndarray, dims: int, reach: float) -> tuple[list[int], list[list[int]]]:
    """The home cell of a block's coordinates, and all cells that it is put in: per
    dimension its own and, if the reach touches it, the one below. Two vectors
    within reach meet in the cell at the lower corner of both homes."""
    side = 2 * reach
    home = np.floor(r[:dims] / side).astype(int)
    low = r[:dims] - home * side <= reach
    steps = product(*[(0, 1) if x else (0,) for x in low])
    return home.tolist(), [[int(h) - s for h, s in zip(home, step)] for step in steps]


def _pairs(r: np.ndarray, home: np.ndarray, cell: np.ndarray, side: np.ndarray, cross: bool, block: int,
           edges: list[tuple[int, int]], share: float, threshold: float):
    """Indices of the linked pairs among rotated unit vectors ``r`` that this cell and
    block count; with ``cross`` only pairs of one vector of each side."""
    n = len(r)
    y = r[:, slice(*edges[block])]
    norm = (y ** 2).sum(axis=1)
    for lo in range(0, n, 256):
        hi = min(n, lo + 256)
        near = norm[lo:hi, None] + norm[None, :] - 2 * y[lo:hi] @ y.T <= share + 1e-7
        near &= np.arange(n)[None, :] > np.arange(lo, hi)[:, None]
        if cross:
            near &= side[lo:hi, None] != side[None, :]
        i, j = np.nonzero(near)
        i += lo
        ok = (np.minimum(home[i], home[j]) == cell).all(axis=1)
        i, j = i[ok], j[ok]
        for b, (a, z) in enumerate(edges[:block + 1]):
            d = ((r[i, a:z] - r[j, a:z]) ** 2).sum(axis=1)
            # a little over the share, for rounding; a pair counts in the first such block
            ok = d <= share + 1e-9 if b == block else d > share + 1e-9
            i, j = i[ok], j[ok]
        ok = np.einsum("ij,ij->i", r[i], r[j]) >= threshold
        yield i[ok], j[ok]


def _forest(n: int, i: np.ndarray, j: np.ndarray, root: np.ndarray) -> tuple[list, np.ndarray]:
    """Those pairs that join sets of ``root`` not joined before, and the new roots."""
    out = []
    while len(i):
        a, b = root[i], root[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        top, first = np.unique(np.maximum(a, b), return_index=True)
        out += list(zip(i[first].tolist(), j[first].tolist()))
        parent = np.arange(n)
        parent[top] = np.minimum(a, b)[first]
        while (parent != parent[parent]).any():
            parent = parent[parent]
        root = parent[root]
    return out, root


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = 0.98, blocks: int = BLOCKS, cell: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors of one label and one dimension are linked at a cosine of
    ``threshold`` or more; n_links counts the other rows linked directly,
    component_id is the smallest key reachable. A null label, and a vector that
    is null, empty, zero or has a null or non-finite component, links with
    nothing. Repeated rows are linked with each other. A null key is no
    component_id while its component has another. Other columns are not read.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"),
                          F.col(label).cast("string").alias("label"))

    def units(given):
        for k, v, lab in given:
            u = None if lab is None else unit(v)
            if u is None:
                yield k, None, lab, None, None
            else:
                yield k, digest16(u.tobytes() + lab.encode()), lab, len(u), (u @ rotation(len(u))).tobytes()

    rows = stage(arrow_map(rows, units, "vec_id long, cls binary, label string, dim int, r binary", flush=512), "units")
    classes = stage(rows.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"),
        F.first("dim").alias("dim"), F.first("r").alias("r")), "classes")
    # the grid follows the number of vectors of a label: one row a label
    counts = stage(classes.groupBy("label", "dim").agg(F.greatest(F.lit(0), F.ceil(
        F.log2(F.count("*") / cell))).cast("int").alias("dims")), "counts")
    budget = 2 - 2 * threshold

    def deal(given, whole):
        for cls, n, lab, dim, r, dims in given:
            x = np.frombuffer(r)
            edges = _edges(dim, blocks)
            for b, (a, z) in enumerate(edges):
                home, put = homes(x[a:z], min(dims, z - a), np.sqrt(budget / len(edges)) + 1e-6)
                for where in put:
                    yield (lab, dim, b, where, *((home, cls, n, r) if whole else ()))

    place = ["label", "dim", "block", "cell"]
    schema = "label string, dim int, block int, cell array<int>"
    known = classes.join(counts, ["label", "dim"]).select("cls", "n", "label", "dim", "r", "dims")
    sizes = stage(arrow_map(known, lambda rows: deal(rows, False), schema).groupBy(*place).agg(
        F.ceil(F.count("*") / chunk).cast("int").alias("chunks")).where("chunks > 0"), "sizes")
    dealt = arrow_map(known, lambda rows: deal(rows, True),
                      schema + ", home array<int>, cls binary, n long, r binary", flush=512)
    paired = (dealt.join(sizes, place)
              .withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("chunks").cast("long")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select(*place, F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
                      "mine", "home", "cls", "n", "r")
              .repartition(*place, "a", "b").sortWithinPartitions(*place, "a", "b"))

    def verify(given):
        for (_, dim, block, where, a, b), group in groupby(given, key=lambda g: (*g[:3], tuple(g[3]), *g[4:6])):
            group = list(group)
            r = np.stack([np.frombuffer(g[10]) for g in group])
            home = np.array([g[7] for g in group], int).reshape(len(group), -1)
            side = np.array([a != b and g[6] == b for g in group])
            copies = np.array([g[9] for g in group], np.float64)
            edges = _edges(dim, blocks)
            links, root = np.zeros(len(r)), np.arange(len(r))
            for i, j in _pairs(r, home, np.array(where, int), side, a != b, block, edges, budget / len(edges), threshold):
                links += np.bincount(i, copies[j], len(r)) + np.bincount(j, copies[i], len(r))
                joined, root = _forest(len(r), i, j, root)
                for p, q in joined:
                    yield group[p][8], group[q][8], None
            for p in np.flatnonzero(links):
                yield group[p][8], None, int(links[p])

    found = stage(arrow_map(paired, verify, "u binary, v binary, links long"), "found")
    linked = stage(components(found.where("v IS NOT NULL").select("u", "v")).toDF("cls", "root"), "linked")
    links = found.where("v IS NULL").groupBy("u").agg(F.sum("links").alias("links"))
    least = classes.select("cls", "least", "n")
    roots = stage(linked.join(least, "cls").groupBy("root").agg(F.min("least").alias("component")), "roots")
    labels = stage(least.join(links.withColumnRenamed("u", "cls"), "cls", "left")
                   .join(linked.join(roots, "root"), "cls", "left")
                   .select("cls", F.coalesce("component", "least").alias("component"),
                           (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")), "labels")
    unstage(counts, sizes, found, linked, roots)
    got = rows.select("vec_id", "cls").join(labels, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return got.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

