"""M7 without a bound: multinomial logistic regression on all training rows, with
the coefficients dealt out by ranges of terms.

The objective is that of ``plans.model``: the mean log-loss plus ``reg / 2 *
||W||^2``, intercepts free. Nothing of the vocabulary's size is on the driver or
whole in one task:

- Features are long rows (row, term number, weight), packed into *cells*: the
  entries of up to 4096 rows in one range of 16384 terms, three arrays each.
- A *state* row holds one range's coefficients, gradient and the last steps.
- A *margin* row holds the scores of one block of rows.

An iteration of L-BFGS is two joins: cells with the search direction by range,
summed by block into margins, and cells with the residuals by block, summed by
range into the gradient. The two-loop recursion needs only inner products of the
kept vectors, a small matrix that each range adds to (the vector-free form of
Chen, Wang and Zhou, 2014), and gives one number a vector; the step is chosen
from the losses at several lengths, which the margins give without the features.
Both joins are plain equi-joins: Spark broadcasts the small side while its
measured size allows, and shuffles beyond. Tables are staged once an iteration,
so a lost executor costs the tasks of one pass.

Up to ``ROW_NUMBERS`` rows x classes (the vocabulary may be of any size), ``solve_rows``
needs less: every step is a sum of feature rows, so it is kept as one number a row and
class, and an iteration is one pass over the cells. The steps that L-BFGS remembers are in
a file of the driver's temp folder and are worked on by blocks of rows, so its memory holds
only the numbers that go out to a pass and come back. Several fits on the same cells, such
as the folds of a cross-validation, share their passes.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.batches import arrow_map
from newsflow.functions import text as T
from newsflow.operators import features as FT
from newsflow.operators.clean import clean_text
from newsflow.operators.lemma import ROW_ID, changed_lemmas, with_row_ids
from newsflow.plans.model import TrainConfig, bounded, held_out, prepare, sides, with_terms
from newsflow.session import materialize, shuffles_removed, stage, unstage

#: Rows of a block and terms of a range, as powers of 2.
BLOCK_BITS, RANGE_BITS = 12, 14
#: Entries of a cell at most; a fuller one goes on in another.
CELL_ENTRIES = 1 << 18
#: Partial sums that a task holds before it sends them on.
HELD_SUMS = 32
#: Steps that the recursion remembers.
HISTORY = 10
#: Step lengths that are tried; the first step has no scale yet.
STEPS = (2.0, 1.0, 0.5, 0.25, 0.1, 0.02)
FIRST_STEPS = tuple(4.0 ** k for k in range(8, -7, -1))
#: The range of the intercepts.
INTERCEPT = -1
#: Rows x classes at most for ``solve_rows``: 128 MB a vector. The driver's memory has a few, its temp folder some 50.
ROW_NUMBERS = 1 << 24
#: Entries of a part of the terms, and rows of one partial sum, in ``solve_rows``.
PART_ENTRIES, SUM_ROWS = 1 << 19, 1 << 14
#: Rows that ``descent`` works on at once.
STORE_ROWS = 1 << 16
#: Packed pairs that are joined to the terms at once, or twice as many as terms: so many are on disk together.
SCORE_PAIRS = 1 << 23
#: Entries that a task packs at once.
PACK_ENTRIES = 1 << 20


def _f8(data: bytes, k: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(-1, k)


def _cells(rows):
    """(block, range, rows, terms, values) of entries (block, range, row, term, value) ordered by both."""
    at, held = None, []

    def cell():
        r, c, v = zip(*held)
        return (*at, np.array(r, "<i4").tobytes(), np.array(c, "<i4").tobytes(), np.array(v, "<f8").tobytes())

    for block, part, r, c, v in rows:
        if held and ((block, part) != at or len(held) >= CELL_ENTRIES):
            yield cell()
            held = []
        at = (block, part)
        held.append((r, c, v))
    if held:
        yield cell()


def _entries(data: tuple) -> tuple:
    r, c, v = data
    return np.frombuffer(r, "<i4"), np.frombuffer(c, "<i4"), np.frombuffer(v, "<f8")


def _add(total: np.ndarray, to: np.ndarray, values: np.ndarray) -> None:
    """``total[to] += values`` for repeated places, a class at a time."""
    for j in range(total.shape[1]):
        total[:, j] += np.bincount(to, values[:, j], len(total))


def _spread_sums(k: int, by: str):
    """Partial sums of cells times the other side: by "rows" margins, by "terms" gradients.

    Rows: (key, width, the cell's three arrays, the other side's numbers)."""
    def run(rows):
        sums: dict = {}
        for key, width, r, c, v, other in rows:
            r, c, v = _entries((r, c, v))
            to, of = (r, c) if by == "rows" else (c, r)
            if key not in sums:
                if len(sums) >= HELD_SUMS:
                    yield from ((x, s.tobytes()) for x, s in sums.items())
                    sums = {}
                sums[key] = np.zeros((width, k))
            _add(sums[key], to, v[:, None] * _f8(other, k)[of])
        yield from ((x, s.tobytes()) for x, s in sums.items())

    return run


def _probabilities(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = z.max(axis=1, keepdims=True)
    e = np.exp(z - top)
    s = e.sum(axis=1, keepdims=True)
    return e / s, (top + np.log(s))[:, 0]


def _new_margins(k: int, t_before: float, steps: tuple):
    """Margins of each block after the last step, along the new direction, and their losses.

    Rows: (block, y, z, zd), the block's own row (y not null), then partial sums in zd."""
    def close(block, y, z, total):
        label = np.frombuffer(y, "<i4")
        real = label >= 0
        losses = []
        for t in steps:
            now = z + t * total
            _, log_sum = _probabilities(now)
            losses.append(float((log_sum[real] - now[real, label[real]]).sum()))
        return block, y, z.tobytes(), total.tobytes(), losses

    def run(rows):
        held = None
        for block, y, z, zd in rows:
            if y is not None:
                if held:
                    yield close(*held)
                held = (block, y, _f8(z, k) + t_before * _f8(zd, k), np.zeros((len(y) // 4, k)))
            else:
                held[3][:] += _f8(zd, k)
        if held:
            yield close(*held)

    return run


def _residuals(k: int, t: float):
    def run(rows):
        for block, y, z, zd in rows:
            label = np.frombuffer(y, "<i4")
            real = label >= 0
            p, _ = _probabilities(_f8(z, k) + t * _f8(zd, k))
            p[real, label[real]] -= 1.0
            p[~real] = 0.0
            yield block, p.tobytes()

    return run


def _direction(weights: list[float]):
    """The search direction of each range: kept steps, kept gradient changes and the gradient, weighted."""
    def run(rows):
        for part, _, g, hist in rows:
            yield part, sum(a * np.frombuffer(v, "<f8") for a, v in zip(weights, [*hist, g])).astype("<f8").tobytes()

    return run


def _new_state(k: int, n: int, reg: float, t: float, weights: list[float], history: int):
    """Coefficients and gradient of each range after the step, the kept steps, and the inner
    products of all of them. ``hist`` is all steps, oldest first, then all gradient changes.

    Rows: (range, width, w, g, hist), the range's own (w not null), then partial gradients in g."""
    def close(part, width, w, g, hist, total):
        penalty = 0.0 if part == INTERCEPT else reg
        vectors = [np.frombuffer(v, "<f8") for v in hist]
        w0, g0 = np.frombuffer(w, "<f8"), np.frombuffer(g, "<f8") if g is not None else None
        m = len(vectors) // 2
        steps, changes = vectors[:m], vectors[m:]
        w1 = w0
        if weights:
            s = t * sum(a * v for a, v in zip(weights, [*vectors, g0]))
            w1 = w0 + s
        g1 = total.ravel() / n + penalty * w1
        if weights:
            steps, changes = [*steps, s][-history:], [*changes, g1 - g0][-history:]
        kept = [*steps, *changes]
        basis = np.stack([*kept, g1, w1])
        return (part, width, w1.astype("<f8").tobytes(), g1.astype("<f8").tobytes(),
                [v.astype("<f8").tobytes() for v in kept], (basis @ basis.T).ravel().tolist())

    def run(rows):
        held = None
        for part, width, w, g, hist in rows:
            if w is not None:
                if held:
                    yield close(*held)
                held = (part, width, w, g, hist, np.zeros((width, k)))
            else:
                held[5][:] += _f8(g, k)
        if held:
            yield close(*held)

    return run


def two_loops(dots: np.ndarray, m: int) -> list[float]:
    """Weights of the ``m`` kept steps, the ``m`` gradient changes and the gradient in the L-BFGS
    direction, from the inner products of all of them (in this order, oldest first)."""
    d = np.zeros(2 * m + 1)
    d[-1] = -1.0
    alpha = np.zeros(m)
    for i in reversed(range(m)):
        alpha[i] = d @ dots[:2 * m + 1, i] / dots[i, m + i]
        d[m + i] -= alpha[i]
    if m:
        d *= dots[m - 1, 2 * m - 1] / dots[2 * m - 1, 2 * m - 1]
    for i in range(m):
        d[i] += alpha[i] - d @ dots[:2 * m + 1, m + i] / dots[i, m + i]
    return d.tolist()


ABOUT = "name string, saved double, lemmas boolean, key array<string>, text_col string, losses array<double>"
SCHEMA_CELL = "block long, part int, rows binary, terms binary, vals binary"
SCHEMA_STATE = "part int, width int, w binary, g binary, hist array<binary>, dots array<double>"
SCHEMA_MARGIN = "block long, y binary, z binary, zd binary, losses array<double>"


@dataclass
class Solved:
    """``coefficients``: (idx, w array of a number a class); ``intercepts``: one a class;
    ``losses``: the objective after each iteration."""

    coefficients: DataFrame
    intercepts: list[float]
    losses: list[float]


def solve(entries: DataFrame, labels: DataFrame, n_classes: int, n_terms: int, reg: float,
          max_iter: int = 1000, tol: float = 1e-6, history: int = HISTORY) -> Solved:
    """Fit on ``entries`` (row, idx, value) and ``labels`` (row, label_idx), all longs but the value.

    Row numbers are unique and not negative, in runs as ``monotonically_increasing_id``
    gives them; idx runs from 0 to ``n_terms - 1``. A row without an entry has the
    intercepts alone. Stops when an iteration improves the objective by less than ``tol`` of it.
    """
    spark, k = entries.sparkSession, n_classes
    block = lambda c: F.shiftright(c, BLOCK_BITS).alias("block")
    place = lambda c, bits: F.col(c).bitwiseAND((1 << bits) - 1).cast("int")
    ranges = -(-n_terms // (1 << RANGE_BITS))
    size = 1 << BLOCK_BITS

    def labelled(rows):
        at, y = None, None
        for b, r, label in rows:
            if b != at:
                if y is not None:
                    yield at, y.tobytes(), bytes(8 * size * k), bytes(8 * size * k), None
                at, y = b, np.full(size, -1, "<i4")
            y[r] = label
        if y is not None:
            yield at, y.tobytes(), bytes(8 * size * k), bytes(8 * size * k), None

    one = labels.select(block("row"), F.lit(INTERCEPT).alias("part"), place("row", BLOCK_BITS).alias("r"),
                        F.lit(0).alias("c"), F.lit(1.0).alias("v"))
    long = entries.select(block("row"), F.shiftright("idx", RANGE_BITS).cast("int").alias("part"),
                          place("row", BLOCK_BITS).alias("r"), place("idx", RANGE_BITS).alias("c"),
                          F.col("value").cast("double").alias("v"))
    cells = stage(arrow_map(long.union(one).repartition("block", "part").sortWithinPartitions("block", "part"),
                            _cells, SCHEMA_CELL, flush=8), "cells")
    margins = stage(arrow_map(labels.select(block("row"), place("row", BLOCK_BITS).alias("r"),
                                            F.col("label_idx").cast("int"))
                              .repartition("block").sortWithinPartitions("block"),
                              labelled, SCHEMA_MARGIN, flush=16), "margins")
    n = labels.count()
    width = F.when(F.col("part") == INTERCEPT, 1).when(
        F.col("part") == ranges - 1, n_terms - (ranges - 1) * (1 << RANGE_BITS)).otherwise(1 << RANGE_BITS)
    zeros = lambda c: F.unhex(F.repeat(F.lit("00"), 8 * k * F.col(c)))
    state = (spark.range(INTERCEPT, ranges).select(F.col("id").cast("int").alias("part"))
             .withColumn("width", width.cast("int"))
             .select("part", "width", zeros("width").alias("w"), F.lit(None).cast("binary").alias("g"),
                     F.array().cast("array<binary>").alias("hist")))

    def gradient_step(state, margins, t, weights):
        """The next state: the gradient at ``t`` along the direction is gathered by range."""
        res = arrow_map(margins.select("block", "y", "z", "zd"), _residuals(k, t), "block long, res binary", flush=16)
        joined = cells.join(res, "block").select("part", width.cast("int").alias("width"), "rows", "terms", "vals", "res")
        sums = arrow_map(joined, _spread_sums(k, "terms"), "part int, g binary", flush=4)
        own = state.select("part", "width", "w", "g", "hist")
        part = sums.select("part", F.lit(None).cast("int").alias("width"), F.lit(None).cast("binary").alias("w"), "g",
                           F.lit(None).cast("array<binary>").alias("hist"))
        both = own.union(part).repartition("part").sortWithinPartitions("part", F.desc_nulls_last("w"))
        return stage(arrow_map(both, _new_state(k, n, reg, t, weights, history), SCHEMA_STATE, flush=2), "state")

    def products(state):
        """Inner products of all ranges together, and those of the intercepts."""
        rows = (state.select((F.col("part") == INTERCEPT).alias("free"), F.posexplode("dots").alias("at", "x"))
                .groupBy("free", "at").agg(F.sum("x").alias("x")).collect())
        side = int(round((1 + max(r["at"] for r in rows)) ** 0.5))
        total, free = np.zeros(side * side), np.zeros(side * side)
        for r in rows:
            total[r["at"]] += r["x"]
            if r["free"]:
                free[r["at"]] += r["x"]
        return total.reshape(side, side), free.reshape(side, side)

    state = gradient_step(state, margins, 0.0, [])
    losses, t = [], 0.0
    for _ in range(max_iter):
        dots, free = products(state)
        m = (len(dots) - 2) // 2
        weights = two_loops(dots[:-1, :-1], m)
        d = np.append(weights, 0.0)
        if d @ dots[:, -2] >= 0:
            break   # no way down: the gradient is zero to rounding
        steps = STEPS if m else FIRST_STEPS
        along = arrow_map(state.select("part", "w", "g", "hist"), _direction(weights), "part int, d binary", flush=2)
        joined = cells.join(along, "part").select("block", F.lit(size).alias("width"), "rows", "terms", "vals", "d")
        sums = arrow_map(joined, _spread_sums(k, "rows"), "block long, zd binary", flush=16)
        none = F.lit(None).cast("binary")
        both = (margins.select("block", "y", "z", "zd")
                .union(sums.select("block", none.alias("y"), none.alias("z"), "zd"))
                .repartition("block").sortWithinPartitions("block", F.desc_nulls_last("y")))
        after = stage(arrow_map(both, _new_margins(k, t, steps), SCHEMA_MARGIN, flush=16), "margins")
        unstage(margins)
        margins = after
        got = (margins.select(F.posexplode("losses").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect())
        pen = dots - free
        ww, wd, dd = pen[-1, -1], d @ pen[:, -1], d @ pen @ d
        found = {r["at"]: r["x"] / n + reg / 2 * (ww + 2 * steps[r["at"]] * wd + steps[r["at"]] ** 2 * dd) for r in got}
        best = min(found, key=found.get)
        if losses and found[best] >= losses[-1]:
            break   # no step helps any more
        t = steps[best]
        after = gradient_step(state, margins, t, weights)
        unstage(state)
        state = after
        losses.append(float(found[best]))
        if len(losses) > 1 and losses[-2] - losses[-1] <= tol * max(abs(losses[-1]), 1e-12):
            break
    unstage(cells, margins)

    def unpacked(rows):
        for part, w in rows:
            for i, x in enumerate(_f8(w, k).tolist()):
                yield (part << RANGE_BITS) + i, x

    free = state.where(F.col("part") == INTERCEPT).select("w").first()["w"]
    coefficients = arrow_map(state.where(F.col("part") != INTERCEPT).select("part", "w"), unpacked,
                             "idx long, w array<double>")
    return Solved(coefficients, _f8(free, k)[0].tolist(), losses)


def _part_cells(at):
    """All entries of a part as one cell ordered by term; rows are named by their place in ``at``."""
    def cell(batch: pa.Table) -> pa.Table:
        r, c, v = (batch.column(n).to_numpy() for n in ("row", "term", "value"))
        by = np.argsort(c, kind="stable")
        terms, counts = np.unique(c, return_counts=True)
        return pa.table({"part": pa.array([batch.column("part")[0].as_py()], pa.int32()),
                         "rows": [np.searchsorted(at.value, r[by]).astype("<i4").tobytes()],
                         "terms": [terms.astype("<i4").tobytes()], "counts": [counts.astype("<i4").tobytes()],
                         "vals": [v[by].astype("<f8").tobytes()]})

    return cell


def _distinct(x: np.ndarray) -> np.ndarray:
    """The different numbers of ``x`` in order; sorting is several times faster than ``np.unique`` here."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def pack(df: DataFrame) -> DataFrame:
    """(block, term, rows) of ``df`` (row, an array of its terms): the places in a block of rows that hold a
    term, so that what goes on by term is a row a block and term and not one an entry.

    A block and term may come more than once, with other places."""
    size = 1 << BLOCK_BITS

    def packed(ids: list, counts: list, flat: list) -> pa.RecordBatch:
        coded = pa.concat_arrays(flat).dictionary_encode()
        blocks, at = np.unique(np.concatenate(ids) >> BLOCK_BITS, return_inverse=True)
        place = np.concatenate(ids) & (size - 1)
        by = np.repeat(np.stack([at, place]), np.concatenate(counts), axis=1)
        kinds = max(1, len(coded.dictionary))
        entries = _distinct((by[0] * kinds + coded.indices.to_numpy()) * size + by[1])
        pair = entries >> BLOCK_BITS
        starts = np.flatnonzero(np.diff(pair, prepend=-1))
        offsets = np.append(starts, len(pair)).astype("<i4") * 2
        rows = (entries & (size - 1)).astype("<u2")
        return pa.record_batch({
            "block": pa.array(blocks[pair[starts] // kinds]), "term": coded.dictionary.take(pa.array(pair[starts] % kinds)),
            "rows": pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])})

    def run(batches):
        ids, counts, flat, held = [], [], [], 0
        for batch in batches:
            row, terms = batch.column(0).to_numpy(), batch.column(1)
            ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(terms), 0).to_numpy(zero_copy_only=False))
            i = 0
            while i < len(row):
                # rows to the bound, and one at least
                before = int(ends[i - 1]) if i else 0
                j = max(i + 1, int(np.searchsorted(ends, before + PACK_ENTRIES - held, "right")))
                some = terms.slice(i, j - i)
                ids.append(row[i:j])
                counts.append(np.diff(ends[i:j], prepend=before))
                flat.append(some.flatten())
                held += int(ends[j - 1]) - before
                i = j
                if held >= PACK_ENTRIES or i < len(row):
                    yield packed(ids, counts, flat)
                    ids, counts, flat, held = [], [], [], 0
        if held:
            yield packed(ids, counts, flat)

    row, terms = df.columns
    return df.select(F.col(row).cast("long"), F.col(terms).cast("array<string>")).mapInArrow(
        run, "block long, term string, rows binary")


def _unpacked(packed: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of places of each row, all places) of a ``rows`` column of ``pack``."""
    if isinstance(packed, pa.ChunkedArray):
        packed = packed.combine_chunks() if packed.num_chunks != 1 else packed.chunk(0)
    lengths = pa.compute.binary_length(packed).to_numpy(zero_copy_only=False) // 2
    first, last = (np.frombuffer(packed.buffers()[1], "<i4")[packed.offset + i] for i in (0, len(packed))) if len(packed) else (0, 0)
    data = packed.buffers()[2]
    return lengths, np.frombuffer(data, "<u2")[first // 2:last // 2] if data is not None else np.zeros(0, "<u2")


def with_lemmas(packed: DataFrame, changes: DataFrame | None) -> DataFrame:
    """``pack``'s rows with the lemma of each term; ``changes``: (token, lemma) made without exceptions,
    so only tokens with a rule suffix go through the join (None: a token is its own lemma)."""
    if changes is None:
        return packed
    may_change = F.col("term").endswith("s") | F.col("term").endswith("men")
    joined = packed.where(may_change).join(changes.select(F.col("token").alias("term"), "lemma"), "term", "left")
    return packed.where(~may_change).union(joined.select("block", F.coalesce("lemma", "term").alias("term"), "rows"))


def smoothed_idf(counts: np.ndarray, n: int, min_df: float) -> np.ndarray:
    """The smoothed idf over ``n`` rows, 0 for terms that fewer than ``min_df`` of them hold (a share if below 1)."""
    least = min_df if min_df >= 1 else min_df * n
    return np.where(counts >= max(least, 1), np.log((1.0 + n) / (1.0 + counts)) + 1.0, 0.0)


def _term_cells(at, n: int, min_df: float, fold=None, folds: int = 0):
    """One cell of a task's packed terms, with the terms themselves and their smoothed idf over ``n`` rows;
    a pair counts once, and terms in fewer than ``min_df`` rows are left out.

    With ``fold`` (the fold of each row), ``folds`` further lines of values: the idf of the other folds' rows."""
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        packed = pa.Table.from_batches(held)
        term = packed.column("term")
        coded = pa.concat_arrays(term.chunks).dictionary_encode()
        lengths, places = _unpacked(packed.column("rows"))
        size, block = max(1, len(at.value)), at.value >> BLOCK_BITS
        blocks = _distinct(block)
        place_of = np.zeros((len(blocks), 1 << BLOCK_BITS), "<i4")   # the place in ``at`` of each row of a block
        place_of[np.searchsorted(blocks, block), at.value & ((1 << BLOCK_BITS) - 1)] = np.arange(len(at.value))
        row = place_of[np.searchsorted(blocks, packed.column("block").to_numpy()).repeat(lengths), places]
        both = _distinct(coded.indices.to_numpy().astype("i8").repeat(lengths) * size + row)
        c, r = np.divmod(both, size)
        counts = np.bincount(c, minlength=len(coded.dictionary))
        keep = smoothed_idf(counts, n, min_df) > 0
        terms, vals = coded.dictionary.filter(pa.array(keep)), [smoothed_idf(counts, n, min_df)[keep]]
        if fold is not None:
            of = np.bincount(c * folds + fold.value[r], minlength=len(counts) * folds).reshape(-1, folds)
            rows = np.bincount(fold.value, minlength=folds)
            vals += [smoothed_idf(counts - of[:, f], n - int(rows[f]), min_df)[keep] for f in range(folds)]
        yield pa.record_batch({"terms": pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms),
                               "rows": pa.array([r[keep[c]].astype("<i4").tobytes()], pa.binary()),
                               "counts": pa.array([counts[keep].astype("<i4").tobytes()], pa.binary()),
                               "vals": pa.array([np.concatenate(vals).astype("<f8").tobytes()], pa.binary())})

    return run


def _cell(cell: tuple, sets: int = 1) -> tuple:
    """(rows, entries a term, where each term begins, values: a line a set) of a cell. Values are one an
    entry, or one a term."""
    r, counts = (np.frombuffer(x, "<i4").astype(np.intp) for x in cell[:2])
    return r, counts, np.cumsum(counts) - counts, np.frombuffer(cell[2], "<f8").reshape(sets, -1)


def _term_sums(cell: tuple, line: np.ndarray, of: int = 0) -> np.ndarray:
    """The sums over the rows of each term of ``line`` (a number a row) times the values of set ``of``."""
    r, counts, starts, vals = cell
    if not len(r):
        return np.zeros(0)
    if vals.shape[1] == len(r):
        return np.add.reduceat(vals[of] * line.take(r), starts)
    return vals[of] * np.add.reduceat(line.take(r), starts)


def _to_entries(cell: tuple, x: np.ndarray, of: int = 0) -> np.ndarray:
    """The values of set ``of`` times ``x`` (one a term), for each entry."""
    r, counts, _, vals = cell
    return vals[of] * np.repeat(x, counts) if vals.shape[1] == len(r) else np.repeat(vals[of] * x, counts)


def _line_search(f, slope: float, t: float) -> tuple[float, float]:
    """(t, loss) with a lower loss and a slope of at most a fifth of the first, or the best that was found.
    ``f``: t -> (loss, slope)."""
    low, high, best = (0.0, slope), None, (0.0, f(0.0)[0])
    for _ in range(20):
        loss, d = f(t)
        if loss < best[1]:
            best = (t, loss)
        if loss <= best[1] and abs(d) <= 0.2 * abs(slope):
            break
        if d < 0:
            low = (t, d)
        else:
            high = (t, d)
        if high is None:
            t *= 4.0
        else:
            # the zero of the line through both slopes, kept off the ends
            zero = low[0] + (high[0] - low[0]) * low[1] / (low[1] - high[1])
            gap = 0.1 * (high[0] - low[0])
            t = min(max(zero, low[0] + gap), high[0] - gap)
    return best


class Store:
    """Vectors of L-BFGS, each a pair of matrices (numbers and margins, a line a row) and its intercepts.

    The matrices are in a file that ends with the object, read and written by blocks of rows."""

    def __init__(self, rows: int, k: int, vectors: int):
        self.rows, self.k, self.file = rows, k, tempfile.TemporaryFile()
        self.free = np.zeros((vectors, k))
        self.file.truncate(max(1, 2 * vectors * rows * k * 8))

    def blocks(self):
        return [(i, min(i + STORE_ROWS, self.rows)) for i in range(0, self.rows, STORE_ROWS)]

    def read(self, vector: int, kind: int, i: int, j: int) -> np.ndarray:
        data = os.pread(self.file.fileno(), (j - i) * self.k * 8, ((2 * vector + kind) * self.rows + i) * self.k * 8)
        return _f8(data, self.k)

    def write(self, vector: int, kind: int, i: int, x: np.ndarray) -> None:
        os.pwrite(self.file.fileno(), np.ascontiguousarray(x, "<f8").tobytes(), ((2 * vector + kind) * self.rows + i) * self.k * 8)

    def dots(self, one: int, others: list[int]) -> np.ndarray:
        """Inner products: the numbers of one vector and the margins of the others."""
        out = self.free[others] @ self.free[one]
        for i, j in self.blocks():
            x = self.read(one, NUMBERS, i, j)
            out += [np.vdot(x, self.read(o, MARGINS, i, j)) for o in others]
        return out


NUMBERS, MARGINS = 0, 1
#: The point, its gradient and the direction in a ``Store``; the remembered steps and gradient changes follow.
POINT, GRADIENT, ALONG, KEPT = 0, 1, 2, 3


def descent(y: np.ndarray, k: int, reg: float, max_iter: int, tol: float, history: int = HISTORY, store: Store | None = None):
    """L-BFGS as a generator: yields numbers a row and class, and is sent their margins.

    A vector of the coefficients' space that is a sum of feature rows is kept as
    (its number a row and class, its margins, its intercepts); an inner product of two
    is that of the numbers of one and the margins of the other. ``y``: classes, -1 for
    rows that are only scored. Returns (store with the optimum as ``POINT``, losses); a
    ``store`` that is given is the start.
    """
    n, size = int((y >= 0).sum()), len(y)
    at = store or Store(size, k, KEPT + 2 * history)
    step, change = (lambda h: KEPT + 2 * h), (lambda h: KEPT + 2 * h + 1)
    gram = np.zeros((KEPT + 2 * history,) * 2)

    def scored(i, j, t=0.0):
        """(rows with a class, their margins ``t`` along the direction, places of their classes) of a block."""
        place = np.flatnonzero(y[i:j] >= 0)
        z = at.read(POINT, MARGINS, i, j)[place] + at.free[POINT]
        if t:
            z = z + t * (at.read(ALONG, MARGINS, i, j)[place] + at.free[ALONG])
        return place, z, (np.arange(len(place)), y[i:j][place])

    def moved(t: float, to: int | None) -> np.ndarray:
        """Goes ``t`` along the direction, keeps the step as vector ``to``; the residuals there, of which the
        gradient's numbers and intercepts are made."""
        res, total = np.zeros((size, k)), np.zeros(k)
        for i, j in at.blocks():
            place, z, own = scored(i, j, t)
            p, _ = _probabilities(z)
            p[own] -= 1.0
            res[i + place] = p / max(n, 1)
            total += res[i:j].sum(axis=0)
            if t:
                for kind in (NUMBERS, MARGINS):
                    s = t * at.read(ALONG, kind, i, j)
                    at.write(to, kind, i, s)
                    at.write(POINT, kind, i, at.read(POINT, kind, i, j) + s)
        if t:
            at.free[to] = t * at.free[ALONG]
            at.free[POINT] += at.free[to]
        return res, total

    def new_gradient(res: np.ndarray, total: np.ndarray | None, kind: int, to: int | None) -> None:
        """The gradient's numbers or margins from those of the residuals; its change is kept as vector ``to``."""
        for i, j in at.blocks():
            g = res[i:j] + reg * at.read(POINT, kind, i, j)
            if to is not None:
                at.write(to, kind, i, g - at.read(GRADIENT, kind, i, j))
            at.write(GRADIENT, kind, i, g)
        if total is not None:
            if to is not None:
                at.free[to] = total - at.free[GRADIENT]
            at.free[GRADIENT] = total

    losses, kept, now, t = [], [], None, 0.0   # kept: places of the remembered steps, oldest first
    for it in range(max_iter):
        res, total = moved(t, None if now is None else step(now))
        t = 0.0
        new_gradient(res, total, NUMBERS, None if now is None else change(now))
        new_gradient((yield res), None, MARGINS, None if now is None else change(now))
        del res
        if now is not None:
            basis = [*(step(h) for h in kept), *(change(h) for h in kept), step(now), change(now)]
            for one in basis[-2:]:
                gram[one, basis] = gram[basis, one] = at.dots(one, basis)
            if gram[step(now), change(now)] > 0:
                kept = [*kept, now][-history:]
        basis = [*(step(h) for h in kept), *(change(h) for h in kept), GRADIENT]
        gram[GRADIENT, basis] = gram[basis, GRADIENT] = at.dots(GRADIENT, basis)
        weights = two_loops(gram[np.ix_(basis, basis)], len(kept))
        at.free[ALONG] = np.array(weights) @ at.free[basis]
        aa = ad = dd = 0.0
        slope = float(at.free[ALONG] @ at.free[GRADIENT])
        for i, j in at.blocks():
            d = [sum(w * at.read(v, kind, i, j) for w, v in zip(weights, basis)) for kind in (NUMBERS, MARGINS)]
            for kind in (NUMBERS, MARGINS):
                at.write(ALONG, kind, i, d[kind])
            x = at.read(POINT, NUMBERS, i, j)
            aa += np.vdot(x, at.read(POINT, MARGINS, i, j))
            ad, dd = ad + np.vdot(x, d[MARGINS]), dd + np.vdot(d[NUMBERS], d[MARGINS])
            slope += np.vdot(d[NUMBERS], at.read(GRADIENT, MARGINS, i, j))
        if slope >= 0:
            break   # no way down: the gradient is zero to rounding

        def f(t):
            loss = down = 0.0
            for i, j in at.blocks():
                place, z, own = scored(i, j, t)
                p, log_sum = _probabilities(z)
                loss += (log_sum - z[own]).sum()
                p[own] -= 1.0
                down += (p * (at.read(ALONG, MARGINS, i, j)[place] + at.free[ALONG])).sum()
            return (float(loss / max(n, 1) + reg / 2 * (aa + 2 * t * ad + t * t * dd)),
                    float(down / max(n, 1) + reg * (ad + t * dd)))

        t, loss = _line_search(f, slope, 1.0 if kept else 4.0 / max(1e-12, -slope) ** 0.5)
        if t == 0.0 or (losses and loss >= losses[-1]):
            t = 0.0
            break   # no step helps any more
        kept = kept[1:] if len(kept) == history else kept
        now = next(h for h in range(history) if h not in kept)
        losses.append(loss)
        if len(losses) > 1 and losses[-2] - losses[-1] <= tol * max(abs(losses[-1]), 1e-12):
            break
    if t:
        moved(t, ALONG)
    return at, losses


def _rows_of(labels: DataFrame):
    """(row numbers broadcast, classes, folds if there is such a column) of ``labels``, by row."""
    given = labels.withColumn("label_idx", F.col("label_idx").cast("int")).orderBy("row").toArrow()
    fold = given.column("fold").to_numpy() if "fold" in labels.columns else None
    return labels.sparkSession.sparkContext.broadcast(given.column("row").to_numpy()), given.column("label_idx").to_numpy(), fold


def _parts(spark: SparkSession, n_entries: int, size: int) -> int:
    """Parts for ``n_entries`` of ``size`` rows: a part is worth the numbers a row that it makes."""
    return max(spark.sparkContext.defaultParallelism, -(-n_entries // max(PART_ENTRIES, min(2 * size, 8 * PART_ENTRIES))))


def solve_rows(entries: DataFrame, labels: DataFrame, n_classes: int, reg: float, max_iter: int = 1000,
               tol: float = 1e-6, history: int = HISTORY, n_entries: int | None = None, unit: bool = False) -> Solved:
    """``solve`` for at most ``ROW_NUMBERS`` rows x classes, over any number of terms.

    Terms are dealt out to parts, each one cell with all rows of its terms; see
    ``Passes``. With ``unit`` the rows count as if scaled to length 1.
    ``n_entries``: their number, if known.
    """
    at, y, _ = _rows_of(labels)
    entries = entries.select("row", "idx", F.col("value").cast("double"))
    parts = _parts(entries.sparkSession, n_entries or entries.count(), len(y))
    dealt = entries.select("row", F.expr(f"int(idx div {parts})").alias("term"), "value",
                           F.expr(f"int(idx % {parts})").alias("part"))
    cells = stage(dealt.repartition(parts, "part").groupBy("part").applyInArrow(
        _part_cells(at), "part int, rows binary, terms binary, counts binary, vals binary"), "cells")
    passes = Passes(cells, len(y), unit=unit)
    (store, losses), = passes.run([(0, descent(y, n_classes, reg, max_iter, tol, history))])
    lines = passes.lines(store)

    def unpacked(rows):
        for part, terms, *cell in rows:
            cell = _cell(cell)
            w = np.stack([_term_sums(cell, line) for line in lines.value], axis=1)
            for i, x in zip(np.frombuffer(terms, "<i4").tolist(), w.tolist()):
                yield i * parts + part, x

    coefficients = stage(arrow_map(cells.select("part", "terms", "rows", "counts", "vals"), unpacked,
                                   "idx long, w array<double>"), "coefficients")
    unstage(cells)
    return Solved(coefficients, store.free[POINT].tolist(), losses)


def solve_terms(pairs: DataFrame, labels: DataFrame, n_classes: int, n: int, reg: float, max_iter: int = 1000,
                tol: float = 1e-6, history: int = HISTORY, n_entries: int | None = None, min_df: float = 1) -> Solved:
    """``solve_packed`` on (row, term) pairs."""
    return solve_packed(pack(pairs.select("row", F.array("term"))), labels, n_classes, n, reg, max_iter, tol, history,
                        n_entries or pairs.count(), min_df)


def solve_packed(packed: DataFrame, labels: DataFrame, n_classes: int, n: int, reg: float, max_iter: int, tol: float,
                 history: int, n_entries: int, min_df: float) -> Solved:
    """``solve_rows`` on TF-IDF rows of length 1 from ``pack``'s pairs of ``n`` rows. ``coefficients``: (term, df, w)."""
    at, y, _ = _rows_of(labels)
    cells = term_cells(packed, at, len(y), n, n_entries, min_df)
    passes = Passes(cells, len(y), unit=True)
    (store, losses), = passes.run([(0, descent(y, n_classes, reg, max_iter, tol, history))])
    got = passes.solved(store, losses)
    unstage(cells)
    return got


def term_cells(packed: DataFrame, at, size: int, n: int, n_entries: int, min_df: float, fold=None, folds: int = 0) -> DataFrame:
    """Cells of ``pack``'s pairs (staged), by ``_term_cells``.

    One shuffle deals the pairs by term: where all rows of a term are together, repeated pairs
    are dropped and its document frequency and idf are known, so no vocabulary is joined to
    the pairs."""
    parts = _parts(packed.sparkSession, n_entries, size)
    return stage(packed.repartition(parts, "term").mapInArrow(
        _term_cells(at, n, min_df, fold, folds), "terms array<string>, rows binary, counts binary, vals binary"), "cells")


class Passes:
    """Passes over ``cells`` of ``size`` rows for any number of fits at once.

    A pass sends the residuals to every part, which sums them by term and the terms' sums
    by row; the parts' sums are added up by blocks of rows before the driver sees them.
    ``sets``: lines of values that a cell holds. With ``unit`` a row counts as if scaled to
    length 1 in each of them.
    """

    def __init__(self, cells: DataFrame, size: int, sets: int = 1, unit: bool = False):
        self.spark, self.cells, self.size, self.sets = cells.sparkSession, cells, size, sets
        self.scale = np.ones((sets, size))
        if unit:
            def squares(cell, total):
                for of, line in enumerate(total):
                    line += np.bincount(cell[0], _to_entries(cell, np.ones(len(cell[1])), of) ** 2, size)

            norm = self.gathered(squares, sets) ** 0.5
            self.scale = np.divide(1.0, norm, out=self.scale, where=norm > 0)

    def gathered(self, add, width: int) -> np.ndarray:
        """``width`` lines, a number a row: the sums of what ``add`` puts on a task's lines for each of its cells."""
        size, sets = self.size, self.sets

        def blocks(rows):
            total = np.zeros((width, size))
            for cell in rows:
                add(_cell(cell, sets), total)
            for i in range(0, size, SUM_ROWS):
                yield i, total[:, i:i + SUM_ROWS].tobytes()

        def added(rows):
            sums: dict = {}
            for i, x in rows:
                sums[i] = sums.get(i, 0.0) + np.frombuffer(x, "<f8")
            yield from ((i, x.tobytes()) for i, x in sums.items())

        out = np.zeros((width, size))
        with shuffles_removed(self.spark):
            # a task sends a number a row, however many cells it has
            cells = self.cells.select("rows", "counts", "vals").coalesce(self.spark.sparkContext.defaultParallelism)
            some = arrow_map(cells, blocks, "at long, z binary", flush=4)
            for i, x in arrow_map(some.repartition("at"), added, "at long, z binary", flush=4).collect():
                out[:, i:i + SUM_ROWS] = np.frombuffer(x, "<f8").reshape(width, -1)
        return out

    def margins(self, asked: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
        """The margins of each (set, numbers a row and class, which sum to 0 over the classes of a row, so that
        the last class needs no line of its own); the numbers are scaled in place."""
        lines = [max(1, x.shape[1] - 1) for _, x in asked]
        sets = [of for (of, _), c in zip(asked, lines) for _ in range(c)]
        for of, x in asked:
            x *= self.scale[of][:, None]
        sent = self.spark.sparkContext.broadcast(np.concatenate([x[:, :c].T for (_, x), c in zip(asked, lines)]))

        def add(cell, total):
            for line, numbers, of in zip(total, sent.value, sets):
                line += np.bincount(cell[0], _to_entries(cell, _term_sums(cell, numbers, of), of), len(line))

        out, got, i = self.gathered(add, len(sets)), [], 0
        sent.destroy()
        for (of, x), c in zip(asked, lines):
            z = np.zeros(x.shape)
            np.multiply(out[i:i + c].T, self.scale[of][:, None], out=z[:, :c])
            if c < x.shape[1]:
                z[:, c] = -z[:, :c].sum(axis=1)
            got.append(z)
            i += c
        return got

    def run(self, fits: list) -> list:
        """What each of ``fits`` (set, a generator like ``descent``) returns; all that still go on share a pass."""
        got, asked = [None] * len(fits), {}

        def go(i, step):
            try:
                asked[i] = step()
            except StopIteration as end:
                got[i] = end.value
                asked.pop(i, None)

        for i, (_, fit) in enumerate(fits):
            go(i, lambda: next(fit))
        while asked:
            now = list(asked)
            for i, z in zip(now, self.margins([(fits[i][0], asked[i]) for i in now])):
                go(i, lambda: fits[i][1].send(z))
        return got

    def lines(self, store: Store, of: int = 0):
        """The numbers of ``store``'s point, a line a class, broadcast."""
        numbers = store.read(POINT, NUMBERS, 0, store.rows) * self.scale[of][:, None]
        return self.spark.sparkContext.broadcast(np.ascontiguousarray(numbers.T))

    def solved(self, store: Store, losses: list[float]) -> Solved:
        """The solution at ``store``'s point over the first line of values of ``_term_cells``' cells."""
        lines, sets = self.lines(store), self.sets

        def unpacked(rows):
            for terms, *cell in rows:
                cell = _cell(cell, sets)
                w = np.stack([_term_sums(cell, line) for line in lines.value], axis=1)
                yield from zip(terms, cell[1].tolist(), w.tolist())

        coefficients = stage(arrow_map(self.cells.select("terms", "rows", "counts", "vals"), unpacked,
                                       "term string, df long, w array<double>"), "coefficients")
        return Solved(coefficients, store.free[POINT].tolist(), losses)


def _best_classes(free: list[float]):
    """(row, place of its best class) of the rows that hold a known term, from (block, idx, idf, w, rows)
    ordered by block: the first class of the largest score, with the row's weights scaled to length 1."""
    k, size = len(free), 1 << BLOCK_BITS

    def scored(block: int, held: pa.Table) -> pa.RecordBatch:
        lengths, places = _unpacked(held.column("rows"))
        idx, x = held.column("idx").to_numpy(), held.column("idf").to_numpy()
        w = held.column("w").combine_chunks().flatten().to_numpy().reshape(-1, k) * x[:, None]
        of = np.repeat(np.arange(len(idx)), lengths)
        # a row counts a lemma once that several of its tokens have
        _, which, often = np.unique(idx, return_inverse=True, return_counts=True)
        again = (often[which] > 1)[of]
        _, first = np.unique(which[of[again]] * size + places[again], return_index=True)
        keep = np.concatenate([np.flatnonzero(~again), np.flatnonzero(again)[first]])
        of, places = of[keep], places[keep].astype(np.intp)
        norm = np.sqrt(np.bincount(places, (x ** 2)[of], size))
        rows = np.flatnonzero(norm)
        z = np.stack([np.bincount(places, w[:, j][of], size)[rows] / norm[rows] + free[j] for j in range(k)], axis=1)
        return pa.record_batch({ROW_ID: pa.array((block << BLOCK_BITS) + rows, pa.int64()), "_best": pa.array(z.argmax(axis=1), pa.int32())})

    def run(batches):
        at, held = None, []
        for batch in batches:
            ends = np.flatnonzero(np.diff(batch.column("block").to_numpy())) + 1
            for i, j in zip([0, *ends], [*ends, batch.num_rows]):
                if j > i:
                    block = batch.column("block")[int(i)].as_py()
                    if held and block != at:
                        yield scored(at, pa.Table.from_batches(held))
                        held = []
                    at = block
                    held.append(batch.slice(int(i), int(j - i)))
        if held:
            yield scored(at, pa.Table.from_batches(held))

    return run


@dataclass
class ShardedModel:
    """A classifier whose vocabulary is a table: ``terms`` (term, df, idx, idf, w), ``classes``
    (label, label_idx, intercept; one row a class) and the lemma lexicon."""

    terms: DataFrame
    classes: DataFrame
    lexicon: DataFrame | None
    key: str | list = "doc_id"
    text_col: str = "text"
    losses: tuple = ()

    #: Scoring joins the term table, so a stream goes through its batches.
    streams = False

    def labels(self) -> list:
        """The classes, one row each, in the model's order."""
        return [r["label"] for r in self.classes.orderBy("label_idx").collect()]

    def with_input(self, key: str | list, text_col: str = "text") -> "ShardedModel":
        """The same fitted model reading another table's key and text columns."""
        return replace(self, key=key, text_col=text_col)

    def score(self, df: DataFrame, content: bool = True) -> DataFrame:
        """The rows of ``df`` with ``content`` and ``prediction_label``, by joins (C2, C3); without
        ``content`` neither it nor the text is kept.

        A null or empty text, or one without a known term, gets the class of the
        largest intercept; equal scores go to the first class. One row out per
        row in, also where keys repeat or are null.
        """
        clean = clean_text(df, self.text_col, processed_col=None)
        rows = with_row_ids(clean if content else clean.drop("content", self.text_col))
        packed = stage(pack(rows.select(ROW_ID, "tokens")), "packed")
        if not content:
            rows, cleaned = materialize(rows.drop("tokens")), rows
            unstage(cleaned)
        changes = None
        if self.lexicon is not None:
            changes = changed_lemmas(packed.select(F.col("term").alias("token")).distinct(), self.lexicon)
        classes = self.classes.orderBy("label_idx").collect()   # one row a class
        terms = self.terms.select("term", "idx", "idf", "w")
        slices, best = -(-packed.count() // max(SCORE_PAIRS, 2 * terms.count())) or 1, None
        for i in range(slices):   # the shuffles of one are gone before the next
            some = packed if slices == 1 else packed.where(F.pmod(F.xxhash64("block"), F.lit(slices)) == i)
            found = with_lemmas(some, changes).join(terms, "term").select("block", "idx", "idf", "w", "rows")
            scored = stage(found.repartition("block").sortWithinPartitions("block").mapInArrow(
                _best_classes([c["intercept"] for c in classes]), f"{ROW_ID} long, _best int"), "scores")
            best = scored if best is None else best.union(scored)
        unstage(packed, *([] if changes is None else [changes]))
        free = [c["intercept"] for c in classes]
        named = F.array(*[F.lit(c["label"]) for c in classes])
        return (rows.select([c for c in rows.columns if c != "tokens"]).join(best, ROW_ID, "left").drop(ROW_ID)
                .withColumn("prediction_label", F.element_at(named, F.coalesce("_best", F.lit(free.index(max(free)))) + 1))
                .drop("_best"))

    def score_rows(self, df: DataFrame) -> DataFrame:
        """C2 output: (key..., Content, Predicted Category)."""
        keys = [self.key] if isinstance(self.key, str) else list(self.key)
        return self.score(df).select(*keys, F.col("content").alias("Content"),
                                     F.col("prediction_label").alias("Predicted Category"))

    def score_distinct(self, df: DataFrame) -> DataFrame:
        """C4: one prediction per distinct content (T3), scored once."""
        keyed = df.withColumn("_content", T.sentence_trim(self.text_col))
        return (self.score_rows(keyed.dropDuplicates(["_content"]).drop("_content"))
                .select("Content", "Predicted Category"))

    def save(self, path: str) -> None:
        """Tables in a fresh folder, then a row in ``versions`` that makes it the
        current one; a save that fails leaves the last one."""
        name, keys = uuid.uuid4().hex, [self.key] if isinstance(self.key, str) else list(self.key)
        self.terms.write.parquet(f"{path}/{name}/terms")
        self.classes.coalesce(1).write.parquet(f"{path}/{name}/classes")
        if self.lexicon is not None:
            self.lexicon.write.parquet(f"{path}/{name}/lexicon")
        about = (name, time.time(), self.lexicon is not None, keys, self.text_col, list(self.losses))
        self.terms.sparkSession.createDataFrame([about], ABOUT).coalesce(1).write.mode("append").parquet(f"{path}/versions")

    @classmethod
    def load(cls, spark: SparkSession, path: str, key: str | list | None = None, text_col: str | None = None) -> "ShardedModel":
        """The version saved last; key and text column are the saved ones unless given."""
        a = spark.read.schema(ABOUT).parquet(f"{path}/versions").orderBy(F.desc("saved")).first()
        at, saved = f"{path}/{a['name']}", a["key"][0] if len(a["key"]) == 1 else list(a["key"])
        return cls(spark.read.parquet(f"{at}/terms"), spark.read.parquet(f"{at}/classes"),
                   spark.read.parquet(f"{at}/lexicon") if a["lemmas"] else None, key or saved,
                   text_col or a["text_col"], tuple(a["losses"]))


def fit_sharded(df: DataFrame, cfg: TrainConfig | None = None) -> ShardedModel:
    """M7 with the vocabulary as a table, on the training side of ``df``.

    The same cleaning, lemmas, split, weights and objective as ``plans.model.train``.
    """
    cfg = cfg or TrainConfig()
    t = training_rows(df, cfg)
    reg = cfg.reg_param if cfg.reg_param is not None else 1.0 / max(t.n, 1)
    if t.n * len(t.names) <= ROW_NUMBERS:
        got = solve_packed(t.pairs, t.labels, len(t.names), t.n, reg, cfg.max_iter, cfg.tol, HISTORY, t.n_entries, cfg.min_df)
        terms = FT.idf_table(FT.vocabulary_index(got.coefficients), t.n)
    else:
        prep = with_row_ids(with_terms(t.rows, t.changes).select(cfg.label_col, "terms"))
        long = prep.select(F.col(ROW_ID).alias("row"), F.explode(F.array_distinct("terms")).alias("term"))
        vocabulary = materialize(FT.idf_table(FT.vocabulary_index(FT.vocabulary(long, "row", int(cfg.min_df))), t.n))
        weights = FT.tfidf(long, vocabulary.select("term", "idx", "idf"), "row", keep=["idx"])
        entries = weights.select("row", "idx", F.col("weight").alias("value"))
        labels = prep.join(F.broadcast(t.index), cfg.label_col).select(F.col(ROW_ID).alias("row"), "label_idx")
        got = solve(entries, materialize(labels), len(t.names), vocabulary.count(), reg, cfg.max_iter, cfg.tol)
        terms = vocabulary.join(got.coefficients, "idx")
    return t.model(terms, got, cfg)


@dataclass
class TrainingRows:
    """Cleaned training rows: ``rows`` (label, tokens, numbered), ``index`` (label, label_idx), ``labels`` (row,
    label_idx, and ``fold`` if asked for), ``pairs`` (``pack``'s, by lemma), all staged but the pairs; the lexicon and the
    lemmas that differ; class names; numbers of rows and of (row, token) entries."""

    rows: DataFrame
    index: DataFrame
    labels: DataFrame
    packed: DataFrame
    pairs: DataFrame
    lexicon: DataFrame | None
    changes: DataFrame | None
    names: list
    n: int
    n_entries: int

    def model(self, terms: DataFrame, got: Solved, cfg: TrainConfig) -> ShardedModel:
        """The model of a solution; the staged rows, and what ``terms`` was made of, are deleted."""
        made, terms = terms, materialize(terms.select("term", "df", "idx", "idf", "w"))
        unstage(made, got.coefficients)
        classes = terms.sparkSession.createDataFrame(
            [(c, i, b) for i, (c, b) in enumerate(zip(self.names, got.intercepts))],
            f"label {self.index.schema[cfg.label_col].dataType.simpleString()}, label_idx long, intercept double")
        unstage(self.rows, self.packed, self.labels, *([] if self.changes is None else [self.changes]))
        return ShardedModel(terms, classes, self.lexicon, cfg.key, cfg.text_col, tuple(got.losses))


def training_rows(df: DataFrame, cfg: TrainConfig, fold=None) -> TrainingRows:
    """The training side of ``df``, cleaned; the same rows, lemmas and lexicon as in ``cleaned_rows``.

    ``fold``: a column of the rows for ``labels``."""
    trn, _ = sides(df, cfg)
    rows = with_row_ids(prepare(bounded(trn, cfg), cfg))   # regex cleaning runs once
    packed = stage(pack(rows.select(ROW_ID, "tokens")), "packed")
    lexicon = changes = None
    if cfg.lemmas:
        lexicon = materialize(packed.select(F.col("term").alias("form")).distinct())
        changes = changed_lemmas(lexicon, lexicon)
    index = materialize(FT.label_index(rows, cfg.label_col))
    names = [r[cfg.label_col] for r in index.orderBy("label_idx").collect()]   # one row a class
    labels = materialize(rows.join(F.broadcast(index), cfg.label_col).select(
        F.col(ROW_ID).alias("row"), "label_idx", *([] if fold is None else [fold.alias("fold")])))
    n, n_entries = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()
    pairs = with_lemmas(packed, changes).where(F.length("term") >= 2)
    return TrainingRows(rows, index, labels, packed, pairs, lexicon, changes, names, n, n_entries)


def predictions(model: ShardedModel, df: DataFrame, cfg: TrainConfig) -> DataFrame:
    """(key, label, prediction) on the whole test split of ``df``."""
    return model.score(held_out(df, cfg)).select(
        cfg.key, F.col(cfg.label_col).alias("label"), F.col("prediction_label").alias("prediction"))


def train_sharded(df: DataFrame, cfg: TrainConfig | None = None):
    """M15 with the vocabulary as a table: (ShardedModel, predictions on the whole test split)."""
    cfg = cfg or TrainConfig()
    model = fit_sharded(df, cfg)
    return model, predictions(model, df, cfg)
